"""Connected components of an edge list by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import files_for
from panelkit.session import materialize

#: Edges that a checkpointed file of a round should hold; fewer make a file for each shuffle partition, however small.
EDGES_PER_FILE = 50_000


def _smallest(edges: DataFrame) -> DataFrame:
    """``u, m``: each node's smallest neighbour or itself. Combined before the shuffle, so a hub is cheap."""
    return edges.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))


def _state(edges: DataFrame):
    """Number and digest of the edges."""
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def connected_components(edges: DataFrame, files: int | None = None) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns a, b), root being the component's smallest node.

    Each round hangs the larger neighbours of every node on its smallest one
    (large star), then the smaller ones (small star), until nothing changes;
    the number of rounds grows with the logarithm of the longest chain. Edges
    stay distributed and are checkpointed each round, in files for their number
    (at first in ``files`` at most): a round never adds edges. Self loops and repeated
    edges are harmless; nodes with only self loops are left out; no edges give no rows.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = materialize(e.coalesce(files) if files else e)
    state = _state(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.join(_smallest(both), "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = _smallest(large)
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        e = materialize(small.coalesce(files_for(state[0], EDGES_PER_FILE)))
        now = _state(e)
        if now == state:
            break
        state = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
