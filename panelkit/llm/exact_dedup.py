"""Exact dedup by a tree merge of sorted digest runs.

Every input partition sorts its digests into one run, equal digests reduced to
the smallest identifier and a count. The runs then meet in rounds on a
binomial tree of fan-in ``FAN_IN``: a run starts at a node with the number
``(o_1 .. o_R)`` in base ``FAN_IN``; round r replaces the digit ``o_r`` by the
r-th digit of the digest, so the ``FAN_IN`` nodes that differ only in that
digit exchange parts of their runs. Each node brings what it gets into order (by Spark's sort,
which merges spilled runs, not the ones that were sent) and again keeps one row per digest. After R rounds all rows of a digest
are in the node that its own digits name. R follows the number of rows, so a
node holds about ``ROWS_PER_NODE`` digests at any size.

A text that holds a third of all rows is reduced in every partition first, so
no node ever reads more than ``FAN_IN`` rows of it in a round.

The merge key is a 128-bit digest (MD5). A match is verified at every level by
the SHA-256 and the length of the normalised text: rows that agree in the key
but not in these stay apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import one_row, text_or_empty, whole_row
from panelkit.session import materialize

#: Nodes that exchange runs in a round (a power of two), and digests a node should hold.
FAN_IN = 4
ROWS_PER_NODE = 1_000_000
#: A group of more than this share of all rows is joined by broadcast; there are fewer than HOT such groups.
HOT = 1_000

#: White space runs that count as one space.
SPACES = r"[\x20\x09-\x0D]+"

RUN_SCHEMA = "origin int, key binary, sha binary, n_bytes long, keep_id long, group_size long"
_VERIFY = ["key", "sha", "n_bytes"]


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id, key, sha, n_bytes`` of each row's whitespace-normalised text."""
    norm = F.regexp_replace(text_or_empty(), SPACES, " ")
    return (docs.select("doc_id", norm.alias("norm"))
            .select("doc_id", F.unhex(F.md5("norm")).alias("key"), F.unhex(F.sha2("norm", 256)).alias("sha"),
                    F.octet_length("norm").cast("long").alias("n_bytes")))


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reduce a sorted stream: one row per verified digest, smallest identifier, summed count.

    The last row of a batch is held back, since its digest may go on in the next one.
    """
    held = None
    names = ["origin", *_VERIFY]
    for batch in batches:
        if batch.num_rows == 0:
            continue
        # all columns nullable, as they come out of the aggregate: Spark marks some of a first run's as not null
        part = pa.table(batch.columns, names=batch.schema.names)
        if held is not None:
            part = pa.concat_tables([held, part])
        last = part.slice(part.num_rows - 1).to_pylist()[0]
        part = (part.combine_chunks().group_by(names, use_threads=False)
                .aggregate([("keep_id", "min"), ("group_size", "sum")])
                .rename_columns([*names, "keep_id", "group_size"]))
        # groups come in no set order, so the one that may go on is found by its key
        goes_on = pc.and_(pc.equal(part["origin"], last["origin"]), pc.equal(part["key"], last["key"]))
        goes_on = pc.and_(goes_on, pc.and_(pc.equal(part["sha"], last["sha"]),
                                           pc.equal(part["n_bytes"], last["n_bytes"])))
        held = part.filter(goes_on)
        yield from part.filter(pc.invert(goes_on)).to_batches()
    if held is not None:
        yield from held.to_batches()


def _sorted_run(df: DataFrame) -> DataFrame:
    return (df.select("origin", *_VERIFY, "keep_id", "group_size")
            .sortWithinPartitions("origin", *_VERIFY, F.col("keep_id").asc_nulls_last())
            .mapInArrow(_merge, RUN_SCHEMA))


def rounds_for(n_rows: int) -> int:
    """Rounds of a tree whose FAN_IN ** rounds nodes hold ROWS_PER_NODE digests each; at least two."""
    rounds = 2
    while FAN_IN ** rounds * ROWS_PER_NODE < n_rows:
        rounds += 1
    return rounds


def merge_runs(rows: DataFrame) -> DataFrame:
    """``key, sha, n_bytes, keep_id, group_size``: one row per distinct text of ``digests(docs)``.

    ``rows`` should be materialised: it is counted first.
    """
    rounds = rounds_for(rows.count())
    nodes = FAN_IN ** rounds
    home = F.pmod(F.conv(F.substring(F.hex("key"), 1, 15), 16, 10).cast("long"), F.lit(nodes)).cast("int")
    runs = _sorted_run(rows.select(F.pmod(F.spark_partition_id(), F.lit(nodes)).alias("origin"), *_VERIFY,
                                   F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size")))
    for r in range(rounds):
        place = FAN_IN ** r

        def digit(c):
            return F.floor(c / place) % FAN_IN

        node = (F.col("origin") + (digit(home) - digit(F.col("origin"))) * place).cast("int")
        runs = _sorted_run(runs.withColumn("origin", node).repartitionById(nodes, "origin"))
    return runs.drop("origin")


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after each run of white space becomes one
    space. Null text counts as empty; empty texts are a group like any other.
    ``keep_id`` is the smallest doc_id of the group (null ids come last, so it is
    null only if every id is). Of repeated rows with the same id and text all have
    ``kept`` true; ``keep_first`` leaves one of them. An empty table gives no rows.
    Columns other than doc_id and text are ignored, whatever their names.
    """
    rows = materialize(digests(docs))
    groups = materialize(merge_runs(rows))
    hot = F.col("group_size") > rows.count() / HOT
    large = F.broadcast(groups.where(hot))
    return (rows.join(large, _VERIFY).unionByName(
                rows.join(large.select(*_VERIFY), _VERIFY, "left_anti").join(groups.where(~hot), _VERIFY))
            .select("doc_id", "keep_id", "group_size",
                    F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    F.lower(F.hex("sha")).alias("text_sha256")))


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` with one row per distinct text: the one with the smallest doc_id.

    All columns are returned unchanged. Of rows that repeat both id and text, the
    smallest by the remaining columns stays. Whole texts cross the network once.
    """
    win = merge_runs(materialize(digests(docs))).select(F.col("key").alias("k_key"), F.col("sha").alias("k_sha"),
                                                        "keep_id")
    norm = F.regexp_replace(text_or_empty(), SPACES, " ")
    tagged = docs.select(whole_row(docs), F.col("doc_id").alias("k_id"), F.unhex(F.md5(norm)).alias("key"),
                         F.unhex(F.sha2(norm, 256)).alias("sha"))
    hit = tagged.join(win, F.col("k_id").eqNullSafe(F.col("keep_id")) & (F.col("key") == F.col("k_key"))
                      & (F.col("sha") == F.col("k_sha")))
    return one_row(hit, ["k_id", "key", "sha"])
