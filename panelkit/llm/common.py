"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A table of at most this many short rows may be broadcast. The rows are
#: counted first; a larger table takes the shuffle join.
BROADCAST_ROWS = 100_000
#: Rows of an Arrow batch that are Python objects at a time.
ROWS_AT_ONCE = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    """The column as a string, null counting as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting the rows; ``df`` should be materialised.

    The count stops at ``limit + 1`` rows, so it is cheap however large ``df`` is.
    """
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def files_for(n_rows: int, rows_per_file: int) -> int:
    """Files for a table of short rows; at least one."""
    return max(1, -(-n_rows // rows_per_file))


def whole_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct ``row``, so that they cannot clash with added ones."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


def one_row(df: DataFrame, keys: list[str]) -> DataFrame:
    """Unpack ``row`` once per key: the smallest row where rows can be ordered, else any."""
    kind = df.schema["row"].dataType.simpleString()
    pick = F.any_value if "map<" in kind or "variant" in kind else F.min
    return df.groupBy(*keys).agg(pick("row").alias("row")).select("row.*")


def map_columns(df: DataFrame, make: Callable[[], Callable[..., tuple]], schema: str, keep: list[str],
                args: list[str]) -> DataFrame:
    """Add columns computed in Python, batch by batch, next to the kept ones.

    ``make`` runs once per task (load tables there) and returns a function of
    one row's ``args`` that gives a tuple with the values of ``schema``. Only
    one Arrow batch is held at a time, ROWS_AT_ONCE of its rows as Python objects, and
    rows are handled one by one. What Arrow keeps for later is given back as the task ends.
    """
    names = [part.split()[0] for part in schema.split(",")]
    src = df.select(*keep, *[F.col(a).alias(f"arg_{i}") for i, a in enumerate(args)])
    out_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:len(keep)])
    out_schema = ", ".join(x for x in (out_schema, schema) if x)
    n_keep = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            rows = []
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                cols = [c.to_pylist() for c in batch.slice(at, ROWS_AT_ONCE).columns[n_keep:]]
                rows.extend(fn(*values) for values in zip(*cols))
            made = list(zip(*rows)) if rows else [() for _ in names]
            yield pa.RecordBatch.from_arrays(
                batch.columns[:n_keep] + [pa.array(list(values)) if rows else pa.array([], pa.null())
                                          for values in made],
                names=keep + names)
        batch = cols = None
        pa.default_memory_pool().release_unused()

    return src.mapInArrow(run, out_schema)
