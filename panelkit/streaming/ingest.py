"""Incremental snapshot ingestion: ``readStream`` over the landing root, ``availableNow``.

Each run picks up only files not seen before (the file source's checkpoint
tracks them) and writes them to a landed mirror, one folder per micro-batch,
partitioned by ``dt``. From that folder alone a batch adds its part to the
manifest. The curated table is rebuilt only if the batch holds records of the
newest snapshot after the floor, from the files of that snapshot. A
late-arriving older ``dt`` therefore never changes the curated result, and
re-running with no new files is a no-op. The trigger message of the studied
job carried no data; here the trigger is the arrival of files.

Manifest and curated table are versions named by the batch (``versions``):
readers never miss them, and a batch that is run again after a crash neither
counts twice nor touches what is committed. Checkpoint, mirror, manifest and
curated table belong together; a new checkpoint needs new folders.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelkit.constants import SNAPSHOT_FLOOR
from panelkit.sources.snapshots import (PARTITION_FIELDS, manifest_label, manifest_part, merge_parts, last_after,
                                        open_files, partition_dates)
from panelkit.streaming import versions

#: Committed versions that stay for readers of an older one.
KEEP_VERSIONS = 3


def count_part(df: DataFrame) -> DataFrame:
    """The plainest manifest: records per snapshot."""
    return df.groupBy("dt").agg(F.count(F.lit(1)).alias("n_records"))


def ingest_available_now(spark: SparkSession, landing_root: str, record_schema: StructType,
                         mirror_path: str, curated_path: str, manifest_path: str, checkpoint: str,
                         curate: Callable[[DataFrame], DataFrame], floor=SNAPSHOT_FLOOR,
                         fmt: str = "json",
                         summarize: Callable[[DataFrame], DataFrame] = manifest_part) -> None:
    """Process every new landed file once, then stop (``Trigger.AvailableNow``), however long that takes.

    ``summarize`` gives a batch's part of the manifest, by ``dt`` (default: the event manifest's record count, max
    document number, max publication date); parts are merged by ``merge_parts``. Read the results with
    ``read_curated`` and ``read_manifest``.
    """
    schema = StructType(list(record_schema.fields) + PARTITION_FIELDS)
    reader = spark.readStream.schema(schema).format(fmt).option("basePath", landing_root)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    stream = reader.load(landing_root)

    def landed(session: SparkSession, *under: str) -> DataFrame:
        """The mirror's files below some folders; nothing else is listed, no schema is inferred."""
        path = "/".join([mirror_path.rstrip("/"), *under])
        return session.read.schema(schema).option("basePath", mirror_path).parquet(path).select(*schema.names)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        # foreachBatch is at-least-once: each batch owns a folder that a retry
        # overwrites, so a replayed batch never duplicates rows
        session, own = batch.sparkSession, f"batch={batch_id}"
        with open_files(session):
            batch.write.mode("overwrite").partitionBy("dt", "lang").parquet(f"{mirror_path}/{own}")
        dates = partition_dates(session, f"{mirror_path}/{own}")
        if not dates:
            return
        if not versions.applied(session, manifest_path, batch_id):
            part, before = summarize(landed(session, own)), versions.read_current(session, manifest_path)
            whole = part if before is None else before.unionByName(part)
            versions.write(merge_parts(whole), manifest_path, batch_id)
            versions.commit(session, manifest_path, batch_id)
        # the newest date is known from the listing of the mirror's folders
        newest = last_after(partition_dates(session, mirror_path, "dt", under="batch=*"), floor)
        if not versions.applied(session, curated_path, batch_id) and (
                newest in dates or not versions.committed(session, curated_path)):
            rows = landed(session, own).where("false") if newest is None else landed(session, "batch=*", f"dt={newest}")
            versions.write(curate(rows), curated_path, batch_id)
            versions.commit(session, curated_path, batch_id)
        for root in (manifest_path, curated_path):
            versions.prune(session, root, KEEP_VERSIONS)

    q = (stream.writeStream.foreachBatch(on_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def read_curated(spark: SparkSession, curated_path: str) -> DataFrame | None:
    """The curated table as last committed, None before the first batch."""
    return versions.read_current(spark, curated_path)


def read_manifest(spark: SparkSession, manifest_path: str,
                  final: Callable[[DataFrame], DataFrame] = manifest_label) -> DataFrame | None:
    """The manifest of all committed batches, one row per ``dt``."""
    parts = versions.read_current(spark, manifest_path)
    return None if parts is None else final(parts)


@dataclass(frozen=True)
class Source:
    """One landed source: its record schema, format, and how its newest snapshot is curated and summarised."""

    name: str
    schema: StructType
    curate: Callable[[DataFrame], DataFrame]
    fmt: str = "json"
    summarize: Callable[[DataFrame], DataFrame] = count_part


def ingest_sources(spark: SparkSession, sources: Sequence[Source], landing_root: str, out_root: str,
                   floor=SNAPSHOT_FLOOR) -> dict[str, str]:
    """Ingest every source in the stated order, as one trigger does; the curated table's path (``read_curated``) by source.

    Each source lands under ``<landing_root>/<name>`` and keeps its own mirror,
    manifest and checkpoint under ``<out_root>/<name>``. A source that fails
    raises after the ones before it are complete; the next run takes up from there.
    """
    curated = {}
    for src in sources:
        base = f"{out_root}/{src.name}"
        ingest_available_now(spark, f"{landing_root}/{src.name}", src.schema, f"{base}/mirror", f"{base}/curated",
                             f"{base}/manifest", f"{base}/_checkpoint", src.curate, floor, src.fmt, src.summarize)
        curated[src.name] = f"{base}/curated"
    return curated
