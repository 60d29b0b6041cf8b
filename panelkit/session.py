"""Session construction and the shared work folder.

On a cluster the shared folder comes from ``spark.checkpoint.dir`` (set by
whoever launches the job). Only when it is unset (local runs, tests) do we
create one under the system temp folder.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "panelkit",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


#: The application that has this package on its workers, and the archive sent there.
_SHIPPED: dict[str, str] = {}


def ship_package(spark: SparkSession) -> str:
    """Send this package's source to the Python workers, which import it in grouped-map functions.

    Spark distributes the archive itself (``addPyFile``), once for each application. Not needed where the
    package is installed on every machine.
    """
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        here = Path(__file__).resolve().parent
        if here.is_dir():
            stage = Path(tempfile.mkdtemp(prefix="panelkit-ship-"))
            shutil.copytree(here, stage / "src" / here.name, ignore=shutil.ignore_patterns("__pycache__"))
            archive = shutil.make_archive(str(stage / here.name), "zip", stage / "src")
            spark.sparkContext.addPyFile(archive)
            _SHIPPED[app] = archive
        else:  # already running from an archive
            _SHIPPED[app] = str(here.parent)
    return _SHIPPED[app]


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when nothing is configured (local runs and
    tests) a fresh local folder is created and registered.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store): "
                               "a machine-local folder does not survive executor loss on a cluster")
        root = tempfile.mkdtemp(prefix="panelkit-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    root = checkpoint_root(spark)
    path = f"{root}/panelkit/{name}-{uuid.uuid4().hex[:12]}"
    if "://" not in path:
        os.makedirs(path, exist_ok=True)
    return path


def materialize(df):
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder.

    Used on small panel-grain frames that feed several branches (model fits,
    projections), so the event aggregation upstream is not recomputed per
    branch. Never ``localCheckpoint``: executors may be lost.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
