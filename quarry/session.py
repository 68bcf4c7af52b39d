"""Session construction, table access and lineage cuts."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def build_session(master: str | None = None, app: str = "quarry",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Session with AQE on, UI off, UTC time zone and Arrow enabled.

    On a cluster ``master`` stays None and the launcher decides; locally the
    caller passes ``local[N]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        # reliable checkpoints (cut_lineage) are removed once their DataFrame is gone
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: ``spark.checkpoint.dir``, else the one the context was given.

    The cluster's setting always wins. Only a local session (tests) may leave it
    unset and gets a fresh scratch folder; elsewhere that would put checkpoints
    on the disks of single machines, so it is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or _LOCAL_FOLDERS.get(spark.sparkContext.applicationId)
    d = d or spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", None) or ""):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = _LOCAL_FOLDERS[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="quarry-ckpt-")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
    if spark.sparkContext.applicationId not in _REGISTERED:
        spark.sparkContext.setCheckpointDir(d)
        _REGISTERED.add(spark.sparkContext.applicationId)
    return d


_LOCAL_FOLDERS: dict[str, str] = {}
_REGISTERED: set[str] = set()


@contextmanager
def scratch(spark: SparkSession, name: str):
    """A fresh folder inside the shared checkpoint folder, removed at the end of the block.

    What outlives the block must be written elsewhere or pass ``cut_lineage``.
    """
    folder = os.path.join(checkpoint_dir(spark), "scratch", f"{name}-{uuid.uuid4().hex}")
    try:
        yield folder
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``quarry`` importable in Python workers (zip + ``addPyFile``), once per application.

    Operators that run Python in tasks (pandas UDFs, ``applyInPandas``,
    ``mapInPandas``) call this; a cluster deployment that installs the package
    on the executors does not need it, and it is harmless there.
    """
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # pragma: no cover - Spark Connect
        return
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(checkpoint_dir(spark), "pyfiles", app)
    if "://" in base and not base.startswith("file:"):
        base = tempfile.mkdtemp(prefix="quarry-pyfiles-")   # archive is built locally, Spark ships it
    base = base.replace("file:", "")
    os.makedirs(base, exist_ok=True)
    archive = shutil.make_archive(os.path.join(base, "quarry"), "zip", os.path.dirname(pkg), "quarry")
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)
