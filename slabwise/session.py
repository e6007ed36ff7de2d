"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from slabwise.schema import ArrayError

CHECKPOINT_DIR = "spark.checkpoint.dir"
LOCAL_SCRATCH = "spark.slabwise.localScratch"


def build_session(app: str = "slabwise", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the package is tested with.

    On a cluster leave ``master`` to spark-submit; adaptive execution then
    sizes shuffles and splits skewed join partitions.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name for intermediate tables, on storage every executor sees.

    The folder lies below ``spark.checkpoint.dir``.  Only a local session, where
    driver and executors share one machine, may fall back to a temporary folder.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ArrayError(f"set {CHECKPOINT_DIR} to a folder shared by the cluster")
        base = spark.conf.get(LOCAL_SCRATCH, None) or tempfile.mkdtemp(prefix="slabwise-")
        spark.conf.set(LOCAL_SCRATCH, base)
    # Spark and pyarrow must agree on the file system, so the name is qualified.
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}")
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(folder).toString()


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Scans run Python on the executors, where the package need not be installed.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="slabwise-package-")) / "slabwise.zip"
    with zipfile.ZipFile(archive, "w") as bundle:
        for source in sorted(root.rglob("*.py")):
            bundle.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def task_count(spark: SparkSession) -> int:
    """Tasks for work whose rows are tiny but costly, such as file headers.

    Adaptive execution would merge such rows into one task by their size, so
    these repartitions name a number, which it leaves alone.
    """
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(shuffle, spark.sparkContext.defaultParallelism)
