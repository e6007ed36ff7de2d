"""What the operators of this subpackage share."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slabwise.session import ship_package

CHECKPOINT_DIR = "spark.checkpoint.dir"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

#: Stands for a null doc_id in comparisons: rows without one come last.
NO_ID = 2**63 - 1

#: A word, as a regular expression of Spark and DuckDB alike.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees, from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set(CHECKPOINT_DIR, base)
    return base


def cut(df: DataFrame) -> DataFrame:
    """The same rows without their history, kept by checkpoint() in the shared folder."""
    spark = df.sparkSession
    shared = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared)
    return df.checkpoint()


def prepare(spark: SparkSession) -> None:
    """Make a session ready for passes over texts in Python.

    The package goes to the executors, where it need not be installed.  Batches of rows are
    bounded by bytes, since texts may be long; a bound the session has set already stays.
    """
    ship_package(spark)
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, str(4 << 20))


def documents(df: DataFrame, *more: Column) -> DataFrame:
    """``doc_id``, ``text`` and the given columns only, so that no other name can clash."""
    prepare(df.sparkSession)
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def text_keys(text: Column | str) -> tuple[Column, Column]:
    """128 bits of a text in two numbers; null and empty texts are told apart."""
    text = F.col(text) if isinstance(text, str) else text
    return F.xxhash64(F.lit(1), text, F.length(text)), F.xxhash64(F.lit(2), text, text.isNull())


def word_count(text: Column | str) -> Column:
    """Number of words of a text, 0 for null."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
