"""A corpus from raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept.  All
but the last return the columns of documents.  ``run`` writes every stage's result as
Parquet in the shared folder and reads it again for the next.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slabwise.llm.common import shared_dir
from slabwise.llm.language_id import UNKNOWN, predict, train
from slabwise.llm.line_dedup import line_dedup
from slabwise.llm.mixing import mixed_documents
from slabwise.llm.ngram_join import ngram_groups
from slabwise.llm.packing import pack

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go (null texts and texts without a letter); the others
    carry the predicted one in ``lang``.  If no row is labelled nothing can be predicted, and
    the others stay as they are.  Repeated rows, rows without an id and very long texts are
    judged like any other; ties go to the first language by name.  Clashing names do no harm."""
    rows = docs.select(*COLUMNS)
    model = train(rows)
    if model is None:
        return rows.where(F.rlike("text", F.lit(r"\p{L}")))
    found = predict(rows, model, *COLUMNS).where(F.col("lang_pred") != UNKNOWN)
    return found.select("doc_id", "text", F.col("lang_pred").alias("lang"), "source", "n_chars")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand in three documents or more stay in the last of these only.  Every
    document stays, with the text that is left of it."""
    kept = line_dedup(docs.select(*COLUMNS), min_chars=20, min_docs=3, with_text=True, more=("lang", "source"))
    return kept.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("long").alias("n_chars"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest id: five-word shingles,
    similarity 0.8 or more.  Texts without words link with nothing and stay, as do all rows
    without an id; rows that repeat an id and its text stay once.  Long texts count whole."""
    return ngram_groups(docs.select(*COLUMNS), size=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares: documents come as often as the mix takes them.
    A null source is one of its own, the last; null and empty texts have no size.  Sources
    tied at the level get the same share; long documents are taken whole or not at all."""
    return mixed_documents(docs.select(*COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 1,024 tokens.  Null and empty texts are one end
    token; repeated rows are packed as often as they come; longer texts are cut, none is left out."""
    return pack(docs, capacity=1024)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Language identification and tokens are not expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.

    The tables between the stages lie below ``spark.checkpoint.dir`` and belong to the
    caller: the result reads the last of them.
    """
    folder = f"{shared_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex[:12]}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
