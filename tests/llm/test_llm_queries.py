"""The registered queries against their SQL, and the pipeline against brute force."""

import sys
from collections import Counter
from pathlib import Path

import pytest
from test_dedup import brute_lines
from test_ngram_join import brute as brute_groups

import __spark_entry__ as contract
import corpus_pipeline
from slabwise.llm.mixing import mix
from slabwise.llm.queries import QUERIES, SQL

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))
from compare import compare  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert compare(spark, SF_DIR, name) == []


def test_names():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(contract.queries())


def test_each_stage_on_its_own_input(spark, tmp_path):
    docs, rows = spark.read.parquet(f"{SF_DIR}/documents.parquet"), None
    odd = spark.createDataFrame([(10_000, None, "en", "s", 0), (10_001, "1 2 3", None, None, 5), (10_002, "only words", None, None, 10)], docs.schema)
    docs = docs.unionByName(odd)
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]
        stage(spark, docs, SF_DIR).write.parquet(path := str(tmp_path / str(number)))
        after = spark.read.parquet(path)
        got = after.collect()
        if number < 4:
            assert after.columns == docs.columns
        if name == "language_id":
            assert {r.doc_id for r in got} == {i for i, *_ in before} - {10_000, 10_001}
            assert {(r.doc_id, r.text) for r in got} <= {(i, t) for i, t, *_ in before}
            truth = {i: lang for i, _, lang, _ in before}
            assert sum(r.lang != truth[r.doc_id] for r in got if truth[r.doc_id]) <= 0.02 * len(got)
        if name == "line_dedup":
            assert Counter((r.doc_id, r.text, r.n_chars) for r in got) == Counter({(i, kept, len(kept)): n for (i, _, _, kept), n in brute_lines(before).items()})
        if name == "ngram_join":
            assert Counter(r.doc_id for r in got) == Counter(i for i, _, c in brute_groups(before, 5, 80) if i == c)
        if name == "mixing":
            times = Counter(r.doc_id for r in got)
            assert all(times[r.doc_id] == (int(r.taken / r.size + 0.5) if r.size else 0) for r in mix(docs).collect())
        if name == "packing":
            assert sum(r.piece == 0 for r in got) == len(before) and max(r.offset + r.length for r in got) <= 1024
        docs = after


def test_run(spark):
    got = corpus_pipeline.run(spark, SF_DIR)
    assert got.count() > 100 and "sequence_id" in got.columns


def test_without_labels_texts_with_letters_stay(spark):
    rows = [(1, "some words", None, "s", 10), (2, "1 2 3", None, None, 5), (3, None, None, None, None), (4, "漢字", None, None, 2), (4, "漢字", None, None, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.language_id(spark, docs, SF_DIR)
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect()) == [1, 4, 4]
