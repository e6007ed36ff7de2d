import hashlib

import pytest

from slabwise.llm.fingerprints import _likeness, fingerprint_edits, lexicon, terms
from pyspark.sql import functions as F


def edited(rows):
    """Edited text of every row with a distinct id."""
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for k, (i, text, *_) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        out[i] = (len(text), hashlib.sha256((text[: len(text) - half] + following[:half]).encode()).hexdigest())
    return out


@pytest.mark.parametrize("n", [1, 2, 60])
def test_edited_texts(frame, prose, n):
    rows = [(i * 13 - 50, text + " Ünïcode 😀" * (i % 3)) for i, text in enumerate(prose(n, n=n))]
    got = fingerprint_edits(frame(rows)).collect()
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == edited(rows)


def test_fingerprints_tell_texts_apart(frame, prose):
    rows = [*enumerate(prose(3, n=150, words=300))] + [(1000, "the copied text of three words"), (1001, "the copied text of three words")]
    got = {r.doc_id: r for r in fingerprint_edits(frame(rows), least=0.01, most=0.5).collect()}
    assert got[1000].fingerprint == got[1001].fingerprint and got[1001].near_next == 1.0
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got.values())
    mean = lambda name: sum(getattr(r, name) for r in got.values()) / len(got)
    assert mean("near_edited") > 3 * mean("near_next")


def test_equal_texts_have_equal_fingerprints(frame, messy):
    got = fingerprint_edits(frame(messy)).collect()
    assert len(got) == len(messy)
    prints = {}
    for r in got:
        prints.setdefault((r.doc_id, r.n_chars), set()).add(r.fingerprint)
    assert all(len(p) == 1 for k, p in prints.items() if k[0] != 9)
    empty = {r.fingerprint for r in got if r.n_chars == 0}
    assert len(empty) == 1 and all(r.fingerprint for r in got)


def test_empty_table(frame):
    assert fingerprint_edits(frame([])).collect() == []


def test_lexicon_is_a_band(frame):
    rows = [(i, "every " + "half " * (i % 2) + f"own{i} " + ("rare " if i < 2 else "")) for i in range(40)]
    got = {r.term for r in lexicon(frame(rows).select("text"), least=0.04, most=0.6).collect()}
    assert got == {"half", "rare"}
    assert sorted(frame([(1, "B a  b\tA")]).select(terms("text").alias("t")).first().t) == ["a", "b"]
    assert frame([(1, None)]).select(F.size(F.coalesce(terms("text"), F.array())).alias("n")).first().n == 0


def test_copies_and_near_copies_keep_their_terms(frame, prose):
    texts = [t for t in prose(5, n=200, words=300) if len(t) > 400]
    words = [f"own{k} shared{k % 40}" for k in range(60)]
    copies = [" ".join(words)] * 40 + [" ".join([*words[:k], f"edit{k}", *words[k + 1 :]]) for k in range(40)]
    rows = [*enumerate(texts + copies)]
    known = {r.term for r in lexicon(frame(rows).select("text"), least=0.001, most=0.1).collect()}
    assert sum(f"own{k}" in known for k in range(60)) > 20  # one of two is drawn
    got = {r.doc_id: r for r in fingerprint_edits(frame(rows)).collect()}
    near = [got[k].near_next for k in range(len(texts) + 42, len(rows))]
    assert sum(near) / len(near) > 0.7 and sum(got[k].near_edited for k in range(len(texts) + 1, len(rows))) / 79 > 0.2


def test_short_equal_texts_are_alike(frame):
    rows = [(2 * i + k, " ".join(f"t{(i + j) % 50}" for j in range(1 + i % 3))) for i in range(100) for k in range(2)]
    got = {r.doc_id: r for r in fingerprint_edits(frame(rows), least=0.0, most=1.0).collect()}
    assert all(got[2 * i + 1].near_next == 1.0 and got[2 * i + 1].fingerprint == got[2 * i].fingerprint for i in range(100))


def test_every_term_of_the_lexicon_is_looked_at(frame):
    rows = [(2 * i + k, f"same words here {'x' if k else 'y'}{i}") for i in range(60) for k in range(2)]
    rows += [(1000 + i, f"{a}{i}") for i in range(60) for a in "xy"]
    got = {r.doc_id: r for r in fingerprint_edits(frame(rows), least=0.0, most=1.0).collect()}
    assert all(got[2 * i + 1].near_next < 1 for i in range(60))


def test_a_sparse_density_without_terms_gives_way(spark):
    v = lambda level, subset: (level, subset, 7)
    schema = "a array<struct<level int, subset bigint, value bigint>>, b array<struct<level int, subset bigint, value bigint>>, n bigint"
    df = spark.createDataFrame([([v(0, 1), v(0, 2)], [v(0, 1), v(0, 3)], 100), ([v(0, 1), v(1, 2)], [v(0, 1), v(1, 2)], 100)], schema)
    assert [r.x for r in df.select(_likeness(F.col("a"), F.col("n"), F.col("b"), F.col("n")).alias("x")).collect()] == [1 / 3, 1.0]
