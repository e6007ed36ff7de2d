import hashlib

import numpy as np
import pyarrow as pa
import pytest

from slabwise.llm.streams import after_first, combine, in_several
from slabwise.llm.substring_dedup import levels, substring_dedup
from slabwise.llm.words import Words, minimisers, pieces, window_hashes


def brute(rows, window):
    first = {}
    texts = [(2**63 if i is None else i, (t or "").encode().split()) for i, t, *_ in rows]
    for i, words in texts:
        for p in range(len(words) - window + 1):
            key = tuple(words[p : p + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for (i, *_), (own, words) in zip(rows, texts, strict=True):
        gone = set()
        for p in range(len(words) - window + 1):
            if first[tuple(words[p : p + window])] < own:
                gone |= set(range(p, p + window))
        kept = b" ".join(w for p, w in enumerate(words) if p not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def ours(df, window, **options):
    return sorted((tuple(r[:4]) for r in substring_dedup(df, window, **options).collect()), key=str)


@pytest.mark.parametrize("window", [1, 10, 17, 50])
def test_equals_brute_force(frame, prose, window):
    rows = [(i * 3 % 61, text) for i, text in enumerate(prose(window))]
    assert ours(frame(rows), window) == brute(rows, window)


def test_odd_rows(frame, messy):
    rows = [r for r in messy if len(r[1] or "") < 100_000]
    assert ours(frame(rows), 20) == brute(rows, 20)
    assert len(ours(frame(messy), 50)) == len(messy)


def test_empty_table(frame):
    assert ours(frame([]), 50) == []


def test_kept_text(frame):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(1, f"start {passage} end"), (2, f"other  {passage}\nlast")]
    kept = {r.doc_id: r.kept for r in substring_dedup(frame(rows), 50, with_text=True).collect()}
    assert kept == {1: f"start {passage} end", 2: "other last"}


def test_levels():
    assert levels(50) == [13, 25, 50] and levels(16) == [16] and levels(200) == [13, 25, 50, 100, 200]


def test_every_window_holds_the_same_minimiser(prose):
    words = Words(pa.array(prose(5)))
    hashes = words.hashes()
    chosen, _ = minimisers(words, hashes, 13, 50)
    ends = words.ends()
    for start in np.flatnonzero(np.arange(len(words)) + 50 <= ends):
        inside = chosen[(chosen >= start) & (chosen + 13 <= start + 50)]
        grams = window_hashes(hashes, 13, np.arange(start, start + 38))
        assert np.argmin(grams) + start in inside


def test_words_of_sliced_and_null_texts():
    texts = pa.array(["zero", " a b", None, "", "ü\tc d ", "last"])
    words = Words(texts.slice(1, 4))
    assert [bytes(words.data[s:e]).decode() for s, e in zip(words.start, words.end, strict=True)] == ["a", "b", "ü", "c", "d"]
    assert words.counts.tolist() == [2, 0, 0, 3]
    assert words.hashes()[0] == Words(pa.array(["x a"])).hashes()[1]


def test_pieces_cover_the_batch():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * n for n in (5, 100, 1, 1, 1, 50)]})
    sizes = [p.num_rows for p in pieces(batch, limit=10)]
    assert sum(sizes) == 6 and sizes[0] == 1


@pytest.mark.parametrize("size", [1, 2, 3, 1000])
def test_streams_over_any_batches(size):
    rng = np.random.default_rng(size)
    key, doc = rng.integers(0, 40, 300), rng.integers(0, 4, 300)
    rows = pa.RecordBatch.from_pydict({"key": key, "id": doc, "at": np.arange(300)})
    parts = [rows.slice(i, 100) for i in (0, 100, 200)]  # three tasks
    for later, stream, order in ((False, in_several, [("key", "ascending"), ("state", "descending"), ("id", "ascending")]), (True, after_first, [("key", "ascending"), ("id", "ascending")])):
        settled = pa.Table.from_batches([b for p in parts for b in combine(["key"], "id", later)(iter([p]))])
        meeting = settled.filter(pa.compute.not_equal(settled["state"], 1)).sort_by(order)
        out = stream(["key"], "id")(iter([*meeting.to_batches(max_chunksize=size), *settled.filter(pa.compute.equal(settled["state"], 1)).to_batches()]))
        got = sorted(x for b in out for x in b.column("at").to_pylist())
        docs = {k: set(doc[key == k]) for k in set(key)}
        want = [i for i in range(300) if (doc[i] > min(docs[key[i]]) if later else len(docs[key[i]]) > 1)]
        assert got == want
