import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from slabwise.llm import ngram_join as module
from slabwise.llm.components import connected_components
from slabwise.llm.ngram_join import ngram_groups, ngram_join, shingle_sets

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
NO_ID = 2**63


def sets(text, size):
    words = (text or "").translate(LOWER).encode().split()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if len(words) >= size else ({tuple(words)} if words else set())


def brute(rows, size, percent):
    own = [(NO_ID if i is None else i, sets(t, size)) for i, t, *_ in rows]
    root = {i: i for i, _ in own}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(own):
        for j, b in own[:k]:
            common = len(a & b)
            if common and 100 * common >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    null = lambda x: None if x == NO_ID else x
    return Counter((null(i), len(s), null(find(i))) for i, s in own)


def ours(df, **options):
    return Counter(tuple(r) for r in ngram_join(df, counters=1 << 12, **options).collect())


def near_copies(seed, n):
    rng = random.Random(seed)
    rows, texts = [], []
    for i in range(n):
        if texts and rng.random() < 0.6:
            text = list(rng.choice(texts))
            for _ in range(rng.randint(0, 6)):
                text[rng.randrange(len(text))] = f"new{rng.randrange(20)}"
            if rng.random() < 0.3:
                text = text[: rng.randint(1, len(text))]
        else:
            text = [f"w{rng.randrange(60)}" for _ in range(rng.randint(1, 80))]
        texts.append(text)
        rows.append((i * 7 % 401, rng.choice((" ", "\n")).join(w.upper() if rng.random() < 0.05 else w for w in text)))
    return rows


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80), (1, 60)])
def test_equals_brute_force(frame, size, percent):
    rows = near_copies(size, 150)
    assert ours(frame(rows), size=size, percent=percent) == brute(rows, size, percent)


def test_small_blocks_and_parts(frame, monkeypatch):
    monkeypatch.setattr(module, "BLOCK", 3)
    monkeypatch.setattr(module, "PARTNERS", 2)
    rows = near_copies(9, 120)
    assert ours(frame(rows), size=2, percent=70) == brute(rows, 2, 70)


def test_odd_rows(frame, messy):
    rows = [r for r in messy if len(r[1] or "") < 100_000] + [(70, "two words"), (71, "Two  words"), (72, "one"), (73, "two words more")]
    assert ours(frame(rows), size=3, percent=90) == brute(rows, 3, 90)
    assert ngram_join(frame([])).collect() == []


def test_one_document_of_each_group_stays(frame, messy):
    rows = near_copies(4, 60) + [(900, "some row that stands here twice"), (900, "some row that stands here twice")] + [(2000 + i, t) for i, t in messy[:3]]
    kept = ngram_groups(frame(rows), counters=1 << 12).collect()
    want = {i for i, _, c in brute(rows, 5, 80) if i == c}
    assert Counter(r.doc_id for r in kept) == Counter(want)
    assert kept[0].size == 7


def exchanged_bytes(plan):
    """Bytes of all rows that an executed plan has sent through its exchanges."""
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        return exchanged_bytes(plan.executedPlan())
    below = [plan.children().apply(i) for i in range(plan.children().size())]
    if name.endswith("QueryStage"):
        below = [plan.plan()]
    own = plan.metrics().apply("dataSize").value() if name == "Exchange" else 0
    return own + sum(map(exchanged_bytes, below))


def test_texts_that_stay_are_not_exchanged(spark, frame, tmp_path):
    rng = random.Random(11)
    rows = [(i, " ".join(str(rng.random()) for _ in range(200)), "en", "web") for i in range(60)]
    rows += [rows[3], (70, rows[4][1]), (None, rows[5][1]), (None, rows[5][1])]
    frame(rows).write.parquet(str(tmp_path / "docs"))
    found = ngram_groups(spark.read.parquet(str(tmp_path / "docs")), counters=1 << 12)
    kept = found.collect()
    assert Counter(r.doc_id for r in kept) == Counter([*range(60), None, None])
    assert 0 < exchanged_bytes(found._jdf.queryExecution().executedPlan()) < sum(len(r[1]) for r in rows) / 4


@pytest.mark.parametrize("bits", [1, 8, 1 << 20])
def test_rows_that_share_a_bit_of_the_map_are_told_apart(frame, monkeypatch, bits):
    monkeypatch.setattr(module, "FILTER_BITS", bits)
    rows = near_copies(9, 50) + [(900, "some row that stands here twice")] * 2 + [(901, "one id two texts " * 9), (901, "another text with that id " * 9)]
    rows += [(None, "no id here"), (None, "no id here"), (902, None), (902, None), (903, "")]
    kept = ngram_groups(frame(rows), counters=1 << 12).collect()
    stay = {i for i, _, c in brute(rows, 5, 80) if i == c and i is not None}
    want = Counter({(i, t) for i, t, *_ in rows if i in stay}) + Counter((i, t) for i, t, *_ in rows if i is None)
    assert Counter((r.doc_id, r.text) for r in kept) == want


def test_shingles_of_rows_are_apart():
    batch = pa.RecordBatch.from_pydict({"text": ["a b c d", None, "A B", "a b c d a b c d", "a b"]})
    row, value = shingle_sets(batch, 3)
    assert np.bincount(row, minlength=5).tolist() == [2, 0, 1, 4, 1]
    assert set(value[row == 0]) <= set(value[row == 3]) and set(value[row == 2]) == set(value[row == 4])


@pytest.mark.parametrize("shape", ["path", "star", "random"])
def test_components(spark, shape):
    rng = random.Random(5)
    edges = {"path": [(i, i + 1) for i in range(60)], "star": [(50, i) for i in range(100)], "random": [(rng.randrange(90), rng.randrange(90)) for _ in range(60)]}[shape]
    rng.shuffle(edges)
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    root = {}
    for a, b in edges:
        if a != b:
            group = root.get(a, {a}) | root.get(b, {b})
            for x in group:
                root[x] = group
    assert got == {x: min(g) for x, g in root.items()}


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([(1, 1)], "a long, b long")).collect() == []
