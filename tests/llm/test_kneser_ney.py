import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from slabwise.llm import kneser_ney as module
from slabwise.llm.kneser_ney import PLAIN_DISCOUNTS, Sums, discounts, score_texts, train

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)) + [None]


def plain_discounts(counts):
    n = [sum(c == k for c in counts) for k in (1, 2, 3, 4)]
    if min(n) > 0:
        y = n[0] / (n[0] + 2 * n[1])
        d = 1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]
        if 0 < d[0] <= 1 and 0 < d[1] <= 2 and 0 < d[2] <= 3:
            return d
    return 0.5, 1.0, 1.5


class Plain:
    """The model with dictionaries."""

    def __init__(self, texts):
        found = [tokens(t) for t in texts]
        self.c = Counter(t for ts in found for t in ts)
        self.n, self.v = sum(self.c.values()), len(self.c)
        self.pairs = Counter(p for ts in found for p in zip(["", *ts], ts, strict=False))
        self.before = Counter(w for _, w in self.pairs)
        self.d2, self.d1 = plain_discounts(self.pairs.values()), plain_discounts(self.before.values())
        self.after = defaultdict(list)
        for (v, _), n in self.pairs.items():
            self.after[v].append(n)

    def word(self, w):
        if not self.pairs:
            return 1.0
        total = len(self.pairs)
        freed = sum(self.d1[min(n, 3) - 1] for n in self.before.values()) / total
        n = self.before.get(w, 0)
        return (n - self.d1[min(n, 3) - 1] if n else 0) / total + freed / (self.v + 1)

    def pair(self, v, w):
        if v not in self.after:
            return self.word(w)
        total, n = sum(self.after[v]), self.pairs.get((v, w), 0)
        freed = sum(self.d2[min(x, 3) - 1] for x in self.after[v]) / total
        return (n - self.d2[min(n, 3) - 1] if n else 0) / total + freed * self.word(w)


def out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def brute(rows):
    model = Plain([t for i, t in rows if not out(i)])
    for i, text in rows:
        ts = tokens(text)
        base = sum(math.log10((model.c[t] + 1) / (model.n + model.v + 1)) for t in ts)
        score = sum(math.log10(model.pair(v, w)) for v, w in zip(["", *ts], ts, strict=False))
        yield i, out(i), len(ts), sum(t in model.c for t in ts), model.n, base, score


def same(got, rows):
    order = lambda r: (r[0] is None, r[0] or 0, r[2], r[6])
    got, want = sorted(map(tuple, got), key=order), sorted(brute(rows), key=order)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9, atol=2e-6)


@pytest.mark.parametrize("held", [module.HELD_KEYS, 64])
def test_equals_dictionaries(frame, prose, monkeypatch, held):
    monkeypatch.setattr(module, "HELD_KEYS", held)
    rows = list(enumerate(prose(5, 120, 80)))
    same(score_texts(frame(rows)).collect(), rows)


def test_odd_rows(frame, messy):
    rows = messy + [(i, "copies count as often as they come") for i in range(100, 160)]
    same(score_texts(frame(rows)).collect(), rows)


def test_little_or_nothing_to_learn_from(frame):
    held = next(i for i in range(100) if out(i))
    assert score_texts(frame([])).collect() == []
    for rows in ([(held, "only this one")], [(held, "a b"), (held + 1, None)], [(1, "one")]):
        same(score_texts(frame(rows)).collect(), rows)


def test_probabilities_add_up(frame, prose):
    rows = list(enumerate(prose(6, 60, 60)))
    df = frame(rows)
    model = train(df)
    words = np.arange(-1, model.words)
    assert model.word_probabilities(words).sum() == pytest.approx(1)
    for context in (-1, 0, 7, model.words // 2, model.words):
        assert model.probabilities(words, np.full(len(words), context)).sum() == pytest.approx(1)


def test_held_out_texts_are_better_known_than_by_words_alone(frame):
    """Word order carries information here, and the model must find it."""

    def walk(at):
        for k in range(60):
            yield f"w{at}"
            at = (3 * at + 1 + (k % 5 == 0)) % 50

    rows = [(i, " ".join(walk(i % 50))) for i in range(400)]
    scored = score_texts(frame(rows)).where("held_out").selectExpr("sum(score) s", "sum(base_score) b").first()
    assert scored.s > 0.5 * scored.b


def test_discounts_of_few_counts():
    assert discounts([0, 3, 2, 1]) == PLAIN_DISCOUNTS and discounts([1, 2, 50, 9]) == PLAIN_DISCOUNTS
    assert discounts([100, 40, 20, 12]) == pytest.approx(plain_discounts([1] * 100 + [2] * 40 + [3] * 20 + [4] * 12))


def test_sums_merge_runs():
    sums, want = Sums(), Counter()
    rng = np.random.default_rng(1)
    for _ in range(50):
        keys, counts = np.unique(rng.integers(-(2**62), 2**62, 20) // 2**58, return_counts=True)
        sums.add(keys, counts)
        want.update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
    keys, counts = sums.merge()
    assert dict(zip(keys.tolist(), counts.tolist(), strict=True)) == want and (np.diff(keys) > 0).all()
