import math
import random
import re
from collections import Counter, defaultdict

import pytest

from slabwise.llm import lexical_search as module
from slabwise.llm.lexical_search import lexical_search, terms_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, top=10):
    found = [(i, split(t)) for i, t in docs]
    total, length = sum(bool(ts) for _, ts in found), sum(len(ts) for _, ts in found)
    df = Counter(t for _, ts in found for t in set(ts))
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i] |= set(split(t))
    out = []
    for item, terms in wanted.items():
        scores = []
        for doc, ts in found:
            tf, n = Counter(ts), len(ts)
            score = 0
            for t in terms & set(tf):
                w = math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1)))
                score += w * (1_000_000_000 * tf[t] // (1000 * tf[t] + 8 * (10 + 90 * n * total // length)))
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        out += [(item, rank, None if none else doc, -score) for rank, (score, none, doc) in enumerate(sorted(scores)[:top], 1)]
    return Counter(out)


def items_frame(spark, items):
    return spark.createDataFrame(items, "item_id long, text string").selectExpr("item_id", "text", "1 as doc_id", "'x' as term", "2 as score")


def run(frame, docs, items, **options):
    df = frame(docs)
    return Counter(tuple(r) for r in lexical_search(df, items_frame(df.sparkSession, items), **options).select("item_id", "rank", "doc_id", "score").collect())


@pytest.mark.parametrize("limits", [{}, {"BLOCK_ROWS": 7, "GROUP_ITEMS": 3}, {"BLOCK_BYTES": 2000, "VOCABULARY": 1}])
def test_equals_brute_force(frame, prose, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(module, name, value)
    docs = list(enumerate(prose(3, 150, 60)))
    items = [(i, " ".join(random.Random(i).choice([t for _, t in docs]).split()[:9])) for i in range(12)] + [(50, "the of and to"), (51, "nowhere")]
    assert run(frame, docs, items) == brute(docs, items)
    assert run(frame, docs, items, top=3) == brute(docs, items, 3)


def test_odd_rows_and_ties(frame, messy):
    docs = messy + [(i, "tied Text one") for i in range(40, 70)] + [(7, "tied text one"), (None, "TIED text one")]
    items = [(1, "Tied one"), (1, "text 漢字"), (None, "long words"), (None, "ünïcode"), (2, None), (3, ""), (4, " .,- "), (5, "x" * 300_000), (6, "endoftext http"), (6, "endoftext http")]
    assert run(frame, docs, items) == brute(docs, items)


def test_a_group_of_copies_and_a_common_word(frame):
    docs = [(i, "common words of a copied text") for i in range(300)] + [(1000 + i, f"common w{i} w{i % 7}") for i in range(300)]
    items = [(0, "common"), (1, "copied w3"), (2, "w5 w6 common of")]
    assert run(frame, docs, items) == brute(docs, items)


def test_empty_tables(frame):
    assert not run(frame, [], [(1, "a")]) and not run(frame, [(1, "a")], []) and not run(frame, [(1, None), (2, "")], [(1, "a")])
    with pytest.raises(ValueError):
        run(frame, [(1, "a")], [(1, "a")], top=0)


def test_terms_are_maximal_matches():
    for text in ("It's A-1 Ünï_x 漢字ab\x00c\x7fd é", "", "...", "Z[z`z{z@9:9/0"):
        assert [t.decode() for t in terms_of(text.encode())] == split(text)
