import random
from collections import defaultdict

import pytest

from slabwise.llm.suffix_array import suffix_array_matches


def tokens(rows):
    return {i: (t or "").split() for i, t, *_ in rows}


def spans(got):
    covered = defaultdict(set)
    for r in got:
        covered[r.doc_id] |= set(range(r.start, r.start + r.n_words))
        covered[r.partner_id] |= set(range(r.partner_start, r.partner_start + r.n_words))
    return covered


def brute(rows, length):
    """Words of every document in a run of ``length`` words that another document holds."""
    own, where = tokens(rows), defaultdict(set)
    for i, words in own.items():
        for p in range(len(words) - length + 1):
            where[tuple(words[p : p + length])].add(i)
    covered = defaultdict(set)
    for i, words in own.items():
        for p in range(len(words) - length + 1):
            if len(where[tuple(words[p : p + length])]) > 1:
                covered[i] |= set(range(p, p + length))
    return covered


def check_matches(got, rows, length):
    own = tokens(rows)
    for r in got:
        a, b = own[r.doc_id], own[r.partner_id]
        assert r.doc_id > r.partner_id and r.n_words >= length
        assert a[r.start : r.start + r.n_words] == b[r.partner_start : r.partner_start + r.n_words]
        assert len(a[r.start : r.start + r.n_words]) == r.n_words


@pytest.mark.parametrize("seed", [1, 2])
def test_planted_passages(frame, prose, seed):
    rows = [*enumerate(prose(seed, n=50))]
    got = suffix_array_matches(frame(rows), 49).collect()
    check_matches(got, rows, 49)
    assert spans(got) == brute(rows, 49)


def test_matches_have_their_full_length(frame):
    rng = random.Random(0)
    word = lambda: f"w{rng.randrange(10**6)}"
    passage = [word() for _ in range(300)]
    rows = [(i, " ".join([word() for _ in range(40 + i)] + passage + [word() for _ in range(70)])) for i in (3, 1, 2)]
    two = suffix_array_matches(frame(rows[:2]), 50).collect()
    assert [tuple(r) for r in two] == [(3, 43, 300, 1, 41)]
    three = suffix_array_matches(frame(rows), 50).collect()  # neighbours alternate, so matches may be shorter
    check_matches(three, rows, 50)
    assert spans(three) == brute(rows, 50)


def test_clean_documents_stay_out(frame):
    rng = random.Random(1)
    rows = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(200))) for i in range(20)]
    part = rows[0][1].split()[10:59]  # 49 words are too few
    rows.append((30, " ".join([*part, "other", "words"])))
    assert suffix_array_matches(frame(rows), 50).collect() == []


def test_odd_rows(frame, messy):
    got = suffix_array_matches(frame(messy), 50).collect()
    assert {(r.doc_id, r.partner_id) for r in got if r.partner_id == 3} >= {(8, 3)}
    assert suffix_array_matches(frame([])).collect() == []


def test_runs_between_many_heads_and_tails(frame):
    rng = random.Random(2)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    heads, body, tails = [words(5) for _ in range(10)], words(40), [words(5) for _ in range(10)]
    rows = [(i, " ".join(words(3) + rng.choice(heads) + body + rng.choice(tails) + words(3))) for i in range(300)]
    got = suffix_array_matches(frame(rows), 50).collect()
    check_matches(got, rows, 50)
    assert spans(got) == brute(rows, 50)


def test_places_in_one_document_all_count(frame):
    rng = random.Random(3)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passage = words(55)
    rows = [(i, " ".join(sum((words(4) + passage for _ in range(n)), []))) for i, n in enumerate((3, 1, 2, 1))]
    got = suffix_array_matches(frame(rows), 50).collect()
    check_matches(got, rows, 50)
    assert spans(got) == brute(rows, 50)


@pytest.mark.parametrize("n", [3, 12])
def test_matches_of_many_documents_are_maximal(frame, n):
    rng = random.Random(4)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passage = words(300)
    rows = [(i, " ".join(words(5 + i) + passage[(i % 4) * 40 : 300 - (i % 3) * 30] + words(7))) for i in range(n)]
    rows += [(100 + i, " ".join([*passage[:120], f"edit{i}", *passage[121:]])) for i in range(n)]
    own, got = tokens(rows), suffix_array_matches(frame(rows), 50).collect()
    check_matches(got, rows, 50)
    assert spans(got) == brute(rows, 50)
    assert len({(r.doc_id, r.partner_id, r.start, r.partner_start) for r in got}) == len(got)
    for r in got:
        a, b, ends = own[r.doc_id], own[r.partner_id], (r.start + r.n_words, r.partner_start + r.n_words)
        assert min(r.start, r.partner_start) == 0 or a[r.start - 1] != b[r.partner_start - 1]
        assert ends[0] == len(a) or ends[1] == len(b) or a[ends[0]] != b[ends[1]]
