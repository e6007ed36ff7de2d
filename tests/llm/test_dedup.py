"""Exact and line dedup."""

import hashlib
import random
import re
from collections import Counter, defaultdict

from slabwise.llm.exact_dedup import CuckooFilter, DigestIndex, build_index, exact_dedup, index_keys, live_rows, update_index
from slabwise.llm.line_dedup import BLANKS, keep_bitmaps, keep_mask, line_dedup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def digest(n):
    return hashlib.sha256(str(n).encode()).digest()


def test_filter_holds_what_is_inserted_and_not_deleted():
    found, live = CuckooFilter(64), set()
    rng = random.Random(1)
    for _ in range(2000):
        n = rng.randrange(300)
        if n in live:
            live.discard(n)
            found.delete(digest(n))
        elif len(live) < 150:
            live.add(n)
            assert found.insert(digest(n))
        assert all(digest(x) in found for x in live)


def test_index_grows_from_its_stored_keys():
    index = DigestIndex()
    for n in range(5000):
        assert not index.add(digest(n), n)
    assert index.filter.mask + 1 > 1024 and all(digest(n) in index.filter for n in range(5000))
    assert index.add(digest(7), 3) and index.keys[digest(7)] == [3, 2]
    assert index.remove(digest(7)) and index.remove(digest(7)) and not index.remove(digest(7))


def test_index_table_with_deletion(frame):
    rows = [(i, f"text {i % 40}") for i in range(100)]
    index = build_index(frame(rows), buckets=8)
    assert index.count() <= 8
    gone = [(i, f"text {i % 40}") for i in range(100) if i % 40 < 10]
    came = [(200, "new text"), (201, "text 39"), (202, "text 5")]
    now = index_keys(update_index(index, live_rows(frame(rows)), frame(came), frame(gone), buckets=8)[0]).collect()
    want = Counter(t for _, t in rows) + Counter(t for _, t in came) - Counter(t for _, t in gone)
    assert {bytes(r.digest): r.n for r in now} == {hashlib.sha256(t.encode()).digest(): n for t, n in want.items()}


def test_deletion_takes_only_what_is_there(frame, tmp_path):
    spark = frame([]).sparkSession
    rows = [(1, "x"), (2, "x"), (3, "y"), (3, "y"), (4, None), (None, "x")]

    def keys(index):
        return {bytes(r.digest): (r.first_id, r.n) for r in index_keys(index).collect()}

    def of(text):
        return hashlib.sha256(text.encode()).digest()

    index, live = build_index(frame(rows), buckets=4), live_rows(frame(rows))
    foreign = [(9, "x"), (9, "x"), (1, "y"), (2, "nobody's")]
    same, kept = update_index(index, live, frame([]), frame(foreign), buckets=4)
    assert keys(same) == keys(index) and kept.count() == live.count()
    same.write.parquet(str(tmp_path / "index"))
    kept.write.parquet(str(tmp_path / "rows"))
    stored = spark.read.parquet(str(tmp_path / "index")), spark.read.parquet(str(tmp_path / "rows"))
    less, kept = update_index(*stored, frame([(0, "y")]), frame([(1, "x"), (3, "y"), (4, None), (None, "x")]), buckets=4)
    assert keys(less) == {of("x"): (2, 1), of("y"): (0, 2)}  # the representative of x went, one row of 3 is left
    assert keys(update_index(less, kept, frame([]), frame([(2, "x"), (0, "y"), (3, "y")]), buckets=4)[0]) == {}


def brute_exact(rows):
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t, *_ in rows]
    groups = defaultdict(list)
    for (i, *_), text in zip(rows, texts, strict=True):
        groups[text].append(i)
    least = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return Counter((i, least[t], len(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for (i, *_), t in zip(rows, texts, strict=True)), len(groups)


def test_exact_dedup(frame, messy):
    rows = messy + [(i, f"copy\t of \n {i % 5}") for i in range(50, 80)] + [(81, "copy of 3"), (82, "copy  of 3")]
    got = exact_dedup(frame(rows), buckets=4).collect()
    want, n = brute_exact(rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == n and all(r.doc_id == r.keep_id for r in got if r.kept)
    assert exact_dedup(frame([])).collect() == []


def brute_lines(rows, min_chars=20, min_docs=3):
    docs = defaultdict(set)
    of = lambda i: 2**63 if i is None else i
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            docs[line.strip(BLANKS).translate(LOWER)].add(of(i))
    out = Counter()
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        keys = [x.strip(BLANKS).translate(LOWER) for x in lines]
        kept = [x for x, k in zip(lines, keys, strict=True) if len(k) < min_chars or len(docs[k]) < min_docs or max(docs[k]) == of(i)]
        out[i, len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    return out


def test_line_dedup(frame, messy):
    rng = random.Random(3)
    pool = [f"  A line that may Repeat, number {i}\t" for i in range(30)] + ["short", "", "ÄÖ line of twenty chars", " ä" * 10]
    rows = messy + [(i, "\n".join(rng.choice(pool).upper() if rng.random() < 0.2 else rng.choice(pool) for _ in range(rng.randint(1, 30)))) for i in range(100, 160)]
    got = line_dedup(frame(rows), with_text=True, more=("lang", "size")).collect()
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got) == brute_lines(rows)
    assert all(r.kept_sha256 == hashlib.sha256(r.kept.encode()).hexdigest() and r.size == 7 for r in got)
    assert line_dedup(frame([])).collect() == []


def test_bitmaps_are_small_and_whole(frame):
    line = "the same line in all of the documents"
    rows = [(i, "\n".join([f"own line of document {i}"] * 3 + [line] * 1000 + ["tail"])) for i in range(4)]
    maps = keep_bitmaps(frame(rows)).collect()
    assert {r.id for r in maps} == {0, 1, 2}
    for r in maps:
        assert len(r.keep) < 40 and keep_mask(bytes(r.keep), 1004).nonzero()[0].tolist() == [0, 1, 2, 1003]
