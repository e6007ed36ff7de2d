import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from slabwise.llm import alignment as module
from slabwise.llm.alignment import Bitmaps, align_tokens


@pytest.fixture(scope="module")
def tokenizers():
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    codes = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in codes]
    return first, second, {chr(c): b for c, b in [(c, c) for c in codes] + [(256 + i, b) for i, b in enumerate(rest)]}


def ends_of(tokens):
    return np.cumsum([len(t) for t in tokens]).tolist()


def brute(tokenizers, rows):
    first, second, decode = tokenizers
    docs = []
    for doc, text in rows:
        a, b, links, groups = [], [], Counter(), []
        if text:
            a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
            a_bytes = [bytes(decode[c] for c in first.id_to_token(i)) for i in a]
            names = [second.id_to_piece(i) for i in b]
            b_bytes = [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode() for p in names]
            raw = (" " + text).encode()
            if b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
                a, b = [], []
            else:
                a_ends, b_ends, i, j, low = ends_of(a_bytes), ends_of(b_bytes), 0, 0, (0, 0)
                while i < len(a):
                    links[a[i], b[j]] += 1
                    x, y = a_ends[i], b_ends[j]
                    i, j = i + (x <= y), j + (y <= x)
                    if x == y:
                        groups.append((a[low[0] : i], b[low[1] : j]))
                        low = (i, j)
        docs.append((doc, a, b, links, groups))
    count = Counter(pair for *_, links, _ in docs for pair in links)
    highest = defaultdict(int)
    for (a, _), n in count.items():
        highest[a] = max(highest[a], n)
    out = Counter()
    for doc, a, b, links, groups in docs:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        best = sum(n for p, n in links.items() if count[p] == highest[p[0]])
        out[doc, len(a), len(b), len(groups), sum(links.values()), best, sum(n * count[p] for p, n in links.items()), hashlib.sha256(text.encode()).hexdigest() if a else ""] += 1
    return out


def run(df):
    return Counter(tuple(r) for r in align_tokens(df).collect())


ODD = [(60, "a▁b c"), (61, "<0x41> <s> </s> <unk>"), (62, "  two  spaces\n\n\nx "), (63, "nul\x00 ﻿  "), (64, "é 가 \U0001f468‍\U0001f469"), (65, " ")]


def test_equals_brute_force(frame, tokenizers, messy):
    spark = frame([]).sparkSession
    texts = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()][:120]
    rows = texts + [m for m in messy if not m[1] or len(m[1]) < 100_000] + ODD
    assert run(frame(rows)) == brute(tokenizers, rows)


@pytest.mark.parametrize("limits", [{"CHUNK_ROWS": 64, "_ROW_BITS": 6}, {"CHUNK_BYTES": 500}, {"PART_BYTES": 100, "OWNERS": 1}])
def test_small_chunks_owners_and_parts(frame, prose, tokenizers, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(module, name, value)
    rows = list(enumerate(prose(4, 90, 40))) + [(500 + i, "one copied text, many times over") for i in range(200)] + [(i, None) for i in range(800, 900)]
    assert run(frame(rows)) == brute(tokenizers, rows)


def test_very_long_texts_and_none(frame, messy):
    long = [m for m in messy if m[1] and len(m[1]) > 100_000]
    row = align_tokens(frame(long)).first()
    assert row.n_links == row.n_a + row.n_b - row.n_groups and row.n_best == row.n_links == row.count_sum
    assert align_tokens(frame([])).collect() == []


def test_bitmaps_count_and_sum_like_sets():
    rng = np.random.default_rng(0)
    pair, row = rng.integers(0, 9, 3000) << 32 | rng.integers(0, 3, 3000), rng.integers(0, 700, 3000)
    parts = [Bitmaps.of_links(pair[x], row[x]) for x in (row < 333, row >= 333)]  # a word is shared
    whole = Bitmaps.merged(parts)
    assert len(whole.bits) < sum(len(p.bits) for p in parts)
    whole = Bitmaps.unpacked(whole.packed(), len(whole.pair))
    times = Counter(zip(pair.tolist(), row.tolist(), strict=True))
    found, counts = whole.document_counts()
    assert dict(zip(found.tolist(), counts.tolist(), strict=True)) == Counter(p for p, _ in times)
    weight = whole.pair % 101
    want = np.zeros(704, np.int64)
    for (p, r), n in times.items():
        want[r] += n * (p % 101)
    assert (whole.link_sums([weight], 704)[0] == want).all()
