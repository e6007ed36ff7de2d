import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from slabwise.llm.packing import BestFit, default_ranks, encoder, pack, piece_bounds


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_are_the_tokenizers(spark, tokenizer, messy):
    texts = [t for _, t in messy if t and len(t) < 100_000] + ["a  b\n\n c", "it's\tI'll  \n", " lead", "trail ", "\r\n x", "  z", "1234 ²½"]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    encode = encoder(default_ranks())
    for text, want in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(encode(text), "<u4").tolist() == want.ids


@pytest.mark.parametrize("n", [1, 7, 8, 9, 16, 17, 100])
def test_piece_bounds(n):
    bounds = piece_bounds(n, 8)
    assert [s for s, _ in bounds] == list(np.cumsum([0, *(size for _, size in bounds)])[:-1]) and sum(size for _, size in bounds) == n
    assert all(size == 8 for _, size in bounds[1:]) and 0 < bounds[0][1] <= 8


def naive(lengths, capacity, open_bins):
    bins, places = [], []
    for length in lengths:
        fit = [b for b in bins if b[0] >= length]
        if fit:
            b = min(fit, key=lambda x: (x[0], -x[3]))
        else:
            if len(bins) == open_bins:
                bins.remove(min(bins, key=lambda x: (x[0], -x[3])))
            b = [capacity, len({p for p, _ in places}), 0, 0]
            bins.append(b)
        places.append((b[1], b[2]))
        b[0], b[2], b[3] = b[0] - length, b[2] + length, len(places)
        if not b[0]:
            bins.remove(b)
    return places


@pytest.mark.parametrize("open_bins", [1, 3, 1000])
def test_best_fit_equals_a_naive_search(open_bins):
    rng = random.Random(open_bins)
    lengths = [rng.randint(1, 50) for _ in range(500)]
    packer = BestFit(50, open_bins)
    assert [packer.place(x) for x in lengths] == naive(lengths, 50, open_bins)
    assert packer.open <= open_bins


def check(got, rows, tokenizer, capacity):
    own, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        own[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    for i, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        pieces = sorted(own[i], key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length) for r in pieces] == [(k, s, n) for k, (s, n) in enumerate(piece_bounds(len(ids), capacity))]
        assert [r.ids_crc32 for r in pieces] == [zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in pieces]
    return len(sequences)


def test_pack(frame, prose, tokenizer):
    rows = [*enumerate(prose(8)), (500, None), (501, ""), (502, "x" * 20_000 + " words" * 5000)]
    got = pack(frame(rows), capacity=64).collect()
    n = check(got, rows, tokenizer, 64)
    assert n <= 1.02 * sum(r.length for r in got) / 64 + 2
    spread = pack(frame(rows), capacity=64, group_tokens=500, open_bins=4).collect()
    check(spread, rows, tokenizer, 64)


def test_odd_rows(frame, messy):
    got = pack(frame(messy)).collect()
    assert sum(1 for r in got if r.piece == 0) == len(messy) and sum(r.doc_id == 8 for r in got) == 2
    assert pack(frame([])).collect() == []


def test_many_empty_texts_are_several_groups(spark):
    rows = spark.range(200_000).selectExpr("id as doc_id", "if(id % 2 = 0, '', null) as text")
    placed = pack(rows, capacity=1024)
    groups = placed.selectExpr("sequence_id >> 32 as g", "sequence_id").groupBy("g").agg({"sequence_id": "approx_count_distinct"}).collect()
    assert len(groups) > 1 and placed.count() == 200_000
    assert placed.select("sequence_id").distinct().count() <= 200
