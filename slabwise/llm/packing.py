"""Best-fit packing of token sequences into rows of fixed length.

Documents are tokenised where they are read; only lengths and checksums travel on.
Pieces are dealt by hash to groups of a bounded number of tokens, and each group is
packed in one pass by bounded-space online best-fit: a fixed number of open bins, found
through a bitset keyed by free space.  A piece goes to the bin that it fills best; when
all bins are open and none fits, the fullest closes.  Pieces arrive longest first.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slabwise.llm.common import documents

END_ID = 2
OPEN_BINS = 16_384
#: Tokens and documents of one packing group: its lengths are what one task holds.
GROUP_TOKENS = 16_000_000
GROUP_ROWS = 100_000
#: Texts that stand for one id wherever they occur, beside the ranks of the file.
ADDED = (("<|endoftext|>", 50256),)


def default_ranks() -> str:
    """The byte-level BPE of 50,257 ids as a rank file (the ids of ``byte_bpe_50k.json``)."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def encoder(ranks_path: str, added: tuple[tuple[str, int], ...] = ADDED):
    """A function from a text to its ids as little-endian 32-bit bytes.

    Added tokens cut a text; what is between them is encoded by itself.
    """
    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    encode = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    numbers = {token: np.array([i], "<u4").tobytes() for token, i in added}
    marks = re.compile("(" + "|".join(map(re.escape, sorted(numbers, key=len, reverse=True))) + ")") if added else None

    def ids(text: str) -> bytes:
        if not any(token in text for token in numbers):
            return np.array(encode(text), "<u4").tobytes()
        return b"".join(numbers.get(part) or np.array(encode(part), "<u4").tobytes() for part in marks.split(text) if part)

    return ids


def piece_bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of ``n`` ids: whole ones, but for the first."""
    first = n % capacity or capacity
    return [(0, first), *((start, capacity) for start in range(first, n, capacity))] if n > capacity else [(0, n)]


_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(ranks_path: str, capacity: int, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks_path)
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = encode(text.as_py() or "") + end
                for number, (start, length) in enumerate(piece_bounds(len(ids) // 4, capacity)):
                    rows.append((doc, number, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])))
            if rows:
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in _PIECES.split(", ")])

    return run


class BestFit:
    """Online best-fit over at most ``open_bins`` open bins of ``capacity``."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.open_bins = capacity, open_bins
        self.free = 0  # bit f is set while a bin with f free places is open
        self.bins: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
        self.opened = self.open = 0

    def _take(self, space: int) -> tuple[int, int]:
        found = self.bins[space].pop()
        if not self.bins[space]:
            self.free ^= 1 << space
        self.open -= 1
        return found

    def place(self, length: int) -> tuple[int, int]:
        """Number of the sequence and the place in it."""
        if not 0 < length <= self.capacity:
            raise ValueError("a piece must have 1 to capacity tokens")
        if fitting := self.free >> length:
            space = length + (fitting & -fitting).bit_length() - 1
            number, offset = self._take(space)
        else:
            space, number, offset = self.capacity, self.opened, 0
            self.opened += 1
            if self.open == self.open_bins:  # the fullest one closes
                self._take((self.free & -self.free).bit_length() - 1)
        if left := space - length:
            self.bins[left].append((number, offset + length))
            self.free |= 1 << left
            self.open += 1
        return number, offset


def _pack(capacity: int, open_bins: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, packer = None, None
        for batch in batches:
            sequences, offsets = [], []
            for at, length in zip(batch.column("group").to_pylist(), batch.column("length").to_pylist(), strict=True):
                if at != group:
                    group, packer = at, BestFit(capacity, open_bins)
                number, offset = packer.place(length)
                sequences.append(group << 32 | number)
                offsets.append(offset)
            out = {n: batch.column(n) for n in batch.schema.names if n != "group"}
            out |= {"sequence_id": pa.array(sequences, pa.int64()), "offset": pa.array(offsets, pa.int64())}
            yield pa.RecordBatch.from_pydict(out)

    return run


def pack(docs: DataFrame, capacity: int = 1024, ranks_path: str | None = None, end_id: int = END_ID, open_bins: int = OPEN_BINS, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """Pack every row of ``docs`` into sequences of at most ``capacity`` tokens.

    A document is its text's ids and ``end_id``.  Only longer ones are cut: into pieces of
    ``capacity``, of which the first may be shorter.  Returns per piece ``doc_id``,
    ``piece``, ``start``, ``length``, ``ids_crc32`` (over little-endian 32-bit ids),
    ``sequence_id`` and ``offset``; the pieces of a sequence lie one behind the other.

    Null and empty texts are one piece with ``end_id`` alone.  Repeated rows are packed
    as often as they come, also under one doc_id; a null doc_id stays null.  Only
    ``doc_id`` and ``text`` are read.  An empty table gives an empty result.  Pieces of equal
    length go by doc_id, piece and checksum, and of bins with equal space the one used last is
    taken; pieces that are alike in all of this can change places.  Very long texts are encoded
    whole, one at a time.  ``<|endoftext|>`` in a text is its id, as the tokenizer has it.  One
    read of the text lengths sets the number of groups before the packing.
    """
    if capacity < 1 or open_bins < 1:
        raise ValueError("capacity and open_bins must be at least 1")
    ranks_path = ranks_path or default_ranks()
    rows = documents(docs)
    size = rows.select(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes"), F.count("*").alias("rows")).first()
    groups = max(1, round((size["bytes"] / 4 + size["rows"]) / group_tokens), -(-size["rows"] // GROUP_ROWS))  # about four bytes a token
    pieces = rows.mapInArrow(_pieces(ranks_path, capacity, end_id), _PIECES)
    group = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)).alias("group")
    order = ["group", F.desc("length"), "doc_id", "piece", "ids_crc32"]
    placed = pieces.select("*", group).repartition(groups, "group").sortWithinPartitions(*order)
    return placed.mapInArrow(_pack(capacity, open_bins), _PIECES + ", sequence_id long, offset long")
