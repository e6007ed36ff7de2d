"""Words of whole texts as numpy arrays, for functions that run inside tasks.

A word is ``[^\\x20\\x09-\\x0D]+`` over the UTF-8 bytes.  Texts are worked on in
pieces of a few megabytes (one text at least), so memory follows the longest
text, never the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20
_BLOCK_BITS = 16
_BLOCK = 1 << _BLOCK_BITS
GOLDEN = 0x9E3779B97F4A7C15

_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _base(seed: int) -> int:
    return int(mix(np.array([GOLDEN * (2 * seed + 1) & (2**64 - 1)], np.uint64))[0]) | 1


@lru_cache(maxsize=8)
def _block_powers(seed: int, inverse: bool) -> tuple[np.ndarray, int]:
    """The powers 0 to ``_BLOCK`` - 1 of the base, and the next one."""
    base = pow(_base(seed), -1, 2**64) if inverse else _base(seed)
    out = np.full(_BLOCK, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64), pow(base, _BLOCK, 2**64)


def _range_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of ``values[start:end]`` for every pair: polynomial prefix sums.

    Powers come block by block, so what a worker keeps does not follow its longest text.
    """
    total = np.zeros(len(values) + 1, np.uint64)
    (powers, step), (back, back_step) = _block_powers(seed, False), _block_powers(seed, True)
    blocks = range(0, max(len(values), 1), _BLOCK)
    factor = 1
    for low in blocks:
        part = values[low : low + _BLOCK]
        np.multiply(part, powers[: len(part)], out=total[low + 1 : low + 1 + len(part)])
        if factor != 1:
            total[low + 1 : low + 1 + len(part)] *= np.uint64(factor)
        factor = factor * step % 2**64
    np.cumsum(total, out=total)
    out = total[end]
    out -= total[start]
    out *= back[start & (_BLOCK - 1)]
    if len(blocks) > 1:
        factors = np.array([pow(back_step, k, 2**64) for k in range(len(blocks) + 1)], np.uint64)
        out *= factors[start >> _BLOCK_BITS]
    return mix(out)


@lru_cache(maxsize=4)
def _byte_values(seed: int) -> np.ndarray:
    return mix((np.arange(1, 257, dtype=np.uint64) + np.uint64(seed << 9)) * np.uint64(GOLDEN))


class Words:
    """The words of a run of texts: byte ranges, and where each text's words begin."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        buffer = texts.buffers()[2]
        data = np.frombuffer(buffer, np.uint8)[at[0] : at[-1]] if buffer and len(at) else np.zeros(0, np.uint8)
        at = at - at[0] if len(at) else np.zeros(1, np.int64)
        self.data = _LOWER[data] if lower else data
        inside = _IS_WORD[data]
        before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edges = at[(at > 0) & (at < len(data))]
        before[edges] = False
        after[edges - 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        #: Word number at which each text begins, and the number of words at the end.
        self.first = np.searchsorted(self.start, at)
        self.counts = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, seed: int = 0) -> np.ndarray:
        return _range_hash(_byte_values(seed)[self.data], self.start, self.end, seed)

    def ends(self) -> np.ndarray:
        """For every word the number of the word behind its text's last one."""
        return np.repeat(self.first[1:], self.counts)

    def rows(self) -> np.ndarray:
        """For every word the number of its text."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


def window_hashes(word_hashes: np.ndarray, length: int, starts: np.ndarray, seed: int = 1) -> np.ndarray:
    """Hashes of the windows of ``length`` words at ``starts`` (all inside their texts)."""
    return _range_hash(word_hashes, starts, starts + length, seed)


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over every ``width`` neighbours."""
    if len(values) < width:
        return values[:0]
    span = 1
    while span * 2 <= width:
        values = pick(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


def minimisers(words: Words, word_hashes: np.ndarray, gram: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers and hashes of the content-selected grams.

    Every ``window`` consecutive words of one text hold at least one selected gram
    of ``gram`` words, the same one wherever these words occur: the gram with the
    smallest hash (all of them if several are equal).
    """
    n, ends = len(words), words.ends()
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    all_starts = np.arange(n - gram + 1)
    hashes = window_hashes(word_hashes, gram, all_starts)
    width = window - gram + 1
    least = sliding(hashes, width, np.minimum)
    least = np.where(np.arange(len(least)) + window <= ends[: len(least)], least, np.uint64(0))
    edge = np.zeros(width - 1, np.uint64)
    most = sliding(np.concatenate([edge, least, edge]), width, np.maximum)
    chosen = np.flatnonzero((most == hashes) & (most > 0))
    return chosen, hashes[chosen]


def pieces(batch: pa.RecordBatch, text: str = "text", limit: int = PIECE_BYTES, rows: int | None = None) -> Iterator[pa.RecordBatch]:
    """The batch in runs of at most ``rows`` rows with at most ``limit`` bytes of text, one row at least."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    total, low = np.cumsum(sizes), 0
    while low < batch.num_rows:
        done = total[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(total, done + limit, side="right")))
        high = min(high, low + rows) if rows else high
        yield batch.slice(low, high - low)
        low = high


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of ``n`` words lie in a window of ``length`` words at one of ``starts``."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + length, n), -1)
    return np.cumsum(steps[:-1]) > 0
