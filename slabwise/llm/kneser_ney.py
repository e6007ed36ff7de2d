"""Scores of texts by an interpolated modified Kneser-Ney bigram model.

Counts are made by Spark: tasks add up what they read, send sorted runs to the shard that
owns a range of keys, and the shard's task merges them and writes sorted arrays to the
shared folder.  First come the hashes of all words; the rank of a word is its number from
then on, so a bigram is one exact 64-bit key, context before word.  Shards of bigrams own
ranges of contexts: totals and kinds of followers of a context are known where it is
written.  Continuation counts of words go back to the shards of the words.

Workers map the arrays into memory and look keys up by binary search, sorted keys of a
piece at a time.  Where the shared folder is not a file system that can be mapped, a worker
copies an array to its own scratch folder first.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slabwise.llm.common import cut, documents, shared_dir
from slabwise.llm.words import Words, mix, pieces
from slabwise.sources.files import file_system, write_atomic

#: Shards of each kind of array at least; otherwise as many as there are shuffle partitions.
SHARDS = 64
#: Keys that a task adds up before it sends them on.
HELD_KEYS = 4 << 20
#: Discounts where the counts of counts give none (a tiny corpus).
PLAIN_DISCOUNTS = (0.5, 1.0, 1.5)
#: Words a model can number: a bigram is one 64-bit key.
MOST_WORDS = 1 << 31
#: Stands for the end of a text among word hashes.
END = int(mix(np.array([1], np.uint64)).view(np.int64)[0])
_RUN = "shard int, n int, data binary"
_BLANK = np.zeros(0, np.int64)


def _flags(values: np.ndarray) -> np.ndarray:
    """Where sorted values begin anew."""
    return np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)


class Sums:
    """Counts by key; runs are merged whenever they have doubled what is held."""

    def __init__(self):
        self.runs, self.waiting = [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.runs.append((keys, counts))
        self.waiting += len(keys)
        if self.waiting > max(HELD_KEYS // 4, 2 * len(self.runs[0][0])):
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.runs:
            return _BLANK, _BLANK
        if len(self.runs) > 1:
            keys, counts = (np.concatenate(x) for x in zip(*self.runs, strict=True))
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], counts[order]
            starts = _flags(keys)
            self.runs = [(keys[starts], np.add.reduceat(counts, starts) if len(starts) else counts)]
        self.waiting = 0
        return self.runs[0]


def _dealt(keys: np.ndarray, counts: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
    """A sorted run as one row per shard; shard s has the keys from ``bounds[s]`` on."""
    edges = np.append(np.searchsorted(keys, bounds), len(keys))
    held = np.flatnonzero(np.diff(edges))
    data = []
    for s in held:
        part = slice(edges[s], edges[s + 1])
        most = "<u4" if counts[part].max() < 1 << 32 else "<u8"
        columns = np.diff(keys[part], prepend=0).astype("<i8"), counts[part].astype(most)
        data.append(pa.compress(b"".join(c.tobytes() for c in columns), codec="zstd", asbytes=True))
    sizes = np.diff(edges)[held]
    wide = pa.array([int(n) * (1 if counts[edges[s] : edges[s + 1]].max() < 1 << 32 else -1) for s, n in zip(held, sizes, strict=True)], pa.int32())
    return pa.RecordBatch.from_pydict({"shard": pa.array(held, pa.int32()), "n": wide, "data": pa.array(data, pa.binary())})


def _undealt(n: int, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A run again; a negative length says that its counts are wide."""
    kind, n = ("<u4", n) if n > 0 else ("<u8", -n)
    raw = pa.decompress(data, n * (8 + np.dtype(kind).itemsize), codec="zstd", asbytes=True)
    return np.cumsum(np.frombuffer(raw, "<i8", n)), np.frombuffer(raw, kind, n, 8 * n).astype(np.int64)


def _counted(keys_of: Callable[[pa.RecordBatch], np.ndarray], bounds: np.ndarray):
    """The keys of all pieces, added up and dealt to shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums()
        for whole in batches:
            for batch in pieces(whole):
                keys = np.sort(keys_of(batch))
                starts = _flags(keys)
                sums.add(keys[starts], np.diff(np.append(starts, len(keys))))
                if sums.waiting > HELD_KEYS or len(sums.runs[0][0]) > HELD_KEYS:
                    yield _dealt(*sums.merge(), bounds)
                    sums = Sums()
        keys, counts = sums.merge()
        if len(keys):
            yield _dealt(keys, counts, bounds)

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Rows sorted by shard: the keys and counts of every shard."""
    last, sums = None, Sums()
    for batch in batches:
        for shard, n, data in zip(*(batch.column(c).to_pylist() for c in ("shard", "n", "data")), strict=True):
            if shard != last and last is not None:
                yield last, *sums.merge()
                sums = Sums()
            last = shard
            sums.add(*_undealt(n, data))
    if last is not None:
        yield last, *sums.merge()


def _token_hashes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and the end of every text, in order, and where each text begins."""
    words = Words(batch.column("text"), lower=True)
    tokens = np.insert(words.hashes().view(np.int64), words.first[1:], END)
    return tokens, np.append(words.first[:-1] + np.arange(batch.num_rows), len(tokens))


class Arrays:
    """Arrays of the shared folder, mapped into memory when first used."""

    def __init__(self, folder: str):
        self.folder, self._held = folder, {}

    def __call__(self, name: str, shard: int, kind: str) -> np.ndarray:
        if (name, shard) not in self._held:
            self._held[name, shard] = self._mapped(f"{self.folder}/{name}-{shard}", kind)
        return self._held[name, shard]

    def _mapped(self, path: str, kind: str) -> np.ndarray:
        system, inner = file_system(path)
        info = system.get_file_info(inner)
        if info.type != fs.FileType.File or not info.size:
            return np.zeros(0, kind)
        if not isinstance(system, fs.LocalFileSystem):
            handle, own = tempfile.mkstemp(prefix="lm-")
            with os.fdopen(handle, "wb") as out, system.open_input_stream(inner) as stream:
                while chunk := stream.read(8 << 20):
                    out.write(chunk)
            mapped = np.memmap(own, kind, "r")
            os.unlink(own)  # the mapping keeps it until the worker ends
            return mapped
        return np.memmap(inner, kind, "r")


@lru_cache(maxsize=2)
def arrays(folder: str) -> Arrays:
    return Arrays(folder)


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Of counts 1, 2 and more, from the numbers of keys with counts 1 to 4."""
    if min(n) > 0:
        y = n[0] / (n[0] + 2 * n[1])
        found = tuple(k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3))
        if all(0 < d <= k for k, d in zip((1, 2, 3), found, strict=True)):
            return found
    return PLAIN_DISCOUNTS


def _discount(counts: np.ndarray, by: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *by])[np.minimum(counts, 3)]


@dataclass
class Model:
    """What all workers need beside the arrays: a few numbers a shard."""

    folder: str
    shards: int
    base: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))  # number of the first word of each shard, and of all
    tokens: int = 0
    pair_discounts: tuple = PLAIN_DISCOUNTS
    word_discounts: tuple = PLAIN_DISCOUNTS
    pairs: int = 0
    unseen: float = 1.0  # weight of the uniform distribution

    @property
    def words(self) -> int:
        return int(self.base[-1])

    @property
    def word_bounds(self) -> np.ndarray:
        """The least hash of each shard."""
        step = 2**64 // self.shards
        return np.array([s * step - 2**63 for s in range(self.shards)], np.int64)

    @property
    def context_bounds(self) -> np.ndarray:
        """The first context of each shard; the context behind the last word opens a text."""
        return np.array([s * (self.words + 1) // self.shards for s in range(self.shards)], np.int64)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of words, -1 for unknown ones."""
        held, out = arrays(self.folder), np.full(len(hashes), -1, np.int64)
        shard = np.searchsorted(self.word_bounds, hashes, side="right") - 1
        for s, at in _by_shard(shard):
            known = held("words", s, "<i8")
            if len(known):
                place = np.minimum(np.searchsorted(known, hashes[at]), len(known) - 1)
                out[at] = np.where(known[place] == hashes[at], place + self.base[s], -1)
        return out

    def of_words(self, name: str, kind: str, numbers: np.ndarray) -> np.ndarray:
        """Values of words by their (known) numbers."""
        held, out = arrays(self.folder), np.zeros(len(numbers), np.int64)
        for s, at in _by_shard(np.searchsorted(self.base[1:], numbers, side="right")):
            out[at] = held(name, s, kind)[numbers[at] - self.base[s]]
        return out

    def of_contexts(self, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens behind each context, and the mass that its followers' discounts free."""
        held, total, freed = arrays(self.folder), np.zeros(len(contexts), np.int64), np.zeros(len(contexts))
        bounds = self.context_bounds
        for s, at in _by_shard(np.searchsorted(bounds, contexts, side="right") - 1):
            kinds = held("contexts", s, "<i8").reshape(-1, 4)
            if len(kinds):  # a shard without any bigram has no array
                kinds = kinds[contexts[at] - bounds[s]]
                total[at], freed[at] = kinds[:, 0], kinds[:, 1:] @ np.array(self.pair_discounts)
        return total, freed

    def of_pairs(self, keys: np.ndarray) -> np.ndarray:
        """Counts of sorted bigram keys, 0 for unknown ones."""
        held, out = arrays(self.folder), np.zeros(len(keys), np.int64)
        for s, at in _by_shard(np.searchsorted(self.context_bounds, keys >> 32, side="right") - 1):
            known = held("pairs", s, "<i8")
            if len(known):
                place = np.minimum(np.searchsorted(known, keys[at]), len(known) - 1)
                out[at] = np.where(known[place] == keys[at], held("pair_counts", s, "<u4")[place], 0)
        return out

    def word_probabilities(self, numbers: np.ndarray) -> np.ndarray:
        """Kneser-Ney probabilities without context; -1 is an unknown word."""
        out = np.full(len(numbers), self.unseen / (self.words + 1))
        known = numbers >= 0
        counts = self.of_words("continuations", "<i8", numbers[known])
        out[known] += (counts - _discount(counts, self.word_discounts)) / max(self.pairs, 1)
        return out

    def probabilities(self, numbers: np.ndarray, contexts: np.ndarray) -> np.ndarray:
        """Of each word after its context; -1 is an unknown word or context."""
        if not self.words:
            return np.ones(len(numbers))
        words, back = np.unique(numbers, return_inverse=True)
        out = self.word_probabilities(words)[back]
        known = np.flatnonzero(contexts >= 0)
        distinct, back = np.unique(contexts[known], return_inverse=True)
        total, freed = (x[back] for x in self.of_contexts(distinct))
        known, total, freed = known[total > 0], total[total > 0], freed[total > 0]
        out[known] *= freed / total
        keys, back = np.unique((contexts[known] << 32) | numbers[known], return_inverse=True)
        counts = np.where(numbers[known] >= 0, self.of_pairs(keys)[back], 0)
        out[known] += (counts - _discount(counts, self.pair_discounts)) / total
        return out


def _by_shard(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(shard, kind="stable")
    edges = np.append(_flags(shard[order]), len(order))
    for low, high in zip(edges, edges[1:], strict=False):
        yield int(shard[order[low]]), order[low:high]


def _contexts(numbers: np.ndarray, first: np.ndarray, opening: int) -> np.ndarray:
    """The token before each, ``opening`` before the first of a text."""
    before = np.empty_like(numbers)
    before[1:] = numbers[:-1]
    before[first[:-1]] = opening
    return before


def _kinds(counts: np.ndarray) -> list[int]:
    """How many counts are 1, 2, 3 and 4."""
    return np.bincount(np.minimum(counts, 5), minlength=6)[1:5].tolist()


def _write_words(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, words, counts in _merged(batches):
            write_atomic(f"{model.folder}/words-{shard}", [words.astype("<i8").tobytes()])
            write_atomic(f"{model.folder}/counts-{shard}", [counts.astype("<i8").tobytes()])
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "n": pa.array([len(words)]), "tokens": pa.array([int(counts.sum())])})

    return run


def _pair_keys(model: Model):
    def keys(batch: pa.RecordBatch) -> np.ndarray:
        tokens, first = _token_hashes(batch)
        words, back = np.unique(tokens, return_inverse=True)
        numbers = model.numbers(words)[back]
        return (_contexts(numbers, first, model.words) << 32) | numbers

    return keys


_PAIR_ROWS = _RUN + ", kinds array<long>, pairs long"


def _write_pairs(model: Model):
    """Writes a shard; passes on the counts of counts and, to the words, their distinct contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = np.append(model.context_bounds, model.words + 1)
        schema = pa.schema([("shard", pa.int32()), ("n", pa.int32()), ("data", pa.binary()), ("kinds", pa.list_(pa.int64())), ("pairs", pa.int64())])
        for shard, keys, counts in _merged(batches):
            write_atomic(f"{model.folder}/pairs-{shard}", [keys.astype("<i8").tobytes()])
            write_atomic(f"{model.folder}/pair_counts-{shard}", [np.minimum(counts, 2**32 - 1).astype("<u4").tobytes()])
            size = int(bounds[shard + 1] - bounds[shard])
            context = (keys >> 32) - bounds[shard]
            held = np.zeros((size, 4), np.int64)
            np.add.at(held[:, 0], context, counts)
            np.add.at(held, (context, np.minimum(counts, 3)), 1)
            write_atomic(f"{model.folder}/contexts-{shard}", [held.astype("<i8").tobytes()])
            yield pa.RecordBatch.from_pydict({"shard": [shard], "n": [None], "data": [None], "kinds": [_kinds(counts)], "pairs": [len(keys)]}, schema)
            words = np.sort(keys & 0xFFFFFFFF)
            starts = _flags(words)
            if len(words):
                dealt = _dealt(words[starts], np.diff(np.append(starts, len(words))), model.base[:-1])
                none = [pa.nulls(dealt.num_rows, t) for t in (schema.field("kinds").type, pa.int64())]
                yield pa.RecordBatch.from_arrays([*dealt.columns, *none], schema=schema)

    return run


def _write_continuations(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, words, counts in _merged(batches):
            # Every word follows something, so the shard's words are all here, in order.
            write_atomic(f"{model.folder}/continuations-{shard}", [counts.astype("<i8").tobytes()])
            more = int((counts > 2).sum())
            yield pa.RecordBatch.from_pydict({"kinds": pa.array([_kinds(counts)], pa.list_(pa.int64())), "more": pa.array([more])})

    return run


def train(texts: DataFrame) -> Model:
    """A model of the ``text`` of all rows, its arrays below the shared folder.

    Four numbers per shard reach the driver.  The folder belongs to the caller.
    """
    spark = texts.sparkSession
    texts = texts.select("text")
    shards = max(SHARDS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    model = Model(f"{shared_dir(spark).rstrip('/')}/lm-{uuid.uuid4().hex[:12]}", shards)

    def gathered(rows: DataFrame) -> DataFrame:
        return rows.repartition(shards, "shard").sortWithinPartitions("shard")

    found = texts.mapInArrow(_counted(lambda batch: _token_hashes(batch)[0], model.word_bounds), _RUN)
    written = gathered(found).mapInArrow(_write_words(model), "shard int, n long, tokens long").collect()
    sizes = np.zeros(shards, np.int64)
    for row in written:
        sizes[row["shard"]] = row["n"]
        model.tokens += row["tokens"]
    model.base = np.append(0, np.cumsum(sizes))
    if model.words >= MOST_WORDS:
        raise ValueError(f"{model.words} words; a model numbers {MOST_WORDS}")
    if not model.words:
        return model

    keys = texts.mapInArrow(_counted(_pair_keys(model), model.context_bounds << 32), _RUN)
    pairs = cut(gathered(keys).mapInArrow(_write_pairs(model), _PAIR_ROWS))
    sums = pairs.where("pairs is not null").select("kinds", "pairs").collect()
    model.pairs = sum(r["pairs"] for r in sums)
    model.pair_discounts = discounts(np.sum([r["kinds"] for r in sums], axis=0).tolist())

    back = gathered(pairs.where("pairs is null").select("shard", "n", "data")).mapInArrow(_write_continuations(model), "kinds array<long>, more long").collect()
    kinds = np.sum([r["kinds"] for r in back], axis=0).tolist()
    model.word_discounts = discounts(kinds)
    freed = np.array([kinds[0], kinds[1], sum(r["more"] for r in back)]) @ np.array(model.word_discounts)
    model.unseen = float(freed / model.pairs)
    return model


_SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole):
                tokens, first = _token_hashes(batch)
                row = np.repeat(np.arange(batch.num_rows), np.diff(first))
                words, back = np.unique(tokens, return_inverse=True)
                numbers, counts = model.numbers(words), np.zeros(len(words), np.int64)
                counts[numbers >= 0] = model.of_words("counts", "<i8", numbers[numbers >= 0])
                base = np.log10((counts + 1) / (model.tokens + 1 * (model.words + 1)))[back]
                numbers, known = numbers[back], (counts > 0)[back]
                scores = np.log10(model.probabilities(numbers, _contexts(numbers, first, model.words)))
                sums = {n: np.bincount(row, v, batch.num_rows) for n, v in (("base_score", base), ("score", scores))}
                counted = {"n_tokens": np.diff(first), "n_known": np.bincount(row, known, batch.num_rows).astype(np.int64), "train_tokens": np.full(batch.num_rows, model.tokens)}
                given = counted | sums
                names = [x.split()[0] for x in _SCORED.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(given[n]) if n in given else batch.column(n) for n in names], names)

    return run


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """Rows that are not learned from: crc32 of the id as text, modulo 7, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 7 == 2, F.lit(False))


def score_texts(docs: DataFrame) -> DataFrame:
    """Learn from the rows of ``docs`` (``doc_id``, ``text``) that are not held out, score every row.

    Tokens are the words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case, then one end of text.
    Returns ``doc_id``, ``held_out``, ``n_tokens``, ``n_known`` (tokens that occur in the
    training rows), ``train_tokens``, ``base_score`` (sum of ``log10((c+1)/(N+V+1))``) and
    ``score``, the model's log10 probability of the text; both are rounded to six places, so
    that the order of addition does not show.  ``10 ** (-score / n_tokens)`` is the perplexity.

    Null, empty and blank texts have the end as their only token.  A null doc_id is not held
    out.  Repeated rows count and are scored as often as they come; counts that are equal are
    no special case.  Very long texts are worked on whole, one at a time.  Other columns are
    ignored.  An empty table gives an empty result; if nothing can be learned from, every token
    has probability 1.
    """
    rows = documents(docs).withColumn("held_out", held_out())
    model = train(rows.where("not held_out"))
    scored = rows.mapInArrow(_score(model), _SCORED)
    return scored.withColumns({c: F.round(c, 6) for c in ("base_score", "score")})
