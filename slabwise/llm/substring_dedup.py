"""Substring dedup by level-wise doubling of repeated word windows.

The levels are the window length halved (rounded up) until it is at most
``SHORTEST``: 13, 25 and 50 words for a window of 50.  Level one takes windows at
content-selected starts, such that every full window holds one of them.  At each
level only windows that stand in several documents survive; they are extended to
about twice their length, to the right and to the left, and at the last level to
every full window around them.  Nothing is lost: a full window that repeats holds
repeated windows of every shorter level.

Texts that are equal byte for byte are settled beforehand: of a group only the
smallest doc_id takes part, and its copies lose every word if they hold a window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slabwise.llm.common import NO_ID, documents, text_keys
from slabwise.llm.streams import SETTLED, after_first, combine, in_several
from slabwise.llm.words import Words, covered, minimisers, pieces, window_hashes

#: Windows no longer than this are not halved further.
SHORTEST = 16

_MARKS = "key long, id long, at long, state byte"
_FULL = "key long, check int, id long, at long, state byte"


def levels(window: int) -> list[int]:
    out = [window]
    while out[0] > SHORTEST:
        out.insert(0, -(-out[0] // 2))
    return out


def _salted(batch: pa.RecordBatch, rows: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document and place of windows; the place holds 31 bits of the text's key, which keeps
    rows with the same doc_id apart, and the window's first word."""
    ids = batch.column("id").to_numpy(zero_copy_only=False)
    salts = batch.column("salt").to_numpy(zero_copy_only=False)
    return ids[rows], (salts[rows] << 32) | starts


def _marks(batch, words, hashes, starts, length, full) -> pa.RecordBatch:
    rows = np.searchsorted(words.first, starts, side="right") - 1
    ids, at = _salted(batch, rows, starts - words.first[rows])
    columns = {"key": window_hashes(hashes, length, starts).view(np.int64)}
    if full:
        columns["check"] = window_hashes(hashes, length, starts, 2).astype(np.uint32).view(np.int32)
    return pa.RecordBatch.from_pydict(columns | {"id": ids, "at": at})


def _settled(full: bool):
    return combine(["key", "check"] if full else ["key"], "id", later=full)


def _first_level(length: int, window: int):
    full = length == window
    settled = _settled(full)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole):
                words = Words(batch.column("text"))
                hashes = words.hashes()
                if full:
                    starts = np.flatnonzero(np.arange(len(words)) + window <= words.ends())
                else:
                    starts, _ = minimisers(words, hashes, length, window)
                if len(starts):
                    yield _marks(batch, words, hashes, starts, length, full)

    return lambda batches: settled(run(batches))


def _next_level(length: int, longer: int, window: int):
    full = longer == window
    settled = _settled(full)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole):
                words = Words(batch.column("text"))
                hashes = words.hashes()
                found = batch.column("starts")
                rows = np.repeat(np.arange(batch.num_rows), found.value_lengths().to_numpy(zero_copy_only=False))
                places = found.flatten().to_numpy(zero_copy_only=False) + words.first[rows]
                if full:
                    steps = np.zeros(len(words) + 1, np.int64)
                    np.add.at(steps, np.maximum(places - (longer - length), words.first[rows]), 1)
                    np.add.at(steps, places + 1, -1)
                    starts = np.flatnonzero(np.cumsum(steps[:-1]) > 0)
                    starts = starts[starts + longer <= words.ends()[starts]]
                else:
                    left = places - (longer - length)
                    both = np.concatenate([places[places + longer <= words.first[rows + 1]], left[left >= words.first[rows]]])
                    starts = np.unique(both)
                if len(starts):
                    yield _marks(batch, words, hashes, starts, longer, full)

    return lambda batches: settled(run(batches))


def _kept(window: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole):
                n_words, n_removed, digests, texts = [], [], [], []
                found = batch.column("starts")
                for row, text in enumerate(batch.column("text").cast(pa.large_binary())):
                    words = (text.as_py() or b"").split()  # bytes split at exactly the six separators
                    n_words.append(len(words))
                    if found[row].is_valid:
                        gone = covered(found[row].values.to_numpy(zero_copy_only=False), window, len(words))
                        words = [w for w, out in zip(words, gone.tolist(), strict=True) if not out]
                    kept = b" ".join(words)
                    n_removed.append(n_words[-1] - len(words))
                    digests.append(hashlib.sha256(kept).hexdigest())
                    texts.append(kept)
                out = {"id": batch.column("id"), "h1": batch.column("h1"), "h2": batch.column("h2")}
                out |= {"n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "kept_sha256": digests}
                if with_text:
                    out["kept"] = pa.array(texts, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_pydict(out)

    return run


def _sorted_by(marks: DataFrame, *order) -> DataFrame:
    """Open rows and witnesses meet by key; settled ones are dealt out evenly."""
    place = F.when(F.col("state") == SETTLED, F.xxhash64("key", "at")).otherwise(F.col("key"))
    return marks.repartition(place).sortWithinPartitions(*order)


def _starts(marks: DataFrame) -> DataFrame:
    """One row per text with its window starts."""
    salt = F.shiftright("at", 32).alias("salt")
    start = F.col("at").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")
    return marks.groupBy("id", salt).agg(F.collect_list(start).alias("starts"))


def substring_dedup(docs: DataFrame, window: int = 50, with_text: bool = False) -> DataFrame:
    """Remove the words of every ``window``-word window that also starts in an earlier document.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored.  Returns one row
    per input row: ``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` and, with
    ``with_text``, ``kept`` (kept words joined by one space).

    Earlier means a smaller doc_id; null ids come last.  Rows that share a doc_id never
    remove words from each other, unless their texts are equal, and then neither does:
    equal texts under one id give equal rows.  Null and empty texts have no words.
    Texts shorter than the window stay whole.  An empty table gives an empty result.
    """
    if window < 1:
        raise ValueError("window must be at least 1")
    h1, h2 = text_keys("text")
    rows = documents(docs).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), h1.alias("h1"), h2.alias("h2"), "text")
    classes = rows.groupBy("h1", "h2").agg(F.min("id").alias("id"))
    salt = F.shiftrightunsigned("h1", 33).alias("salt")
    # One exchange of the texts, by document, serves every level.
    texts = rows.select("*", salt).join(classes.select("id", salt), ["id", "salt"], "left_semi")
    steps = levels(window)
    full = _FULL if len(steps) == 1 else _MARKS
    marks = texts.select("id", "salt", "text").mapInArrow(_first_level(steps[0], window), full)
    for shorter, longer in zip(steps, steps[1:], strict=False):
        again = _sorted_by(marks, "key", F.desc("state"), "id").mapInArrow(in_several(["key"], "id"), _MARKS)
        candidates = texts.join(_starts(again), ["id", "salt"]).select("id", "salt", "text", "starts")
        schema = _FULL if longer == window else _MARKS
        marks = candidates.mapInArrow(_next_level(shorter, longer, window), schema)
    later = _sorted_by(marks, "key", "check", "id").mapInArrow(after_first(["key", "check"], "id"), _FULL)
    schema = "id long, h1 long, h2 long, n_words long, n_removed long, kept_sha256 string"
    done = (
        texts.join(_starts(later), ["id", "salt"], "left")
        .select("id", "h1", "h2", "text", "starts")
        .mapInArrow(_kept(window, with_text), schema + ", kept string" * with_text)
        .dropDuplicates(["id", "h1", "h2"])
        .withColumnRenamed("id", "first_id")
    )
    copy = (F.col("id") != F.col("first_id")) & (F.col("n_words") >= window)
    result = rows.select("id", "h1", "h2").join(done, ["h1", "h2"])
    columns = [
        F.nullif("id", F.lit(NO_ID)).alias("doc_id"),
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
    ]
    if with_text:
        columns.append(F.when(copy, F.lit("")).otherwise(F.col("kept")).alias("kept"))
    return result.select(*columns)
