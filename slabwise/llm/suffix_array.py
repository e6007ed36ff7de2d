"""Substring dedup with a sparse suffix array.

Suffixes start at content-selected minimisers: every run of ``length`` words holds one, at
the same place in every copy of the run.  Suffixes whose first gram stands in one document
only cannot be part of a repeat and go.  Every window of ``length`` words around one of the
others is dealt by its hash, and each document is matched with the next lower id that has
the same window: equal windows are a class with neighbours of its own, whatever words lie
around them.  Matches that overlap on one diagonal of two documents are joined to one.
Where the words beside a joined match agree, since the neighbours change within a run, the
two texts are compared word by word and the match becomes the maximal one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slabwise.llm.common import NO_ID, cut, documents, text_keys, word_count
from slabwise.llm.streams import SETTLED, combine, in_several
from slabwise.llm.words import Words, minimisers, pieces, window_hashes

GRAM = 13

_MARKS = "key long, id long, at long, state byte"
_WINDOWS = "key long, id long, at int, beside long"
_MATCHES = "id long, partner long, shift int, at int, left boolean, right boolean"
_RUNS = "id long, partner long, shift int, at int, end int"


def _grams(gram: int, length: int):
    """First grams of the retained suffixes, by document."""
    settle = combine(["key"], "id", later=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole):
                words = Words(batch.column("text"))
                starts, hashes = minimisers(words, words.hashes(), gram, length)
                if len(starts):
                    row = words.rows()[starts]
                    ids = batch.column("id").to_numpy(zero_copy_only=False)[row]
                    yield pa.RecordBatch.from_pydict({"key": hashes.view(np.int64), "id": ids, "at": starts - words.first[row]})

    return lambda batches: settle(run(batches))


def _windows(gram: int, length: int):
    """Hashes of the windows of ``length`` words that hold a gram at one of the given starts.

    ``beside`` has 32 bits each of the words before and behind, 0 where the text ends.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole):
                words = Words(batch.column("text"))
                hashes = words.hashes()
                found = batch.column("starts")
                row = np.repeat(np.arange(batch.num_rows), found.value_lengths().to_numpy(zero_copy_only=False))
                at = found.flatten().to_numpy(zero_copy_only=False) + words.first[row]
                room = at + gram <= words.first[row + 1]  # rows that share an id may be shorter
                row, at = row[room], at[room]
                steps = np.zeros(len(words) + 1, np.int64)
                np.add.at(steps, np.maximum(at - (length - gram), words.first[row]), 1)
                np.add.at(steps, at + 1, -1)
                starts = np.flatnonzero(np.cumsum(steps[:-1]) > 0)
                starts = starts[starts + length <= words.ends()[starts]]
                if len(starts):
                    row = words.rows()[starts]
                    marks = np.concatenate([hashes >> np.uint64(32) | np.uint64(1), np.zeros(1, np.uint64)])
                    left = np.where(starts > words.first[row], marks[starts - 1], np.uint64(0))
                    right = np.where(starts + length < words.first[row + 1], marks[starts + length], np.uint64(0))
                    yield pa.RecordBatch.from_pydict(
                        {
                            "key": window_hashes(hashes, length, starts).view(np.int64),
                            "id": batch.column("id").take(pa.array(row)),
                            "at": (starts - words.first[row]).astype(np.int32),
                            "beside": (left << np.uint64(32) | right).view(np.int64),
                        }
                    )

    return run


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by window, id and place: each with a row of the next lower id that has the window.

    The k-th place in a document meets the k-th place in the other, or the last one.  Places
    of a window's first document beyond those of the second meet the second's last.  ``left`` and
    ``right`` tell whether the words beside agree as well.
    """

    def pairs(key, doc, at, beside, opening: bool, done: bool):
        starts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])))
        sizes = np.diff(np.append(starts, len(key)))
        follows = np.append(False, key[starts[1:]] == key[starts[:-1]])
        first = ~follows
        first[0] = opening
        later = np.flatnonzero(follows)
        if not done:
            later = later[later < len(starts) - 1]
        rows, others = [], []
        for own, other, low in ((later, later - 1, 0), (later[first[later - 1]] - 1, later[first[later - 1]], 1)):
            skip = sizes[other] * low  # places that have met one already
            n = np.maximum(sizes[own] - skip, 0)
            rank = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - skip, n)
            rows.append(np.repeat(starts[own], n) + rank)
            others.append(np.repeat(starts[other], n) + np.minimum(rank, np.repeat(sizes[other] - 1, n)))
        upper, lower = np.concatenate([rows[0], others[1]]), np.concatenate([others[0], rows[1]])
        sides = [(beside.view(np.uint64) >> np.uint64(k)).astype(np.uint32) for k in (32, 0)]
        left, right = ((x[upper] == x[lower]) & (x[upper] > 0) for x in sides)
        out = pa.RecordBatch.from_pydict({"id": doc[upper], "partner": doc[lower], "shift": at[upper] - at[lower], "at": at[upper], "left": left, "right": right})
        hold = max(0, len(starts) - 2)
        return out, starts[hold], bool(first[hold])

    held, opening = None, True
    for batch in batches:
        if batch.num_rows:
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "id", "at", "beside")]
            held = columns if held is None else [np.concatenate(x) for x in zip(held, columns, strict=True)]
            out, low, opening = pairs(*held, opening, False)
            held = [c[low:] for c in held]
            yield out
    if held is not None:
        # Of what is held, only the last document of a window has not met the one before.
        yield pairs(*held, opening, True)[0]


def _joined(matches: DataFrame, *more: Column) -> DataFrame:
    """Overlapping matches on one diagonal as one."""
    diagonal = Window.partitionBy("id", "partner", "shift").orderBy("at", "end")
    reach = F.max("end").over(diagonal.rowsBetween(Window.unboundedPreceding, -1))
    runs = matches.withColumn("opens", F.when(F.col("at") <= reach, 0).otherwise(1))
    runs = runs.withColumn("run", F.sum("opens").over(diagonal.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("id", "partner", "shift", "run").agg(F.min("at").alias("at"), F.max("end").alias("end"), *more).drop("run")


def _extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of two texts as far as the words agree; runs that other rows of these ids hold go."""
    for whole in batches:
        out = []
        for k in range(whole.num_rows):
            row = whole.slice(k, 1)
            words = Words(pa.concat_arrays([row.column("text"), row.column("partner_text")]))
            hashes = words.hashes()
            a, b = hashes[: words.first[1]], hashes[words.first[1] :]
            ids = (row.column("id")[0].as_py(), row.column("partner")[0].as_py())
            last = None
            for x in sorted(row.column("runs")[0].as_py(), key=lambda x: x["shift"]):
                shift, at, end = x["shift"], x["at"], x["end"]
                low, high = max(0, shift), min(len(a), len(b) + shift)
                if not low <= at < end <= high:
                    continue
                if shift != last:
                    differ = low + np.flatnonzero(a[low:high] != b[low - shift : high - shift])
                    edges, last = np.concatenate([[low - 1], differ, [high]]), shift
                n = int(np.searchsorted(edges, at))
                if end <= edges[n]:
                    out.append((*ids, shift, int(edges[n - 1]) + 1, int(edges[n])))
        if out:
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
            arrays = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "partner", "shift", "at", "end"])


def _maximal(runs: DataFrame, texts: DataFrame) -> DataFrame:
    """Runs from ``_joined`` with ``left`` and ``right``, extended where these say that more may agree."""
    columns = ["id", "partner", "shift", "at", "end"]
    closed, more = runs.where("not left and not right").select(columns), runs.where("left or right").select(columns)
    pairs = more.groupBy("id", "partner").agg(F.collect_list(F.struct("shift", "at", "end")).alias("runs"))
    others = texts.select(F.col("id").alias("partner"), F.col("text").alias("partner_text"))
    longer = pairs.join(texts.select("id", "text"), "id").join(others, "partner").mapInArrow(_extended, _RUNS)
    return closed.unionByName(_joined(more.unionByName(longer)))


def suffix_array_matches(docs: DataFrame, length: int = 50, gram: int = GRAM) -> DataFrame:
    """Runs of ``length`` words or more that two documents share.

    Returns rows ``doc_id``, ``start``, ``n_words``, ``partner_id`` and ``partner_start``
    (in words from 0): the run of the document with the larger id and its neighbour, the
    next lower id with the same ``length`` words.  A run that many documents share is a chain
    of neighbours, not all pairs.  Every match is maximal: the words before it differ, and so
    do the words behind it, or a text ends.
    Documents that share no such run do not appear.

    Of documents with equal texts the smallest id takes part; every other one is a match
    with it from end to end.  Rows that share a doc_id are not compared with each other.
    Null ids count as one document that comes last (``doc_id`` is null then); null, empty
    and shorter texts have no runs.  Only ``doc_id`` and ``text`` are read; an empty table
    gives an empty result.
    """
    if not 0 < gram <= length:
        raise ValueError("gram must be 1 to length")
    h1, h2 = text_keys("text")
    rows = documents(docs).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), h1.alias("h1"), h2.alias("h2"), "text")
    classes = rows.groupBy("h1", "h2").agg(F.min("id").alias("partner"))
    texts = rows.select("id", "text").join(classes.select(F.col("partner").alias("id")).distinct(), "id", "left_semi")

    marks = texts.mapInArrow(_grams(gram, length), _MARKS)
    place = F.when(F.col("state") == SETTLED, F.xxhash64("key", "id", "at")).otherwise(F.col("key"))
    shared = marks.repartition(place).sortWithinPartitions("key", F.desc("state"), "id").mapInArrow(in_several(["key"], "id"), _MARKS)
    starts = shared.groupBy("id").agg(F.collect_set(F.col("at").cast("int")).alias("starts"))
    windows = texts.join(starts, "id").mapInArrow(_windows(gram, length), _WINDOWS)
    pairs = windows.repartition("key").sortWithinPartitions("key", "id", "at").mapInArrow(_neighbours, _MATCHES)
    ends = F.min_by("left", "at").alias("left"), F.max_by("right", "at").alias("right")
    matches = _maximal(cut(_joined(pairs.withColumn("end", F.col("at") + length), *ends)), texts)
    found = matches.select("id", F.col("at").alias("start"), (F.col("end") - F.col("at")).alias("n_words"), "partner", (F.col("at") - F.col("shift")).alias("partner_start"))

    whole = rows.select("id", "h1", "h2", word_count("text").cast("int").alias("n_words")).where(F.col("n_words") >= length)
    zero = F.lit(0)
    copies = whole.join(classes, ["h1", "h2"]).where("id <> partner").select("id", zero.alias("start"), "n_words", "partner", zero.alias("partner_start"))
    both = found.unionByName(copies)
    return both.select(
        F.nullif("id", F.lit(NO_ID)).alias("doc_id"), F.col("start").cast("int").alias("start"), F.col("n_words").cast("int").alias("n_words"),
        F.col("partner").alias("partner_id"), F.col("partner_start").cast("int").alias("partner_start"),
    )
