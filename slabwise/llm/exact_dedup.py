"""Exact dedup over a cuckoo-filter index of live digests.

The index is cut into buckets by digest.  A bucket holds a cuckoo filter of 16-bit
fingerprints, four to a slot, and the stored keys: full SHA-256 digests with the
smallest document and the number of live rows.  A filter hit is verified against the
stored keys; a filter that overflows is rebuilt at twice the size from them.  Digests
can be deleted again, row by row.

Dedup builds partial indexes inside the tasks that read the documents (a hot text is
one row per task from there on), merges them by bucket, and verifies every digest that
is live more than once against the normalised texts themselves.
"""

from __future__ import annotations

import struct
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slabwise.llm.common import NO_ID, documents

SLOTS = 4
KICKS = 500
#: Keys a task's partial index holds before it is passed on and begun anew.
PARTIAL_KEYS = 500_000
#: Parts of a hot digest while its texts are verified.
SALTS = 16


class CuckooFilter:
    """A set of digests that may answer yes for others; supports deletion."""

    def __init__(self, buckets: int = 16, slots: bytes | None = None):
        if buckets < 1 or buckets & (buckets - 1):
            raise ValueError("buckets must be a power of two")
        self.mask = buckets - 1
        self.slots = array("H", slots if slots is not None else bytes(2 * SLOTS * buckets))

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        place, mark = struct.unpack_from("<QH", digest)
        mark = mark or 1
        return mark, place & self.mask, self._other(place & self.mask, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ ((mark * 0x5BD1E995 >> 7) & self.mask)

    def __contains__(self, digest: bytes) -> bool:
        mark, a, b = self._places(digest)
        return mark in self.slots[a * SLOTS : a * SLOTS + SLOTS] or mark in self.slots[b * SLOTS : b * SLOTS + SLOTS]

    def insert(self, digest: bytes) -> bool:
        """False if there was no room: some fingerprint is lost then and the filter must be rebuilt."""
        mark, a, b = self._places(digest)
        for bucket in (a, b):
            if self._put(bucket, mark):
                return True
        bucket = b
        for kick in range(KICKS):
            at = bucket * SLOTS + (mark + kick) % SLOTS
            mark, self.slots[at] = self.slots[at], mark
            bucket = self._other(bucket, mark)
            if self._put(bucket, mark):
                return True
        return False

    def _put(self, bucket: int, mark: int) -> bool:
        for at in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
            if not self.slots[at]:
                self.slots[at] = mark
                return True
        return False

    def delete(self, digest: bytes) -> None:
        """Only for digests that were inserted."""
        mark, a, b = self._places(digest)
        for bucket in (a, b):
            for at in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.slots[at] == mark:
                    self.slots[at] = 0
                    return
        raise KeyError("digest is not in the filter")


class DigestIndex:
    """A cuckoo filter with its stored keys: digest -> [smallest document, live rows]."""

    def __init__(self):
        self.filter, self.keys = CuckooFilter(), {}

    def add(self, digest: bytes, first_id: int, n: int = 1) -> bool:
        """True if the digest was live already."""
        if digest in self.filter and (stored := self.keys.get(digest)):  # a hit counts once its key agrees
            stored[0], stored[1] = min(stored[0], first_id), stored[1] + n
            return True
        self.keys[digest] = [first_id, n]
        if not self.filter.insert(digest):
            self._resize()
        return False

    def remove(self, digest: bytes, n: int = 1) -> bool:
        """Take away ``n`` live rows; True if the digest was live."""
        if digest not in self.filter or not (stored := self.keys.get(digest)):
            return False
        stored[1] -= n
        if stored[1] <= 0:
            del self.keys[digest]
            self.filter.delete(digest)
        return True

    def _resize(self) -> None:
        buckets = self.filter.mask + 1
        while True:
            buckets *= 2
            self.filter = CuckooFilter(buckets)
            if all(map(self.filter.insert, self.keys)):
                return


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int").alias("bucket")


def normalised(text: Column | str) -> Column:
    """Every run of ``[\\x20\\x09-\\x0D]`` as one space; null is empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


_KEYS = "digest binary, first_id long, n long"


def _rows(index: DigestIndex) -> pa.RecordBatch:
    values = index.keys.values()
    return pa.RecordBatch.from_pydict(
        {
            "digest": pa.array(list(index.keys), pa.binary()),
            "first_id": pa.array([v[0] for v in values], pa.int64()),
            "n": pa.array([v[1] for v in values], pa.int64()),
        }
    )


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index = DigestIndex()
    for batch in batches:
        for digest, doc, n in zip(*(batch.column(c).to_pylist() for c in ("digest", "first_id", "n")), strict=True):
            index.add(digest, doc, n)
        if len(index.keys) >= PARTIAL_KEYS:
            yield _rows(index)
            index = DigestIndex()
    if index.keys:
        yield _rows(index)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket; one index row per bucket."""
    bucket, index = None, DigestIndex()
    for batch in batches:
        for at, digest, doc, n in zip(*(batch.column(c).to_pylist() for c in ("bucket", "digest", "first_id", "n")), strict=True):
            if at != bucket:
                if index.keys:
                    yield _index_row(bucket, index)
                bucket, index = at, DigestIndex()
            index.add(digest, doc, n)
    if index.keys:
        yield _index_row(bucket, index)


_INDEX = "bucket int, filter binary, digests array<binary>, first_ids array<long>, ns array<long>"


def _index_row(bucket: int, index: DigestIndex) -> pa.RecordBatch:
    keys = _rows(index)
    lists = [pa.array([c.to_pylist()], pa.list_(c.type)) for c in keys.columns]
    names = ["bucket", "filter", "digests", "first_ids", "ns"]
    return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([index.filter.slots.tobytes()], pa.binary()), *lists], names)


def _digests(docs: DataFrame) -> DataFrame:
    text = normalised("text")
    return documents(docs).select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("first_id"), F.unhex(F.sha2(text, 256)).alias("digest"), F.lit(1).cast("long").alias("n"), text.alias("norm")
    )


def _built(rows: DataFrame, buckets: int) -> DataFrame:
    partial = rows.select("digest", "first_id", "n").mapInArrow(_partial, _KEYS)
    placed = partial.select(_bucket(buckets), "*").repartition("bucket").sortWithinPartitions("bucket")
    return placed.mapInArrow(_merge, _INDEX)


def build_index(docs: DataFrame, buckets: int = 1024) -> DataFrame:
    """The index of all rows of ``docs``: one row per bucket with its filter and stored keys.

    A task holds one bucket at a time, so choose ``buckets`` such that a bucket's keys
    (about 300 bytes each) fit in a Python worker.  Store the result as a table.
    """
    return _built(_digests(docs), buckets)


def index_keys(index: DataFrame) -> DataFrame:
    """The stored keys: ``digest``, ``first_id``, ``n``."""
    return index.select(F.inline(F.arrays_zip("digests", "first_ids", "ns"))).toDF("digest", "first_id", "n")


def _load(row: dict) -> DigestIndex:
    index = DigestIndex()
    slots = row["filter"]
    index.filter = CuckooFilter(len(slots) // (2 * SLOTS), slots)
    index.keys = {d: [i, n] for d, i, n in zip(row["digests"], row["first_ids"], row["ns"], strict=True)}
    return index


def _update(left: pa.Table, right: pa.Table) -> pa.Table:
    """A bucket after changes: what is live of a digest now, nothing if ``n`` is 0."""
    rows = left.to_pylist()
    index = _load(rows[0]) if rows else DigestIndex()
    changes = right.to_pylist()
    bucket = rows[0]["bucket"] if rows else changes[0]["bucket"]
    for change in changes:
        stored = index.keys.get(change["digest"]) if change["digest"] in index.filter else None
        if not change["n"]:
            if stored:
                index.remove(change["digest"], stored[1])
        elif stored:
            stored[:] = change["first_id"], change["n"]
        else:
            index.add(change["digest"], change["first_id"], change["n"])
    schema = pa.schema([("bucket", pa.int32()), ("filter", pa.binary()), ("digests", pa.list_(pa.binary())), ("first_ids", pa.list_(pa.int64())), ("ns", pa.list_(pa.int64()))])
    return pa.Table.from_batches([_index_row(bucket, index).cast(schema)] if index.keys else [], schema)


def live_rows(docs: DataFrame) -> DataFrame:
    """The live rows that an index stands for: ``digest``, ``id`` and how often it is there.

    Keep them as a table beside the index: a deletion must know whose row it takes away.
    """
    return _digests(docs).groupBy("digest", F.col("first_id").alias("id")).agg(F.sum("n").alias("n"))


def update_index(index: DataFrame, rows: DataFrame, inserted: DataFrame, deleted: DataFrame, buckets: int = 1024) -> tuple[DataFrame, DataFrame]:
    """The index and its live rows after some documents came and then others went.

    ``rows`` are the ``live_rows`` of ``index``; ``buckets`` is as it was built with.  A row is
    taken away by its digest and id, as often as it is deleted: a document that was never
    inserted, or not with that text, takes nothing from others.  The smallest live document
    of a digest is found again if that document goes.  Hot texts combine map-side.  A bucket
    without live digests has no row.  Write both results before the next update.
    """
    came, gone = live_rows(inserted), live_rows(deleted).withColumnRenamed("n", "gone")
    summed = rows.unionByName(came).groupBy("digest", "id").agg(F.sum("n").alias("n"))
    left = summed.join(gone, ["digest", "id"], "left").withColumn("n", F.col("n") - F.coalesce("gone", F.lit(0))).where("n > 0").drop("gone")
    touched = came.select("digest").unionByName(gone.select("digest")).distinct()
    now = left.join(touched, "digest", "left_semi").groupBy("digest").agg(F.min("id").alias("first_id"), F.sum("n").alias("n"))
    changes = touched.join(now, "digest", "left").select(_bucket(buckets).alias("at"), "digest", "first_id", F.coalesce("n", F.lit(0)).alias("n"))
    changed = changes.withColumnRenamed("at", "bucket")
    return index.groupBy("bucket").cogroup(changed.groupBy("bucket")).applyInArrow(_update, _INDEX), left


def exact_dedup(docs: DataFrame, buckets: int = 1024) -> DataFrame:
    """Of rows with equal normalised texts the one with the smallest doc_id stays.

    Returns one row per input row: ``doc_id``, ``keep_id``, ``group_size``, ``kept`` and
    ``text_sha256`` (of the normalised text).  Null texts count as empty, so empty texts
    are equal to each other.  A null doc_id comes after all others.  If rows share the
    smallest doc_id and the text, one of them stays (they are alike).  Only ``doc_id`` and
    ``text`` are read; an empty table gives an empty result.

    Two texts that differ under one digest end the job with an error.
    """
    rows = _digests(docs)
    live = index_keys(_built(rows, buckets)).where("n > 1").select("digest")
    salt = F.pmod(F.xxhash64("first_id"), F.lit(SALTS)).cast("int")
    hits = live.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    members = rows.withColumn("salt", salt).join(hits, ["digest", "salt"], "left_semi")
    contents = members.groupBy("digest", "norm").agg(F.min("first_id").alias("keep"), F.count("*").alias("size"))
    single = F.when(F.count("*") > 1, F.raise_error(F.lit("different texts have the same SHA-256 digest")).cast("long")).otherwise(F.max("size"))
    groups = contents.groupBy("digest").agg(F.min("keep").alias("keep"), single.alias("size"))
    joined = rows.select(F.col("first_id").alias("id"), "digest").join(groups, "digest", "left")
    # Rows that share id and text are numbered apart, by halves of one small group.
    alike = Window.partitionBy("id", "digest").orderBy("id")
    return joined.withColumn("copy", F.row_number().over(alike)).select(
        F.nullif("id", F.lit(NO_ID)).alias("doc_id"),
        F.nullif(F.coalesce("keep", "id"), F.lit(NO_ID)).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        ((F.col("id") == F.coalesce("keep", "id")) & (F.col("copy") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
