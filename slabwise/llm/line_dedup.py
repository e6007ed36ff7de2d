"""Line dedup across documents.

Lines travel as hashes.  Each task first combines its own: per line hash the three
largest documents that hold it, which is all that merging needs.  These rows are
range-partitioned by hash with a secondary sort by document, and one streaming pass
per range keeps the first document of each hash that has enough documents.  The
decisions meet the documents' own lines (hash, document, positions; AQE splits hot
hashes) and come back as one compressed keep bitmap per document, never as text.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slabwise.llm.common import NO_ID, cut, documents

#: What is stripped at both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TO_LOWER = str.maketrans(_UPPER, _LOWER)


def split_lines(text: str | None) -> list[str]:
    return (text or "").split("\n")


def line_keys(lines: list[str], min_chars: int) -> dict[bytes, list[int]]:
    """128-bit hashes of the keys that are long enough, each with its line numbers."""
    found: dict[bytes, list[int]] = {}
    for number, line in enumerate(lines):
        if len(line) >= min_chars and len(key := line.strip(BLANKS)) >= min_chars:
            digest = hashlib.md5(key.translate(_TO_LOWER).encode("utf-8", "surrogatepass"), usedforsecurity=False).digest()
            found.setdefault(digest, []).append(number)
    return found


def _occurrences(min_chars: int):
    """One row per document and key: hash, document, line numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            high, low, ids, salts, lines = [], [], [], [], []
            rows = zip(batch.column("id").to_pylist(), batch.column("salt").to_pylist(), batch.column("text"), strict=True)
            for doc, salt, text in rows:
                found = line_keys(split_lines(text.as_py()), min_chars)
                pairs = np.frombuffer(b"".join(found), np.int64).reshape(-1, 2)
                high.append(pairs[:, 0])
                low.append(pairs[:, 1])
                ids += [doc] * len(found)
                salts += [salt] * len(found)
                lines += found.values()
            if ids:
                yield pa.RecordBatch.from_pydict(
                    {
                        "k1": np.concatenate(high),
                        "k2": np.concatenate(low),
                        "id": pa.array(ids, pa.int64()),
                        "salt": pa.array(salts, pa.int64()),
                        "lines": pa.array(lines, pa.list_(pa.int32())),
                    }
                )

    return run


def _combine(most: int):
    """Within one task: per hash its ``most`` largest distinct documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        rows = 0
        for batch in batches:
            held.append(np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("k1", "k2", "id")]))
            rows += batch.num_rows
            if rows > 1 << 20:  # combine now and then: memory stays bounded, nothing is dropped but what cannot count
                yield from _top(held, most)
                held, rows = [], 0
        if held:
            yield from _top(held, most)

    return run


def _top(held: list[np.ndarray], most: int) -> Iterator[pa.RecordBatch]:
    k1, k2, ids = np.concatenate(held, axis=1)
    order = np.lexsort((-ids, k2, k1))
    k1, k2, ids = k1[order], k2[order], ids[order]
    new_key = np.append(True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]))
    new_doc = new_key | np.append(True, ids[1:] != ids[:-1])
    k1, k2, ids, new_key = k1[new_doc], k2[new_doc], ids[new_doc], new_key[new_doc]
    starts = np.flatnonzero(new_key)
    rank = np.arange(len(ids)) - np.repeat(starts, np.diff(np.append(starts, len(ids))))
    keep = rank < most
    yield pa.RecordBatch.from_pydict({"k1": k1[keep], "k2": k2[keep], "id": ids[keep]})


def _decide(min_docs: int):
    """Streaming over (hash, document descending): the first document of each hash with enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, last, seen = None, 0, 0, 0
        for batch in batches:
            out: list[tuple[int, int, int]] = []
            columns = (batch.column(c).to_numpy(zero_copy_only=False).tolist() for c in ("k1", "k2", "id"))
            for k1, k2, doc in zip(*columns, strict=True):
                if key != (k1, k2):
                    key, first, last, seen = (k1, k2), doc, doc, 1
                elif doc != last:
                    last, seen = doc, seen + 1
                else:
                    continue
                if seen == min_docs:
                    out.append((k1, k2, first))
            if out:
                k1s, k2s, firsts = zip(*out, strict=True)
                yield pa.RecordBatch.from_pydict({n: pa.array(v, pa.int64()) for n, v in (("k1", k1s), ("k2", k2s), ("first_id", firsts))})

    return run


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Dropped line numbers into a compressed bitmap with a set bit for each line that stays."""
    for batch in batches:
        maps = []
        for lines in batch.column("gone"):
            gone = np.concatenate([x.values.to_numpy(zero_copy_only=False) for x in lines.values])
            keep = np.ones(int(gone.max()) // 8 * 8 + 8, np.uint8)  # whole bytes; lines behind them stay
            keep[gone] = 0
            maps.append(zlib.compress(np.packbits(keep).tobytes(), 1))
        yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "salt": batch.column("salt"), "keep": pa.array(maps, pa.binary())})


def keep_mask(keep: bytes | None, n_lines: int) -> np.ndarray:
    """A bitmap of ``keep_bitmaps`` as one flag per line."""
    mask = np.ones(n_lines, bool)
    if keep is not None:
        bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8))[:n_lines]
        mask[: len(bits)] = bits
    return mask


def _apply(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_lines, n_dropped, digests, texts = [], [], [], []
            for text, keep in zip(batch.column("text"), batch.column("keep"), strict=True):
                kept, lines = text.as_py() or "", kept_count(text.as_py())
                n_lines.append(lines)
                if keep.is_valid:
                    mask = keep_mask(keep.as_py(), lines).tolist()
                    kept = "\n".join(x for x, stays in zip(split_lines(kept), mask, strict=True) if stays)
                    n_dropped.append(lines - sum(mask))
                else:
                    n_dropped.append(0)
                digests.append(hashlib.sha256(kept.encode()).hexdigest())
                if with_text:
                    texts.append(kept)
            out = {n: batch.column(n) for n in batch.schema.names if n not in ("text", "keep")}
            out |= {"n_lines": pa.array(n_lines, pa.int64()), "n_dropped": pa.array(n_dropped, pa.int64()), "kept_sha256": digests}
            if with_text:
                out["kept"] = texts
            yield pa.RecordBatch.from_pydict(out)

    return run


def kept_count(text: str | None) -> int:
    return (text or "").count("\n") + 1


def _keyed(docs: DataFrame, *more: Column) -> DataFrame:
    # 31 bits of the text's hash keep rows that share a doc_id apart.
    salt = F.shiftrightunsigned(F.xxhash64("text"), 33).alias("salt")
    return documents(docs, *more).select("*", F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), salt)


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``id``, ``salt`` and ``keep`` of every document that loses lines; see ``keep_mask``."""
    rows = _keyed(docs)
    # Read twice, and once more to find the ranges; the lines are hashed once.
    found = cut(rows.select("id", "salt", "text").mapInArrow(_occurrences(min_chars), "k1 long, k2 long, id long, salt long, lines array<int>"))
    partial = found.select("k1", "k2", "id").mapInArrow(_combine(min_docs), "k1 long, k2 long, id long")
    # A hash has as many rows as there are tasks, times min_docs, at most: hot lines are small here.
    ranged = partial.repartitionByRange("k1").sortWithinPartitions("k1", "k2", F.desc("id"))
    decided = ranged.mapInArrow(_decide(min_docs), "k1 long, k2 long, first_id long")
    gone = found.join(decided, ["k1", "k2"]).where(F.col("id") != F.col("first_id"))
    by_doc = gone.groupBy("id", "salt").agg(F.collect_set("lines").alias("gone"))
    return by_doc.mapInArrow(_bitmaps, "id long, salt long, keep binary")


def line_dedup(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, with_text: bool = False, more: tuple[str, ...] = ()) -> DataFrame:
    """Drop lines that stand in ``min_docs`` documents or more, except in the last of these.

    A line's key is the line stripped of ``BLANKS`` and with A-Z in lower case; keys
    shorter than ``min_chars`` code points are left alone.  The document with the largest
    doc_id keeps all its lines.  Returns one row per input row: ``doc_id``, the columns
    named in ``more``, ``n_lines`` (before), ``n_dropped``, ``kept_sha256`` and, with
    ``with_text``, ``kept`` (other lines joined by a newline).

    Null and empty texts are one empty line.  A null doc_id counts as the largest.  Rows
    that share a doc_id are one document in the count, and each keeps or loses its own
    lines; repeated rows give repeated rows.  An empty table gives an empty result, and
    columns not named are ignored, whatever their names.
    """
    if min_docs < 2:
        raise ValueError("min_docs must be at least 2")
    carried = F.struct(*more).alias("carried") if more else F.lit(None).cast("int").alias("carried")  # no name can clash inside
    rows = _keyed(docs, carried)
    both = rows.join(keep_bitmaps(docs, min_chars, min_docs), ["id", "salt"], "left").select("doc_id", "carried", "text", "keep")
    schema = T.StructType(both.select("doc_id", "carried").schema.fields)
    schema = schema.add("n_lines", "long").add("n_dropped", "long").add("kept_sha256", "string")
    done = both.mapInArrow(_apply(with_text), schema.add("kept", "string") if with_text else schema)
    found = ["n_lines", "n_dropped", "kept_sha256", *(["kept"] if with_text else [])]
    return done.select("doc_id", *[F.col("carried")[c].alias(c) for c in more], *found)
