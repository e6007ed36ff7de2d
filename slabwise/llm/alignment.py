"""Cross-tokenizer alignment with inverted pair bitmaps.

1. Every text is encoded by two tokenizers where it lies.  Tokens are byte ranges, so one
   pass over the ends of both gives groups (ranges between common ends) and links (pairs
   of tokens whose ranges overlap).
2. Documents are numbered within chunks.  Per pair of ids and chunk there is a compressed
   bitmap of the documents that hold it linked: only 32-bit words that are not zero.
   Multiplicity planes beside it hold the bits of the number of further links.
   Bitmaps of the pieces of a chunk are merged by OR.
3. Bitmaps belong to the owner of their first id.  Popcounts per chunk add up to the number
   of documents of every pair, and the owner sees which partners of an id count highest.
4. The postings go through the owners' counts again and return scores: per chunk and owner
   one number a document, added up beside the document's own row.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slabwise.llm.common import cut, documents
from slabwise.llm.packing import default_ranks
from slabwise.llm.words import pieces

#: Documents and text bytes of a chunk.
CHUNK_ROWS = 8192
_ROW_BITS = CHUNK_ROWS.bit_length() - 1
CHUNK_BYTES = 16 << 20
#: Owners of first ids at least; otherwise as many as there are shuffle partitions.
OWNERS = 64
#: Bytes of one owner's postings that one task goes through.
PART_BYTES = 64 << 20


def default_pieces() -> str:
    """The piece model of 32,000 ids."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _text_table(n: int, end: str) -> list[bytes]:
    """``id,`` and ``id`` with the other end, for all ids in turn."""
    return [f"{i}{mark}".encode() for i in range(n) for mark in (",", end)]


class Aligner:
    """Both tokenizers, with the bytes of all their tokens."""

    def __init__(self, ranks_path: str, model_path: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self._a = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._b = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.a_bytes[rank] = token
        names = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        if max(len(self.a_bytes), len(self.b_bytes)) > 1 << 18:
            raise ValueError("a tokenizer may have 262,144 ids")
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in table], np.int64) for table in (self.a_bytes, self.b_bytes))
        self._texts = _text_table(len(self.a_bytes), "|") + _text_table(len(self.b_bytes), ";")

    def encode(self, text: str | None) -> tuple[list[int], list[int], int]:
        """Ids of both and the number of bytes; nothing if a text is empty or is not what the tokens spell."""
        if text:
            a, b, raw = self._a.encode_ordinary(" " + text), self._b.encode(text), b" " + text.encode()
            if b"".join(map(self.a_bytes.__getitem__, a)) == raw and b"".join(map(self.b_bytes.__getitem__, b)) == raw:
                return a, b, len(raw)
        return [], [], 0

    def align(self, texts: list[str | None]) -> tuple[dict[str, np.ndarray], list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Numbers per text and the hash of its groups, then every link: its text and both ids."""
        encoded = [self.encode(t) for t in texts]
        a, b = (np.fromiter((i for e in encoded for i in e[k]), np.int64) for k in (0, 1))
        n_a, n_b, size = (np.array(x, np.int64) for x in zip(*((len(e[0]), len(e[1]), e[2]) for e in encoded), strict=True))
        text_end = np.cumsum(size)
        flags = np.zeros(int(text_end[-1]) + 1, np.uint8)
        flags[np.cumsum(self.a_sizes[a])] |= 1
        flags[np.cumsum(self.b_sizes[b])] |= 2
        ends = np.flatnonzero(flags)
        at = flags[ends]
        is_a, is_b, common = (at & 1).astype(bool), (at & 2).astype(bool), at == 3
        # Texts without tokens end where the one before them does; that one is found first.
        text = np.searchsorted(text_end, ends, side="left")
        group = np.cumsum(common) - common
        link_a, link_b = a[np.cumsum(is_a) - is_a], b[np.cumsum(is_b) - is_b]
        numbers = {"n_a": n_a, "n_b": n_b, "n_groups": np.bincount(text[common], minlength=len(texts)), "n_links": np.bincount(text, minlength=len(texts))}
        return numbers, self._group_hashes(a, b, group[is_a], group[is_b], common[is_a], common[is_b], n_a + n_b), text, link_a, link_b

    def _group_hashes(self, a, b, a_group, b_group, a_last, b_last, n) -> list[str]:
        groups = int(a_group[-1]) + 1 if len(a_group) else 0
        a_before, b_before = (np.append(0, np.cumsum(np.bincount(g, minlength=groups))) for g in (a_group, b_group))
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + b_before[a_group]] = 2 * a + a_last
        codes[np.arange(len(b)) + a_before[b_group + 1]] = 2 * (len(self.a_bytes) + b) + b_last
        out, low = [], 0
        for high in np.cumsum(n).tolist():
            written = b"".join(map(self._texts.__getitem__, codes[low:high].tolist()))
            out.append(hashlib.sha256(written[:-1]).hexdigest() if written else "")
            low = high
        return out


@lru_cache(maxsize=1)
def aligner(ranks_path: str, model_path: str) -> Aligner:
    return Aligner(ranks_path, model_path)


class Bitmaps:
    """Sparse bitmaps of many pairs, sorted by pair, plane and word.

    ``place`` is ``plane << 24 | word`` with 32 documents a word.  Plane 0 has the documents
    that hold the pair; plane j has bit j - 1 of the number of further links.
    """

    def __init__(self, pair: np.ndarray, place: np.ndarray, bits: np.ndarray):
        self.pair, self.place, self.bits = pair, place, bits

    @classmethod
    def of_links(cls, pair: np.ndarray, row: np.ndarray) -> Bitmaps:
        links = np.sort((pair << _ROW_BITS) | row)
        starts = np.flatnonzero(np.append(True, links[1:] != links[:-1])) if len(links) else np.zeros(0, np.int64)
        more = np.diff(np.append(starts, len(links))) - 1
        pair, row = links[starts] >> _ROW_BITS, links[starts] & (CHUNK_ROWS - 1)
        found, plane = [cls._plane(pair, row, 0)], 1
        while (more >> (plane - 1)).any():
            use = (more >> (plane - 1)) & 1 == 1
            found.append(cls._plane(pair[use], row[use], plane))
            plane += 1
        return cls.merged(found)

    @classmethod
    def _plane(cls, pair: np.ndarray, row: np.ndarray, plane: int) -> Bitmaps:
        return cls(pair, (row >> 5) | (plane << 24), np.left_shift(np.uint32(1), (row & 31).astype(np.uint32)))

    @classmethod
    def merged(cls, parts: list[Bitmaps]) -> Bitmaps:
        """All parts as one, words of the same place merged by OR."""
        pair, place, bits = (np.concatenate([getattr(p, c) for p in parts]) for c in ("pair", "place", "bits"))
        order = np.lexsort((place, pair))
        pair, place, bits = pair[order], place[order], bits[order]
        if not len(pair):
            return cls(pair, place, bits)
        starts = np.flatnonzero(np.append(True, (pair[1:] != pair[:-1]) | (place[1:] != place[:-1])))
        return cls(pair[starts], place[starts], np.bitwise_or.reduceat(bits, starts))

    def document_counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Every pair and the number of documents in its bitmap."""
        own = self.place >> 24 == 0
        pair, counts = self.pair[own], np.bitwise_count(self.bits[own]).astype(np.int64)
        starts = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])) if len(pair) else np.zeros(0, np.int64)
        return pair[starts], np.add.reduceat(counts, starts) if len(starts) else counts

    def link_sums(self, weights: list[np.ndarray], rows: int) -> list[np.ndarray]:
        """Per document the sum of each weight (one a word) over its links."""
        word, bit = np.nonzero(np.unpackbits(self.bits.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little"))
        plane = (self.place >> 24)[word]
        times = np.left_shift(np.int64(1), np.maximum(plane - 1, 0))
        row = (self.place & 0xFFFFFF)[word] * 32 + bit
        out = []
        for weight in weights:
            total = np.zeros(rows, np.int64)
            np.add.at(total, row, times * weight[word])
            out.append(total)
        return out

    def packed(self) -> bytes:
        step = np.diff(self.pair, prepend=0).astype("<i8")
        return _packed(step, self.place.astype("<i4"), self.bits.astype("<u4"))

    @classmethod
    def unpacked(cls, data: bytes, n: int) -> Bitmaps:
        step, place, bits = _unpacked(data, n, ("<i8", "<i4", "<u4"))
        return cls(np.cumsum(step), place.astype(np.int64), bits)


def _packed(*columns: np.ndarray) -> bytes:
    return pa.compress(b"".join(c.tobytes() for c in columns), codec="zstd", asbytes=True)


def _unpacked(data: bytes, n: int, kinds: tuple[str, ...]) -> list[np.ndarray]:
    widths = [np.dtype(k).itemsize for k in kinds]
    raw, at, out = pa.decompress(data, n * sum(widths), codec="zstd", asbytes=True), 0, []
    for kind, width in zip(kinds, widths, strict=True):
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * width
    return out


_ALIGNED = "chunk long, owner int, n int, bits binary, row int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_KINDS = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
_COLUMNS = {n: _KINDS[k] for n, k in (x.split() for x in _ALIGNED.split(", "))}


def _aligned_batch(rows: int, **given) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(given[c], k) if c in given else pa.nulls(rows, k) for c, k in _COLUMNS.items()], list(_COLUMNS))


def _owner(pair: np.ndarray, owners: int) -> np.ndarray:
    """Owners go by the first id alone, spread by a multiplication."""
    first = (pair >> 32).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((first >> np.uint64(33)) % np.uint64(owners)).astype(np.int64)


def _align(ranks_path: str, model_path: str, owners: int):
    """A row per document, and per chunk and owner a row of bitmaps."""

    def flush(chunk: int, parts: list[Bitmaps]) -> Iterator[pa.RecordBatch]:
        whole = Bitmaps.merged(parts)
        owner = _owner(whole.pair, owners)
        order = np.argsort(owner, kind="stable")
        bounds = np.searchsorted(owner[order], np.arange(owners + 1))
        held = [(o, order[bounds[o] : bounds[o + 1]]) for o in range(owners) if bounds[o] < bounds[o + 1]]
        if held:
            bits = [Bitmaps(whole.pair[x], whole.place[x], whole.bits[x]).packed() for _, x in held]
            yield _aligned_batch(len(held), chunk=[chunk] * len(held), owner=[o for o, _ in held], n=[len(x) for _, x in held], bits=bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(ranks_path, model_path)
        chunk, rows, size, parts = TaskContext.get().partitionId() << 32, 0, 0, []
        for whole in batches:
            for batch in pieces(whole, rows=CHUNK_ROWS // 4):
                if rows + batch.num_rows > CHUNK_ROWS or size > CHUNK_BYTES:
                    yield from flush(chunk, parts)
                    chunk, rows, size, parts = chunk + 1, 0, 0, []
                numbers, hashes, text, a, b = both.align(batch.column("text").to_pylist())
                parts.append(Bitmaps.of_links((a << 32) | b, text + rows))
                own = np.arange(rows, rows + batch.num_rows, dtype=np.int32)
                yield _aligned_batch(batch.num_rows, chunk=np.full(batch.num_rows, chunk), row=own, doc_id=batch.column("doc_id"), groups_sha256=hashes, **numbers)
                rows += batch.num_rows
                size += batch.column("text").nbytes
        if parts:
            yield from flush(chunk, parts)

    return run


def _popcount(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per chunk and owner: pairs and in how many of the chunk's documents they are."""
    for batch in batches:
        counted = [Bitmaps.unpacked(b, n).document_counts() for b, n in zip(batch.column("bits").to_pylist(), batch.column("n").to_pylist(), strict=True)]
        sizes, data = [len(p) for p, _ in counted], [_packed(p, c) for p, c in counted]
        yield pa.RecordBatch.from_pydict({"owner": batch.column("owner"), "n": pa.array(sizes, pa.int32()), "bits": pa.array(data, pa.binary())})


def _by_owner(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in names), strict=True)


def _sum_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by owner: documents of every pair of the owner, over all chunks.

    What is held are the owner's distinct pairs; runs are added up as they double it.
    """

    def added(runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        pair, count = (np.concatenate(x) for x in zip(*runs, strict=True))
        pair, where = np.unique(pair, return_inverse=True)
        total = np.zeros(len(pair), np.int64)
        np.add.at(total, where, count)
        return pair, total

    def out(owner: int, runs: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        pair, total = added(runs)
        first = pair >> 32
        starts = np.flatnonzero(np.append(True, first[1:] != first[:-1]))
        highest = np.repeat(np.maximum.reduceat(total, starts), np.diff(np.append(starts, len(pair))))
        return pa.RecordBatch.from_pydict({"owner": pa.array([owner], pa.int32()), "n": pa.array([len(pair)], pa.int32()), "bits": [_packed(pair, total, (total == highest).astype(np.int64))]})

    last, runs, waiting = None, [], 0
    for owner, n, data in _by_owner(batches, "owner", "n", "bits"):
        if owner != last and runs:
            yield out(last, runs)
            runs, waiting = [], 0
        last = owner
        runs.append(tuple(_unpacked(data, n, ("<i8", "<i8"))))
        waiting += n
        if waiting > max(1 << 20, 2 * len(runs[0][0])):
            runs, waiting = [added(runs)], 0
    if runs:
        yield out(last, runs)


def _scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by owner, part and chunk, counts first (no chunk): per chunk two sums a document."""
    pair = count = best = np.zeros(0, np.int64)
    for chunk, n, data in _by_owner(batches, "chunk", "n", "bits"):
        if chunk is None:
            pair, count, best = _unpacked(data, n, ("<i8", "<i8", "<i8"))
            continue
        maps = Bitmaps.unpacked(data, n)
        at = np.searchsorted(pair, maps.pair)
        rows = 32 * (1 + int((maps.place & 0xFFFFFF).max()))
        sums = maps.link_sums([best[at], count[at]], rows)
        yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk], pa.int64()), "n": pa.array([rows], pa.int32()), "bits": [_packed(*sums)]})


_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _with_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by chunk, sums first (they have no row): every document with its sums."""
    last, best, total = None, None, None
    for batch in batches:
        found_best, found_total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
        keep = np.zeros(batch.num_rows, bool)
        columns = zip(*(batch.column(c).to_pylist() for c in ("chunk", "row", "n", "bits")), strict=True)
        for i, (chunk, row, n, data) in enumerate(columns):
            if chunk != last:
                last, best, total = chunk, np.zeros(CHUNK_ROWS + 32, np.int64), np.zeros(CHUNK_ROWS + 32, np.int64)
            if row is None:
                one, other = _unpacked(data, n, ("<i8", "<i8"))
                best[:n] += one
                total[:n] += other
            else:
                keep[i], found_best[i], found_total[i] = True, best[row], total[row]
        added = {"n_best": pa.array(found_best), "count_sum": pa.array(found_total)}
        names = [x.split()[0] for x in _RESULT.split(", ")]
        yield pa.RecordBatch.from_arrays([added[c] if c in added else batch.column(c) for c in names], names).filter(pa.array(keep))


def align_tokens(docs: DataFrame, ranks_path: str | None = None, model_path: str | None = None) -> DataFrame:
    """How two tokenizers cut every text of ``docs`` (``doc_id``, ``text``), and how usual its links are.

    Tokenizer A is the byte-level one of ``ranks_path`` over a blank and the text, B the piece
    model of ``model_path`` over the text (it adds the blank).  Groups lie between byte places
    where tokens of both end; links are pairs of tokens whose bytes overlap.  A pair of ids
    counts the documents of the whole table that hold it linked.  Returns per row of ``docs``
    ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best`` (links whose count is the highest
    of their A id, ties included), ``count_sum`` (counts summed over links) and
    ``groups_sha256`` (of ``a1,a2|b1;a3|b2,b3``).

    Null and empty texts, and texts that the tokens of A or B do not spell again, have no
    tokens: zeros and an empty ``groups_sha256``.  Repeated rows are documents of their own,
    also under one doc_id; a null doc_id stays null.  Very long texts are encoded whole, one at
    a time.  Other columns are ignored.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    owners = max(OWNERS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    paths = ranks_path or default_ranks(), model_path or default_pieces()
    aligned = cut(documents(docs).mapInArrow(_align(*paths, owners), _ALIGNED))
    postings = aligned.where("owner is not null").select("owner", "chunk", "n", "bits")
    counted = postings.select("owner", "n", "bits").mapInArrow(_popcount, "owner int, n int, bits binary")
    counts = cut(counted.repartition(owners, "owner").sortWithinPartitions("owner").mapInArrow(_sum_counts, "owner int, n int, bits binary"))

    # An owner whose postings are many is several tasks; each gets the owner's counts.
    parts = postings.groupBy("owner").agg(F.ceil(F.sum(F.octet_length("bits")) / PART_BYTES).cast("int").alias("parts"))
    dealt = postings.join(F.broadcast(parts), "owner").select("owner", F.pmod(F.xxhash64("chunk"), "parts").cast("int").alias("part"), "chunk", "n", "bits")
    each = counts.join(parts, "owner").select("owner", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("long").alias("chunk"), "n", "bits")
    met = dealt.unionByName(each).repartition(owners, "owner", "part").sortWithinPartitions("owner", "part", F.asc_nulls_first("chunk"))
    returned = met.mapInArrow(_scores, "chunk long, n int, bits binary")

    own = aligned.where("row is not null").drop("owner")
    together = own.unionByName(returned, allowMissingColumns=True).repartition("chunk").sortWithinPartitions("chunk", F.asc_nulls_first("row"))
    return together.mapInArrow(_with_scores, _RESULT)
