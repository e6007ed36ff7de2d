"""N-gram Jaccard join with rare-first prefix filtering.

1. Documents with equal shingle sets are one class; its smallest document stands for it.
   Texts are read where they lie; only hashes travel, and the texts of candidates.
2. Shingles are ordered rare first by a table of counters of fixed size, summed over all
   documents.  Any common order gives right results; this one keeps posting lists short.
3. Two sets that reach the threshold share a shingle of their prefixes.  Prefix rows of
   shingles that only one document has are dropped, and those that no other row of their
   list is near enough to in size (the length filter): they meet nothing.
4. Round one tries, along each posting list, every document with the one before and with
   the first.  This settles groups of near copies in linear work.
5. Round two tries, along each posting list, the document with most candidates so far with
   all others: copies of one text are closer to it than to each other.
   Round three tries all pairs of a posting list whose sides are still not connected, within
   cells of a bounded number of rows, under the length, the positional and the suffix filter.
6. Candidates, each pair once, pass the suffix filter by the profiles of their sets; those
   left meet their texts and are verified.

Links, and the members of classes, end in connected components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slabwise.llm.common import NO_ID, cut, documents
from slabwise.llm.components import connected_components
from slabwise.llm.words import Words, mix, pieces, window_hashes

#: Counters of the frequency table (one byte each where it is used), and its parts.
COUNTERS = 1 << 23
SEGMENTS = 64
#: Rows of one block of a posting list in round three; pairs of blocks are cells.
BLOCK = 4096
#: Partners that one copy of a document is verified against.
PARTNERS = 256
#: Parts of a set whose sizes bound its distance to another.
PROFILE = 64
#: Bits of the map that finds candidates' texts without an exchange: 1 MB.
FILTER_BITS = 1 << 23
_ROWS = 2048
_BITS = np.uint64(53)


def shingle_sets(batch: pa.RecordBatch, size: int, text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Row and 53-bit hash of every distinct shingle, sorted; 2,048 rows at most.

    A-Z are lower-cased.  A text with fewer words than ``size`` is one shingle.
    """
    words = Words(batch.column(text), lower=True)
    hashes, rows, ends = words.hashes(), words.rows(), words.ends()
    full = np.flatnonzero(np.arange(len(words)) + size <= ends)
    found = [(rows[full], window_hashes(hashes, size, full))]
    for count in range(1, size):
        short = words.first[:-1][words.counts == count]
        found.append((rows[short], window_hashes(hashes, count, short)))
    row, value = (np.concatenate(x) for x in zip(*found, strict=True))
    keys = np.sort((row.astype(np.uint64) << _BITS) | (value >> np.uint64(11)))
    if len(keys):
        keys = keys[np.append(True, keys[1:] != keys[:-1])]
    return (keys >> _BITS).astype(np.int64), keys & np.uint64((1 << 53) - 1)


def _small_pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for low in range(0, batch.num_rows, _ROWS):
        yield from pieces(batch.slice(low, _ROWS))


def _set_keys(value: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """128 bits of every set, from the sets one behind the other and their sizes."""
    sums, ends = [], np.cumsum(n)
    for salt in (1, 2):
        total = np.zeros(len(value) + 1, np.uint64)
        np.cumsum(mix(value + np.uint64(salt << 60)), out=total[1:])
        sums.append((total[ends] - total[ends - n]).view(np.int64))
    return sums


def _profiles(row: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """Per set the sizes of its ``PROFILE`` parts by hash, 255 at most, as rows of bytes.

    The sum of the differences of two profiles is at most the number of shingles that only
    one of the sets has: the suffix filter's bound, with fixed pivots.
    """
    part = value >> np.uint64(53 - PROFILE.bit_length() + 1)
    counts = np.bincount(row * PROFILE + part.astype(np.int64), minlength=n * PROFILE)
    return np.minimum(counts, 255).astype(np.uint8).reshape(n, PROFILE)


def _signatures(size: int):
    """Per document: set size, 128 bits of the set and its profile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _small_pieces(whole):
                row, value = shingle_sets(batch, size)
                n = np.bincount(row, minlength=batch.num_rows)
                s1, s2 = _set_keys(value, n)
                profiles = pa.array([p.tobytes() for p in _profiles(row, value, batch.num_rows)], pa.binary())
                yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "n": n, "s1": s1, "s2": s2, "profile": profiles})

    return run


def _count(size: int, counters: int):
    """One table of counters per task, cut into compressed segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(counters, np.uint32)
        for whole in batches:
            for batch in _small_pieces(whole):
                _, value = shingle_sets(batch, size)
                np.add.at(table, (value & np.uint64(counters - 1)).astype(np.int64), 1)
        if table.any():
            # Bytes of the same rank lie together: the upper ones are nearly all 0.
            planes = (np.ascontiguousarray(part.view(np.uint8).reshape(-1, 4).T) for part in np.split(table, SEGMENTS))
            parts = [pa.compress(p.tobytes(), codec="zstd", asbytes=True) for p in planes]
            yield pa.RecordBatch.from_pydict({"segment": pa.array(range(SEGMENTS), pa.int32()), "part": pa.array(parts, pa.binary())})

    return run


def _add_up(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for segment, part in zip(batch.column("segment").to_pylist(), batch.column("part"), strict=True):
                planes = np.frombuffer(pa.decompress(part.as_py(), width * 4, codec="zstd", asbytes=True), np.uint8)
                counts = np.ascontiguousarray(planes.reshape(4, -1).T).view(np.uint32)[:, 0]
                totals.setdefault(segment, np.zeros(width, np.uint64))
                totals[segment] += counts
        for segment, total in totals.items():
            level = np.minimum(255, np.log2(total + 1.0) * 8).astype(np.uint8)
            yield pa.RecordBatch.from_pydict({"segment": pa.array([segment], pa.int32()), "part": pa.array([level.tobytes()], pa.binary())})

    return run


def frequency_levels(texts: DataFrame, size: int, counters: int = COUNTERS) -> np.ndarray:
    """For every counter a level that rises with the number of documents; ``counters`` bytes in all."""
    parts = texts.select("text").mapInArrow(_count(size, counters), "segment int, part binary")
    summed = parts.repartition("segment").mapInArrow(_add_up(counters // SEGMENTS), "segment int, part binary")
    levels = np.zeros(counters, np.uint8)
    width = counters // SEGMENTS
    for row in summed.collect():  # SEGMENTS rows of a fixed size
        levels[row["segment"] * width : (row["segment"] + 1) * width] = np.frombuffer(row["part"], np.uint8)
    return levels


def _prefixes(size: int, percent: int, levels):
    """Prefix rows: shingle, document, set size, place in the rare-first order.

    Of equal sets a task passes on the first only (it remembers 128 bits of each).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = levels.value, set()
        for whole in batches:
            for batch in _small_pieces(whole):
                row, value = shingle_sets(batch, size)
                if not len(value):
                    continue
                level = table[(value & np.uint64(len(table) - 1)).astype(np.int64)]
                order = np.argsort((row.astype(np.uint64) << _BITS) | (level.astype(np.uint64) << np.uint64(45)) | (value >> np.uint64(8)), kind="stable")
                value = value[order]  # rows stay in order
                n = np.bincount(row, minlength=batch.num_rows)
                place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                new = np.zeros(batch.num_rows, bool)
                for i, key in enumerate(zip(*(x.tolist() for x in _set_keys(value, n)), strict=True)):
                    if key not in seen:
                        seen.add(key)
                        new[i] = True
                keep = (place <= (n - (n * percent + 99) // 100)[row]) & new[row]
                yield pa.RecordBatch.from_pydict(
                    {
                        "token": value[keep].view(np.int64),
                        "id": batch.column("id").take(pa.array(row[keep])),
                        "n": n[row[keep]].astype(np.int32),
                        "pos": place[keep].astype(np.int32),
                    }
                )

    return run


def _possible(n1, p1, n2, p2, percent: int):
    """Length and positional filter of two prefix rows, as arrays."""
    least, most = np.minimum(n1, n2), np.maximum(n1, n2)
    need = -(-(percent * (n1 + n2)) // (100 + percent))
    return (100 * least >= percent * most) & (1 + np.minimum(n1 - p1, n2 - p2) - 1 >= need)


_PAIR = "a long, b long"


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
    both = both[both[:, 0] != both[:, 1]]
    return pa.RecordBatch.from_pydict({"a": np.ascontiguousarray(both[:, 0]), "b": np.ascontiguousarray(both[:, 1])})


def _along(percent: int):
    """Rows sorted by shingle and set size: each with the one before and the first of its list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = head = None
        for batch in batches:
            if not batch.num_rows:
                continue
            token, *rest = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("token", "id", "n", "pos"))
            rows = np.stack(rest)
            same = np.append(last is not None and last[0] == token[0], token[1:] == token[:-1])
            starts = np.flatnonzero(~same)
            before = np.concatenate([(last[1] if last else rows[:, 0])[:, None], rows[:, :-1]], axis=1)
            run_of = np.cumsum(~same)
            heads = np.concatenate([(head if head is not None else rows[:, 0])[:, None], rows[:, starts]], axis=1)
            first = heads[:, run_of]
            a, b = [], []
            for other in (before, first):
                use = same & _possible(other[1], other[2], rows[1], rows[2], percent)
                a.append(other[0][use])
                b.append(rows[0][use])
            last, head = (token[-1], rows[:, -1].copy()), first[:, -1].copy()
            yield _pairs(np.concatenate(a), np.concatenate(b))

    return run


def _to_hubs(percent: int):
    """Rows sorted by shingle, the hub of each list first: the hub with all others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, hub = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            token, *rest = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("token", "id", "n", "pos"))
            rows = np.stack(rest)
            new = np.append(token[0] != last, token[1:] != token[:-1])
            heads = np.concatenate([(rows[:, 0] if hub is None else hub)[:, None], rows[:, new]], axis=1)
            first = heads[:, np.cumsum(new)]
            use = ~new & _possible(first[1], first[2], rows[1], rows[2], percent)
            last, hub = token[-1], first[:, -1].copy()
            yield _pairs(first[0][use], rows[0][use])

    return run


def _profile_rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, PROFILE).astype(np.int16)


def _suffixes_fit(x: np.ndarray, y: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
    """Pairs whose profiles leave the threshold in reach; ``n`` is the sum of both sizes."""
    return np.abs(x - y).sum(axis=1, dtype=np.int64) <= n - 2 * -(-(percent * n) // (100 + percent))


def _cells(percent: int):
    """One cell at a time: pairs of its two sides (or within its one) that are not connected yet."""

    names = ("token", "left", "right", "own", "comp", "id", "n", "pos")

    def cell(rows: np.ndarray, profiles: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        _, left, right, own, comp, ids, n, pos = rows
        if (comp == comp[0]).all():
            return []
        one = left[0] == right[0]
        kinds, counts = np.unique(comp, return_counts=True)
        largest = kinds[counts.argmax()]
        found = []
        # Two sides that differ: one of them at least is not of the largest component.
        for i in np.flatnonzero(comp != largest):
            ok = (comp != comp[i]) & _possible(n, pos, n[i], pos[i], percent)
            if not one:
                ok &= own != own[i]
            near = np.flatnonzero(ok)
            near = near[_suffixes_fit(profiles[near], profiles[i], n[near] + n[i], percent)]
            if len(near):
                found.append((ids[near], np.full(len(near), ids[i])))
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, kept = np.zeros((len(names), 0), np.int64), np.zeros((0, PROFILE), np.int16)
        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in names])
            rows = np.concatenate([held, rows], axis=1)
            profiles = np.concatenate([kept, _profile_rows(batch.column("profile"))])
            starts = np.flatnonzero(np.append(True, (rows[:3, 1:] != rows[:3, :-1]).any(axis=0))) if rows.shape[1] else np.zeros(1, np.int64)
            found = [x for low, high in zip(starts, starts[1:], strict=False) for x in cell(rows[:, low:high], profiles[low:high])]
            held, kept = rows[:, starts[-1] :], profiles[starts[-1] :]
            if found:
                yield _pairs(np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found]))
        if held.shape[1] and (found := cell(held, kept)):
            yield _pairs(np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found]))

    return run


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Exactly: 100 * intersection >= percent * union, of two sorted sets."""
    need = -(-(percent * (len(x) + len(y))) // (100 + percent))
    if need > min(len(x), len(y)):
        return False
    return len(np.intersect1d(x, y, assume_unique=True)) >= need


def _verify(size: int, percent: int):
    """Rows sorted by (a, part, b): a's own text comes first (b is null), then its partners'."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner, own_sets = None, []
        for whole in batches:
            for batch in _small_pieces(whole):
                row, value = shingle_sets(batch, size)
                bounds = np.searchsorted(row, np.arange(batch.num_rows + 1))
                a, b = [], []
                rows = zip(*(batch.column(c).to_pylist() for c in ("a", "part", "b")), strict=True)
                for i, (left, part, right) in enumerate(rows):
                    one = value[bounds[i] : bounds[i + 1]]
                    if right is None:
                        own_sets = [*own_sets, one] if owner == (left, part) else [one]
                        owner = (left, part)
                    elif any(_similar(x, one, percent) for x in own_sets):
                        a.append(left)
                        b.append(right)
                if a:
                    yield _pairs(np.array(a, np.int64), np.array(b, np.int64))

    return run


def _suffix_filter(percent: int):
    """Pairs whose profiles leave the threshold in reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n = sum(batch.column(c).to_numpy(zero_copy_only=False) for c in ("n", "m"))
            keep = _suffixes_fit(_profile_rows(batch.column("x")), _profile_rows(batch.column("y")), n, percent)
            if keep.any():
                yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def _near_sizes(rows: DataFrame, percent: int) -> DataFrame:
    """The rows of posting lists that some other row of the list is near enough to in size.

    Of all sizes the next smaller and the next larger one are nearest, so these decide.
    """
    order = Window.partitionBy("token").orderBy("n", "id")
    below, above = F.lag("n").over(order), F.lead("n").over(order)
    near = F.coalesce(100 * below >= percent * F.col("n"), F.lit(False)) | F.coalesce(100 * F.col("n") >= percent * above, F.lit(False))
    return rows.select("*", near.alias("near")).where("near").drop("near")


def _ids(pairs: DataFrame) -> DataFrame:
    """The distinct ids of both sides."""
    return pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()


def _in_reach(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that pass the suffix filter; ``sets`` has ``id``, ``n`` and ``profile``."""
    with_a = pairs.join(sets.select(F.col("id").alias("a"), "n", F.col("profile").alias("x")), "a")
    with_b = with_a.join(sets.select(F.col("id").alias("b"), F.col("n").alias("m"), F.col("profile").alias("y")), "b")
    return with_b.mapInArrow(_suffix_filter(percent), _PAIR).distinct()


def _among(rows: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """The rows with ``among``: false only if their id is certainly none of ``ids``, as a null one is.

    A bitmap of ``FILTER_BITS`` hashed ids is broadcast (a fixed size), so no row travels.
    An inner join may leave such rows out.
    """
    place = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS))
    maps = ids.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    at = F.bitmap_bit_position("place")
    byte = F.conv(F.hex(F.substring("bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    bit = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False)) & F.col("id").isNotNull()
    joined = rows.withColumn("place", place).join(F.broadcast(maps), F.bitmap_bucket_number("place") == F.col("bucket"), how)
    return joined.select(*rows.columns, bit.alias("among"))


def _only(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows with an id among the distinct ``ids``, found before any exchange as far as possible.

    The join that follows is exact, however full the bitmap is.
    """
    near = _among(rows, ids, "inner").where("among").select(*rows.columns)
    # Not a semi-join: that would be moved below the map, next to all texts.
    return near.join(ids, "id")


def _verified(pairs: DataFrame, rows: DataFrame, size: int, percent: int) -> DataFrame:
    """The links among candidate pairs.  A document with many partners is split into parts."""
    texts = _only(rows, _ids(pairs))
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / PARTNERS).cast("int").alias("parts"))
    dealt = pairs.join(parts, "a").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), "b")
    partners = dealt.join(texts.withColumnRenamed("id", "b"), "b").select("a", "part", "b", "text")
    owners = parts.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    own = owners.join(texts.withColumnRenamed("id", "a"), "a").select("a", "part", F.lit(None).cast("long").alias("b"), "text")
    together = own.unionByName(partners).repartition("a", "part").sortWithinPartitions("a", "part", F.asc_nulls_first("b"))
    return together.mapInArrow(_verify(size, percent), _PAIR)


def ngram_join(docs: DataFrame, size: int = 5, percent: int = 80, counters: int = COUNTERS) -> DataFrame:
    """Groups of documents whose ``size``-word shingle sets have a Jaccard similarity of
    ``percent`` / 100 or more, directly or over others.

    Returns one row per input row: ``doc_id``, ``n_shingles`` and ``component_id``, the
    smallest doc_id reachable by links, its own included.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case.  A text with fewer words than
    ``size`` is one shingle; null texts and texts without words have none and link with
    nothing.  Rows that share a doc_id are one node (its links are those of all its rows)
    and repeated rows give repeated rows.  A null doc_id comes last and gives a null
    ``component_id`` only if nothing else is reachable; all null ids are one node.  Other
    columns are ignored.  An empty table gives an empty result.
    """
    if not 1 <= percent <= 100 or size < 1:
        raise ValueError("percent must be 1 to 100 and size at least 1")
    spark = docs.sparkSession
    rows = documents(docs).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "text")
    signed = cut(rows.mapInArrow(_signatures(size), "id long, n long, s1 long, s2 long, profile binary"))
    filled = signed.where("n > 0")
    classes = filled.groupBy("s1", "s2", "n").agg(F.min("id").alias("first_id"))
    levels = spark.sparkContext.broadcast(frequency_levels(rows, size, counters))

    prefix = rows.mapInArrow(_prefixes(size, percent, levels), "token long, id long, n int, pos int")
    listed = F.count("*").over(Window.partitionBy("token")).cast("int")
    shared = _near_sizes(prefix.withColumn("c", listed).where("c > 1"), percent)
    members = filled.join(classes, ["s1", "s2", "n"]).select("id", "first_id").distinct()
    # c counts copies of other tasks too; it only bounds the blocks of round three.
    standing = shared.join(members, "id").groupBy("token", F.col("first_id").alias("id"), "n").agg(F.min("pos").alias("pos"), F.max("c").alias("c"))
    # Lists lie in one partition each, sorted by size and id; the checkpoint keeps them so.
    postings = cut(_near_sizes(standing, percent))

    tried = cut(postings.mapInArrow(_along(percent), _PAIR).distinct())
    sets = cut(filled.join(classes.select(F.col("first_id").alias("id"), "s1", "s2", "n"), ["id", "s1", "s2", "n"], "left_semi").select("id", "n", "profile"))
    reached = cut(_in_reach(tried, sets, percent))
    degrees = reached.select("a").unionByName(reached.select(F.col("b").alias("a"))).groupBy(F.col("a").alias("id")).agg(F.count("*").alias("degree"))
    ranked = postings.join(degrees, "id", "left").withColumn("degree", F.coalesce("degree", F.lit(0)))
    led = ranked.repartition("token").sortWithinPartitions("token", F.desc("degree"), "id")
    hubs = cut(led.mapInArrow(_to_hubs(percent), _PAIR).distinct().join(tried, ["a", "b"], "left_anti"))
    links = _verified(cut(reached.unionByName(_in_reach(hubs, sets, percent))), rows, size, percent)
    # A class is known by its first id; an id with several texts links their classes.
    first = members.groupBy("id").agg(F.min("first_id").alias("rep"))
    same = members.join(first, "id").where("first_id <> rep").select(F.col("first_id").alias("a"), F.col("rep").alias("b"))
    settled = cut(connected_components(links.unionByName(same)))
    tried = tried.unionByName(hubs)

    comp = F.coalesce("component", "id").alias("comp")
    labelled = postings.join(settled.withColumnRenamed("node", "id"), "id", "left").select("token", "id", "n", "pos", "c", comp)
    mixed = labelled.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("token")
    blocks = F.ceil(F.col("c") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("id"), blocks).cast("int")
    cells = (
        labelled.join(mixed, "token", "left_semi")
        .join(sets.select("id", "profile"), "id")
        .select("*", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
        .select("token", "id", "n", "pos", "comp", "profile", "own", F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"))
    )
    dealt = cells.repartition("token", "left", "right").sortWithinPartitions("token", "left", "right")
    open_pairs = dealt.mapInArrow(_cells(percent), _PAIR).distinct().join(tried, ["a", "b"], "left_anti")
    more = _verified(cut(open_pairs), rows, size, percent)

    # What round three finds links whole components; the rest keeps the one it has.
    for side in ("a", "b"):
        known = settled.select(F.col("node").alias(side), F.col("component").alias("c"))
        more = more.join(known, side, "left").withColumn(side, F.coalesce("c", side)).drop("c")
    top = connected_components(more).select(F.col("node").alias("component"), F.col("component").alias("top"))
    by_rep = signed.join(first, "id", "left").withColumn("node", F.coalesce("rep", "id"))
    found = by_rep.join(settled, "node", "left").withColumn("component", F.coalesce("component", "node")).join(top, "component", "left")
    return found.select(
        F.nullif("id", F.lit(NO_ID)).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.nullif(F.coalesce("top", "component"), F.lit(NO_ID)).alias("component_id"),
    )


def ngram_groups(docs: DataFrame, size: int = 5, percent: int = 80, **options) -> DataFrame:
    """The rows of ``docs`` that stay if one document of each group of ``ngram_join`` stays:
    the one with the smallest doc_id.

    All columns are kept.  Rows repeated under one id with one text stay once.  Rows without
    a doc_id cannot be told apart and all stay.

    Rows are judged where they lie.  Only those travel whose id goes, stands in several rows
    or shares its bit of the map with such an id.
    """
    groups = ngram_join(docs, size, percent, **options)
    ids = groups.groupBy(F.coalesce("doc_id", F.lit(NO_ID)).alias("id")).agg(F.count("*").alias("rows"), F.max(F.expr("doc_id <=> component_id and doc_id is not null")).alias("stays"))
    unsure = cut(ids.where("rows > 1 or not stays").select("id", "stays"))
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text", F.isnull("text")).alias("hash"), F.struct("*").alias("row"))
    sure = _among(rows, unsure.select("id"), "left").where("not among")
    met = _among(rows, unsure.select("id"), "inner").where("among").select(*rows.columns).join(unsure, "id", "left")
    copy = F.row_number().over(Window.partitionBy("id", "hash").orderBy("hash"))
    kept = met.where(F.coalesce("stays", F.lit(True))).withColumn("copy", copy).where("copy = 1")
    return sure.select("row.*").unionByName(kept.select("row.*"))
