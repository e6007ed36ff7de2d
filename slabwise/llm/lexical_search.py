"""Ranked lexical search by pipelined term partitioning.

Terms belong to owners, the rarest terms to the first one.  Postings lie in blocks of
documents.  A bundle is an item within a block: its terms and a sparse accumulator of
scores.  Bundles go from owner to owner; at each one a cogroup brings them together with
that owner's postings of their block, and integer contributions are added.

Between two owners the best ten partial scores of an item give its floor: scores only
grow, so what cannot reach the floor even with the most its remaining terms can add is
let go.  Ties with the floor stay, so the selection is exact.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slabwise.llm.common import cut, documents

#: A term: letters A-Z and digits, and everything beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bytes to terms: what separates becomes a blank, A-Z small letters.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Shares of the documents that part one owner's terms from the next one's.
OWNER_SHARES = (1 / 256, 1 / 32, 1 / 8)
#: Documents and text bytes of one block.
BLOCK_ROWS = 8192
BLOCK_BYTES = 16 << 20
#: Items that share the cogroups of a block.
GROUP_ITEMS = 512
#: Terms of the items that tasks look up while they read; with more, all terms are indexed.
VOCABULARY = 200_000

_INDEX = "block long, term string, hits binary, ids array<long>, n_docs long, n_terms long"
_BUNDLE = "block long, grp int, item long, terms array<string>, weights array<long>, owners array<int>, caps array<long>, floor long, rows binary, scores binary, best array<long>"
_FOUND = "item long, doc_id long, score long"


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def _index(vocabulary: frozenset[bytes] | None):
    """Per block: a row of hits (row in the block, occurrences, terms of the document) for every
    term, and one row without a term that holds the ids and the sums of the block."""

    def rows_of(block: int, posts: dict, ids: list, n_docs: int, n_terms: int) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("block", pa.int64()), ("term", pa.string()), ("hits", pa.binary()), ("ids", pa.list_(pa.int64())), ("n_docs", pa.int64()), ("n_terms", pa.int64())])
        yield pa.RecordBatch.from_pydict({"block": [block], "term": [None], "hits": [None], "ids": [ids], "n_docs": [n_docs], "n_terms": [n_terms]}, schema)
        names = list(posts)
        for low in range(0, len(names), 10_000):
            part = names[low : low + 10_000]
            none = [None] * len(part)
            hits = [np.array(posts[t], np.int32).tobytes() for t in part]
            yield pa.RecordBatch.from_pydict({"block": [block] * len(part), "term": [t.decode() for t in part], "hits": hits, "ids": none, "n_docs": none, "n_terms": none}, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        posts, ids, size, n_docs, n_terms = defaultdict(list), [], 0, 0, 0
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()), strict=True):
                raw = text.as_py() or b""
                if ids and (len(ids) == BLOCK_ROWS or size + len(raw) > BLOCK_BYTES):
                    yield from rows_of(block, posts, ids, n_docs, n_terms)
                    posts, ids, size, n_docs, n_terms, block = defaultdict(list), [], 0, 0, 0, block + 1
                found = terms_of(raw)
                n = len(found)
                for term, tf in Counter(found if vocabulary is None else [t for t in found if t in vocabulary]).items():
                    posts[term] += (len(ids), tf, n)
                ids.append(doc)
                size += len(raw)
                n_docs += n > 0
                n_terms += n
        if ids:
            yield from rows_of(block, posts, ids, n_docs, n_terms)

    return run


def _impacts(hits: bytes, n_docs: int, n_terms: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the block and ``(10**9 tf) div (1000 tf + 8 m)``, ``m = 10 + (90 n N) div L``."""
    row, tf, n = np.frombuffer(hits, np.int32).reshape(-1, 3).T.astype(np.int64)
    return row, (1_000_000_000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))


def _term_parts(n_docs: int, n_terms: int):
    """What a block adds to a term: its documents and its largest impact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_impacts(h, n_docs, n_terms)[1] for h in batch.column("hits").to_pylist()]
            yield pa.RecordBatch.from_pydict({"term": batch.column("term"), "df": pa.array([len(q) for q in found], pa.int64()), "most": pa.array([q.max() for q in found], pa.int64())})

    return run


def _stage(owner: int, n_docs: int, n_terms: int, top: int, last: bool):
    """Bundles of one block and group meet the owner's postings of the block."""

    def run(bundles: pa.Table, postings: pa.Table) -> pa.Table:
        impacts = {t: _impacts(h, n_docs, n_terms) for t, h in zip(postings["term"].to_pylist(), postings["hits"].to_pylist(), strict=True) if t is not None}
        ids = next((x for x in postings["ids"].to_pylist() if x is not None), [])
        out, found = [], []
        for bundle in bundles.to_pylist():
            floor, rest, new = bundle["floor"], 0, 0
            mine = []
            for term, weight, at, cap in zip(*(bundle[c] for c in ("terms", "weights", "owners", "caps")), strict=True):
                if at == owner and term in impacts:
                    mine.append((weight, *impacts[term]))
                new += cap if at >= owner else 0
                rest += cap if at > owner else 0
            before, held = np.frombuffer(bundle["rows"] or b"", np.int32), np.frombuffer(bundle["scores"] or b"", np.int64)
            size = 1 + max([int(r.max()) for _, r, _ in mine] + [int(before.max()) if len(before) else 0])
            scores = np.zeros(size, np.int64)
            scores[before] = held
            for weight, row, impact in mine:
                scores[row] += weight * impact
            if floor is not None and new < floor:  # a document met here first cannot reach the floor any more
                keep = before[scores[before] + rest >= floor]
            else:
                keep = np.flatnonzero((scores > 0) & (scores + rest >= (floor or 0)))
            scores = scores[keep]
            if last:
                ranked = sorted(zip((-scores).tolist(), ((ids[r] is None, ids[r] or 0) for r in keep.tolist()), strict=True))[:top]
                found += [{"item": bundle["item"], "doc_id": None if none else doc, "score": -score} for score, (none, doc) in ranked]
            elif len(keep) or floor is None or rest >= floor:
                best = -np.partition(-scores, top - 1)[:top] if len(scores) > top else scores
                out.append(bundle | {"rows": keep.astype(np.int32).tobytes(), "scores": scores.tobytes(), "best": best.tolist()})
        if last:
            return pa.Table.from_pylist(found, pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())]))
        return pa.Table.from_pylist(out, bundles.schema)

    return run


def _floors(bundles: DataFrame, top: int) -> DataFrame:
    """The ``top``-th best partial score of every item that has so many."""
    order = Window.partitionBy("item").orderBy(F.desc("score"))
    best = bundles.select("item", F.explode("best").alias("score")).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.groupBy("item").agg(F.min("score").alias("floor"), F.count("*").alias("n")).where(F.col("n") == top).select(F.col("item").alias("floor_item"), "floor")


def lexical_search(docs: DataFrame, items: DataFrame, top: int = 10) -> DataFrame:
    """The ``top`` highest-scoring rows of ``docs`` (``doc_id``, ``text``) for every item of
    ``items`` (``item_id``, ``text``): ``item_id``, ``rank`` (from 1), ``doc_id``, ``score``.

    Terms are the matches of ``TERM``, A-Z in lower case.  With N documents that have terms,
    L terms in all, df documents with the term, and in one document tf of n terms, a term adds
    ``w * ((10**9 tf) div (1000 tf + 8 m))``, ``w = floor(1000 ln((2N+2)/(2df+1)))`` and
    ``m = 10 + (90 n N) div L``, once per distinct term of the item.

    Every row of ``docs`` is a document of its own, also if it repeats another or its id.
    Rows of ``items`` with one ``item_id`` (null among them) are one item with the terms of
    all.  Null and empty texts have no terms: such items have no rows.  Equal scores go by
    ascending doc_id, null last.  Only positive scores count.  Very long texts are read
    whole; they fill a block of their own.  Other columns are ignored.  Without documents or
    items the result is empty.

    The items are the query set: every block of documents meets all of them, in groups of
    ``GROUP_ITEMS``.  Up to ``VOCABULARY`` of their terms are sent to the tasks that read.
    """
    if top < 1:
        raise ValueError("top must be at least 1")
    spark = docs.sparkSession
    low = F.translate(F.col("text").cast("string"), _UPPER, _UPPER.lower())
    wanted = cut(
        items.select(F.col("item_id").cast("long").alias("item"), F.explode(F.array_distinct(F.regexp_extract_all(low, F.lit(TERM), F.lit(0)))).alias("term")).distinct()
    )
    sizes = wanted.agg(F.count_distinct("term").alias("terms"), F.count_distinct(F.coalesce("item", F.lit(-1))).alias("items")).first()
    vocabulary = None
    if sizes["terms"] <= VOCABULARY:
        vocabulary = frozenset(r["term"].encode() for r in wanted.select("term").distinct().collect())
    index = cut(documents(docs).mapInArrow(_index(vocabulary), _INDEX))
    sums = index.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    n_docs, n_terms = sums["n"] or 0, sums["l"] or 0
    if not n_docs or not sizes["terms"]:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")

    hits = index.where("term is not null").select("term", "hits")
    if vocabulary is None:
        hits = hits.join(wanted.select("term").distinct(), "term", "left_semi")
    stats = hits.mapInArrow(_term_parts(n_docs, n_terms), "term string, df long, most long").groupBy("term").agg(F.sum("df").alias("df"), F.max("most").alias("most"))
    weight = F.floor(1000 * F.log((2.0 * F.lit(n_docs) + 2) / (2.0 * F.col("df") + 1))).cast("long")
    owner = sum((F.col("df") > share * n_docs).cast("int") for share in OWNER_SHARES)
    owned = cut(stats.select("term", weight.alias("weight"), owner.alias("owner"), (weight * F.col("most")).alias("cap")).where("weight > 0"))

    groups = -(-sizes["items"] // GROUP_ITEMS)
    listed = wanted.join(owned, "term").groupBy("item").agg(F.sort_array(F.collect_list(F.struct("owner", "term", "weight", "cap"))).alias("t"))
    grp = F.pmod(F.xxhash64("item"), F.lit(groups)).cast("int").alias("grp")
    queries = listed.select(grp, "item", F.col("t.term").alias("terms"), F.col("t.weight").alias("weights"), F.col("t.owner").alias("owners"), F.col("t.cap").alias("caps"))
    every = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp")
    empty = [F.lit(None).cast(kind).alias(name) for name, kind in (("floor", "long"), ("rows", "binary"), ("scores", "binary"), ("best", "array<long>"))]
    columns = [x.split()[0] for x in _BUNDLE.split(", ")]
    # The query set against all rows, in blocks: one bundle per item and block.
    bundles = index.where("term is null").select("block", every).join(queries, "grp").select("*", *empty).select(*columns)
    placed = index.where("term is not null").join(owned.select("term", "owner"), "term").select("block", "term", "hits", F.lit(None).cast("array<long>").alias("ids"), "owner")
    ends = index.where("term is null").select("block", "term", "hits", "ids", F.lit(len(OWNER_SHARES)).alias("owner"))
    postings = cut(placed.unionByName(ends))
    for at in range(len(OWNER_SHARES) + 1):
        last = at == len(OWNER_SHARES)
        if at:
            floors = _floors(bundles, top)
            met = bundles.drop("floor").join(floors, F.col("item").eqNullSafe(F.col("floor_item")), "left")
            bundles = met.select(*columns)
        mine = postings.where(F.col("owner") == at).select(F.col("block").alias("at"), every.alias("for"), "term", "hits", "ids")
        stage = bundles.groupBy("block", "grp").cogroup(mine.groupBy("at", "for")).applyInArrow(_stage(at, n_docs, n_terms, top, last), _FOUND if last else _BUNDLE)
        bundles = stage if last else cut(stage)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = bundles.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select(F.col("item").alias("item_id"), F.col("rank").cast("int").alias("rank"), "doc_id", "score")
