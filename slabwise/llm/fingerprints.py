"""I-Match fingerprints, in DataFrame functions only.

The lexicon holds the terms whose document frequency lies in a band.  Copies and near
copies count as one text there: of the texts that share their outermost shingles, by a hash,
one is counted, so a text that is copied however often keeps its terms.  Every text keeps its
distinct lexicon terms; randomised subsets of the lexicon are drawn by a hash of the
term, and the hashes of the terms in a subset are joined to one value by exclusive or.  A fingerprint is the list
of these values.  Two texts are alike in the share of subsets that agree, among those in
which either has a term.

Subsets come in three densities, ``SUBSETS`` disjoint subsets of each: a 64th, a 256th and
a 1024th of the lexicon.  Those of the first cover the whole lexicon.  The density at which
the longer text has about one term in a subset is the one compared, so long texts are not
all or nothing; if neither text has a term there, a denser one is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slabwise.llm.common import WORD, cut

LEAST_SHARE = 0.001
MOST_SHARE = 0.1
#: One subset is this part of the lexicon, per density.
PARTS = (64, 256, 1024)
SUBSETS = 64
#: Words in a run by which near copies are known.
SHINGLE = 3
#: Ranges of ids that texts are dealt to, per shuffle partition.
RANGES = 3


def terms(text: Column | str) -> Column:
    """Distinct words of a text in lower case."""
    text = F.col(text) if isinstance(text, str) else text
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)))


def _subset(level: int, term: Column | str) -> Column:
    """The subset of a density that a term belongs to; only the first ``SUBSETS`` are drawn."""
    return F.pmod(F.xxhash64(F.lit(level), term), F.lit(PARTS[level]))


def _sketched(texts: DataFrame) -> DataFrame:
    """``text`` with ``sketch``: the least and the largest hash of its runs of ``SHINGLE`` words.

    It is the same for copies, and for most near copies; unlike texts that share a phrase
    seldom share both.
    """
    words = texts.select("text", F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)).alias("words"))
    run = F.transform("words", lambda w, i: F.xxhash64(w, *[F.get(F.col("words"), i + k) for k in range(1, SHINGLE)]))
    whole = F.slice(run, F.lit(1), F.greatest(F.lit(1), F.size("words") - (SHINGLE - 1)))
    runs = words.select("text", whole.alias("runs"))
    return runs.select("text", F.xxhash64(F.array_min("runs"), F.array_max("runs")).alias("sketch"))


def lexicon(texts: DataFrame, least: float = LEAST_SHARE, most: float = MOST_SHARE) -> DataFrame:
    """Terms in at least ``least`` and at most ``most`` of the texts that count, and in two of
    them at least.  Of texts with one sketch one counts.

    It has at most (distinct terms per text, on average) / ``least`` rows, whatever the
    number of texts: a quarter of a million for texts of 250 distinct words.
    """
    once = _sketched(texts).groupBy("sketch").agg(F.max("text").alias("text"))
    # The empty word is no word: it counts the texts.
    found = once.select(F.explode(F.array_append(terms("text"), "")).alias("term"))
    counts = cut(found.groupBy("term").agg(F.count("*").alias("df")).where("df > 1 or term = ''"))
    row = counts.where("term = ''").first()
    rows = row["df"] if row else 0
    return counts.where((F.col("term") != "") & F.col("df").between(max(2, rows * least), rows * most)).select("term")


def _ranges(ids: DataFrame) -> list[int]:
    """Borders that cut the ids into ranges of about equal size; a bounded list."""
    n = RANGES * int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row = ids.agg(F.percentile_approx("id", [k / n for k in range(1, n)], 20 * n).alias("borders")).first()
    return sorted(set(row["borders"] or []))


def _dealt(docs: DataFrame) -> DataFrame:
    """Texts dealt to ranges of ids, each with the first text of the range below as an extra row."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    borders = _ranges(rows)
    place = F.array_size(F.filter(F.array(*[F.lit(b) for b in borders]), lambda b: b <= F.col("id"))) if borders else F.lit(0)
    rows = rows.withColumn("range", F.coalesce(place, F.lit(-1)).cast("int"))  # null ids come last
    first = F.max_by(F.struct("id", "text"), F.struct(F.col("id"), F.xxhash64("text"), F.col("text"))).alias("head")
    heads = rows.groupBy("range").agg(first)
    downwards = Window.orderBy(F.desc("range"))  # a bounded number of rows
    above = heads.select("range").select("range", F.coalesce(F.lag("range").over(downwards), F.min("range").over(Window.partitionBy())).alias("above"))
    extra = heads.join(above, "range").select(F.col("head.id").alias("id"), F.col("head.text").alias("text"), F.col("above").alias("range"), F.lit(1).alias("extra"))
    return rows.withColumn("extra", F.lit(0)).unionByName(extra)


def _named(**fields: Column) -> Column:
    """A struct whose names hold beside a generator too."""
    return F.named_struct(*[x for name, value in fields.items() for x in (F.lit(name), value)])


def edited(text: Column, following: Column) -> Column:
    """The last half of a text replaced by as many code points from the start of the next."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def _subset_values(side_terms: DataFrame) -> DataFrame:
    """Rows (range, n, side, term, info) to one row per text: its subset values and ``info``."""
    draws = [_named(level=F.lit(k), subset=_subset(k, "term")) for k in range(len(PARTS))]
    own = _named(level=F.lit(-1), subset=F.lit(0).cast("long"))
    drawn = F.when(F.col("term") == "", F.array(own)).otherwise(F.filter(F.array(*draws), lambda d: d["subset"] < SUBSETS))
    numbered = side_terms.select("range", "n", "side", F.xxhash64("term").alias("term"), "info", F.explode(drawn).alias("d"))
    exploded = numbered.select("*", "d.level", "d.subset").drop("d")
    hashed = exploded.groupBy("range", "n", "side", "level", "subset").agg(
        F.bit_xor("term").alias("x"), F.count("*").alias("size"), F.max("info").alias("info")
    )
    value = F.xxhash64("x").bitwiseAND(F.lit(0xFFFFFFFF))
    values = hashed.select("*", F.struct("level", "subset", value.alias("value")).alias("v"))
    real = F.col("level") >= 0
    return values.groupBy("range", "n").agg(
        *[F.sort_array(F.collect_list(F.when(real & (F.col("side") == side), F.col("v")))).alias(name) for side, name in ((0, "own"), (1, "changed"))],
        *[F.coalesce(F.sum(F.when((F.col("level") == 0) & (F.col("side") == side), F.col("size"))), F.lit(0)).alias(f"n_{name}") for side, name in ((0, "own"), (1, "changed"))],
        F.max("info").alias("info"),
    )


def _or_whole(values: Column, text_hash: Column) -> Column:
    """A text without a term of the lexicon has one value, of its whole."""
    whole = F.array(F.struct(F.lit(9).alias("level"), F.lit(0).cast("long").alias("subset"), text_hash.bitwiseAND(F.lit(0xFFFFFFFF)).alias("value")))
    return F.when(F.size(values) > 0, values).otherwise(whole)


def _likeness(a: Column, n_a: Column, b: Column, n_b: Column) -> Column:
    n = F.greatest(n_a, n_b)

    def agreed(k: int) -> Column:
        compared = [F.filter(x, lambda v: (v["level"] == k) | (v["level"] == 9)) for x in (a, b)]
        places = [F.transform(x, lambda v: v["level"] * 10_000 + v["subset"]) for x in compared]
        return F.array_size(F.array_intersect(*compared)) / F.nullif(F.array_size(F.array_union(*places)), F.lit(0))

    # The first density has all terms; a sparser one may have none of either text.
    ratios = [agreed(k) for k in range(len(PARTS))]
    found = F.coalesce(*ratios[::-1])
    for k in range(len(PARTS) - 2, -1, -1):
        found = F.when(n <= PARTS[k], F.coalesce(*ratios[k::-1])).otherwise(found)
    return F.coalesce(found, F.lit(0.0)).cast("double")


def _text(values: Column) -> Column:
    """Eleven hexadecimal digits per value: density, subset, hash."""
    return F.array_join(F.transform(values, lambda v: F.lower(F.concat(F.hex(v["level"]), F.lpad(F.hex(v["subset"]), 2, "0"), F.lpad(F.hex(v["value"]), 8, "0")))), "")


def fingerprint_edits(docs: DataFrame, least: float = LEAST_SHARE, most: float = MOST_SHARE) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text has its last floor(n/2) code points replaced by the first as many (or
    all) of the next document in descending order of doc_id; after the last comes the
    first.  Returns one row per input row: ``doc_id``, ``n_chars``, ``edited_sha256``,
    ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and ``near_next`` (0 to 1).

    Null texts count as empty.  Null ids come last in the order; rows with equal ids follow
    each other by a hash of their texts.  A text without a lexicon term is known by a hash
    of its whole, so equal texts always have equal fingerprints and likeness 1.  A single
    row is its own next document.  Only ``doc_id`` and ``text`` are read; an empty table
    gives an empty result.

    The lexicon is broadcast: its size has a bound that does not grow with the texts.
    """
    dealt = _dealt(docs)
    order = Window.partitionBy("range").orderBy("extra", F.desc_nulls_last("id"), F.desc(F.xxhash64("text")), F.desc("text"))
    numbered = dealt.select("range", "extra", "id", "text", F.row_number().over(order).alias("n"), F.lead("text").over(order).alias("following"))
    sides = numbered.select("range", "n", "extra", "id", "text", edited(F.col("text"), F.coalesce("following", F.lit(""))).alias("edited"))
    info = _named(
        extra=F.col("extra"), id=F.col("id"), n_chars=F.length("text"), edited_sha256=F.sha2("edited", 256),
        own_hash=F.xxhash64("text"), changed_hash=F.xxhash64("edited"),
    )
    both_sides = F.array(
        _named(side=F.lit(0), terms=F.array_append(terms("text"), "")),
        _named(side=F.lit(1), terms=terms("edited")),
    )
    exploded = (
        sides.select("range", "n", info.alias("info"), F.explode(both_sides).alias("s"))
        .select("range", "n", F.col("s.side").alias("side"), "info", F.explode("s.terms").alias("term"))
    )
    # The empty word is no word: it stands for the text itself and carries what is known of it.
    narrow = exploded.select("range", "n", "side", "term", F.when(F.col("term") == "", F.col("info")).alias("info"))
    words = lexicon(docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")), least, most)
    known = words.unionByName(docs.sparkSession.range(1).select(F.lit("").alias("term")))
    found = _subset_values(narrow.join(F.broadcast(known), "term"))
    prints = found.select("range", "n", "n_own", "n_changed", "info.*", *[_or_whole(F.col(c), F.col(f"info.{c}_hash")).alias(c) for c in ("own", "changed")])
    following = Window.partitionBy("range").orderBy("n")
    both = prints.withColumn("next", F.lead(F.struct("own", "n_own")).over(following)).where("extra = 0")
    return both.select(
        F.col("id").alias("doc_id"),
        F.col("n_chars").cast("long").alias("n_chars"),
        "edited_sha256",
        _text(F.col("own")).alias("fingerprint"),
        _text(F.col("changed")).alias("edited_fingerprint"),
        _likeness(F.col("own"), F.col("n_own"), F.col("changed"), F.col("n_changed")).alias("near_edited"),
        _likeness(F.col("own"), F.col("n_own"), F.col("next.own"), F.col("next.n_own")).alias("near_next"),
    )
