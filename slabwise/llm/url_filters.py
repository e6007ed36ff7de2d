"""URL filters: host and path rules, and a path-template tree for the rest; DataFrame functions only.

Pages that a rule judges are the labelled ones.  The tree of a host has its path segments
as branches: digits are generalised, and so is a segment that takes many values at its
place.  Branches of one place whose labelled rates agree are merged; where all labelled
branches of a place agree, those without a label join them.  A template is rejected if its
smoothed labelled share of blocked pages is high.

Paths are counted once per host and shape before anything else, so a hot host is as many
rows as it has shapes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slabwise.llm.common import cut


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    def __str__(self) -> str:
        return self.host + self.path


RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))
#: Segments of the tree; the rest of a longer path is one more segment.
DEPTH = 6
#: A place is variable if it has this many values in effect: the inverse of the chance that two
#: of the shapes below it have the same value, whatever the number of pages.
VALUES = 16
#: Standard deviations by which the rates of merged branches may differ from their common rate.
DEVIATIONS = 1.96
#: Labelled pages that the common rate counts for in a template, and the share that rejects.
PRIOR_PAGES = 20.0
REJECT = 0.9

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ANY = "*"


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, null without one."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(str(r)), str(r))):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        text, verdict = F.when(fits, F.lit(str(rule))).otherwise(text), F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def _segments(path: Column) -> Column:
    """Segments with digits generalised, ``DEPTH`` + 1 at most."""
    parts = F.split(F.regexp_replace(F.regexp_replace(path, "^/", ""), "[0-9]+", "#"), "/", DEPTH + 1)
    return F.transform(parts, lambda p: F.when(p == _ANY, F.lit("%2A")).otherwise(p))


def _shape(segments: Column | str) -> Column:
    return F.array_join(segments, "/")


def _put(segments: Column, at: int, value: Column) -> Column:
    return F.transform(segments, lambda s, i: F.when(i == at, value).otherwise(s))


def _generalised(shapes: DataFrame, depth: int) -> DataFrame:
    """Replace a segment by a wildcard where it takes many values below the same branch."""
    for at in range(depth):
        reach = F.size("template") > at
        value = F.when(reach, F.element_at("template", F.lit(at + 1)))  # null behind the path's end
        branch = _shape(F.slice("template", 1, at)).alias("branch")
        places = shapes.where(reach).groupBy("host", branch, value.alias("value")).agg(F.count("*").cast("double").alias("shapes"))
        places = places.groupBy("host", "branch").agg(F.sum("shapes").alias("all"), F.sum(F.col("shapes") * F.col("shapes")).alias("same"))
        variable = places.where(F.col("all") * F.col("all") >= VALUES * F.col("same"))
        marked = shapes.withColumn("branch", branch).join(variable.select("host", "branch", F.lit(True).alias("variable")), ["host", "branch"], "left")
        template = F.when(F.col("variable") & reach, _put(F.col("template"), at, F.lit(_ANY))).otherwise(F.col("template"))
        shapes = cut(marked.withColumn("template", template).drop("branch", "variable"))
    return shapes


def _merged(templates: DataFrame, depth: int) -> DataFrame:
    """Adds ``merged``: the template with branches of like rates made one, place by place."""
    table = templates.withColumn("merged", F.col("template"))
    for at in reversed(range(depth)):
        reach = F.size("merged") > at
        around = _put(F.col("merged"), at, F.lit(_ANY)).alias("around")
        counted = table.where(reach).groupBy("host", "merged").agg(F.sum("labelled").alias("n"), F.sum("blocked").alias("k")).select("*", around)
        # Branches are compared within a quarter of the rates, so that one odd branch does not keep the others apart.
        sides = counted.where("n > 0").withColumn("quarter", F.round(F.col("k") / F.col("n") * 4).cast("int"))
        rates = sides.groupBy("host", "around", "quarter").agg((F.sum("k") / F.sum("n")).alias("p"))
        near = F.abs(F.col("k") / F.col("n") - F.col("p")) <= DEVIATIONS * F.sqrt(F.col("p") * (1 - F.col("p")) / F.col("n")) + 1e-9
        tested = cut(sides.join(rates, ["host", "around", "quarter"]).withColumn("like", near))
        groups = tested.groupBy("host", "around", "quarter").agg(F.sum(F.col("like").cast("int")).alias("together"))
        mark = F.concat(F.lit(_ANY), F.col("quarter").cast("string"))
        joined = tested.where("like").join(groups.where("together > 1"), ["host", "around", "quarter"]).select("host", "merged", mark.alias("mark"))
        agreed = tested.groupBy("host", "around").agg(F.min("quarter").alias("quarter"), F.max("quarter").alias("most"), F.bool_and("like").alias("like"), F.count("*").alias("branches"))
        agreed = agreed.where("like and quarter = most and branches > 1")
        following = counted.where("n = 0").join(agreed, ["host", "around"]).select("host", "merged", mark.alias("mark"))
        changes = joined.unionByName(following).select("host", "merged", _put(F.col("merged"), at, F.col("mark")).alias("now"))
        table = cut(table.join(changes, ["host", "merged"], "left").withColumn("merged", F.coalesce("now", "merged")).drop("now"))
    return table


def template_verdicts(judged: DataFrame, prior_pages: float = PRIOR_PAGES, reject: float = REJECT) -> DataFrame:
    """Per host and path shape: ``template``, ``labelled``, ``blocked``, ``purity`` and ``rejected``.

    ``judged`` needs ``host``, ``path`` and ``label`` (1 blocked, 0 allowed, null unknown).
    ``purity`` is the template's labelled share of blocked pages, smoothed towards one half
    by ``prior_pages``: without evidence nothing is rejected.  A shape without a label has
    evidence if two branches or more beside it are labelled and all of these agree.
    """
    segments = _segments(F.col("path"))
    shapes = cut(
        judged.select("host", segments.alias("template"), "label")
        .groupBy("host", "template")
        .agg(F.count("*").alias("pages"), F.count("label").alias("labelled"), F.coalesce(F.sum("label"), F.lit(0)).alias("blocked"))
        .withColumn("shape", _shape("template"))
    )
    depth = shapes.agg(F.max(F.size("template")).alias("depth")).first()["depth"] or 0
    table = _merged(_generalised(shapes, depth), depth)
    pooled = table.groupBy("host", "merged").agg(F.sum("labelled").alias("n"), F.sum("blocked").alias("k"))
    purity = (F.col("k") + prior_pages / 2) / (F.col("n") + prior_pages)
    judged_templates = pooled.select("host", "merged", F.col("n").alias("labelled"), F.col("k").alias("blocked"), purity.alias("purity"))
    found = table.select("host", "shape", "merged").join(judged_templates, ["host", "merged"])
    return found.select("host", "shape", F.concat(F.lit("/"), _shape("merged")).alias("template"), "labelled", "blocked", "purity", (F.col("purity") >= reject).alias("rejected"))


def url_filter(pages: DataFrame, rules: tuple[Rule, ...] = RULES, **options) -> DataFrame:
    """Judge every url by the longest rule that fits, or else by its path template.

    ``pages`` needs ``page_id`` and ``url``; other columns are ignored.  Returns one row per
    input row: ``page_id``, ``host``, ``path``, ``rule`` (null without one), ``verdict``
    (allow or block), ``template`` and ``purity``.

    A url that is null or has no ``://`` has an empty host and path and is allowed, since no
    labelled page shares that template unless a rule names it.  Of rules of equal length that
    fit, the last by text wins.  Very long paths are ``DEPTH`` segments and one for the rest.
    Repeated rows give repeated rows and weigh as often as labels, but do not make a place
    variable; an empty table gives an empty result.
    """
    url = F.col("url").cast("string")
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    text, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", text.alias("rule"), verdict.alias("ruled"), _shape(_segments(F.col("path"))).alias("shape"))
    label = F.when(F.col("ruled") == "block", 1).when(F.col("ruled") == "allow", 0)
    verdicts = template_verdicts(rows.select("host", "path", label.alias("label")), **options)
    joined = rows.join(verdicts, ["host", "shape"])
    learned = F.when(F.col("rejected"), F.lit("block")).otherwise(F.lit("allow"))
    return joined.select("page_id", "host", "path", "rule", F.coalesce("ruled", learned).alias("verdict"), "template", "purity")
