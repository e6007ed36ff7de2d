import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from slabwise.llm.url_filters import RULES, Rule, template_verdicts, url_filter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(url, rules=RULES):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, path = rest[:end].translate(LOWER), rest[end:]
    path = path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, str(max(fits, key=lambda r: (len(str(r)), str(r)))) if fits else None


URLS = [
    None, "", "no scheme", "http://a.net", "http://a.net/", "HTTP://EXAMPLE.net/en/1?x=/de/#f", "https://b.example.net/en", "https://b.example.net/en/x",
    "http://example.com/de/5", "http://notexample.com/de/5", "http://x.example.com/de", "http://org/fr/", "http://foo.org/fr/a#b", "http://org?fr/",
    "ftp://h.org#://x", "a://b://c/d", "http:///path", "://x.net/y", "http://ÄÖ.Net/É", "http://a.net:80/x", "http://u@a.net/", "x\ny://a.net/z\nw?q",
    "http://a.example.net.evil.org/fr/1", "http://a.net/*/x", "http://a.net/" + "d/" * 40, "http://a.com/" + "y" * 50_000,
]


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "<html>") for i, u in enumerate(urls)], "page_id long, url string, html string").selectExpr("*", "7 as host", "7 as shape", "'x' as label", "7 as template")


def test_hosts_paths_and_rules(spark):
    got = url_filter(pages(spark, URLS + URLS[:6])).collect()
    assert len(got) == len(URLS) + 6
    verdicts = {str(r): r.verdict for r in RULES}
    for r in got:
        assert (r.host, r.path, r.rule) == brute((URLS + URLS[:6])[r.page_id])
        assert r.verdict == verdicts[r.rule] if r.rule else r.verdict in ("allow", "block")
    assert {r.verdict for r in got if r.page_id < 3} == {"allow"}


def test_on_a_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r for r in url_filter(table).collect()}
    for row in table.select("page_id", "url").collect():
        assert (got[row.page_id].host, got[row.page_id].path, got[row.page_id].rule) == brute(row.url)


def test_templates_by_labelled_purity(spark):
    """Bad shapes go, also where digits or names vary; clean ones and unlabelled ones stay."""
    rows = []
    for i in range(120):
        rows += [("h", f"/shop/{i}/buy", 1), ("h", f"/blog/{i}/read", 0), ("h", f"/user/n{chr(97 + i % 26)}{chr(97 + i // 26)}/offer", 1 if i % 2 else None)]
        rows += [("h", f"/mixed/{i}", i % 2), ("h", f"/new/{i}", None), ("g", f"/shop/{i}/buy", None)]
    judged = spark.createDataFrame(rows, "host string, path string, label int")
    got = {(r.host, r["shape"]): r for r in template_verdicts(judged, reject=0.85).collect()}
    assert got["h", "shop/#/buy"].rejected and not got["h", "blog/#/read"].rejected
    users = [r for (h, s), r in got.items() if s.startswith("user/")]
    assert len(users) > 100 and all(r.rejected for r in users)  # one wildcard, so few labels are enough
    assert not any(got[k].rejected for k in (("h", "mixed/#"), ("h", "new/#"), ("g", "shop/#/buy")))
    assert got["g", "shop/#/buy"].purity == 0.5


def test_like_branches_are_merged_and_odd_ones_are_not(spark):
    rows = [("h", f"/{lang}/{i}", bad) for lang, bad in (("en", 1), ("de", 1), ("fr", 0), ("es", 1)) for i in range(15)]
    got = {r["shape"]: r for r in template_verdicts(spark.createDataFrame(rows, "host string, path string, label int"), reject=0.8).collect()}
    assert len({got[f"{x}/#"].template for x in ("en", "de", "es")}) == 1 and got["en/#"].labelled == 45
    assert got["en/#"].rejected and not got["fr/#"].rejected


@pytest.mark.parametrize("rules", [(), (Rule("block", "", "/"),)])
def test_other_rules_and_empty_tables(spark, rules):
    assert url_filter(pages(spark, URLS).limit(0), rules).collect() == []
    assert all(r.rule is None for r in url_filter(pages(spark, URLS[:6]), rules).collect())


def test_rows_keep_only_their_columns(spark):
    df = url_filter(pages(spark, URLS[:3]))
    assert df.columns == ["page_id", "host", "path", "rule", "verdict", "template", "purity"]
    assert df.where(F.col("host") != "").count() == 0


def plain_verdicts(rows, prior=20.0, reject=0.9):
    """The tree with dictionaries: rows of (host, path, label) to shape -> rejected."""
    shapes = defaultdict(lambda: [0, 0])
    for host, path, label in rows:
        parts = re.sub("[0-9]+", "#", path.removeprefix("/")).split("/", 6)
        shapes[host, tuple("%2A" if p == "*" else p for p in parts)][0] += label is not None
        shapes[host, tuple("%2A" if p == "*" else p for p in parts)][1] += label or 0
    template = {k: list(k[1]) for k in shapes}
    depth = max(map(len, template.values()), default=0)
    for at in range(depth):
        values = defaultdict(Counter)
        for (host, _), t in template.items():
            if len(t) > at:
                values[host, tuple(t[:at])][t[at]] += 1
        for (host, _), t in template.items():
            if len(t) > at and (c := values[host, tuple(t[:at])]).total() ** 2 >= 16 * sum(n * n for n in c.values()):
                t[at] = "*"
    for at in reversed(range(depth)):
        counted = defaultdict(lambda: [0, 0])
        for k, t in template.items():
            if len(t) > at:
                counted[k[0], tuple(t)][0] += shapes[k][0]
                counted[k[0], tuple(t)][1] += shapes[k][1]
        places = defaultdict(lambda: defaultdict(list))
        for (host, t), (n, k) in counted.items():
            around = (host, t[:at], t[at + 1 :])
            places[around][None if not n else math.floor(k / n * 4 + 0.5)].append((t, n, k))
        changes = {}
        for (host, *_), quarters in places.items():
            like = {}
            for quarter, sides in quarters.items():
                if quarter is not None:
                    p = sum(k for *_, k in sides) / sum(n for _, n, _ in sides)
                    like[quarter] = [t for t, n, k in sides if abs(k / n - p) <= 1.96 * math.sqrt(p * (1 - p) / n) + 1e-9]
                    if len(like[quarter]) > 1:
                        changes |= {(host, t): f"*{quarter}" for t in like[quarter]}
            if len(like) == 1 and len(next(iter(like.values()))) == len(quarters[next(iter(like))]) > 1:
                changes |= {(host, t): f"*{next(iter(like))}" for t, *_ in quarters.get(None, [])}
        for k, t in template.items():
            if (mark := changes.get((k[0], tuple(t)))) and len(t) > at:
                t[at] = mark
    pooled = defaultdict(lambda: [0, 0])
    for k, t in template.items():
        pooled[k[0], tuple(t)][0] += shapes[k][0]
        pooled[k[0], tuple(t)][1] += shapes[k][1]
    return {(k[0], "/".join(k[1])): (pooled[k[0], tuple(t)][1] + prior / 2) / (pooled[k[0], tuple(t)][0] + prior) >= reject for k, t in template.items()}


@pytest.mark.parametrize("seed", range(3))
def test_the_tree_equals_dictionaries(spark, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(1500):
        host, a, b = rng.choice("hg"), rng.choice(["x", "y", "z", f"u{rng.randrange(60)}"]), rng.choice(["p", "q", "*", f"n{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}"])
        bad = a in "xy" and (b != "q" or host == "h")
        rows.append((host, f"/{a}/{b}" + rng.choice(["", "/1", "/a/2/3/4/5/6/7"]), rng.choice([None, int(bad), int(bad), int(bad and rng.random() < 0.97)])))
    judged = spark.createDataFrame(rows, "host string, path string, label int")
    got = {(r.host, r["shape"]): r.rejected for r in template_verdicts(judged, prior_pages=4.0, reject=0.8).collect()}
    assert got == plain_verdicts(rows, 4.0, 0.8) and len(set(got.values())) == 2


def test_a_page_without_a_rule_is_blocked_beside_blocked_ones(spark):
    rules = (Rule("block", "h.com", "/bad/"), Rule("block", "h.com", "/worse/"), Rule("block", "g.com", "/bad/"), Rule("allow", "f.com", "/bad/"), Rule("block", "f.com", "/worse/"))
    urls = [f"http://{h}.com/{part}/{i}" for h in "hgf" for part in ("bad", "worse") for i in range(60)] + [f"http://{h}.com/new/{i}" for h in "hgf" for i in range(3)]
    got = {r.path + "@" + r.host: r for r in url_filter(pages(spark, urls), rules).collect() if r.path.startswith("/new/")}
    assert all(r.rule is None and r.verdict == ("block" if r.host == "h.com" else "allow") for r in got.values()) and len(got) == 9


@pytest.mark.parametrize("times", [1, 4, 5, 20])
def test_repeated_urls_change_no_template(spark, times):
    rows = [("h", f"/u/name{chr(97 + i % 26)}{chr(97 + i // 26)}/x", 1 if i % 2 else None) for i in range(240)] * times
    got = template_verdicts(spark.createDataFrame(rows, "host string, path string, label int")).collect()
    assert len(got) == 240 and all(r.rejected for r in got) == (120 * times + 10 >= 0.9 * (120 * times + 20))
