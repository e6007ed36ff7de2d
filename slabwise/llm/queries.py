"""The registered queries of this subpackage: thin forms of the operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from slabwise.llm.alignment import align_tokens
from slabwise.llm.common import table
from slabwise.llm.exact_dedup import exact_dedup
from slabwise.llm.line_dedup import line_dedup
from slabwise.llm.fingerprints import fingerprint_edits
from slabwise.llm.kneser_ney import score_texts
from slabwise.llm.language_id import identify
from slabwise.llm.lexical_search import lexical_search
from slabwise.llm.mixing import mix
from slabwise.llm.ngram_join import ngram_join
from slabwise.llm.packing import pack
from slabwise.llm.substring_dedup import substring_dedup
from slabwise.llm.suffix_array import suffix_array_matches
from slabwise.llm.url_filters import url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"), window=50)


SQL["op1_substring_dedup"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM d WHERE len(ws) >= 50),
h AS (SELECT doc_id, i, sha256(array_to_string(ws[i:i + 49], ' ')) AS h FROM w),
f AS (SELECT h, min(doc_id) AS first_id FROM h GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, j FROM (
    SELECT h.doc_id, unnest(range(h.i, h.i + 50)) AS j FROM h JOIN f USING (h) WHERE f.first_id < h.doc_id)),
k AS (
  SELECT p.doc_id, count(*) AS n, string_agg(p.w, ' ' ORDER BY p.j) AS kept
  FROM (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS j FROM d) p
  LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.j = p.j WHERE g.j IS NULL GROUP BY p.doc_id)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, CAST(len(d.ws) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""


@_query
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


SQL["op4_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
  doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM d
"""


@_query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents"), min_chars=20, min_docs=3)


SQL["op9_line_dedup"] = r"""
WITH l AS (
  SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
k AS (
  SELECT doc_id, i, line, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, max(doc_id) AS last_id FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
SELECT k.doc_id, count(*) AS n_lines, count(*) FILTER (f.last_id <> k.doc_id) AS n_dropped,
  sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.i) FILTER (f.last_id IS NULL OR f.last_id = k.doc_id), '')) AS kept_sha256
FROM k LEFT JOIN f USING (key) GROUP BY k.doc_id
"""


@_query
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), capacity=1024)


@_query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


@_query
def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"), size=3, percent=90)


#: Links between all pairs that share a shingle, then the smallest id reached over them.
SQL["op6_ngram_jaccard_join"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 3 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i + 2], ' ') END AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
  GROUP BY ALL),
l AS (
  SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * common >= 90 * (p.n + q.n - common)),
r(doc_id, reached) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.reached)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY doc_id) m USING (doc_id)
"""


@_query
def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("source")


SQL["op3_source_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5('mix:' || doc_id) AS key FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, CAST([3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS weight,
    CAST(2 * source_size AS DOUBLE) AS cap FROM s),
r AS (SELECT *, cap / weight AS ratio FROM w),
l AS (
  SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM s)
      - (sum(cap) OVER (ORDER BY ratio, source NULLS LAST ROWS UNBOUNDED PRECEDING) - cap))
    / sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r),
f AS (SELECT ratio AS free_ratio, level AS free_level FROM l WHERE ratio > level ORDER BY ratio, source NULLS LAST LIMIT 1),
t AS (
  SELECT source, source_size, CASE WHEN free_ratio IS NULL OR ratio < free_ratio THEN cap ELSE weight * free_level END AS target
  FROM l LEFT JOIN f ON true),
e AS (SELECT *, CAST(coalesce(floor(target / nullif(source_size, 0)), 0) AS BIGINT) AS whole FROM t),
o AS (
  SELECT d.*, e.source_size, e.target, e.whole, CAST(floor(e.target - e.whole * e.source_size + 0.5) AS BIGINT) AS rest,
    CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id ROWS UNBOUNDED PRECEDING) - d.size AS BIGINT) AS start
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, CAST(whole * size + greatest(0, least(size, rest - start)) AS BIGINT) AS taken FROM o
"""


@_query
def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))


@_query
def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"))


@_query
def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array_matches(table(spark, sf_dir, "documents"), length=50)


@_query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=10)


SQL["op11_lexical_search"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
c AS (SELECT count(*) FILTER (len(ts) > 0) AS nn, CAST(sum(len(ts)) AS BIGINT) AS ll FROM d),
p AS (SELECT r, doc_id, len(ts) AS n, term, count(*) AS tf FROM (SELECT r, doc_id, ts, unnest(ts) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * nn + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM p, c GROUP BY term, nn),
i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
s AS (
  SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + ((90 * n * nn) // ll))))) AS BIGINT) AS score
  FROM i JOIN w USING (term) JOIN p USING (term), c GROUP BY item_id, r, doc_id)
SELECT * FROM (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
  FROM s WHERE score > 0) WHERE rank <= 10
"""


@_query
def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(table(spark, sf_dir, "documents"))


@_query
def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


#: A blank stands for the end of a text, and the empty string for what opens it; crc32 comes from its polynomial.
SQL["op13_lm_scoring"] = r"""
WITH crc AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
    ORDER BY i) AS t FROM (SELECT unnest(range(256)) AS i)),
d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(xor(list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
      lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) % 7 = 2, false) AS held_out,
    list_append(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x20\x09-\x0D]+'), ' ') AS ws FROM documents, crc),
t AS (SELECT r, doc_id, held_out, unnest(list_prepend('', ws[:-2])) AS v, unnest(ws) AS w FROM d),
u AS (SELECT w, count(*) AS c FROM t WHERE NOT held_out GROUP BY w),
s AS (SELECT coalesce(sum(c), 0) AS nn, count(*) AS vv FROM u),
b AS (SELECT v, w, count(*) AS c FROM t WHERE NOT held_out GROUP BY v, w),
a AS (SELECT w, count(*) AS c FROM b GROUP BY w),
k AS (
  SELECT 2 AS o, count(*) FILTER (c = 1) AS n1, count(*) FILTER (c = 2) AS n2, count(*) FILTER (c = 3) AS n3, count(*) FILTER (c = 4) AS n4 FROM b
  UNION ALL SELECT 1, count(*) FILTER (c = 1), count(*) FILTER (c = 2), count(*) FILTER (c = 3), count(*) FILTER (c = 4) FROM a),
e AS (
  SELECT o, 1 - 2 * y * n2 / n1 AS d1, 2 - 3 * y * n3 / n2 AS d2, 3 - 4 * y * n4 / n3 AS d3
  FROM (SELECT *, n1 / CAST(n1 + 2 * n2 AS DOUBLE) AS y FROM k WHERE least(n1, n2, n3, n4) > 0)),
f AS (
  SELECT k.o, CASE WHEN ok THEN d1 ELSE 0.5 END AS d1, CASE WHEN ok THEN d2 ELSE 1.0 END AS d2, CASE WHEN ok THEN d3 ELSE 1.5 END AS d3
  FROM k LEFT JOIN (SELECT *, d1 > 0 AND d1 <= 1 AND d2 > 0 AND d2 <= 2 AND d3 > 0 AND d3 <= 3 AS ok FROM e) x ON k.o = x.o),
g AS (SELECT (d1 * count(*) FILTER (c = 1) + d2 * count(*) FILTER (c = 2) + d3 * count(*) FILTER (c > 2)) / sum(c) AS unseen, sum(c) AS pairs
  FROM a, f WHERE o = 1 GROUP BY d1, d2, d3),
q AS (SELECT w, (c - CASE c WHEN 1 THEN d1 WHEN 2 THEN d2 ELSE d3 END) / pairs + unseen / (vv + 1) AS p FROM a, f, g, s WHERE o = 1),
h AS (SELECT v, sum(c) AS total, (d1 * count(*) FILTER (c = 1) + d2 * count(*) FILTER (c = 2) + d3 * count(*) FILTER (c > 2)) AS freed
  FROM b, f WHERE o = 2 GROUP BY v, d1, d2, d3),
x AS (
  SELECT t.r, t.doc_id, t.held_out, u.c, coalesce(q.p, unseen / (vv + 1)) AS p1, h.total, h.freed,
    coalesce(b.c - CASE b.c WHEN 1 THEN d1 WHEN 2 THEN d2 ELSE d3 END, 0) AS part
  FROM t JOIN f ON o = 2 CROSS JOIN g CROSS JOIN s LEFT JOIN u ON u.w = t.w LEFT JOIN q ON q.w = t.w
  LEFT JOIN h ON h.v = t.v LEFT JOIN b ON b.v = t.v AND b.w = t.w)
SELECT doc_id, held_out, count(*) AS n_tokens, count(c) AS n_known, CAST(nn AS BIGINT) AS train_tokens,
  round(sum(log10((coalesce(c, 0) + 1) / CAST(nn + vv + 1 AS DOUBLE))), 6) AS base_score,
  round(sum(log10(CASE WHEN total IS NULL THEN p1 ELSE p1 * (freed / total) + part / total END)), 6) AS score
FROM x, s GROUP BY r, doc_id, held_out, nn
"""
