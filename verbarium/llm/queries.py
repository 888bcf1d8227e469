"""The queries opN_* over the driver's tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, embedding_dedup, exact_dedup, filter_audit, license_scan, line_dedup, minhash_dedup, quality, secret_scan, source_mix, token_alignment, url_filter, warc
from .common import read_table

# The filter rules.
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(read_table(spark, sf_dir, "documents"))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = source_mix.mix_sources(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "repeats")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(read_table(spark, sf_dir, "documents"))


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.score_quality(docs, read_table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.filter_urls(read_table(spark, sf_dir, "pages"), url_filter.rule_table(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(read_table(spark, sf_dir, "embeddings"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    deduped = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return deduped.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), F.array_join("removed", ",").alias("removed"), F.length("text").cast("long").alias("kept_chars"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.report(read_table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(read_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_license_scan, op2_source_mix, op3_secret_scan, op4_minhash_dedup, op5_decontaminate, op6_quality, op7_warc, op8_url_filter, op9_embedding_dedup, op10_line_dedup, op11_token_alignment, op12_filter_audit, op13_exact_dedup)}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_GRAMS = "list_distinct(list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]))"
_TEMPLATES = ", ".join(f"({_quoted(k)}, {_quoted(v)})" for k, v in sorted(license_scan.TEMPLATES.items()))

_OP1 = rf"""
WITH listed AS (
  SELECT license, {_GRAMS} AS b FROM (
    SELECT license, list_filter(regexp_split_to_array({_LOWER.format("body")}, '[^a-z0-9]+'), lambda x: x <> '') AS w FROM (VALUES {_TEMPLATES}) t(license, body))
), parts AS (
  SELECT doc_id, text, string_split(regexp_replace(text, '([.!?])[\x20\x09-\x0D]+', '\1' || chr(10), 'g'), chr(10)) AS p FROM documents WHERE text IS NOT NULL
), whole AS (
  SELECT DISTINCT doc_id, text, CASE WHEN len(p) > 1 THEN list_append(p, text) ELSE p END AS p FROM parts
), one AS (
  SELECT doc_id, text, unnest(p) AS s, unnest(range(len(p))) AS seg FROM whole
), grams AS (
  SELECT doc_id, text, seg, {_GRAMS} AS b FROM (
    SELECT doc_id, text, seg, list_filter(regexp_split_to_array({_LOWER.format("s")}, '[^a-z0-9]+'), lambda x: x <> '') AS w FROM one)
), scored AS (
  SELECT doc_id, text, seg, license, 2.0::DOUBLE * len(list_intersect(g.b, l.b)) / (len(g.b) + len(l.b)) AS dice
  FROM grams g JOIN listed l ON list_has_any(g.b, l.b)
), matched AS (SELECT * FROM scored WHERE dice >= 0.8
), templates AS (
  SELECT license, len(w) - 1 AS span, len({_GRAMS}) AS m, {_GRAMS} AS b, list_transform(range(2, len(w)), lambda k: w[k - 1] || ' ' || w[k] || ' ' || w[k + 1]) AS tri FROM (
    SELECT license, list_filter(regexp_split_to_array({_LOWER.format("body")}, '[^a-z0-9]+'), lambda x: x <> '') AS w FROM (VALUES {_TEMPLATES}) t(license, body))
), texts AS (
  SELECT doc_id, text, row_number() OVER () AS id, list_filter(regexp_split_to_array({_LOWER.format("text")}, '[^a-z0-9]+'), lambda x: x <> '') AS w
  FROM (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL)
), all_grams AS MATERIALIZED (SELECT id, w, list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]) AS g FROM texts
), candidates AS MATERIALIZED (
  SELECT id, license, span, m, b, tri, w, g FROM all_grams JOIN templates ON list_has_any(g, b) WHERE len(list_intersect(g, b)) >= m * (0.8 / 1.2) - 1e-9
), places AS (SELECT *, unnest(range(1, len(g) + 1)) AS p FROM candidates
), hits AS MATERIALIZED (
  SELECT id, license, span, m, p, g[p] AS gram, p = 1 OR NOT list_contains(tri, w[p - 1] || ' ' || g[p]) AS is_first FROM places WHERE list_contains(b, g[p])
), tried AS (
  SELECT s.id, s.license, s.span, s.m, s.p AS s, f AS by_length, count(DISTINCT h.gram) AS common, max(h.p) AS e
  FROM (SELECT *, unnest([1.0::DOUBLE, 1.25::DOUBLE]) AS f FROM hits WHERE is_first) s JOIN hits h ON h.id = s.id AND h.license = s.license AND h.p >= s.p AND h.p < s.p + s.span * s.f GROUP BY ALL
), runs AS MATERIALIZED (
  SELECT id, license, span, s, max(dice) AS dice FROM (
    SELECT t.id, license, span, s, 2.0::DOUBLE * common / (len(list_distinct(list_slice(g, s, e))) + m) AS dice FROM tried t JOIN all_grams a ON a.id = t.id)
  WHERE dice >= 0.8 GROUP BY ALL
), judged AS (
  SELECT doc_id, text, r.license, r.s, r.dice, NOT EXISTS (
    FROM runs o WHERE o.id = r.id AND o.license = r.license AND abs(o.s - r.s) <= r.span AND (o.dice > r.dice OR o.dice = r.dice AND o.s < r.s)) AS peak
  FROM runs r JOIN texts x ON x.id = r.id
), every AS (
  SELECT doc_id, text, seg, license, dice, 0 AS notice FROM matched
  UNION ALL SELECT doc_id, text, CASE WHEN peak AND NOT EXISTS (FROM matched m WHERE m.doc_id IS NOT DISTINCT FROM j.doc_id AND m.text = j.text AND m.license = j.license) THEN -s END, license, dice, peak::INT FROM judged j
), per_doc AS (
  SELECT doc_id, count(DISTINCT CASE WHEN seg IS NOT NULL THEN (text, seg) END) AS n_segments, arg_min(license, (-dice, license)) AS license, max(dice) AS dice,
    array_to_string(list_sort(list(DISTINCT license)), ',') AS licenses, sum(notice) AS n_notices FROM every GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_segments, 0) AS n_segments, license, coalesce(dice, 0.0::DOUBLE) AS dice, coalesce(licenses, '') AS licenses, coalesce(n_notices, 0)::BIGINT AS n_notices
FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN per_doc p ON d.doc_id IS NOT DISTINCT FROM p.doc_id
"""

_OP2 = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT AS key FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM sized GROUP BY source
), levels AS (
  SELECT *, source_size * 2 / weight::DOUBLE AS ratio,
    (1.5::DOUBLE * sum(source_size) OVER ()::DOUBLE - coalesce(sum(source_size * 2) OVER (ORDER BY source_size * 2 / weight::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
    / sum(weight) OVER (ORDER BY source_size * 2 / weight::DOUBLE, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level FROM totals
), water AS (SELECT arg_min(level, ratio) AS level FROM levels WHERE ratio > level
), targets AS (
  SELECT l.source, source_size, CASE WHEN w.level IS NULL OR ratio <= w.level THEN (source_size * 2)::DOUBLE ELSE weight * w.level END AS target FROM levels l, water w
), plan AS (
  SELECT *, floor(target + 0.5)::BIGINT AS total, CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT // source_size ELSE 0 END AS repeats FROM targets
), run AS (
  SELECT s.*, p.source_size, p.target, p.repeats, p.total - p.repeats * p.source_size AS extra,
    coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY key, size, doc_id NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS prior
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target, (repeats * size + greatest(0, least(size, extra - prior)))::BIGINT AS taken, source, repeats::BIGINT AS repeats FROM run
"""

_OP4 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k : k + 4], ' '))) END AS s FROM d
), one AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS c FROM one a JOIN one b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (SELECT a, b FROM pairs WHERE 100 * c >= 75 * (na + nb - c)
), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT a AS doc_id, a AS other FROM both_ways UNION SELECT r.doc_id, e.b FROM reach r JOIN both_ways e ON r.other = e.a
), least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(component_id, s.doc_id) AS component_id, coalesce(component_id, s.doc_id) = s.doc_id AS kept
FROM sets s LEFT JOIN least USING (doc_id)
"""

_WORDS = "list_filter(regexp_split_to_array({}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
_OP5 = rf"""
WITH items AS (
  SELECT item_id, w, least(10, len(w)) AS n FROM (SELECT item_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM benchmark)
), wanted AS (
  SELECT DISTINCT item_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda k: array_to_string(w[k : k + n - 1], ' '))) AS win FROM items WHERE n > 0
), d AS (
  SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents
), sizes AS (SELECT DISTINCT n FROM wanted
), runs AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS k, unnest(list_transform(range(1, len(w) - n + 2), lambda k: array_to_string(w[k : k + n - 1], ' '))) AS win
  FROM d, sizes WHERE len(w) >= n
), hits AS (SELECT doc_id, r.n, k, item_id FROM runs r JOIN wanted t ON r.n = t.n AND r.win = t.win
), words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS j FROM hits) GROUP BY doc_id
), found AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""

_OP7 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages
), d AS (
  SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS h, min(page_id) OVER (PARTITION BY sha1(body)) AS first FROM p
), digits AS (
  SELECT *, list_transform(range(1, 41), lambda k: instr('0123456789abcdef', h[k]) - 1) AS x FROM d
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((16 * x[5 * i // 4 + 1] + x[5 * i // 4 + 2]) >> (3 - 5 * i % 4)) & 31)::INTEGER + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM digits
"""

_RULES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)
_OP8 = rf"""
WITH rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages
), parts AS (
  SELECT page_id, {_LOWER.format("regexp_extract(coalesce(r, ''), '^([^/?#]*)', 1)")} AS host, regexp_extract(coalesce(r, ''), '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM rest
), rules(verdict, h, p) AS (VALUES {_RULES}
), fits AS (
  SELECT page_id, arg_max(h || p, (length(h || p), length(h), verdict)) AS rule, arg_max(verdict, (length(h || p), length(h), verdict)) AS verdict
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id
)
SELECT parts.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN fits USING (page_id)
"""

_SPACES = "[^\\x20\\x09-\\x0D]+"
_OP12 = f"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_SPACES}') AS w FROM documents
), failed AS (
  SELECT doc_id, part, CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails FROM d
), good AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), h AS (
  SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM failed LEFT JOIN good USING (doc_id) GROUP BY ALL
), l(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')
), o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM o
), s AS (
  SELECT part, filter_order, step, filter_order[step] AS f, fails, n, good, toxic, contains(fails, filter_order[step]) AS here,
    len(list_filter(string_split(filter_order[1 : step - 1], ''), lambda x: x <> '' AND contains(fails, x))) > 0 AS gone FROM h, steps
), r AS (
  SELECT part, filter_order, step, f, sum(CASE WHEN NOT gone AND NOT here THEN n ELSE 0 END) AS kept, sum(CASE WHEN here AND NOT gone THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN here AND gone THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fails = f THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN here AND NOT gone THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN here AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost FROM s GROUP BY ALL
)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
  good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM r
"""

_OP13 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents
), g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)
"""

ORACLE_SQL = {"op1_license_scan": _OP1, "op2_source_mix": _OP2, "op4_minhash_dedup": _OP4, "op5_decontaminate": _OP5, "op7_warc": _OP7, "op8_url_filter": _OP8, "op12_filter_audit": _OP12, "op13_exact_dedup": _OP13}
