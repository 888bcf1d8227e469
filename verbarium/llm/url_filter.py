"""URL filter lists: host-suffix and path-prefix expressions looked up by short hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, small, store

#: Hex digits of the digest that the lookup joins on; the whole digest confirms.
PREFIX = 8


def url_parts(url: str) -> tuple[F.Column, F.Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://`` or for null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def rule_table(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rows (verdict, host, path) of ``rules`` as a table."""
    return spark.createDataFrame([tuple(r) for r in rules], "verdict string, rule_host string, rule_path string")


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """The rule and the verdict of every URL.

    ``pages`` needs page_id and url; ``rules`` has verdict (allow or block), rule_host and
    rule_path. A rule fits its host and all subdomains when the path starts with the
    rule's. A URL expands into the suffixes of its host at a dot with prefixes of its path,
    for each number of labels and path length that some rule has; these meet the rules on
    the first digits of their SHA-256, and the whole digest, host and path confirm. Rows
    are brought together again by a number of their own, so no host or path is a hot key. Of the rules that fit, the one
    with the longest host and path together decides, then the longer host, then block.

    Defined cases: null URLs and those without ``://`` have an empty host and path and
    get ``default`` as no rule's host is empty; rules with null parts never fit; pages keep
    one row each, repeated rows too.

    Returns page_id, url, host, path, rule (host then path, or null), verdict.
    """
    host, path = url_parts("url")
    parts = pages.select(F.monotonically_increasing_id().alias("_row"), "page_id", "url", host.alias("host"), path.alias("path"))
    listed = rules.where("rule_host <> '' and rule_path is not null and verdict in ('allow', 'block')").select("verdict", ascii_lower("rule_host").alias("rule_host"), "rule_path")
    listed = listed.groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("verdict"))  # of two equal rules block holds
    digest = lambda h, p: F.sha2(F.concat(h, F.lit("\x00"), p), 256)
    listed = store(listed.withColumn("_full", digest(F.col("rule_host"), F.col("rule_path"))).withColumn("_short", F.substring("_full", 1, PREFIX)), "url-rules")
    labels = lambda h: F.length(h) - F.length(F.replace(h, F.lit("."), F.lit(""))) + 1
    shapes = sorted(tuple(r) for r in listed.select(labels(F.col("rule_host")), F.length("rule_path")).distinct().collect())  # few: bounded by what hosts and paths are like
    fits = lambda k, n: (labels(F.col("host")) >= k) & (F.length("path") >= n)
    expressions = [F.when(fits(k, n), F.struct(F.substring_index("host", ".", -k).alias("suffix"), F.substring("path", 1, n).alias("start"))) for k, n in shapes]
    expressions = F.filter(F.array(*expressions), lambda e: e.isNotNull()) if shapes else F.array().cast("array<struct<suffix:string,start:string>>")
    tried = parts.select("*", F.explode_outer(expressions).alias("_e"))
    tried = tried.withColumn("_digest", digest(F.col("_e.suffix"), F.col("_e.start"))).withColumn("_start", F.substring("_digest", 1, PREFIX))
    same = (F.col("_digest") == F.col("_full")) & (F.col("_e.suffix") == F.col("rule_host")) & (F.col("_e.start") == F.col("rule_path"))
    found = tried.join(small(listed), (F.col("_start") == F.col("_short")) & same, "left")
    rank = F.struct((F.length("rule_host") + F.length("rule_path")).alias("n"), F.length("rule_host").alias("h"), F.col("verdict"), F.concat("rule_host", "rule_path").alias("rule"))
    best = F.max(F.when(F.col("rule_host").isNotNull(), rank)).alias("_best")
    judged = found.groupBy("_row", "page_id", "url", "host", "path").agg(best)
    return judged.select("page_id", "url", "host", "path", F.col("_best.rule").alias("rule"), F.coalesce(F.col("_best.verdict"), F.lit(default)).alias("verdict"))
