"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import small, store

#: Hash buckets of a source's documents; only the one bucket at a source's limit is ordered.
BUCKETS = 4096
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str) -> F.Column:
    """Words of ``text``: runs of characters other than space and 09 to 0D; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(totals: DataFrame, weights: Sequence[int], share: float, max_epochs: int) -> DataFrame:
    """Targets of the sources: weights' shares of ``share`` times all sizes, none above its cap.

    ``totals`` has a row per source (source, source_size). Clamping sources at their cap
    and resharing the excess by weight ends at one water level for the others: with
    sources in order of cap by weight, the level before source k is what the capped ones
    leave, by the weight of the rest; a source is capped when its own ratio is below it.
    """
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    order = W.orderBy(F.col("source").asc_nulls_last())
    by_ratio = W.orderBy("_ratio", F.col("source").asc_nulls_last())
    everything = W.partitionBy()
    filled = (
        totals.withColumn("_weight", F.get(cycle, F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))))
        .withColumn("_cap", F.col("source_size") * max_epochs)
        .withColumn("_ratio", F.col("_cap") / F.col("_weight"))
        .withColumn("_budget", F.lit(float(share)) * F.sum("source_size").over(everything))
        .withColumn("_below", F.coalesce(F.sum("_cap").over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("_rest", F.sum("_weight").over(by_ratio.rowsBetween(0, W.unboundedFollowing)))
        .withColumn("_level", (F.col("_budget") - F.col("_below")) / F.col("_rest"))
        # The level of the first source that is not capped holds for it and all after it.
        .withColumn("_level", F.min(F.when(F.col("_ratio") > F.col("_level"), F.struct("_ratio", "source", "_level"))).over(everything)["_level"])
    )
    capped = F.col("_level").isNull() | (F.col("_ratio") <= F.col("_level"))
    target = F.when(capped, F.col("_cap").cast("double")).otherwise(F.col("_weight") * F.col("_level"))
    return filled.select("source", "source_size", target.alias("target"))


ADDED = ("size", "source_size", "target", "taken", "repeats")


def mix_sources(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, max_epochs: int = 2, seed: int = 17) -> DataFrame:
    """How many words of each document a mix of the sources takes.

    ``docs`` needs doc_id, text and source. Sources, ordered by code point with null last, take ``weights`` in turn. A source's target, rounded to
    words, is met by whole repetitions of all its documents and one more, fractional
    repetition: documents in the order of a seeded hash until the rest is used up, the
    document at the limit with its first words only. So a document is never taken more
    than ``max_epochs`` times its size, a source's taken words are its rounded target, and
    reruns agree.

    Defined cases: null text counts 0 words; a null source is a source; a null doc_id
    hashes as an empty string; documents of equal hash follow by size; repeated rows
    each count; an empty table gives no rows; a source without words has target 0; columns
    of ``docs`` named like an added one are replaced.

    Returns the columns of ``docs`` with size, source_size, target, taken and repeats (whole
    repetitions).
    """
    key = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 13), 16, 10).cast("long")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ADDED]).alias("row"), "source", "doc_id", word_count("text").alias("size"), key.alias("_key"))
    rows = rows.withColumn("_bucket", F.floor(F.col("_key") / (2**52 // BUCKETS)).cast("int"))
    sized = store(rows.groupBy("source", "_bucket").agg(F.sum("size").alias("size")), "mix-sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = water_fill(totals, weights, share, max_epochs)
    total = F.floor(F.col("target") + 0.5).cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(total / F.greatest("source_size", F.lit(1)))).otherwise(0).cast("long")
    plan = targets.withColumn("repeats", whole).withColumn("_extra", total - F.col("repeats") * F.col("source_size"))
    # Where in the hash order of its buckets each source's extra words end.
    before = W.partitionBy("source").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    at = (
        sized.withColumn("_before", F.coalesce(F.sum("size").over(before), F.lit(0)))
        .join(plan.select(F.col("source").alias("_source"), "_extra"), F.col("source").eqNullSafe(F.col("_source")))
        .where(F.col("_before") < F.col("_extra"))
        .groupBy("source")
        .agg(F.max(F.struct("_bucket", "_before")).alias("_limit"))
        .select(F.col("source").alias("_at"), F.col("_limit._bucket").alias("_last"), F.col("_limit._before").alias("_used"))
    )
    plan = store(
        plan.join(at, F.col("source").eqNullSafe(F.col("_at")), "left").select(F.col("source").alias("_source"), "source_size", "target", "repeats", "_extra", "_last", "_used"),
        "mix-plan",
    )
    joined = rows.join(small(plan), F.col("source").eqNullSafe(F.col("_source")))
    base = F.col("repeats") * F.col("size")
    returned = lambda df, extra: df.select("row.*", "size", "source_size", "target", (base + extra).alias("taken"), "repeats")
    clear = joined.where(F.col("_last").isNull() | (F.col("_bucket") != F.col("_last")))
    clear = returned(clear, F.when(F.col("_bucket") < F.col("_last"), F.col("size")).otherwise(0))
    run = W.partitionBy("source").orderBy("_key", "size", F.col("doc_id").asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1)
    edge = joined.where(F.col("_bucket") == F.col("_last")).withColumn("_prior", F.col("_used") + F.coalesce(F.sum("size").over(run), F.lit(0)))
    edge = returned(edge, F.greatest(F.lit(0), F.least(F.col("size"), F.col("_extra") - F.col("_prior"))))
    return clear.unionByName(edge)
