"""Weighted selection of words for every learner at once, without the product of learners and words."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .progress import Weights, hash_uniform, weight

#: A tier is drawn from by jumps if it has at least this many times the words that can be in the way.
ROOM = 4
#: Jumps along a tier for n words: SPARE + PER_WORD * n. With ROOM they fall short of n new words
#: with a chance under 1e-15 (they meet 1.7 * n and more on average).
PER_WORD, SPARE = 3, 60
#: Leading hex digits of the shared order by which its places are counted in parallel.
DIGITS = 3


def shared_order(pool: DataFrame, knobs: Weights = Weights()) -> DataFrame:  # noqa: B008 - frozen
    """``pool`` (id, _ord, frequency and others) with ``tier`` and ``pos``, its place from 0 in an order by hash within the tier.

    Words of a tier weigh the same while they are unseen; frequencies without a factor of their
    own are the tier ''. Places are counted within ranges of hashes, whose sizes are summed
    before, so no task has a whole tier.
    """
    known = F.col("frequency").isin(*knobs.frequency_factor)
    order = F.sha1(F.concat_ws("|", "id", F.col("_ord").cast("string")))
    placed = pool.withColumns({"tier": F.when(known, F.col("frequency")).otherwise(""), "_order": order}).withColumn("_range", F.substring("_order", 1, DIGITS))
    sizes = placed.groupBy("tier", "_range").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.partitionBy("tier").orderBy("_range")) - F.col("_n")
    starts = sizes.select("tier", "_range", before.alias("_before"))
    within = F.row_number().over(W.partitionBy("tier", "_range").orderBy("_order")) - 1
    return placed.withColumn("_within", within).join(F.broadcast(starts), ["tier", "_range"]).withColumn("pos", F.col("_before") + F.col("_within")).drop("_order", "_range", "_before", "_within")


def _exponential(seed: int, kind: str, *columns: Column | str) -> Column:
    return -F.ln(hash_uniform(f"{seed}|{kind}", *columns))


def select_for_learners(pool: DataFrame, records: DataFrame, learners: DataFrame, n: int, now: datetime, seed: int = 0, knobs: Weights = Weights()) -> DataFrame:  # noqa: B008 - frozen
    """Up to ``n`` words for each learner: (user_id, rank, id, pos, tier, weight), in draw order.

    ``pool`` has id, _ord and frequency; ``records`` are progress records (user_id, word_id,
    seen_count, error_count, last_seen_at, is_useless) of any learners; ``learners`` has the
    user_ids to draw for (repeated and null ones count for nothing). Each learner's draw has the
    distribution of ``progress.select_words``: words in the order of exponential keys with
    their weights as rates, of which those of rate 0 are none.

    A word with a record has its own key. For the words of a tier without one, keys are the
    arrivals of a Poisson process of the tier's whole weight: each jump along it meets a word of
    the shared order, chosen evenly; a word's first arrival is its key, and words with a record
    of the learner are passed over, by a join with the learner's records only. A tier that has
    not ROOM times the words that can be in the way (n and the learner's records) gives each of
    its words a key. So there are rows for learners * n and for records, and none for pairs.

    The n least keys of a learner are kept in every task before they are brought together.
    """
    words = shared_order(pool, knobs)
    some = learners.select(F.col("user_id").cast("string").alias("user_id")).where("user_id is not null").distinct()
    fields = [F.col(c) for c in ("seen_count", "error_count", "last_seen_at", "is_useless")]
    own = records.select(F.col("user_id").cast("string").alias("user_id"), F.col("word_id").alias("id"), *fields).join(some, "user_id", "left_semi")
    seen = own.join(words.select("id", "tier", "pos", "frequency"), "id").withColumn("weight", weight(now, knobs)).select("user_id", "tier", "pos", "weight")

    # Tiers are the frequencies that have a factor, and ''.
    tiers = words.groupBy("tier").agg(F.count("*").alias("size"), F.min("frequency").alias("frequency"))
    unseen = tiers.withColumns({c: F.lit(None).cast(t) for c, t in (("seen_count", "bigint"), ("error_count", "bigint"), ("last_seen_at", "timestamp_ntz"), ("is_useless", "boolean"))})
    listed = [r for r in unseen.withColumn("weight", weight(now, knobs)).select("tier", "size", "weight").collect() if r["weight"] > 0]
    offered = F.array(*[F.struct(F.lit(r["tier"]).alias("tier"), F.lit(r["size"]).alias("size"), F.lit(r["weight"]).alias("weight")) for r in listed])
    counted = some.join(seen.groupBy("user_id").agg(F.count("*").alias("_seen")), "user_id", "left").withColumn("_seen", F.coalesce("_seen", F.lit(0)))
    if listed:
        open_tiers = counted.select("user_id", "_seen", F.inline(offered))
    else:
        open_tiers = counted.select("user_id", "_seen", F.lit("").alias("tier"), F.lit(0).cast("bigint").alias("size"), F.lit(0.0).alias("weight")).where("false")
    roomy = F.col("size") >= ROOM * (F.lit(n) + F.col("_seen"))

    # Along a tier words are met by rising keys, so of its new ones the learner's first n and as many as have a record are enough.
    jump = lambda last, value: F.transform(F.sequence(F.lit(1), last.cast("int")), value)
    met = jump(F.lit(PER_WORD * max(n, 0) + SPARE), lambda k: F.floor(hash_uniform(f"{seed}|word", "user_id", "tier", k) * F.col("size")).cast("bigint"))
    first = F.slice(F.array_distinct("_met"), F.lit(1), (F.lit(max(n, 0)) + F.col("_seen")).cast("int"))
    met = open_tiers.where(roomy).withColumn("_met", met).withColumn("_first", first).where(F.size("_first") > 0)
    gaps = jump(F.array_position("_met", F.element_at("_first", -1)), lambda k: _exponential(seed, "gap", "user_id", "tier", k) / (F.col("size") * F.col("weight")))
    along = lambda pos: F.aggregate(F.slice("_gaps", F.lit(1), F.array_position("_met", pos).cast("int")), F.lit(0.0), lambda total, gap: total + gap)
    arrivals = met.withColumn("_gaps", gaps).select("user_id", "tier", "weight", F.inline(F.transform("_first", lambda pos: F.struct(pos.alias("pos"), along(pos).alias("key")))))

    key = (_exponential(seed, "own", "user_id", "tier", "pos") / F.col("weight")).alias("key")
    each = open_tiers.where(~roomy).select("user_id", "tier", "weight", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("size") - 1)).alias("pos"))
    new = arrivals.select("user_id", "tier", "pos", "weight", "key").unionByName(each.select("user_id", "tier", "pos", "weight", key))
    new = new.join(seen.select("user_id", "tier", "pos"), ["user_id", "tier", "pos"], "left_anti")
    drawn = new.unionByName(seen.where("weight > 0").select("user_id", "tier", "pos", "weight", key))

    rank = F.row_number().over(W.partitionBy("user_id").orderBy("key", "tier", "pos"))
    best = drawn.withColumn("rank", rank).where(F.col("rank") <= n)
    return best.join(words.select("tier", "pos", "id"), ["tier", "pos"]).select("user_id", "rank", "id", "tier", "pos", "weight")
