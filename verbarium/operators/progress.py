"""Progress of users: counters from attempts, selection weights and weighted sampling."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.schemas import EXERCISE_TYPES, STATS
from ..stored import BUCKETS, StoredTable


def counters(*keys: str):
    """Aggregates of attempts by ``keys``: seen, correct and error counts, and the last time applied."""
    return lambda attempts: attempts.groupBy(*keys).agg(
        F.count("*").alias("seen_count"),
        F.count_if(F.col("correct")).alias("correct_count"),
        F.count_if(~F.col("correct")).alias("error_count"),
        F.max_by("when", "_ord").alias("last_seen_at"),
    )


def attempts_of_results(results: DataFrame, sessions: DataFrame, exercise_type: str) -> DataFrame:
    """Attempts from the word results of a round's exercise: what progress counts.

    ``results`` has session, word_id and correct, as the exercises' ``word_results`` give them;
    ``sessions`` has session, user_id, when and _ord, one row each. Results of an unknown
    session, and results without a word, count for nothing.
    """
    if exercise_type not in EXERCISE_TYPES:
        raise ValueError(f"unknown exercise type {exercise_type}")
    known = sessions.select(F.col("session").alias("_session"), F.col("user_id").cast("string").alias("user_id"), F.col("when").cast("timestamp_ntz").alias("when"), F.col("_ord").cast("bigint").alias("_ord"))
    joined = results.where("word_id is not null").join(known, F.col("session") == F.col("_session"))
    return joined.select("user_id", "word_id", F.lit(exercise_type).alias("exercise_type"), "correct", "when", "_ord")


def progress_totals(attempts: DataFrame) -> DataFrame:
    """Counters by user and word; ``last_seen_at`` is of the last attempt applied, not the latest."""
    return counters("user_id", "word_id")(attempts)


def progress_by_exercise(attempts: DataFrame) -> DataFrame:
    """Counters by user, word and exercise type, of attempts that have a type."""
    return counters("user_id", "word_id", "exercise_type")(attempts.where("exercise_type is not null"))


def progress(attempts: DataFrame, useless: DataFrame | None = None) -> DataFrame:
    """The progress record of every user and word; ``useless`` lists flagged (user_id, word_id)."""
    by_type = progress_by_exercise(attempts).groupBy("user_id", "word_id")
    stats = F.struct("seen_count", "correct_count", "error_count", "last_seen_at")
    maps = by_type.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("exercise_type", stats.alias("stats"))))).alias("exercise_stats"))
    none = F.create_map().cast(f"map<string,{STATS}>")
    out = progress_totals(attempts).join(maps, ["user_id", "word_id"], "left").withColumn("exercise_stats", F.coalesce("exercise_stats", none))
    if useless is None:
        return out.withColumn("is_useless", F.lit(False))
    flags = useless.select("user_id", "word_id").distinct().withColumn("is_useless", F.lit(True))
    return out.join(flags, ["user_id", "word_id"], "left").withColumn("is_useless", F.coalesce("is_useless", F.lit(False)))


def counted(attempts: DataFrame) -> DataFrame:
    """Counters by user and word with the place of the last attempt: rows that ``combine_counts`` adds up."""
    last = F.max(F.struct(F.col("_ord").alias("at"), F.col("when").alias("value"))).alias("last")
    return attempts.groupBy("user_id", "word_id").agg(F.count("*").alias("seen_count"), F.count_if(F.col("correct")).alias("correct_count"), F.count_if(~F.col("correct")).alias("error_count"), last)


def combine_counts(rows: DataFrame) -> DataFrame:
    """One row per user and word of rows that several batches have of them."""
    sums = [F.sum(c).alias(c) for c in ("seen_count", "correct_count", "error_count")]
    return rows.groupBy("user_id", "word_id").agg(*sums, F.max("last").alias("last"))


def stored_progress(path: str, buckets: int = BUCKETS) -> StoredTable:
    """Counters that are kept below ``path``: ``apply`` takes ``counted`` attempts of a numbered batch, once."""
    return StoredTable(path, ("user_id", "word_id"), combine_counts, buckets)


def totals_of(rows: DataFrame) -> DataFrame:
    """``progress_totals``' rows from stored counters."""
    return rows.select("user_id", "word_id", "seen_count", "correct_count", "error_count", F.col("last.value").alias("last_seen_at"))


@dataclass(frozen=True)
class Weights:
    """Knobs of the selection weight."""

    base: float = 1.0
    error_boost: float = 3.0
    unseen_multiplier: float = 5.0
    recency_half_life_seconds: float = 3600.0
    frequency_factor: Mapping[str, float] = field(default_factory=lambda: {"high": 1.2, "medium": 1.0, "low": 0.8})


def weight(now: datetime | Column, knobs: Weights = Weights()) -> Column:  # noqa: B008 - frozen
    """The selection weight of a word (frequency) joined with its progress (null columns without).

    A flagged word weighs 0. Otherwise the base, times the unseen factor without an attempt
    or 1 + boost * errors with; times the factor of its frequency, if it has one; times
    1 - 0.5 ** (seconds since last seen / half-life) once it was seen. Never below 0.
    """
    if knobs.recency_half_life_seconds == 0:
        raise ZeroDivisionError("recency_half_life_seconds is 0")
    moment = now if isinstance(now, Column) else F.lit(now).cast("timestamp_ntz")
    unseen = F.coalesce(F.col("seen_count"), F.lit(0)) == 0
    out = F.lit(knobs.base) * F.when(unseen, F.lit(knobs.unseen_multiplier)).otherwise(1.0 + F.lit(knobs.error_boost) * F.col("error_count"))
    factor = F.lit(1.0)
    for level, value in knobs.frequency_factor.items():
        factor = F.when(F.col("frequency") == level, F.lit(float(value))).otherwise(factor)
    out = out * F.when(F.col("frequency").isNotNull(), factor).otherwise(1.0)
    elapsed = F.greatest(F.lit(0.0), F.timestamp_diff("MICROSECOND", F.col("last_seen_at"), moment) / 1e6)
    recency = 1.0 - F.pow(F.lit(0.5), elapsed / knobs.recency_half_life_seconds)
    out = out * F.when(F.col("last_seen_at").isNotNull(), recency).otherwise(1.0)
    return F.when(F.coalesce(F.col("is_useless"), F.lit(False)), F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), out))


def weighted_pool(pool: DataFrame, records: DataFrame, now: datetime, knobs: Weights = Weights()) -> DataFrame:  # noqa: B008 - frozen
    """``pool`` (derived words) with its ``weight``; ``records`` has one progress row a word of one user.

    Pool columns that a progress record also has are the pool's business; a word that was
    never seen has no record. Spark broadcasts the records while they are small.
    """
    own = records.select(F.col("word_id").alias("_word"), "seen_count", "error_count", "last_seen_at", "is_useless")
    joined = pool.join(own, F.col("id") == F.col("_word"), "left").withColumn("weight", weight(now, knobs))
    return joined.drop("_word", "seen_count", "error_count", "last_seen_at", "is_useless")


def hash_uniform(seed: int | str, *columns: Column | str) -> Column:
    """A number in (0, 1) that the seed and the columns determine, equal on every engine."""
    text = F.concat_ws("|", F.lit(str(seed)), *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns])
    return (F.conv(F.substring(F.sha1(text), 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def select_words(pool: DataFrame, n: int, uniform: Column | None = None) -> DataFrame:
    """Up to ``n`` rows of a weighted pool, sampled without replacement, in draw order.

    Drawing one by one with chances by the remaining weights has the distribution of the
    order of -ln(u) / weight; so one pass keeps the n smallest keys of each partition.
    Rows of weight 0 are never drawn; equal words at different places can both be.
    """
    draw = F.rand() if uniform is None else uniform
    keyed = pool.where("weight > 0").withColumn("_key", -F.ln(draw) / F.col("weight"))
    return keyed.orderBy("_key").limit(max(n, 0)).drop("_key")
