"""Matching rounds (pairs of word and translation) and sentence ordering rounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import SPACE, strip, word_id

LEAST_PORTION = 3
# Fixed value: what a player is told.
WRONG_PAIR = "Wrong pair."


def _shuffle_key(seed: int, *parts: Column | str) -> Column:
    """A key that is as good as random, and the same in every run."""
    texts = [(F.col(x) if isinstance(x, str) else x).cast("string") for x in parts]
    return F.sha1(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(x, F.lit("")) for x in texts]))


def pairs(words: DataFrame, target_language: str, strict: bool = True) -> DataFrame:
    """(round, left, right, word_id, place) of every round's words.

    ``words`` has round, _ord, text, language and translations. A word without a translation
    fails the query if ``strict``, else it is left out. Of equal texts of a round the last
    translation holds, at the first's place.
    """
    right = F.try_element_at("translations", F.lit(target_language))
    rows = words.select("round", "_ord", "text", "language", right.alias("right"))
    if strict:
        missing = F.raise_error(F.concat(F.lit(f"no translation into {target_language}: "), F.coalesce("text", F.lit("null"))))
        rows = rows.withColumn("right", F.when(F.col("right").isNull(), missing).otherwise(F.col("right")))
    else:
        rows = rows.where("right is not null")
    out = rows.groupBy("round", F.col("text").alias("left")).agg(F.max_by("right", "_ord").alias("right"), F.max_by("language", "_ord").alias("_language"), F.min("_ord").alias("place"))
    return out.select("round", "left", "right", word_id(F.col("left"), F.col("_language")).alias("word_id"), "place")


def columns_shown(paired: DataFrame, seed: int) -> DataFrame:
    """(round, left_words in order, right_words shuffled by a seeded hash) of each round."""
    shuffled = F.struct(_shuffle_key(seed, "round", "left").alias("key"), F.col("right").alias("value"))
    ordered = F.struct(F.col("place").alias("key"), F.col("left").alias("value"))
    values = lambda c: F.transform(F.array_sort(F.collect_list(c)), lambda x: x["value"])
    return paired.groupBy("round").agg(values(ordered).alias("left_words"), values(shuffled).alias("right_words"))


def score_taps(taps: DataFrame, paired: DataFrame) -> DataFrame:
    """``taps`` (round, left, right) with correct, word_id (null for an unknown word) and feedback.

    Values are compared, so words of equal translation may be swapped; a left word that the
    round hasn't is right only with a null right.
    """
    known = paired.select(F.col("round").alias("_round"), F.col("left").alias("_left"), F.col("right").alias("_right"), "word_id")
    joined = taps.join(known, (F.col("round") == F.col("_round")) & (F.col("left") == F.col("_left")), "left")
    correct = F.col("_right").eqNullSafe(F.col("right"))
    return joined.withColumns({"correct": correct, "feedback": F.when(~correct, WRONG_PAIR)}).drop("_round", "_left", "_right")


def word_results(scored: DataFrame) -> DataFrame:
    """(session, word_id, correct) of every tap on a word that the round has; rounds are sessions."""
    return scored.where("word_id is not null").select(F.col("round").alias("session"), "word_id", "correct")


def merge_short_portions(portions: Column, least: int = LEAST_PORTION) -> Column:
    """Portions in order; one shorter than ``least``, or after such a one, joins the one before."""

    def step(out: Column, portion: Column) -> Column:
        last = F.element_at(out, -1)
        joined = F.concat(F.slice(out, F.lit(1), F.size(out) - 1), F.array(strip(F.concat(last, F.lit(" "), portion))))
        short = (F.length(portion) < least) | (F.length(last) < least)
        return F.when(F.size(out) == 0, F.array(portion)).when(short, joined).otherwise(F.concat(out, F.array(portion)))

    return F.aggregate(portions, F.array().cast("array<string>"), step)


def split_sentence(sentence: Column) -> Column:
    """A sentence's words, split at white space of any kind."""
    return F.filter(F.split(sentence, f"{SPACE}+"), lambda w: w != "")


def sentence_rounds(sentences: DataFrame, seed: int) -> DataFrame:
    """``sentences`` (sentence, portions or null) with the expected order and a shuffled one."""
    given = F.coalesce("portions", split_sentence(F.col("sentence")))
    ordered = sentences.withColumn("expected", merge_short_portions(given))
    keyed = F.transform("expected", lambda p, k: F.struct(_shuffle_key(seed, "sentence", k, p).alias("key"), p.alias("p")))
    return ordered.withColumn("shuffled", F.transform(F.array_sort(keyed), lambda x: x["p"]))


def score_order(selected: Column, expected: Column) -> Column:
    """Whether an ordering is exactly the expected one."""
    return F.coalesce(selected == expected, F.lit(False))
