"""Typing rounds: hidden characters of a word, opened one keystroke at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import characters, normalize, word_id
from ..sources.schemas import HINT_LEVELS

HIDDEN = "_"


def initial_display(text: Column, hint_level: Column) -> Column:
    """The characters shown at first: all, those without accents, or none."""
    # Folding compares its whole table for each character in a lambda, so ASCII passes by.
    plain = lambda c: F.when(c < "\u0080", c).when(normalize(c) == F.lower(c), c).otherwise(HIDDEN)
    chars = characters(text)
    return F.when(hint_level == "show_all", chars).when(hint_level == "show_unaccented", F.transform(chars, plain)).otherwise(F.transform(chars, lambda _: F.lit(HIDDEN)))


def prompts(words: DataFrame) -> DataFrame:
    """``words`` (text, language, glosses, hint_level) with display and gloss texts."""
    known = F.col("hint_level").isin(*HINT_LEVELS)
    level = F.when(known, F.col("hint_level")).otherwise(F.raise_error(F.concat(F.lit("unknown hint level "), F.coalesce("hint_level", F.lit("null")))))
    return words.withColumns({"display": initial_display(F.col("text"), level), "gloss_texts": F.transform("glosses", lambda g: g["text"])})


def start(sessions: DataFrame) -> DataFrame:
    """Rows with text, language and hint_level, and what is shown at first, the hidden places and their characters."""
    shown = sessions.withColumn("_shown", initial_display(F.col("text"), F.col("hint_level")))
    places = F.filter(F.transform("_shown", lambda c, k: F.when(c == HIDDEN, k)), lambda k: k.isNotNull())
    shown = _once(_once(shown, "_shown").withColumn("_places", places), "_places")
    return _once(shown.withColumn("_expected", F.transform("_places", lambda k: F.substring("text", k + 1, F.lit(1)))), "_expected")


def _once(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the column ``name`` worked out once a row.

    The optimiser moves columns into the filters and lambdas that use them, where they would be
    worked out for every keystroke; it doesn't move them over a generator.
    """
    return df.select(*[c for c in df.columns if c != name], F.inline(F.array(F.struct(name))))


def play(keystrokes: DataFrame) -> DataFrame:
    """Outcome of the keystrokes of every session.

    ``keystrokes`` has session, seq, keystroke, text, language and hint_level. The hidden
    places are fixed at the start (a literal underscore counts as hidden); each keystroke is
    compared, as it is, with the character at the first of them still hidden. A miss
    disables its key. The keystroke that opens the last place completes the word, correct if
    there was no miss; keystrokes after that, or with nothing hidden, count for nothing.

    A session's keystrokes are folded in order in one row, as many as a person types.

    Returns one row per session: word_id, display, disabled_keys (sorted), error_count, rounds
    (keystrokes that counted), correct_rounds, completed, correct (null until completed).
    """
    grouped = keystrokes.groupBy("session").agg(F.array_sort(F.collect_list(F.struct("seq", "keystroke"))).alias("_keys"), *[F.min_by(c, "seq").alias(c) for c in ("text", "language", "hint_level")])
    zero = F.struct(F.lit(0).alias("at"), F.lit(0).cast("long").alias("misses"), F.lit(0).cast("long").alias("rounds"), F.array().cast("array<string>").alias("disabled"))

    def step(state: Column, key: Column) -> Column:
        live = state["at"] < F.size("_expected")
        right = live & F.get(F.col("_expected"), state["at"]).eqNullSafe(key["keystroke"])
        miss = live & ~right
        return F.struct(
            (state["at"] + right.cast("int")).alias("at"),
            (state["misses"] + miss.cast("long")).alias("misses"),
            (state["rounds"] + live.cast("long")).alias("rounds"),
            F.when(miss, F.array_union(state["disabled"], F.array(key["keystroke"]))).otherwise(state["disabled"]).alias("disabled"),
        )

    folded = _once(start(grouped).withColumn("_end", F.aggregate("_keys", zero, step)), "_end").drop("_keys")
    return ended(folded, F.col("_end.at"), F.col("_end.misses"), F.col("_end.rounds"), F.col("_end.disabled"))


def ended(sessions: DataFrame, at: Column, misses: Column, rounds: Column, disabled: Column) -> DataFrame:
    """``play``'s rows of sessions that ``start`` opened, of which ``at`` hidden places are open by now."""
    opened = F.slice("_places", F.lit(1), at)
    display = F.transform("_shown", lambda c, k: F.when(F.array_contains(opened, k), F.substring("text", k + 1, F.lit(1))).otherwise(c))
    completed = (F.size("_places") > 0) & (at >= F.size("_places"))
    return sessions.select(
        "session",
        word_id(F.col("text"), F.col("language")).alias("word_id"),
        display.alias("display"),
        F.array_sort(disabled).alias("disabled_keys"),
        misses.alias("error_count"),
        rounds.alias("rounds"),
        at.cast("long").alias("correct_rounds"),
        completed.alias("completed"),
        F.when(completed, misses == 0).alias("correct"),
    )


def word_results(played: DataFrame) -> DataFrame:
    """(session, word_id, correct) of sessions whose word was completed."""
    return played.where("completed").select("session", "word_id", "correct")
