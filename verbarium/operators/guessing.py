"""Guessing rounds: letters of a guess against a hidden word, sessions and keyboards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import characters, normalize, word_id
from ..sources.schemas import LETTER_STATES

#: Lengths offered to players, and the first choice.
WORD_LENGTHS, DEFAULT_LENGTH = (4, 5, 6, 7), 5
# What a player is told; the length and the guess come between the parts.
FINISHED, WRONG_LENGTH, WRONG_GUESS = "Game already finished.", ("Guess must be ", " letters."), ("'", "' is not the word.")


def evaluate(guess: Column, target: Column) -> Column:
    """Array of (letter, state) of a guess against a target of equal length.

    A letter in its place is correct. The k-th other occurrence of a letter, from the left,
    is misplaced if the target has at least k of it that were not guessed in place.
    """
    g, t = characters(guess), characters(target)
    places = F.sequence(F.lit(1), F.greatest(F.size(g), F.lit(1)))
    pairs = F.transform(F.filter(places, lambda i: i <= F.size(g)), lambda i: F.struct(i.alias("i"), F.get(g, i - 1).alias("g"), F.get(t, i - 1).alias("t")))

    def judged(all_pairs: Column) -> Column:
        open_ = F.filter(all_pairs, lambda p: p["g"] != p["t"])
        rank = lambda p: F.size(F.filter(open_, lambda q: (q["i"] <= p["i"]) & (q["g"] == p["g"])))
        free = lambda p: F.size(F.filter(open_, lambda q: q["t"] == p["g"]))
        state = lambda p: F.when(p["g"] == p["t"], "correct").when(rank(p) <= free(p), "misplaced").otherwise("wrong")
        return F.transform(all_pairs, lambda p: F.struct(p["g"].alias("letter"), state(p).alias("state")))

    return F.get(F.transform(F.array(pairs), judged), 0)


def prompts(targets: DataFrame, max_attempts: int | None = None) -> DataFrame:
    """``targets`` (text, language) with target_id, target, word_length and max_attempts."""
    target = normalize(F.col("text"))
    attempts = F.length(target) + 1 if max_attempts is None else F.lit(max_attempts)
    return targets.withColumns({"target_id": word_id(F.col("text"), F.col("language")), "target": target, "word_length": F.length(target), "max_attempts": attempts})


def offered(words: DataFrame, lengths: Sequence[int] = WORD_LENGTHS) -> DataFrame:
    """Words of a length that is offered to players; rounds themselves take any."""
    return words.where(F.length(normalize(F.col("text"))).isin(list(lengths)))


def play(guesses: DataFrame) -> DataFrame:
    """Outcome of every guess of every session.

    ``guesses`` has session, seq, guess, target_id, target (normalised) and max_attempts.
    A guess of another length is ``rejected`` and uses no attempt; one after a win or the
    last attempt is ``finished``. Others are ``scored``: ``attempt`` counts them, and
    ``ends`` marks the win or last attempt, whose correctness is the word's result.
    """
    folded = guesses.withColumn("guess_normalized", normalize(F.col("guess")))
    fits = F.length("guess_normalized") == F.length("target")
    so_far = W.partitionBy("session").orderBy("seq").rowsBetween(W.unboundedPreceding, W.currentRow)
    earlier = W.partitionBy("session").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)
    hit = fits & (F.col("guess_normalized") == F.col("target"))
    # Guesses that fit count in order, whether or not the session has ended by then.
    counted = folded.withColumns({"_fits": fits, "_hit": hit}).withColumns(
        {
            "_before": F.coalesce(F.count_if("_fits").over(earlier), F.lit(0)),
            "_won": F.coalesce(F.max("_hit").over(earlier), F.lit(False)),
            "_turn": F.count_if("_fits").over(so_far),
        }
    )
    over = F.col("_won") | (F.col("_before") >= F.col("max_attempts"))
    status = F.when(over, "finished").when(~F.col("_fits"), "rejected").otherwise("scored")
    scored = F.col("status") == "scored"
    out = counted.withColumn("status", status).withColumn("correct", scored & F.col("_hit"))
    out = out.withColumn("attempt", F.when(scored, F.col("_turn")))
    out = out.withColumn("ends", scored & (F.col("_hit") | (F.col("_turn") >= F.col("max_attempts"))))
    return told(out).drop("_fits", "_hit", "_before", "_won", "_turn")


def told(answers: DataFrame) -> DataFrame:
    """Answers to guesses (status, correct, guess, guess_normalized, target) with what a player is told: ``feedback`` and ``letters``."""
    scored = F.col("status") == "scored"
    feedback = F.when(F.col("status") == "finished", FINISHED).when(F.col("status") == "rejected", F.concat(F.lit(WRONG_LENGTH[0]), F.length("target").cast("string"), F.lit(WRONG_LENGTH[1])))
    feedback = feedback.when(scored & ~F.col("correct"), F.concat(F.lit(WRONG_GUESS[0]), "guess", F.lit(WRONG_GUESS[1])))
    results = F.when(scored, evaluate(F.col("guess_normalized"), F.col("target")))
    return answers.withColumns({"feedback": feedback, "letters": results})


def keyboard(played: DataFrame) -> DataFrame:
    """(session, letter, state): the best state of each letter over a session's scored guesses."""
    # A session's letters come together in one row, as many as its attempts have: a table of all sessions' letters needs no place.
    scored = played.where("status = 'scored'")
    whole = W.partitionBy("session").orderBy("seq").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    turn = F.row_number().over(W.partitionBy("session").orderBy("seq"))
    rounds = scored.select("session", F.collect_list("letters").over(whole).alias("_all"), turn.alias("_turn")).where("_turn = 1")
    all_letters = rounds.select("session", F.flatten("_all").alias("_all"))
    ranks = F.array(*[F.lit(s) for s in LETTER_STATES])
    rank = lambda x: F.array_position(ranks, x["state"]).cast("int")
    best = lambda c: F.array_max(F.transform(F.filter("_all", lambda x: x["letter"] == c), rank))
    distinct = F.array_distinct(F.transform("_all", lambda x: x["letter"]))
    return all_letters.select("session", F.inline(F.transform(distinct, lambda c: F.struct(c.alias("letter"), F.element_at(ranks, best(c)).alias("state")))))


def word_results(played: DataFrame) -> DataFrame:
    """(session, word_id, correct) of sessions that ended."""
    return played.where("ends").select("session", F.col("target_id").alias("word_id"), "correct")
