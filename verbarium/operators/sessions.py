"""Session summaries, tutor conversations and the user table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import strip
from ..stored import BUCKETS, StoredTable


def session_summary(rounds: DataFrame) -> DataFrame:
    """Totals of every session.

    ``rounds`` has session, exercise_type, correct, word_id (null without a result), at
    (timestamp) and started_at; rejected inputs are not among them. Words are distinct and
    sorted; the duration runs from the start, or the first round, to the last round.
    """
    grouped = rounds.groupBy("session").agg(
        F.min_by("exercise_type", "at").alias("exercise_type"),
        F.count("*").alias("total_rounds"),
        F.count_if(F.col("correct")).alias("correct_rounds"),
        F.array_sort(F.collect_set("word_id")).alias("words_practiced"),
        F.least(F.min("started_at"), F.min("at")).alias("_start"),
        F.max("at").alias("_end"),
    )
    seconds = F.timestamp_diff("MICROSECOND", F.col("_start"), F.col("_end")) / 1e6
    return grouped.withColumn("duration_seconds", F.coalesce(seconds, F.lit(0.0))).drop("_start", "_end")


def tutor_turns(turns: DataFrame) -> DataFrame:
    """Scored user turns of tutor conversations.

    ``turns`` has session, turn, role (user or tutor), content, correction. Every user turn is
    answered by the session's next turn: it is correct if that has no correction but white
    space, and ``history_length`` counts the turns that the tutor saw, this one included. A
    user turn without an answer is not scored.
    """
    order = W.partitionBy("session").orderBy("turn")
    following = turns.withColumns({"_role": F.lead("role").over(order), "_correction": F.lead("correction").over(order), "history_length": F.row_number().over(order)})
    answered = following.where("role = 'user' and _role = 'tutor'")
    correct = F.coalesce(strip(F.col("_correction")), F.lit("")) == ""
    return answered.select("session", "turn", F.col("history_length").cast("long").alias("history_length"), correct.alias("correct"), F.col("_correction").alias("feedback"))


def upsert_users(users: DataFrame) -> DataFrame:
    """One row per user id: the last record, in the order of first arrivals (``first_ord``).

    ``users`` has id, email, name and _ord.
    """
    return users.groupBy("id").agg(F.max_by("email", "_ord").alias("email"), F.max_by("name", "_ord").alias("name"), F.min("_ord").alias("first_ord"))


def user_records(users: DataFrame) -> DataFrame:
    """``users`` (id, email, name, _ord) as rows of a stored table: the last record and the first arrival of each id."""
    last = F.max(F.struct(F.col("_ord").alias("at"), "email", "name")).alias("last")
    return users.groupBy("id").agg(last, F.min("_ord").alias("first_ord"))


def combine_users(rows: DataFrame) -> DataFrame:
    """One row per id of records that several batches have of it."""
    return rows.groupBy("id").agg(F.max("last").alias("last"), F.min("first_ord").alias("first_ord"))


def stored_users(path: str, buckets: int = BUCKETS) -> StoredTable:
    """Users that are kept below ``path``: ``apply`` takes ``user_records`` of a numbered batch, once."""
    return StoredTable(path, ("id",), combine_users, buckets)


def users_of(rows: DataFrame) -> DataFrame:
    """``upsert_users``' rows from stored ones."""
    return rows.select("id", "last.email", "last.name", "first_ord")


def user_by_email(users: DataFrame, email: str) -> DataFrame:
    """The earliest user of ``upsert_users`` with this email, or no row."""
    return users.where(F.col("email") == email).orderBy("first_ord").limit(1)


def delete_user(users: DataFrame, user_id: str) -> DataFrame:
    """The users without one id."""
    return users.where(~F.col("id").eqNullSafe(F.lit(user_id)))
