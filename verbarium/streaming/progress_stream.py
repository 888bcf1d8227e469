"""Progress counters over a stream of attempts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.progress import progress_by_exercise, progress_totals


def stream_progress(attempts: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, by_exercise: bool = False) -> StreamingQuery:
    """Keep the counters of a stream of attempts; ``sink`` gets the changed rows of each batch.

    The state has one row per user and word (and exercise type). ``sink`` may see a batch
    twice after a failure, so it should write by (batch, key). Runs until the attempts that
    are there now are counted.
    """
    counted = progress_by_exercise(attempts) if by_exercise else progress_totals(attempts)
    return counted.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(changes: DataFrame, *keys: str) -> DataFrame:
    """The last state of each key, from changed rows that carry their ``batch``."""
    values = [c for c in changes.columns if c not in (*keys, "batch")]
    return changes.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_v")).select(*keys, "_v.*")


def _timed(attempts: DataFrame, lateness: str) -> DataFrame:
    return attempts.withColumn("at", F.to_timestamp(F.col("when").cast("string"))).withWatermark("at", lateness)


def _by_session(timed: DataFrame, gap: str) -> DataFrame:
    return timed.groupBy("user_id", F.session_window("at", gap)).agg(F.count("*").alias("attempts"), F.count_if(F.col("correct")).alias("correct_attempts"))


def practice_sessions(attempts: DataFrame, gap: str = "30 minutes", lateness: str = "1 hour") -> DataFrame:
    """Attempts by user in sessions without a pause over ``gap``; an addition of this engine.

    Works on batches and streams; events over ``lateness`` behind the latest are dropped in
    a stream. The watermark needs a timestamp of a time zone, so ``when`` is read as UTC.
    """
    return _by_session(_timed(attempts, lateness), gap)


def live_sessions(attempts: DataFrame, gap: str = "30 minutes", lateness: str = "1 hour") -> DataFrame:
    """``practice_sessions`` of a stream that may send an attempt again: a session's row comes once, when nothing can change it.

    ``attempts`` has user_id, _ord, when and correct. Repetitions (same user_id and ``_ord``) are dropped; the
    state of an attempt is kept for ``lateness``, beyond which a repetition is late by itself. Late attempts, over
    ``lateness`` behind the latest one of earlier micro-batches, are in no session: ``late_attempts`` counts them.
    An attempt without a time is in no session and isn't counted. For output in append mode.
    """
    fresh = _timed(attempts.where("when is not null"), lateness).dropDuplicatesWithinWatermark(["user_id", "_ord"])
    return _by_session(fresh, gap)


def late_attempts(query: StreamingQuery) -> int:
    """Rows, repetitions too, that ``live_sessions`` left out as late in the micro-batches that ``query`` still tells of.

    These are the last ``spark.sql.streaming.numRecentProgressUpdates``; add up the numbers of a query's runs.
    """
    states = [state for progress in query.recentProgress for state in progress["stateOperators"]]
    return sum(state["numRowsDroppedByWatermark"] for state in states if state["operatorName"] == "dedupeWithinWatermark")
