"""Rounds that are going on: guesses and keystrokes as streams, with the state of every session kept."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from datetime import timedelta
from operator import itemgetter

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.text import normalize
from ..operators.guessing import told
from ..operators.typing import ended, start

IDLE, LATENESS = timedelta(minutes=30), timedelta(minutes=10)
#: What becomes of an input, besides the states of a guess: the round was left unfinished.
LEFT = "left"
#: Groups of sessions: each has one row of state, which its rows of a micro-batch rewrite.
SESSION_BUCKETS = 1024
#: Answers that go back to Spark at once.
ANSWERS = 10_000
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_state_store(spark: SparkSession) -> None:
    """Keep state in RocksDB: it is on the executors' disks, not on their heaps."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


class _Rounds:
    """Rounds of the sessions of one bucket: inputs in the order of ``seq``, each once, and an end after ``idle``.

    The state of a bucket has for each of its open sessions the round's fields, the last seq and the
    time at which the session ends; it comes and goes with the bucket's rows, in one piece.
    """

    #: What an input has besides session, seq and at, and the answer's columns.
    inputs: tuple[str, ...]
    answer: str

    def __init__(self, idle: timedelta) -> None:
        self.idle = int(idle.total_seconds() * 1000)
        self.columns = ("session", "seq", "millis", *self.inputs)
        self.names = ["session", *(f.split(" ")[0] for f in self.answer.split(", "))]

    def opened(self, row: tuple) -> tuple:
        """The fields of a round that ``row`` opens."""
        raise NotImplementedError

    def played(self, fields: tuple, row: tuple) -> tuple[tuple, tuple]:
        """The fields after an input, and the answer to it."""
        raise NotImplementedError

    def left(self, session: object, fields: tuple, seq: int) -> tuple | None:
        """The row of a round that ends by its idle time."""
        raise NotImplementedError

    def __call__(self, key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kept = pickle.loads(state.get[0]) if state.exists else {}  # noqa: S301 - this class wrote it
        now, answers, rows = state.getCurrentWatermarkMs(), [], []
        if not state.hasTimedOut:
            for frame in frames:
                rows += zip(*(frame[c].tolist() for c in self.columns), strict=True)
        rows.sort(key=itemgetter(1))
        for row in rows:
            session, seq, at = row[:3]
            before = kept.get(session)
            if before is not None and seq <= before[1]:
                continue  # played before, or after a later one was answered
            fields, answer = self.played(before[0] if before is not None else self.opened(row), row)
            answers.append(answer)
            kept[session] = fields, seq, max(at + self.idle, before[2] if before is not None else 0)
        for session in [s for s, k in kept.items() if k[2] <= now]:
            fields, seq, _ = kept.pop(session)
            last = self.left(session, fields, seq)
            if last is not None:
                answers.append(last)
        if kept:
            state.update((pickle.dumps(kept, pickle.HIGHEST_PROTOCOL),))
            state.setTimeoutTimestamp(min(k[2] for k in kept.values()) - 1)  # it fires once the watermark is beyond
        elif state.exists:
            state.remove()
        for start in range(0, len(answers), ANSWERS):
            yield pd.DataFrame(answers[start : start + ANSWERS], columns=self.names, dtype=object)


class _Guesses(_Rounds):
    """A round's fields are its turns, whether it was won, and the most attempts."""

    inputs = ("guess", "guess_normalized", "target_id", "target", "max_attempts")
    answer = "seq bigint, guess string, guess_normalized string, target_id string, target string, status string, correct boolean, attempt int, ends boolean"

    def opened(self, row: tuple) -> tuple:
        return 0, False, row[7]

    def played(self, fields: tuple, row: tuple) -> tuple[tuple, tuple]:
        turns, won, most = fields
        session, seq, _, shown, guess, target_id, target, _ = row
        if won or turns >= most:
            status = "finished"
        elif guess is None or len(guess) != len(target):
            status = "rejected"
        else:
            status, turns, won = "scored", turns + 1, guess == target
        scored = status == "scored"
        answer = session, seq, shown, guess, target_id, target, status, scored and won, turns if scored else None, scored and (won or turns >= most)
        return (turns, won, most), answer

    def left(self, session: object, fields: tuple, seq: int) -> tuple | None:
        turns, won, most = fields
        if won or turns >= most:
            return None
        return session, seq, None, None, None, None, LEFT, False, turns, False


class _Keystrokes(_Rounds):
    """A round's fields are its open places, misses, keystrokes that counted, disabled keys and the hidden characters."""

    inputs = ("keystroke", "expected")
    answer = "seq bigint, status string, opened int, disabled_keys array<string>, error_count bigint, rounds bigint, completed boolean"

    def opened(self, row: tuple) -> tuple:
        return 0, 0, 0, (), row[4]

    def played(self, fields: tuple, row: tuple) -> tuple[tuple, tuple]:
        opened, misses, rounds, disabled, expected = fields
        session, seq, _, key, _ = row
        live = opened < len(expected)
        right = live and expected[opened] == key
        if live:
            opened, misses, rounds = opened + right, misses + (not right), rounds + 1
            disabled = disabled if right or key in disabled else (*disabled, key)
        completed = bool(expected) and opened >= len(expected)
        answer = self._answer(session, seq, opened, misses, rounds, disabled, "correct" if right else "wrong" if live else "finished", completed)
        return (opened, misses, rounds, disabled, expected), answer

    def left(self, session: object, fields: tuple, seq: int) -> tuple | None:
        opened, misses, rounds, disabled, expected = fields
        return None if opened >= len(expected) else self._answer(session, seq, opened, misses, rounds, disabled, LEFT, False)

    @staticmethod
    def _answer(session: object, seq: int, opened: int, misses: int, rounds: int, disabled: tuple, status: str, completed: bool) -> tuple:
        return session, seq, status, opened, sorted(disabled, key=lambda x: (x is not None, x)), misses, rounds, completed


def _kind(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def _answered(rows: DataFrame, session: str, rounds: _Rounds) -> DataFrame:
    """The answers of ``rounds`` to a stream of rows (session, seq, at and its inputs)."""
    whole = session in ("tinyint", "smallint", "int", "bigint")  # in pandas these are no numbers of 64 bits beside a null
    own = F.col("session").cast("string") if whole else F.col("session")
    dealt = rows.select(own.alias("session"), F.col("seq").cast("bigint").alias("seq"), F.unix_millis("at").alias("millis"), "at", *rounds.inputs, F.pmod(F.xxhash64("session"), F.lit(SESSION_BUCKETS)).alias("bucket"))
    schema = f"session {'string' if whole else session}, {rounds.answer}"
    answers = dealt.groupBy("bucket").applyInPandasWithState(rounds.__call__, schema, "rounds binary", "append", GroupStateTimeout.EventTimeTimeout)
    return answers.withColumn("session", F.col("session").cast(session))


def live_guesses(guesses: DataFrame, idle: timedelta = IDLE, lateness: timedelta = LATENESS) -> DataFrame:
    """The answer to every guess of a stream, as ``guessing.play`` gives it for guesses that are all there.

    ``guesses`` has session, seq, at (a timestamp of a time zone), guess, target_id, target
    (normalised) and max_attempts. Guesses of a session are taken in the order of ``seq``
    within a micro-batch; one that isn't after the last answered one is a repetition and has no
    answer. Once the watermark (``lateness`` behind the latest guess) is ``idle`` past a
    session's last guess, the session's state goes; a round without an end then gets a last row
    of status LEFT with its number of attempts, and a later guess opens a new round.

    A session's state is some numbers whatever it was sent. Sessions are dealt to SESSION_BUCKETS groups, of
    which each has one row of state; only a bucket's rows of one micro-batch meet in one
    task. Guesses are folded and letters judged outside, by expressions.
    """
    use_state_store(guesses.sparkSession)
    folded = guesses.withColumn("guess_normalized", normalize(F.col("guess"))).withWatermark("at", f"{lateness.total_seconds()} seconds")
    rows = folded.withColumn("max_attempts", F.col("max_attempts").cast("int"))
    return told(_answered(rows, _kind(guesses, "session"), _Guesses(idle)))


def live_keystrokes(keystrokes: DataFrame, idle: timedelta = IDLE, lateness: timedelta = LATENESS) -> DataFrame:
    """The state of a typing session after every keystroke of a stream; its last row is ``typing.play``'s.

    ``keystrokes`` has session, seq, at, keystroke, text, language and hint_level; sessions, order,
    repetitions and idle sessions are as in ``live_guesses``. The rows have ``opened`` (hidden
    places that are open by now), disabled_keys, error_count, rounds, completed, and as status
    what the keystroke was: correct, wrong, finished (it counted for nothing) or LEFT.
    """
    use_state_store(keystrokes.sparkSession)
    expected = F.coalesce(F.array_join("_expected", ""), F.lit(""))  # single characters, which Python tells apart again
    opened = start(keystrokes).withColumn("expected", expected).withWatermark("at", f"{lateness.total_seconds()} seconds")
    return _answered(opened, _kind(keystrokes, "session"), _Keystrokes(idle))


def typed_sessions(answers: DataFrame, sessions: DataFrame) -> DataFrame:
    """``typing.play``'s rows from ``live_keystrokes``' answers: of each session as it was after its last keystroke.

    ``sessions`` has one row (session, text, language, hint_level) for each.
    """
    played = answers.where(F.col("status") != LEFT).groupBy("session").agg(F.max_by(F.struct("opened", "error_count", "rounds", "disabled_keys"), "seq").alias("_end"))
    folded = start(sessions).join(played, "session")
    return ended(folded, F.col("_end.opened"), F.col("_end.error_count"), F.col("_end.rounds"), F.col("_end.disabled_keys"))
