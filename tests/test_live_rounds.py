from datetime import datetime, timedelta

from pyspark.sql import functions as F

from verbarium.operators import guessing, typing
from verbarium.streaming.live_rounds import LEFT, live_guesses, live_keystrokes, typed_sessions

NOON = datetime(2024, 1, 1, 12)
GUESS = "session string, seq long, at timestamp, guess string, text string, language string"
KEY = "session string, seq long, at timestamp, keystroke string, text string, language string, hint_level string"


def at(minute):
    return NOON + timedelta(minutes=minute)


def streamed(spark, folder, batches, live):
    """The answers to batches that come one by one; the query starts anew from its checkpoint for each."""
    for rows in batches:
        rows.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        query = live(spark.readStream.schema(rows.schema).parquet(f"{folder}/in")).writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state")
        query.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def test_guesses(spark, tmp_path):
    def batch(*rows):
        return guessing.prompts(spark.createDataFrame(list(rows), GUESS), 3)

    def guess(session, seq, minute, word):
        return session, seq, at(minute), word, "Amor", "pt"

    first = batch(guess("a", 2, 1, "omar"), guess("a", 1, 0, "am"), guess("b", 1, 0, "ÁMOR"), guess("c", 1, 0, "roma"), guess("e", 1, 0, None))
    # A repetition, one that comes after its successor, the end of a, one too many; b is finished.
    second = batch(guess("a", 2, 1, "omar"), guess("a", 0, 2, "amor"), guess("a", 3, 3, "rima"), guess("a", 4, 3, "mora"), guess("a", 5, 4, "amor"), guess("b", 2, 4, "amor"), guess("d", 1, 4, "mora"))
    # By now all but z have been idle for long: rounds without an end are left, and c may begin anew.
    third = batch(guess("c", 1, 90, "amor"), guess("z", 1, 90, "amor"))
    fourth = batch(guess("z", 2, 200, "amor"), guess("c", 7, 200, "amor"), guess("d", 9, 5, "amor"))
    answers = streamed(spark, tmp_path, [first, second, third, fourth], lambda df: live_guesses(df, timedelta(minutes=20), timedelta(minutes=10)))
    rows = [((r["session"], r["seq"], r["status"]), (r["correct"], r["attempt"], r["ends"])) for r in answers.collect()]
    got = dict(rows)
    assert len(rows) == len(got) and got == {
        ("a", 1, "rejected"): (False, None, False), ("a", 2, "scored"): (False, 1, False), ("a", 3, "scored"): (False, 2, False), ("a", 4, "scored"): (False, 3, True), ("a", 5, "finished"): (False, None, False),
        ("b", 1, "scored"): (True, 1, True), ("b", 2, "finished"): (False, None, False),
        ("c", 1, "scored"): (False, 1, False), ("c", 1, LEFT): (False, 1, False), ("c", 7, "scored"): (True, 1, True),
        ("d", 1, "scored"): (False, 1, False), ("d", 1, LEFT): (False, 1, False),
        ("e", 1, "rejected"): (False, None, False), ("e", 1, LEFT): (False, 0, False),
        ("z", 1, "scored"): (True, 1, True), ("z", 2, "finished"): (False, None, False),
    }
    told = {(r["session"], r["seq"]): (r["feedback"], r["letters"] and len(r["letters"])) for r in answers.where(F.col("session") == "a").collect()}
    assert told["a", 1] == ("Guess must be 4 letters.", None) and told["a", 3] == ("'rima' is not the word.", 4)


def test_keystrokes_are_the_batch_rows(spark, tmp_path):
    words = [("s1", "café", "czafé!", "off"), ("s2", "café", "é", "show_unaccented"), ("s3", "café", "x", "show_all"), ("s4", "naïve", "nxx", "off")]
    rows = [(s, k, at(k), c, text, "fr", hint) for s, text, keys, hint in words for k, c in enumerate(keys)]
    table = spark.createDataFrame(rows, KEY)
    batches = [table.where("seq < 2"), table.where("seq < 3"), table.where("seq >= 3")]
    answers = streamed(spark, tmp_path, batches, live_keystrokes)
    sessions = table.where("seq = 0").select("session", "text", "language", "hint_level")
    assert sorted(typed_sessions(answers, sessions).collect()) == sorted(typing.play(table).collect())
    assert answers.count() == len(rows)
    status = {(r["session"], r["seq"]): r["status"] for r in answers.collect()}
    assert status["s1", 0] == "correct" and status["s1", 1] == "wrong" and status["s1", 5] == "finished" and status["s3", 0] == "finished"
