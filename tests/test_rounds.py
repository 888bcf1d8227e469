from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from verbarium.operators import guessing, matching, sessions, typing


@pytest.mark.parametrize(("guess", "target", "states"), [("omar", "amor", "mcmc"), ("aabb", "abab", "cmmc"), ("eeee", "abec", "wwcw"), ("", "", ""), ("llama", "allee", "mcmww")])
def test_evaluate(spark, guess, target, states):
    row = spark.createDataFrame([(guess, target)], "g string, t string").select(guessing.evaluate(F.col("g"), F.col("t")).alias("x")).first()
    assert "".join(x["state"][0] for x in row["x"]) == states and "".join(x["letter"] for x in row["x"]) == guess


def played(spark, guesses, limit=3, text="Amor"):
    rows = spark.createDataFrame([("s", k, g, text, "pt") for k, g in enumerate(guesses)], "session string, seq long, guess string, text string, language string")
    return guessing.play(guessing.prompts(rows, limit)).orderBy("seq")


def test_guessing_session(spark):
    rows = played(spark, ["am", "omar", "ÁMOR", "roma"]).collect()
    assert [r["status"] for r in rows] == ["rejected", "scored", "scored", "finished"]
    assert [(r["correct"], r["attempt"], r["ends"]) for r in rows[1:3]] == [(False, 1, False), (True, 2, True)]
    assert rows[0]["feedback"] == "Guess must be 4 letters."
    assert guessing.word_results(played(spark, ["omar"], 1)).first()["correct"] is False
    assert [r["status"] for r in played(spark, ["omar", "amor"], 1).collect()] == ["scored", "finished"]
    assert guessing.prompts(spark.createDataFrame([("Amor", "pt")], "text string, language string")).first()["max_attempts"] == 5


def test_keyboard(spark):
    keys = {r["letter"]: r["state"] for r in guessing.keyboard(played(spark, ["omar", "amxx"])).collect()}
    assert keys == {"o": "misplaced", "m": "correct", "a": "correct", "r": "correct", "x": "wrong"}


def typed(spark, text, keys, hint="off"):
    rows = [("s", k, c, text, "fr", hint) for k, c in enumerate(keys)]
    return typing.play(spark.createDataFrame(rows, "session string, seq long, keystroke string, text string, language string, hint_level string")).first()


def test_typing(spark):
    row = typed(spark, "café", "czafé!")
    assert (row["display"], row["disabled_keys"], row["error_count"], row["rounds"], row["completed"], row["correct"]) == (list("café"), ["z"], 1, 5, True, False)
    row = typed(spark, "café", "é", "show_unaccented")
    assert (row["completed"], row["correct"], row["rounds"]) == (True, True, 1)
    row = typed(spark, "café", "x", "show_all")
    assert (row["completed"], row["rounds"], row["correct"]) == (False, 0, None)
    assert typed(spark, "café", "ce")["display"] == ["c", "_", "_", "_"]


def test_matching(spark):
    words = spark.createDataFrame([(1, 0, "amor", "pt", {"en": "love"}), (1, 1, "paz", "pt", {"en": "peace"}), (1, 2, "amor", "pt", {"en": "passion"})], "round int, _ord long, text string, language string, translations map<string,string>")
    paired = matching.pairs(words, "en")
    taps = spark.createDataFrame([(1, "amor", "passion"), (1, "amor", "love"), (1, "none", None), (1, "none", "x")], "round int, left string, right string")
    got = {(r["left"], r["right"]): (r["correct"], r["word_id"] is None) for r in matching.score_taps(taps, paired).collect()}
    assert got == {("amor", "passion"): (True, False), ("amor", "love"): (False, False), ("none", None): (True, True), ("none", "x"): (False, True)}
    shown = matching.columns_shown(paired, 3).first()
    assert shown["left_words"] == ["amor", "paz"] and sorted(shown["right_words"]) == ["passion", "peace"]
    with pytest.raises(Exception, match="no translation into de"):
        matching.pairs(words, "de").collect()


def test_portions(spark):
    rows = spark.createDataFrame([(["hi", "there", "is", "world"],), (["a"],), ([],), (["abc", "def"],)], "p array<string>")
    assert [r[0] for r in rows.select(matching.merge_short_portions(F.col("p"))).collect()] == [["hi there is", "world"], ["a"], [], ["abc", "def"]]
    rounds = matching.sentence_rounds(spark.createDataFrame([("one two three", None), ("x", [])], "sentence string, portions array<string>"), 5)
    first, second = rounds.collect()
    assert first["expected"] == ["one", "two", "three"] and sorted(first["shuffled"]) == sorted(first["expected"]) and second["expected"] == []
    assert rounds.select(matching.score_order(F.reverse("expected"), F.col("expected"))).first()[0] is False


def test_sessions(spark):
    turns = spark.createDataFrame([("s", 0, "tutor", "hi", None), ("s", 1, "user", "oi", None), ("s", 2, "tutor", "bem", " "), ("s", 3, "user", "a", None), ("s", 4, "tutor", "b", "fix")], "session string, turn int, role string, content string, correction string")
    assert [(r["turn"], r["history_length"], r["correct"]) for r in sessions.tutor_turns(turns).orderBy("turn").collect()] == [(1, 2, True), (3, 4, False)]
    at = datetime(2024, 1, 1)
    rounds = spark.createDataFrame([("s", "wordle", True, "b", at, at), ("s", "wordle", False, "a", at + timedelta(seconds=3), at), ("s", "wordle", True, None, at, at)], "session string, exercise_type string, correct boolean, word_id string, at timestamp_ntz, started_at timestamp_ntz")
    row = sessions.session_summary(rounds).first()
    assert (row["total_rounds"], row["correct_rounds"], row["words_practiced"], row["duration_seconds"]) == (3, 2, ["a", "b"], 3.0)


def test_users(spark):
    rows = spark.createDataFrame([("1", "a", "n", 0), ("2", "a", "m", 1), ("1", "a", "o", 2)], "id string, email string, name string, _ord long")
    users = sessions.upsert_users(rows)
    assert sorted(tuple(r) for r in users.collect()) == [("1", "a", "o", 0), ("2", "a", "m", 1)]
    assert sessions.user_by_email(users, "a").first()["id"] == "1" and sessions.delete_user(users, "1").count() == 1
