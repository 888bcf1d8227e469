from datetime import datetime

from pyspark.sql import functions as F

from verbarium.operators import guessing, practised, selection, typing
from verbarium.plans import inputs
from verbarium.operators.merge_state import MergedVocabulary
from verbarium.operators.words import merge_words
from verbarium.sources.schemas import WORD, WORD_DDL
from verbarium.sources.words import dictionary_lines_to_words
from verbarium.streaming.live_rounds import live_guesses


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_dictionary_lines_are_parsed_once_and_after_they_are_distinct(spark):
    rows = spark.createDataFrame([("é",), ("é",), ("a",)], "text string").groupBy("text").agg(F.count("*").alias("n"))
    lines = rows.select(F.to_json(F.struct(F.col("text").alias("word"), F.lit("noun").alias("pos"))).alias("line"), F.lit(0).cast("long").alias("_ord"))
    words = dictionary_lines_to_words(lines, "xx", require_accent=True)
    assert [r["text"] for r in words.collect()] == ["é"]
    plan = _plan(words)
    assert plan.count("from_json(") == 2 and "from_json(" not in plan[plan.index("Aggregate") :]


def test_hidden_characters_are_worked_out_once_a_session(spark):
    """A filter on what a round came to doesn't hold the places and characters again."""
    keys = spark.createDataFrame([("s", k, c, "café", "fr", "off") for k, c in enumerate("café")], "session string, seq long, keystroke string, text string, language string, hint_level string")
    done = typing.word_results(typing.play(keys))
    assert done.count() == 1
    assert _plan(done).count("collect_list") == 1 and not any("aggregate(" in line for line in _plan(done).splitlines() if line.lstrip(" +-:").startswith("Filter"))


def test_neighbours_meet_by_beginnings(spark, tmp_path):
    texts = ["a", "b", "abcd", "abce", "abda", "zzzz", "éabc", "été", "abc", "abcd"]
    spark.createDataFrame([(1, " ".join(texts), "fr", "s"), (2, "abcd x", None, "s")], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = inputs.neighbours(spark, str(tmp_path))
    expected = set()
    for lang, words in (("fr", set(texts)), (None, {"abcd", "x"})):
        for size in {len(w) for w in words}:
            same = sorted((w for w in words if len(w) == size), key=lambda w: w.encode())
            expected |= {(a, lang, b) for a, b in zip(same, same[1:])}
    assert {tuple(r) for r in rows.collect()} == expected and rows.count() == len(expected)
    windows = [line for line in _plan(rows).splitlines() if " Window " in line]
    assert all("_begin" in line.split("windowspecdefinition(")[1].split(" ASC")[0] for line in windows)


def test_sessions_of_a_stream_share_the_calls_of_their_bucket(spark, tmp_path):
    """There are no calls for each session, and a session may be any number of 64 bits or none."""
    big = 2**62 + 1
    rows = spark.createDataFrame([(s, 1, datetime(2024, 1, 1), "amor", "Amor", "pt") for s in (big, big + 1, None)], "session long, seq long, at timestamp, guess string, text string, language string")
    guessing.prompts(rows, 3).write.parquet(f"{tmp_path}/in")
    answers = live_guesses(spark.readStream.schema(guessing.prompts(rows, 3).schema).parquet(f"{tmp_path}/in"))
    answers.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start().awaitTermination()
    assert {(r["session"], r["status"], r["correct"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()} == {(s, "scored", True) for s in (big, big + 1, None)}
    assert "bucket" in answers._jdf.queryExecution().analyzed().toString()


def test_stored_bitmaps_end_with_their_last_bit(spark):
    """Few words take few bytes, in the bitmaps of a day and after they are merged."""
    numbers = spark.createDataFrame([("a", 0), ("b", 9), ("c", 32_768 + 80)], "word_id string, number bigint")
    tried = spark.createDataFrame([("u", w, datetime(2024, 1, d)) for d, words in ((1, "ac"), (2, "ab")) for w in words], "user_id string, word_id string, when timestamp_ntz")
    days = practised.daily_bitmaps(tried, numbers)
    size = lambda df: sorted((r["block"], len(r["bits"])) for r in df.collect())
    assert sorted(n for _, n in size(days)) == [1, 1, 2, 10]
    assert sorted(n for _, n in size(practised.merged(days, "user_id"))) == [1, 2, 10]
    assert [r["words"] for r in practised.words_practised(days, "user_id").collect()] == [3]


def test_keyboard_keeps_no_table_of_letters(spark):
    """The letters of a session come together in the order of its rows, without a hash table of sessions and letters."""
    tried = [("s", 1, "omar"), ("s", 2, "roma"), ("t", 1, "zzzz")]
    rows = guessing.prompts(spark.createDataFrame([(*t, "amor", "pt") for t in tried], "session string, seq long, guess string, text string, language string"), 5)
    keys = guessing.keyboard(guessing.play(rows))
    assert ("s", "o", "misplaced") in {tuple(r) for r in keys.collect()} and keys.count() == 5
    assert "Aggregate" not in _plan(keys)


def test_merge_deals_contents_once(spark):
    """Contents are dealt by id and read by both sides; entries aren't dealt."""
    rows = [(k, t, "fr", ["x", "y"]) for k, t in enumerate(["été", "Été", "ete", "mot"])]
    words = spark.createDataFrame(rows, "_ord long, text string, language string, topics array<string>")
    given = [F.col(n) if n in words.columns else (F.create_map() if n == "translations" else F.array() if t.startswith("array") else F.lit(None)).cast(t).alias(n) for n, t in WORD.items()]
    merged = merge_words(words.select(*given))
    assert {r["text"] for r in merged.collect()} == {"été", "mot"}
    plan = merged._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    assert "ReusedExchange" in final and final.count("REPARTITION_BY_COL") >= 1
    assert " _e#" not in "".join(line for line in final.splitlines() if " Exchange " in line)


def test_a_learner_gives_rows_for_few_words_of_a_tier(spark):
    """No row for each jump along a tier, which were sorted and, beside a large table of records, shuffled."""
    pool = spark.range(2000).selectExpr("concat('w', id) AS id", "id AS _ord", "'high' AS frequency")
    record = "user_id string, word_id string, seen_count bigint, error_count bigint, last_seen_at timestamp_ntz, is_useless boolean"
    records = spark.createDataFrame([("a", "w1", 1, 0, datetime(2024, 1, 1), False)], record)
    learners = spark.createDataFrame([("a",), ("b",)], "user_id string")
    drawn = selection.select_for_learners(pool, records, learners, 3, datetime(2024, 3, 1), 1)
    assert "[user_id ASC NULLS FIRST, tier ASC NULLS FIRST, jump" not in _plan(drawn) and ", jump#" not in _plan(drawn)
    rows = drawn.collect()
    assert sorted((r["user_id"], r["rank"]) for r in rows) == [(u, k) for u in "ab" for k in (1, 2, 3)] and len({(r["user_id"], r["id"]) for r in rows}) == 6


def test_a_batch_does_not_rewrite_what_was_merged_before(spark, tmp_path):
    """Two runs of a level become one of the next; till then a batch writes its own contents, and reads nothing."""
    def words(places):
        rows = [{"_ord": k, "text": "cafe" if k % 2 else "café", "language": "fr", "normalized": "", "topics": [f"t{k % 3}"]} for k in places]
        return spark.createDataFrame([tuple(r.get(n, [] if t.startswith("array") else None) for n, t in WORD.items()) for r in rows], WORD_DDL)

    vocabulary, parts = MergedVocabulary(str(tmp_path), 2), [range(k, k + 7) for k in range(0, 35, 7)]
    held = lambda: {str(p.parent.relative_to(tmp_path)) for p in tmp_path.glob("**/_SUCCESS")}
    for batch, places in enumerate(reversed(parts)):
        before = {f: f.stat().st_mtime_ns for f in tmp_path.glob("**/*.parquet")}
        assert vocabulary.add(words(places), batch) and not vocabulary.add(words(places), batch)
        assert all(f.stat().st_mtime_ns == t for f, t in before.items() if f.exists())
        assert spark.read.parquet(f"{tmp_path}/level=0/batch={batch}").count() == 6
    assert held() == {"level=2/batch=3", "level=0/batch=4"}
    assert list(map(repr, vocabulary.read(spark).collect())) == list(map(repr, merge_words(words(range(35))).collect()))
    (tmp_path / "level=0/batch=4/_SUCCESS").unlink()  # a batch that broke off is written over
    assert vocabulary.add(words(range(3)), 4) and spark.read.parquet(f"{tmp_path}/level=0/batch=4").count() == 3
