import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from verbarium.operators.practised import WordNumbers, daily_bitmaps, merged, stored_practice, words_practised
from verbarium.sources.schemas import ATTEMPT_DDL
from verbarium.streaming.progress_stream import late_attempts, live_sessions

NOW = datetime(2024, 1, 1)


def attempts(spark, rows):
    return spark.createDataFrame([(u, w, None, True, at, k) for k, (u, w, at) in enumerate(rows)], ATTEMPT_DDL)


def test_numbers_are_dense_and_stay(spark, tmp_path):
    numbers, words = WordNumbers(str(tmp_path), 4), lambda *ids: spark.createDataFrame([(w,) for w in ids], "word_id string")
    assert numbers.read(spark).count() == 0
    assert numbers.add(words("d", "b", None, "b", "a"), 0)
    first = dict(map(tuple, numbers.read(spark).collect()))
    assert first == {"a": 0, "b": 1, "d": 2}
    assert not numbers.add(words("z"), 0) and numbers.add(words("c", "a"), 1) and numbers.add(words(), 2)
    many = spark.range(2000).select(F.format_string("w%05d", "id").alias("word_id"))
    assert numbers.add(many.repartition(7), 3)
    last = dict(map(tuple, numbers.read(spark).collect()))
    assert first.items() <= last.items() and last["c"] == 3 and sorted(last.values()) == list(range(2004))
    assert [last[f"w{k:05}"] for k in (0, 1, 1999)] == [4, 5, 2003]


def test_bitmaps_merge_from_any_cut(spark, tmp_path):
    rng = random.Random(1)
    rows = [(f"u{rng.randrange(4)}", f"w{rng.randrange(40)}", NOW + timedelta(hours=rng.randrange(400))) for _ in range(600)]
    rows += [("u0", None, NOW), ("u0", "w1", None), (None, "w1", NOW), ("u9", "unknown", NOW)]
    # Numbers far apart, at the ends of blocks too.
    places = [0, 1, 32767, 32768, 65535, 65536, 10**12]
    numbers = spark.createDataFrame([(f"w{k}", places[k] if k < len(places) else 100 + k) for k in range(40)], "word_id string, number long")
    table, every = stored_practice(str(tmp_path), 3), attempts(spark, rows)
    for batch, cut in enumerate((rows[:1], rows[1:300], rows[200:])):  # the middle comes twice
        assert table.apply(daily_bitmaps(attempts(spark, cut), numbers), batch)
    assert not table.apply(daily_bitmaps(every, numbers), 2)
    known = {(u, w, at.date()) for u, w, at in rows if u and at and w in {f"w{k}" for k in range(40)}}
    expected = lambda key: {k: len({x[1] for x in known if key(x) == k}) for k in {key(x) for x in known}}
    days = table.read(spark)
    assert {r["user_id"]: r["words"] for r in words_practised(days, "user_id").collect()} == expected(lambda x: x[0])
    assert {r["day"]: r["words"] for r in words_practised(days, "day").collect()} == expected(lambda x: x[2])
    assert {(r["user_id"], r["day"]): r["words"] for r in words_practised(days, "user_id", "day").collect()} == expected(lambda x: (x[0], x[2]))
    assert sorted(merged(days).collect()) == sorted(merged(daily_bitmaps(every, numbers)).collect())
    assert words_practised(daily_bitmaps(every.where("false"), numbers), "user_id").count() == 0


def test_sessions_of_a_stream(spark, tmp_path):
    ddl = "user_id string, _ord long, when timestamp_ntz, correct boolean"
    at = lambda user, key, minute, correct=True: (user, key, None if minute is None else NOW + timedelta(minutes=minute), correct)
    batches = [
        [at("a", 1, 0), at("a", 1, 0), at("a", 2, 20, False), at("b", 3, 5), at("a", 9, None)],
        [at("a", 2, 20, False), at("a", 4, 40), at("b", 5, 100), at("b", 3, 5)],  # repeated within the lateness
        [at("b", 6, 39), at("b", 7, 41), at("b", 3, 5), at("a", 8, 400), at("a", 1, 0)],  # 60 minutes behind 100 is late
        [at("a", 10, 1000)],
    ]
    late = []
    for batch in batches:
        spark.createDataFrame(batch, ddl).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema(spark.createDataFrame([], ddl).schema).parquet(str(tmp_path / "in"))
        writer = live_sessions(source).writeStream.format("parquet").outputMode("append").option("path", str(tmp_path / "out"))
        query = writer.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        query.awaitTermination()
        late.append(late_attempts(query))
    assert late == [0, 0, 3, 0]
    rows = spark.read.parquet(str(tmp_path / "out")).select("user_id", F.col("session_window.start").cast("timestamp_ntz"), F.col("session_window.end").cast("timestamp_ntz"), "attempts", "correct_attempts")
    begun = lambda minute: NOW + timedelta(minutes=minute)
    assert sorted(tuple(r) for r in rows.collect()) == [
        ("a", begun(0), begun(70), 3, 2),
        ("a", begun(400), begun(430), 1, 1),
        ("b", begun(5), begun(35), 1, 1),
        ("b", begun(41), begun(71), 1, 1),
        ("b", begun(100), begun(130), 1, 1),
    ]
