from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from verbarium.operators.progress import Weights, hash_uniform, progress, select_words, weight
from verbarium.sources.schemas import ATTEMPT_DDL
from verbarium.streaming.progress_stream import latest, practice_sessions, stream_progress

NOW = datetime(2024, 1, 1)


def attempts(spark, rows):
    return spark.createDataFrame([("u", "w", *r, k) for k, r in enumerate(rows)], ATTEMPT_DDL)


def test_counters(spark):
    rows = attempts(spark, [("wordle", True, NOW), ("wordle", False, NOW - timedelta(days=1)), (None, True, None)])
    row = progress(rows).first()
    assert (row["seen_count"], row["correct_count"], row["error_count"], row["last_seen_at"]) == (3, 2, 1, None)
    assert {k: tuple(v) for k, v in row["exercise_stats"].items()} == {"wordle": (2, 1, 1, NOW - timedelta(days=1))}
    assert progress(attempts(spark, [(None, True, NOW)])).first()["exercise_stats"] == {}
    assert progress(attempts(spark, [])).count() == 0


@settings(max_examples=5, deadline=None)
@given(st.lists(st.booleans(), min_size=1, max_size=20))
def test_seen_is_correct_and_errors(spark, results):
    row = progress(attempts(spark, [(None, r, NOW) for r in results])).first()
    assert row["seen_count"] == row["correct_count"] + row["error_count"] == len(results)


def weigh(spark, frequency=None, seen=None, errors=None, last=None, useless=None, knobs=Weights()):
    df = spark.createDataFrame([(frequency, seen, errors, last, useless)], "frequency string, seen_count long, error_count long, last_seen_at timestamp_ntz, is_useless boolean")
    return df.select(weight(NOW, knobs)).first()[0]


def test_weight(spark):
    assert weigh(spark) == 5.0 and weigh(spark, seen=3, errors=2) == 7.0 and weigh(spark, "high") == 6.0 and weigh(spark, "other") == 5.0
    assert weigh(spark, useless=True) == 0.0 and weigh(spark, seen=1, errors=0, last=NOW + timedelta(hours=1)) == 0.0
    assert weigh(spark, seen=1, errors=0, last=NOW - timedelta(hours=1)) == pytest.approx(0.5)
    assert weigh(spark, seen=0, errors=0, last=NOW - timedelta(hours=2)) == pytest.approx(5 * 0.75)
    with pytest.raises(ZeroDivisionError):
        weigh(spark, knobs=Weights(recency_half_life_seconds=0))


def test_selection(spark):
    pool = spark.createDataFrame([(k, f"w{k}", float(k % 3)) for k in range(30)], "_ord long, id string, weight double")
    drawn = select_words(pool, 10, hash_uniform(1, "id", "_ord")).collect()
    assert len({r["id"] for r in drawn}) == 10 and all(r["weight"] > 0 for r in drawn)
    assert len(select_words(pool, 99).collect()) == 20 and select_words(pool, 0).count() == 0 and select_words(pool, -1).count() == 0


def test_selection_follows_weights(spark):
    trials = spark.range(4000).select(F.col("id").alias("trial")).withColumn("w", F.explode(F.array(*[F.lit(x) for x in (1.0, 2.0, 5.0)])))
    keyed = trials.withColumn("k", -F.ln(hash_uniform(3, "trial", "w")) / F.col("w"))
    order = keyed.groupBy("trial").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "w"))), lambda x: x["w"]).alias("o"))
    share = {tuple(r["o"][:2]): r["n"] / 4000 for r in order.groupBy("o").agg(F.count("*").alias("n")).collect()}
    assert share[5.0, 2.0] == pytest.approx(5 / 8 * 2 / 3, abs=0.03) and share[1.0, 2.0] == pytest.approx(1 / 8 * 2 / 7, abs=0.02)


def test_stream(spark, tmp_path):
    rows = attempts(spark, [("wordle", True, NOW), (None, False, NOW + timedelta(minutes=50))])
    rows.write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(ATTEMPT_DDL).parquet(str(tmp_path / "in"))
    query = stream_progress(source, lambda df, k: df.write.mode("overwrite").parquet(str(tmp_path / f"out/batch={k}")), str(tmp_path / "state"))
    query.awaitTermination()
    row = latest(spark.read.parquet(str(tmp_path / "out")), "user_id", "word_id").first()
    assert (row["seen_count"], row["error_count"], row["last_seen_at"]) == (2, 1, NOW + timedelta(minutes=50))
    assert practice_sessions(rows).count() == 2
