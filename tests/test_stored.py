import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from verbarium.operators import sessions
from verbarium.operators.merge_state import MergedVocabulary
from verbarium.operators.progress import counted, progress_totals, stored_progress, totals_of
from verbarium.operators.words import merge_words
from verbarium.sources.schemas import ATTEMPT_DDL, WORD, WORD_DDL

NOW = datetime(2024, 1, 1)


def attempts(spark, rows):
    return spark.createDataFrame([(u, w, None, c, NOW + timedelta(hours=k), k) for k, u, w, c in rows], ATTEMPT_DDL)


def test_batches_touch_their_buckets_only(spark, tmp_path):
    table = stored_progress(str(tmp_path), 16)
    first = attempts(spark, [(k, f"u{k}", "w", k % 2 == 0) for k in range(60)])
    assert table.read(spark) is None and table.last_batch(spark) is None
    assert table.apply(counted(first), 1)
    before = table.parts(spark)
    assert set(before.values()) == {1} and len(before) > 8
    second = attempts(spark, [(100, "u7", "w", True), (90, "new", "v", False)])
    assert table.apply(counted(second), 2)
    after = table.parts(spark)
    touched = {b for b, held in after.items() if held == 2}
    assert 1 <= len(touched) <= 2 and all(after[b] == 1 for b in before if b not in touched)
    written = {d for d in os.listdir(tmp_path / "data/batch=2") if d.startswith("bucket=")}
    assert written == {f"bucket={b}" for b in touched}
    assert not {f for f in table.read(spark).inputFiles() if "batch=1" in f and f.split("bucket=")[1].split("/")[0] in {str(b) for b in touched}}
    assert sorted(totals_of(table.read(spark)).collect()) == sorted(progress_totals(first.union(second)).collect())
    assert sorted(totals_of(table.read(spark, 1)).collect()) == sorted(progress_totals(first).collect())


def test_repeated_and_broken_batches(spark, tmp_path):
    table = stored_progress(str(tmp_path), 4)
    rows = [attempts(spark, [(k, "u", f"w{k % 3}", True) for k in range(low, low + 5)]) for low in (0, 5, 10)]
    table.apply(counted(rows[0]), 1)
    # A batch that broke off before its commit has left files behind.
    counted(rows[2]).withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(f"{tmp_path}/data/batch=2")
    os.makedirs(tmp_path / "parts/batch=2")
    assert table.last_batch(spark) == 1
    assert table.apply(counted(rows[1]), 2) and not table.apply(counted(rows[1]), 2) and not table.apply(counted(rows[1]), 1)
    assert table.apply(counted(attempts(spark, [])), 3) and table.apply(counted(rows[2]), 7)
    every = rows[0].union(rows[1]).union(rows[2])
    assert sorted(totals_of(table.read(spark)).collect()) == sorted(progress_totals(every).collect())
    table.forget(spark)
    assert table.last_batch(spark) == 7 and sorted(totals_of(table.read(spark)).collect()) == sorted(progress_totals(every).collect())
    assert set(os.listdir(tmp_path / "parts")) - {".crc"} == {"batch=7"}


def test_stored_users(spark, tmp_path):
    rows = [("1", "a@x", "A", 0), ("2", "b@x", "B", 1), ("1", "c@x", None, 5), ("3", None, "C", 3), ("1", "old@x", "old", 2)]
    table = sessions.stored_users(str(tmp_path), 4)
    ddl = "id string, email string, name string, _ord long"
    for batch, part in enumerate((rows[2:], rows[:1], rows[1:2])):
        assert table.apply(sessions.user_records(spark.createDataFrame(part, ddl)), batch)
    everyone = spark.createDataFrame(rows, ddl)
    assert sorted(sessions.users_of(table.read(spark)).collect()) == sorted(sessions.upsert_users(everyone).collect())
    assert sessions.user_by_email(sessions.users_of(table.read(spark)), "b@x").first()["id"] == "2"


def words(spark):
    def word(place, text, **given):
        known = {"_ord": place, "text": text, "language": "fr", "normalized": "", "translations": {}} | {n: [] for n, t in WORD.items() if t.startswith("array")} | given
        return tuple(known.get(n) for n in WORD)

    gloss = {"text": "drink", "examples": [{"text": "un café", "translation": "a coffee"}]}
    rows = [
        word(0, "cafe", topics=["food", "food"], frequency="", translations={"en": "coffee", "de": None}), word(1, "café", part_of_speech="", topics=["bar"], glosses=[gloss]),
        word(2, "CAFÉ", part_of_speech="noun", frequency="high", translations={"en": "café", "es": "café"}), word(3, "cafe", topics=["food", "bar", "x"], glosses=[gloss], sources=["a"]),
        word(4, "thé", topics=["food", "food"], normalized="own"), word(5, ""), word(6, "", part_of_speech=None), word(7, "eau", translations=None, topics=None), word(8, "été", language="FR"), word(9, "ete"),
    ]
    return spark.createDataFrame(rows, WORD_DDL)


@pytest.mark.parametrize("cuts", [[range(10)], [range(5), range(5, 10)], [range(7, 10), [3], [0, 6], [1, 2, 4, 5]]])
def test_any_cut_gives_the_merge(spark, tmp_path, cuts):
    table, vocabulary = words(spark), MergedVocabulary(str(tmp_path), 3)
    assert vocabulary.read(spark) is None
    for batch, places in enumerate(cuts):
        part = table.where(F.col("_ord").isin([int(k) for k in places]))
        assert vocabulary.add(part, batch) and not vocabulary.add(part, batch)
    assert sorted(map(repr, vocabulary.read(spark).collect())) == sorted(map(repr, merge_words(table).collect()))
