import json

import pytest
from pyspark.sql import functions as F

from verbarium.operators.words import derive, merge_words, union_sources, word_filter
from verbarium.sources.schemas import WORD, WORD_DDL
from verbarium.sources.words import MissingColumns, dictionary_lines_to_words, read_csv_words, read_dictionary_words, static_words


def words(spark, *rows):
    empty = {"normalized": "", "translations": {}, "topics": [], "glosses": [], "examples": [], "false_friends": [], "sources": []}
    return spark.createDataFrame([tuple(({"_ord": k} | empty | r).get(c) for c in WORD) for k, r in enumerate(rows)], WORD_DDL)


def csv(spark, tmp_path, content):
    path = tmp_path / "v.csv"
    path.write_text(content, encoding="utf-8")
    return read_csv_words(spark, str(path))


def test_csv(spark, tmp_path):
    rows = csv(spark, tmp_path, 'text,language,translation_en,translation_xx,topics,topic,secondary_topics,frequency,example_sentence,example_translation,part_of_speech,false_friend_language,false_friend_word,false_friend_similarity\n amor ,PT,love,"  ","a, ,b",z,"c",HIGH,"Oi, ""x""", ,,EN,amour,0.5\n\namour,fr\n').orderBy("_ord").collect()
    first, second = rows
    assert (first["text"], first["language"], first["translations"], first["topics"], first["frequency"]) == ("amor", "pt", {"en": "love", "xx": ""}, ["a", "b", "c"], "high")
    assert first["examples"][0].asDict() == {"sentence": 'Oi, "x"', "translation": None} and first["part_of_speech"] is None
    assert first["false_friends"][0].asDict() == {"language": "en", "similar_word": "amour", "similarity_score": 0.5, "actual_meaning": ""}
    assert (second["text"], second["translations"], second["topics"], second["sources"]) == ("amour", {}, [], ["csv"])


def test_csv_columns(spark, tmp_path):
    with pytest.raises(MissingColumns) as e:
        csv(spark, tmp_path, "topics,frequency\nsea,high\n")
    assert e.value.missing == ["language", "text"]
    with pytest.raises(MissingColumns) as e:
        csv(spark, tmp_path, "text,frequency\nmar,high\n")
    assert e.value.missing == ["language"] and csv(spark, tmp_path, "topics,frequency\n").count() == 0


def test_files_come_in_the_order_of_their_names(spark, tmp_path):
    folder = tmp_path / "many files"
    folder.mkdir()
    for name, rows in (("c", 5), ("a", 3000), ("b", 400)):
        (folder / f"{name}.jsonl").write_text("".join(json.dumps({"word": f"{name}{k:05d}", "pos": "noun"}) + "\n" for k in range(rows)), encoding="utf-8")
        (folder / f"{name}.csv").write_text("text,language\n" + "".join(f"{name}{k:05d},en\n" for k in range(rows)), encoding="utf-8")
    expected = [f"{name}{k:05d}" for name, rows in (("a", 3000), ("b", 400), ("c", 5)) for k in range(rows)]
    for found in (read_dictionary_words(spark, f"{folder}/*.jsonl", "en"), read_csv_words(spark, f"{folder}/*.csv")):
        assert [r["text"] for r in found.orderBy("_ord").collect()] == expected
        assert found.where(F.col("_ord") >= 1 << 56).count() == 0


def test_dictionary(spark, tmp_path):
    lines = [
        {"word": "amor", "pos": "Noun", "other": 1, "senses": [{"glosses": ["love", "x"], "examples": [{"text": "t", "english": "e"}, {"text": ""}]}, {"glosses": []}, {"glosses": ["", "y"]}]},
        {"word": "x", "pos": "letter"},
        {"word": "amei", "pos": "verb", "form_of": [{"word": "amar"}]},
        {"word": "ação", "pos": "noun"},
        {"word": "", "pos": "noun"},
        {"word": "none"},
    ]
    path = tmp_path / "d.jsonl"
    path.write_text("\n".join([*map(json.dumps, lines), "", "  ", "{bad", "no json"]), encoding="utf-8")
    rows = read_dictionary_words(spark, str(path), "pt").orderBy("_ord").collect()
    assert [r["text"] for r in rows] == ["amor", "ação"]
    assert [(g["text"], [e["text"] for e in g["examples"]]) for g in rows[0]["glosses"]] == [("love", ["t"])] and rows[0]["part_of_speech"] == "Noun"
    assert [r["text"] for r in read_dictionary_words(spark, str(path), "pt", require_accent=True).collect()] == ["ação"]
    kept = read_dictionary_words(spark, str(path), "pt", keep_pos=None, skip_form_of=False)
    assert sorted(r["text"] for r in kept.collect()) == sorted(["amor", "x", "amei", "ação", "none"])


@pytest.mark.parametrize("line", ["[1]", "5", '{"word":5}', '{"pos":"noun"}', '{"word":"a","pos":3}', '{"word":"a","senses":{}}'])
def test_dictionary_refuses_other_shapes(spark, line):
    lines = spark.createDataFrame([(0, line)], "_ord long, line string")
    with pytest.raises(Exception, match="not a dictionary record"):
        dictionary_lines_to_words(lines, "pt", keep_pos=None).collect()


def test_static_and_union(spark):
    one = static_words(spark, [{"text": "amor", "language": "pt"}, {"text": " X ", "language": "fr", "normalized": "kept", "more": "y"}])
    both = derive(union_sources(one, one)).orderBy("_ord").collect()
    assert [r["text"] for r in both] == ["amor", " X ", "amor", " X "] and both[1]["normalized"] == "kept" and both[0]["length"] == 4


def test_merge(spark):
    rows = words(
        spark,
        {"text": "acao", "language": "PT", "translations": {"en": "a"}, "topics": ["x", "x"], "part_of_speech": "", "frequency": None, "sources": ["one"]},
        {"text": "ação", "language": "pt", "translations": {"en": "b", "fr": "c"}, "topics": ["y", "x"], "part_of_speech": "noun", "frequency": "low", "sources": ["two"]},
        {"text": "ACAO", "language": "pt", "frequency": "high"},
        {"text": "paz", "language": "pt", "topics": ["z", "z"]},
    )
    first, alone = merge_words(rows).orderBy("_ord").collect()
    assert (first["text"], first["language"], first["normalized"], first["part_of_speech"], first["frequency"]) == ("ação", "PT", "acao", "noun", "low")
    assert first["translations"] == {"en": "a", "fr": "c"} and first["topics"] == ["x", "y"] and first["sources"] == ["one", "two"]
    assert alone["topics"] == ["z", "z"] and alone["translations"] == {}
    again = merge_words(merge_words(rows).select(*WORD)).orderBy("_ord").collect()
    assert [r["text"] for r in again] == ["ação", "paz"]


def test_merge_fills_normalized_first(spark):
    rows = words(spark, {"text": "mar", "language": "pt"}, {"text": "mar", "language": "pt", "normalized": "KEPT"}, {"text": "sol", "language": "pt", "normalized": "FIRST"}, {"text": "sol", "language": "pt", "normalized": "second"})
    assert [r["normalized"] for r in merge_words(rows).orderBy("_ord").collect()] == ["mar", "FIRST"]


def test_merge_text_rules(spark):
    rows = words(spark, {"text": "Acao", "language": "pt"}, {"text": "acao", "language": "pt"})
    assert merge_words(rows).first()["text"] == "acao"  # without an accent the last one holds
    glosses = [("g", [("e", None)])]
    rows = words(spark, {"text": "a", "language": "pt", "glosses": glosses}, {"text": "a", "language": "pt", "glosses": glosses}, {"text": "a", "language": "pt", "glosses": None})
    assert len(merge_words(rows).first()["glosses"]) == 1


def test_filter(spark):
    rows = derive(words(spark, {"text": "oi", "language": "pt", "topics": ["t"]}, {"text": "paciência", "language": "pt", "translations": {"en": ""}, "topics": None}))
    keep = lambda **k: [r["text"] for r in rows.where(word_filter(**k)).collect()]
    assert keep(min_length=4) == ["paciência"] and keep(max_length=2) == ["oi"] and keep(has_accent=False) == ["oi"]
    assert keep(has_translation="en") == ["paciência"] and keep(topics=["t", "u"]) == ["oi"] and keep(languages=["PT"]) == [] and len(keep()) == 2


def test_merge_of_a_hot_word(spark):
    many = spark.range(5000).select(F.col("id").alias("_ord"), F.lit("the").alias("text"), F.lit("en").alias("language"), F.lit("").alias("normalized"), F.lit(None).cast("string").alias("part_of_speech"), F.lit(None).cast("string").alias("frequency"), F.create_map(F.lit("k"), F.col("id").cast("string")).alias("translations"), F.array((F.col("id") % 3).cast("string")).alias("topics"), *[F.array().cast(WORD[c]).alias(c) for c in ("glosses", "examples", "false_friends", "sources")])
    merged = merge_words(many).first()
    assert merged["topics"] == ["0", "1", "2"] and merged["translations"] == {"k": "0"}
