import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from verbarium.functions.languages import UnknownLanguage, get_language, language_table, with_language
from verbarium.functions.text import accented_chars, decomposed, has_accent, normalize, normalize_exact, strip, word_id


def one(spark, text, *columns):
    return tuple(spark.createDataFrame([(text,)], "t string").select(*columns).first())


@pytest.mark.parametrize(
    ("text", "language", "expected"),
    [("señor", None, "senor"), ("Übung", None, "ubung"), ("ÎLOT", None, "ilot"), ("à Évora", "pt", "a evora"), ("cœur", "fr", "coeur"), ("CŒUR", "fr", "cœur"), ("Fuß", "de", "fuss"), ("Fuß", None, "fuß"), ("o\u0308", None, "o"), ("", None, ""), (None, None, None)],
)
def test_normalize(spark, text, language, expected):
    assert one(spark, text, normalize(F.col("t"), language), normalize_exact(F.col("t"), language)) == (expected, expected)


def test_accents(spark):
    assert one(spark, "señor", has_accent(F.col("t"))) == (True,)
    assert one(spark, "Turm 7", has_accent(F.col("t"))) == (False,)
    assert one(spark, "Fuß", has_accent(F.col("t")), has_accent(F.col("t"), "de")) == (False, True)
    assert one(spark, "Ñandú à ñandú", accented_chars(F.col("t"))) == (["Ñ", "ú", "à", "ñ", "ú"],)


def test_word_id(spark):
    rows = spark.createDataFrame([("thé", "fr"), ("THE", "FR"), ("sal", "pt"), ("sal", "es")], "t string, l string")
    ids = [r[0] for r in rows.select(word_id(F.col("t"), F.col("l"))).collect()]
    assert ids[0] == ids[1] and len(set(ids)) == 3 and all(len(i) == 16 for i in ids)


def test_strip_takes_all_white_space(spark):
    assert one(spark, "  \x1c a b \t\n", strip(F.col("t"))) == ("a b",)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.characters(max_codepoint=0x24F)), min_size=30, max_size=60))
def test_normalize_agrees_with_decomposition(spark, texts):
    fold = lambda s: "".join(c for c in unicodedata.normalize("NFD", s) if not unicodedata.combining(c)).lower()
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", normalize(F.col("t"))).collect()
    assert all(fold(t) == got for t, got in rows)


def test_exact_folding_of_all_code_points(spark):
    fold = lambda s: "".join(c for c in unicodedata.normalize("NFD", s) if not unicodedata.combining(c))
    points = [chr(k) for k in range(1, 0x110000) if not 0xD800 <= k <= 0xDFFF]
    texts = ["".join(points[k : k + 500]) for k in range(0, len(points), 500)]
    # Each character of several letters by itself too, and marks in an order that decomposition changes.
    texts += [c for c in points if len(fold(c)) > 1 and not "\uac00" <= c <= "\ud7a3"] + ["\uac00", "\uac01", "\ud7a3", "x\u0301\u0323한\u0323\u0301글", ""]
    rows = spark.createDataFrame([(t,) for t in [*texts, None]], "t string").select("t", decomposed(F.col("t")).alias("d"))
    wrong = [(t, got) for t, got in rows.collect() if got != (None if t is None else fold(t))]
    assert not wrong, wrong[:3]
    plan = rows.select(normalize_exact(F.col("t"), "fr"))._jdf.queryExecution().toString()
    assert "Python" not in plan


def test_languages(spark):
    table = {r["code"]: r for r in language_table(spark).collect()}
    assert set(table) == {"pt", "fr", "es", "it", "en", "de"}
    assert table["de"]["accent_keys"] == sorted("äöüß") and table["en"]["accent_keys"] == []
    assert ["".join(r) for r in table["fr"]["keyboard_rows"]] == ["qwertyuiop", "asdfghjkl", "zxcvbnm"]
    assert get_language("FR").letter_map["œ"] == "oe"
    with pytest.raises(UnknownLanguage):
        get_language("xx")
    rows = spark.createDataFrame([("PT",), ("xx",)], "code string")
    assert [r["language_info"] and r["language_info"]["name"] for r in with_language(rows, "code", strict=False).collect()] == ["Portuguese", None]
    with pytest.raises(Exception, match="Unknown language code"):
        with_language(rows, "code").collect()
