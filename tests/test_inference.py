import pytest

from verbarium.inference.operators import OPERATORS, apply, offline, tutor_open, tutor_reply
from verbarium.inference.prompts import fields_of, fill, keywords, load_prompt


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_templates_use_inputs_only(name):
    assert fields_of(load_prompt(name)) <= set(OPERATORS[name].inputs)


def test_prompt_versions(tmp_path):
    (tmp_path / "p").mkdir()
    for k in (2, 10):
        (tmp_path / "p" / f"v{k}.txt").write_text(f"{k} {{x}}")
    assert load_prompt("p", tmp_path) == "10 {x}" and load_prompt("p", tmp_path, "2") == "2 {x}"
    with pytest.raises(FileNotFoundError):
        load_prompt("p", tmp_path, "3")
    assert fill("{x}|{y}", {"x": ["a", {"r": "u", "c": "t"}], "y": None}) == "- a\n- u: t|"


def test_passages_without_content_are_left_out():
    template = "a{?x} b {x}{/x}{?y}\n{y}\n{/y} c"
    assert fill(template, {"x": None, "y": []}) == "a c" and fill(template, {"x": "k", "y": ["l", "m"]}) == "a b k\n- l\n- m\n c"
    assert fields_of(template) == {"x", "y"}
    for name, field, passage in (("topics", "exclude_topics", "close to"), ("conversation", "sample_conversation", "Example"), ("word_generator", "require_accents", "accented")):
        assert passage not in fill(load_prompt(name), {}) and passage in fill(load_prompt(name), {field: ["x"]})


def test_keywords():
    assert keywords({"a": 1, "b": None, "kwargs": {"a": 2, "c": None}}) == {"a": 2, "b": None, "c": None}
    assert keywords({"a": 1, "b": None, "kwargs": {"c": None, "d": 0}}, leave_out_null=True) == {"a": 1, "d": 0}
    assert keywords({"kwargs": 5}) == {"kwargs": 5} and keywords({"kwargs": None}) == {"kwargs": None} and keywords({"kwargs": None}, True) == {}


def test_tutor_sessions(spark):
    rows = spark.createDataFrame([(1, "food", "pt", "ola")], "session long, topic string, language string, user_message string")

    def corrects(name, prompts, inputs):
        assert [m["role"] for m in inputs[0]["history"]] == ["tutor", "user"] and "ola" in prompts[0]
        return [{"correction": {"content": "olá", "translation": "hi", "errors": [{"original": "ola", "corrected": "olá", "explanation": "accent"}]}, "conversation": {"content": "sim", "translation": "yes"}}]

    assert tutor_open(rows).first()["history"] == []
    row = tutor_reply(tutor_open(rows, offline), corrects).first()
    assert [(m["role"], m["content"]) for m in row["history"]] == [("tutor", "food?"), ("user", "ola"), ("tutor", "sim")]
    assert (row["correct"], row["feedback"], row["history"][2]["correction"]) == (False, "olá", "olá")


def test_offline_answers_are_valid(spark):
    row = spark.createDataFrame([("food", "pt", "oi  tudo bem com você", "en", "fr", True)], "topic string, language string, text string, source_language string, target_language string, require_accents boolean").withColumnRenamed("text", "text")
    row = row.withColumn("user_message", row["text"])
    for name in OPERATORS:
        assert apply(row, name, offline).first()["valid"], name


def test_contracts(spark):
    row = spark.createDataFrame([("a b", "pt", "t", "m")], "text string, language string, topic string, user_message string")
    bad = {
        "splitter": {"portions": ["b", "a"]},
        "conversation": {"turns": [{"role": "user", "content": "", "translation": ""}] * 2},
        "tutor": {"correction": {"content": "x", "translation": "", "errors": []}, "conversation": {"content": "", "translation": ""}},
    }
    for name, answer in bad.items():
        assert not apply(row, name, lambda n, p, r, answer=answer: [answer] * len(r)).first()["valid"], name
    with pytest.raises(ValueError, match="needs the columns"):
        apply(row, "translation", offline)
