"""The seven generation operators: rows of typed input to rows of typed output."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import SPACE, nonempty, normalize, strip
from .prompts import fields_of, fill, load_prompt

#: Answers a batch: gets the prompts and the inputs, returns a mapping of output fields for each.
Provider = Callable[[str, list[str], list[dict]], list[Mapping[str, Any]]]


@dataclass(frozen=True)
class Operator:
    """Name, input fields with their defaults (... where one is needed), output type."""

    name: str
    inputs: Mapping[str, Any]
    output: str
    check: Callable[[Column, Column], Column] | None = field(default=None, compare=False)


def _portions_hold(row: Column, out: Column) -> Column:
    squeezed = lambda c: F.regexp_replace(c, f"{SPACE}+", "")
    return squeezed(F.array_join(out["portions"], "")) == squeezed(row["text"])


def _roles_alternate(_: Column, out: Column) -> Column:
    roles = F.transform(out["turns"], lambda t: t["role"])
    after = F.slice(roles, 2, F.greatest(F.size(roles), F.lit(1)))
    same = F.exists(F.zip_with(roles, after, lambda a, b: F.coalesce(a == b, F.lit(False))), lambda x: x)
    return F.forall(roles, lambda r: r.isin("user", "system")) & ~same


def _correction_holds(_: Column, out: Column) -> Column:
    return (F.size(out["correction"]["errors"]) > 0) == nonempty(out["correction"]["content"])


def _accents_hold(row: Column, out: Column) -> Column:
    accented = F.forall(out["words"], lambda w: normalize(w["text"]) != F.lower(w["text"]))
    return ~F.coalesce(row["require_accents"].cast("boolean"), F.lit(False)) | accented


_TURNS = "array<struct<role:string,content:string,translation:string>>"
_CORRECTION = "struct<content:string,translation:string,errors:array<struct<original:string,corrected:string,explanation:string>>>"
_WORDS = "array<struct<text:string,translation:string,part_of_speech:string,example_sentence:string,example_translation:string>>"

OPERATORS = {
    o.name: o
    for o in (
        Operator("translation", {"text": ..., "source_language": ..., "target_language": ...}, "struct<translated_text:string>"),
        Operator("conversation", {"topic": ..., "language": ..., "difficulty_level": "intermediate", "num_turns": 6, "max_sentences_per_turn": 3, "sample_conversation": None}, f"struct<turns:{_TURNS}>", _roles_alternate),
        Operator("tutor", {"topic": ..., "language": ..., "user_message": ..., "history": (), "difficulty_level": "intermediate"}, f"struct<correction:{_CORRECTION},conversation:struct<content:string,translation:string>>", _correction_holds),
        Operator("topics", {"language": ..., "difficulty_level": "intermediate", "num_topics": 5, "exclude_topics": ()}, "struct<topics:array<string>>"),
        Operator("splitter", {"text": ..., "language": ...}, "struct<portions:array<string>>", _portions_hold),
        Operator("greeting", {"topic": ..., "language": ..., "difficulty_level": "intermediate"}, "struct<greeting:string,translation:string>"),
        Operator("word_generator", {"language": ..., "topic": ..., "num_words": 10, "difficulty": "intermediate", "require_accents": False}, f"struct<words:{_WORDS}>", _accents_hold),
    )
}


def apply(df: DataFrame, name: str, provider: Provider, *, folder: Path | str | None = None, version: str = "auto") -> DataFrame:
    """``df`` with the struct ``output`` of an operator, and ``valid``: whether its contract holds.

    Input fields are columns of ``df``; those with a default may be absent. A template with a
    place for anything else is refused at once. Rows go to the provider in Arrow batches, in
    the executors, once each; ``provider`` must be picklable.
    """
    operator = OPERATORS[name]
    template = load_prompt(name, folder, version)
    if unknown := fields_of(template) - set(operator.inputs):
        raise ValueError(f"the prompt {name} has places for {sorted(unknown)}, which are no inputs")
    if missing := [k for k, v in operator.inputs.items() if v is ... and k not in df.columns]:
        raise ValueError(f"{name} needs the columns {missing}")
    given = [k for k in operator.inputs if k in df.columns]
    defaults = {k: list(v) if isinstance(v, tuple) else v for k, v in operator.inputs.items() if v is not ...}
    output = T.StructType.fromDDL(f"output {operator.output}")["output"].dataType

    @F.pandas_udf(output)
    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [defaults | {k: _plain(v) for k, v in row.items()} for row in batch.to_dict("records")]
            outputs = provider(name, [fill(template, row) for row in rows], rows) if rows else []
            yield pd.DataFrame([[o.get(f.name) for f in output] for o in outputs], columns=[f.name for f in output])

    inputs = F.struct(*[F.col(f"`{k}`") for k in given])
    out = df.withColumn("output", answer(inputs))
    row = F.struct(*[F.col(f"`{k}`") if k in given else F.lit(None if v is ... or v == () else v).alias(k) for k, v in operator.inputs.items()])
    valid = operator.check(row, F.col("output")) if operator.check else F.lit(True)
    return out.withColumn("valid", F.coalesce(valid, F.lit(False)))


def _plain(value: Any) -> Any:
    """Arrow's arrays as lists, and missing scalars as None."""
    if hasattr(value, "tolist") and not isinstance(value, (str, bytes)):
        value = value.tolist()
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    return None if value is None or value is pd.NaT or (isinstance(value, float) and value != value) else value


def offline(name: str, prompts: list[str], rows: list[dict]) -> list[dict]:
    """A provider without a model: fixed, valid answers made of the inputs."""
    return [_OFFLINE[name](row) for row in rows]


def _split(row: dict) -> dict:
    words = (row["text"] or "").split()
    return {"portions": [" ".join(words[k : k + 3]) for k in range(0, len(words), 3)]}


_OFFLINE: dict[str, Callable[[dict], dict]] = {
    "translation": lambda r: {"translated_text": f"[{r['target_language']}] {r['text']}"},
    "conversation": lambda r: {"turns": [{"role": ("user", "system")[k % 2], "content": f"{r['topic']} {k + 1}", "translation": f"{r['topic']} {k + 1}"} for k in range(int(r["num_turns"]))]},
    "tutor": lambda r: {"correction": {"content": "", "translation": "", "errors": []}, "conversation": {"content": f"{r['topic']}: {r['user_message']}", "translation": f"{r['topic']}: {r['user_message']}"}},
    "topics": lambda r: {"topics": [t for t in (f"{r['language']} {r['difficulty_level']} topic {k + 1}" for k in range(int(r["num_topics"]) + len(r["exclude_topics"] or ()))) if t not in (r["exclude_topics"] or ())][: int(r["num_topics"])]},
    "splitter": _split,
    "greeting": lambda r: {"greeting": f"{r['topic']}?", "translation": f"{r['topic']}?"},
    "word_generator": lambda r: {"words": [{"text": f"{r['topic']}{'é' if r['require_accents'] else ''}{k + 1}", "translation": r["topic"], "part_of_speech": "noun", "example_sentence": r["topic"], "example_translation": r["topic"]} for k in range(int(r["num_words"]))]},
}


#: A message of a tutor conversation.
MESSAGE = "struct<role:string,content:string,translation:string,correction:string>"


def _message(role: str, content: Column, translation: Column, correction: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"), translation.alias("translation"), correction.alias("correction")).cast(MESSAGE)


def tutor_open(sessions: DataFrame, provider: Provider | None = None, **options: Any) -> DataFrame:
    """``sessions`` (session, topic, language) with ``history``, the messages so far.

    With a provider the history begins with its greeting (operator ``greeting``), else it is
    empty. ``options`` are those of ``apply``.
    """
    none = F.array().cast(f"array<{MESSAGE}>")
    if provider is None:
        return sessions.withColumn("history", none)
    nothing = F.lit(None).cast("string")
    opened = apply(sessions, "greeting", provider, **options)
    greeting = _message("tutor", F.col("output.greeting"), F.col("output.translation"), nothing)
    return opened.withColumn("history", F.array(greeting)).drop("output", "valid")


def tutor_reply(turns: DataFrame, provider: Provider, **options: Any) -> DataFrame:
    """One turn of every session: the tutor's answer to ``user_message``.

    ``turns`` has session, topic, language, history and user_message. The tutor sees the
    history with the user's message at its end. Returns ``turns`` with the history grown by
    both messages, ``correct`` (whether the correction holds nothing but white space) and
    ``feedback`` (the correction, or null).
    """
    nothing = F.lit(None).cast("string")
    said = F.array_append("history", _message("user", F.col("user_message"), nothing, nothing))
    answered = apply(turns.withColumn("history", said), "tutor", provider, **options)
    feedback = F.col("output.correction.content")
    reply = _message("tutor", F.col("output.conversation.content"), F.col("output.conversation.translation"), feedback)
    grown = answered.withColumns({"history": F.array_append("history", reply), "correct": F.coalesce(strip(feedback), F.lit("")) == "", "feedback": F.nullif(feedback, F.lit(""))})
    return grown.drop("output", "valid")
