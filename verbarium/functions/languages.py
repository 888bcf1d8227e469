"""The language table: codes, names, accented letters, letter maps and keyboards."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Keyboard rows, and per language its names, accented letters and letter map.
KEYBOARD_ROWS = ("qwertyuiop", "asdfghjkl", "zxcvbnm")

SCHEMA = "code string, name string, native_name string, accented_chars array<string>, normalization_map map<string,string>, keyboard_rows array<array<string>>, accent_keys array<string>"


class UnknownLanguage(KeyError):
    """A code that is not in the language table."""

    def __init__(self, code: str):
        super().__init__(f"Unknown language code: {code!r}")
        self.code = code


@dataclass(frozen=True)
class Language:
    code: str
    name: str
    native_name: str
    accented: str = ""
    letter_map: dict[str, str] = field(default_factory=dict)

    def row(self) -> tuple:
        """The language as a row of SCHEMA."""
        keys = sorted(set(self.accented))
        return self.code, self.name, self.native_name, keys, dict(self.letter_map), [list(r) for r in KEYBOARD_ROWS], keys


LANGUAGES = {
    language.code: language
    for language in (
        Language("pt", "Portuguese", "Português", "âãàéêíóôõúç", {"ç": "c"}),
        Language("fr", "French", "Français", "âàéèëêïîôœüùûç", {"œ": "oe", "æ": "ae", "ç": "c"}),
        Language("es", "Spanish", "Español", "áéíóúñü", {"ñ": "n"}),
        Language("it", "Italian", "Italiano", "àèéìòù"),
        Language("en", "English", "English"),
        Language("de", "German", "Deutsch", "äöüß", {"ß": "ss"}),
    )
}


def get_language(code: str) -> Language:
    """The language of a code in either case; raises UnknownLanguage."""
    try:
        return LANGUAGES[code.lower()]
    except KeyError:
        raise UnknownLanguage(code) from None


def language_table(spark: SparkSession) -> DataFrame:
    """The six languages as a table."""
    return spark.createDataFrame([language.row() for language in LANGUAGES.values()], SCHEMA)


def with_language(df: DataFrame, code: str, strict: bool = True) -> DataFrame:
    """``df`` with the struct ``language_info`` of the code in column ``code``, in either case.

    Unknown codes fail the query if ``strict``, else they have a null struct. The table
    has six rows, so it is broadcast.
    """
    info = language_table(df.sparkSession).select(F.col("code").alias("_code"), F.struct("code", "name", "native_name", "accent_keys", "keyboard_rows", "normalization_map").alias("language_info"))
    joined = df.join(F.broadcast(info), F.lower(df[code]) == F.col("_code"), "left").drop("_code")
    if strict:
        unknown = F.raise_error(F.concat(F.lit("Unknown language code: "), F.coalesce(df[code], F.lit("null"))))
        joined = joined.withColumn("language_info", F.when(F.col("language_info").isNull(), unknown).otherwise(F.col("language_info")))
    return joined


def mapped(text: Column, language: str | Column | None) -> Column:
    """``text`` with the letter map of a language applied: a code, or a column of codes."""
    if language is None:
        return text
    if isinstance(language, str):
        return _replaced(text, get_language(language).letter_map)
    out = text
    for code, entry in LANGUAGES.items():
        if entry.letter_map:
            out = F.when(F.lower(language) == code, _replaced(text, entry.letter_map)).otherwise(out)
    return out


def _replaced(text: Column, letters: dict[str, str]) -> Column:
    for letter, base in letters.items():
        text = F.replace(text, F.lit(letter), F.lit(base))
    return text
