"""Word sources: CSV vocabularies, dictionary JSON lines and in-memory lists."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import has_accent, nonempty, strip
from .schemas import FREQUENCIES, ORDER_BITS, WORD, WORD_DDL

REQUIRED = ("text", "language")

# The parts of speech that the dictionary source keeps unless told otherwise.
KEEP_POS = ("noun", "verb", "adjective", "adverb", "expression", "phrase", "intj")

_MAPS = "array<map<string,string>>"
RECORD = f"word string, pos string, senses array<struct<glosses:array<string>,raw_glosses:array<string>,examples:array<struct<text:string,english:string>>,categories:{_MAPS},tags:array<string>,topics:array<string>>>, categories {_MAPS}, form_of {_MAPS}, _bad string"
#: The JSON type that each field of a record must have if it is there at all.
FIELD_TYPES = {"pos": '[n"]', "senses": r"\[", "categories": r"\[", "form_of": r"\["}


class MissingColumns(ValueError):
    """A CSV without a required column; ``missing`` has their sorted names."""

    def __init__(self, missing: Iterable[str]):
        self.missing = sorted(missing)
        # Fixed value: the error's text.
        super().__init__(f"CSV missing required columns: {self.missing}")


def _word(df: DataFrame, **columns: Column) -> DataFrame:
    """A projection onto the word schema; columns that are not given are empty."""
    empty = {"normalized": F.lit(""), "translations": F.create_map()}
    chosen = []
    for name, kind in WORD.items():
        column = columns.get(name, empty.get(name))
        if column is None:
            column = F.array() if kind.startswith("array") else F.lit(None)
        chosen.append(column.cast(kind).alias(name))
    return df.select(*chosen)


#: Files are split at multiples of 2 ** SPLIT_BITS bytes at least, and are below 2 ** FILE_BITS bytes.
SPLIT_BITS, FILE_BITS = 22, 38


def _in_file_order(rows: DataFrame) -> DataFrame:
    """``rows`` of text files with ``_ord``: by file name, place of the split in its file, and row.

    Spark packs splits of several files into a partition in any order, so the number of a row
    in its partition alone does not do.
    """
    plain = lambda path: F.regexp_replace(path, "^(\\w+):/+", "$1:/")
    spark, files = rows.sparkSession, sorted(rows.inputFiles())
    row_bits = ORDER_BITS - (FILE_BITS - SPLIT_BITS) - max(len(files) - 1, 0).bit_length()
    number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    split = F.shiftright(F.col("_metadata.file_block_start"), SPLIT_BITS)
    placed = rows.select("*", plain(F.col("_metadata.file_path")).alias("_path"), split.alias("_split"), number.alias("_row"))
    known = spark.createDataFrame(list(enumerate(files)), "_file bigint, _name string").select("_file", plain(F.col("_name")).alias("_name"))
    placed = placed.join(F.broadcast(known), F.col("_path") == F.col("_name"), "left")  # a row a file: no more than the driver has listed
    place = F.shiftleft(F.shiftleft("_file", FILE_BITS - SPLIT_BITS) + F.col("_split"), row_bits) + F.col("_row")
    sound = F.col("_file").isNotNull() & (F.col("_row") < F.lit(1 << row_bits)) & (F.col("_split") < F.lit(1 << (FILE_BITS - SPLIT_BITS)))
    refuse = F.raise_error(F.concat(F.lit("no place for a row of "), "_path"))
    return placed.withColumn("_ord", F.when(F.coalesce(sound, F.lit(False)), place).otherwise(refuse)).drop("_path", "_split", "_row", "_file", "_name")


def read_csv_words(spark: SparkSession, path: str) -> DataFrame:
    """Words of a CSV file with a header.

    Needed are the columns text and language; known are part_of_speech, frequency, topics or
    topic, secondary_topics, translation_<lang>, example_sentence, example_translation and
    false_friend_language, _word, _meaning and _similarity. The header is checked only if
    there is a data row. Blank lines are skipped, short rows filled with null.
    """
    rows = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', inferSchema=False, enforceSchema=False)
    missing = set(REQUIRED) - set(rows.columns)
    if missing:
        if rows.isEmpty():
            return spark.createDataFrame([], WORD_DDL)
        raise MissingColumns(missing)
    return csv_rows_to_words(_in_file_order(rows))


def csv_rows_to_words(rows: DataFrame) -> DataFrame:
    """Words of raw CSV rows (string columns, and ``_ord``)."""
    col = lambda name: F.col(f"`{name}`") if name in rows.columns else F.lit(None).cast("string")
    given = lambda name: F.when(nonempty(col(name)), col(name))
    stripped_or_null = lambda name: F.nullif(strip(col(name)), F.lit(""))
    listed = lambda c: F.filter(F.transform(F.split(c, ","), strip), lambda x: x != "")
    no_strings = F.array().cast("array<string>")
    languages = [c for c in rows.columns if c.startswith("translation_")]
    translations = F.create_map()
    if languages:
        pairs = F.map_from_arrays(F.array(*[F.lit(c.removeprefix("translation_")) for c in languages]), F.array(*[col(c) for c in languages]))
        translations = F.transform_values(F.map_filter(pairs, lambda _, v: nonempty(v)), lambda _, v: strip(v))
    topics = F.concat(F.coalesce(listed(F.coalesce(given("topics"), given("topic"))), no_strings), F.coalesce(listed(given("secondary_topics")), no_strings))
    tier = F.lower(strip(col("frequency")))
    example = F.struct(strip(col("example_sentence")).alias("sentence"), stripped_or_null("example_translation").alias("translation"))
    friend = F.struct(
        F.lower(strip(col("false_friend_language"))).alias("language"),
        strip(col("false_friend_word")).alias("similar_word"),
        stripped_or_null("false_friend_similarity").cast("double").alias("similarity_score"),
        F.coalesce(strip(col("false_friend_meaning")), F.lit("")).alias("actual_meaning"),
    )
    return _word(
        rows,
        _ord=F.col("_ord"),
        text=strip(col("text")),
        language=F.lower(strip(col("language"))),
        part_of_speech=stripped_or_null("part_of_speech"),
        frequency=F.when(tier.isin(*FREQUENCIES), tier),
        translations=translations,
        topics=topics,
        examples=F.when(nonempty(col("example_sentence")), F.array(example)).otherwise(F.array()),
        false_friends=F.when(nonempty(col("false_friend_language")) & nonempty(col("false_friend_word")), F.array(friend)).otherwise(F.array()),
        sources=F.array(F.lit("csv")),
    )


def read_dictionary_words(spark: SparkSession, path: str, language: str, *, keep_pos: Iterable[str] | None = KEEP_POS, require_accent: bool = False, skip_form_of: bool = True) -> DataFrame:
    """Words of a dictionary in JSON lines, all stamped with ``language``."""
    lines = _in_file_order(spark.read.text(path)).select(F.col("value").alias("line"), "_ord")
    return dictionary_lines_to_words(lines, language, keep_pos=keep_pos, require_accent=require_accent, skip_form_of=skip_form_of)


def dictionary_lines_to_words(lines: DataFrame, language: str, *, keep_pos: Iterable[str] | None = KEEP_POS, require_accent: bool = False, skip_form_of: bool = True) -> DataFrame:
    """Words of raw JSON lines (columns line and ``_ord``).

    Blank lines and lines that are no JSON are skipped. A line that is JSON but breaks the
    schema (no object, no string ``word``, a field of another type) fails the query. Of a
    sense only the first gloss counts; senses without one are dropped, and examples without
    text.
    """
    trimmed = lines.select("_ord", strip(F.col("line")).alias("line"))
    record = F.from_json("line", RECORD, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    fields = F.from_json("line", "map<string,variant>")
    # A filter isn't moved over a generator: each line is parsed once, and not before what ``lines`` brings together.
    parsed = trimmed.select("_ord", F.inline(F.array(F.struct("line", record.alias("r"), fields.alias("_fields"), F.get_json_object("line", "$").isNotNull().alias("_is_json"))))).where("line <> ''")
    is_json = F.col("_is_json")
    checks = [~F.col("line").startswith("{"), F.col("r._bad").isNotNull(), ~F.coalesce(_kind("word") == '"', F.lit(False))]
    checks += [F.coalesce(~_kind(name).rlike(kind), F.lit(False)) for name, kind in FIELD_TYPES.items()]
    wrong = checks[0]
    for check in checks[1:]:
        wrong = wrong | check
    refuse = F.raise_error(F.concat(F.lit("not a dictionary record: "), F.substring("line", 1, 200)))
    # Filters are evaluated in any order, so the check itself passes over what is no JSON.
    checked = parsed.select("_ord", F.inline(F.array(F.struct(F.when(~is_json, F.lit(None)).when(F.coalesce(wrong, F.lit(True)), refuse).otherwise(F.col("r")).alias("r")))))
    kept = checked.where("r.word <> ''")
    if skip_form_of:
        kept = kept.where("coalesce(size(r.form_of), 0) <= 0")
    if keep_pos is not None:
        kept = kept.where(F.lower(F.coalesce("r.pos", F.lit(""))).isin(*keep_pos))
    first = lambda sense: F.get(sense["glosses"], 0)
    example = lambda e: F.struct(e["text"].alias("text"), e["english"].alias("translation"))
    gloss = lambda s: F.struct(first(s).alias("text"), F.coalesce(F.transform(F.filter(s["examples"], lambda e: nonempty(e["text"])), example), F.array()).alias("examples"))
    senses = F.filter(F.coalesce("r.senses", F.array()), lambda s: nonempty(first(s)))
    words = _word(kept, _ord=F.col("_ord"), text=F.col("r.word"), language=F.lit(language), part_of_speech=F.col("r.pos"), glosses=F.transform(senses, gloss), sources=F.array(F.lit("wiktionary")))
    return words.where(has_accent(F.col("text"))) if require_accent else words


def _kind(name: str) -> Column:
    """The first character of a top-level field's JSON value, of ``_fields``: its type, null if it isn't there."""
    value = F.try_element_at("_fields", F.lit(name))
    return F.substring(F.to_json(value), 1, 1)


def static_words(spark: SparkSession, entries: Iterable[Mapping[str, str]]) -> DataFrame:
    """Words of a list of mappings with text, language and perhaps normalized; kept as they are."""
    rows = [(k, e["text"], e["language"], e.get("normalized", "")) for k, e in enumerate(entries)]
    df = spark.createDataFrame(rows, "_ord bigint, text string, language string, normalized string")
    return _word(df, _ord=F.col("_ord"), text=F.col("text"), language=F.col("language"), normalized=F.col("normalized"), sources=F.array(F.lit("static_list")))
