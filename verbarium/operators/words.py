"""Derived columns of words, and the ordered merge of words with equal ids."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import accented_chars, has_accent, has_foreign_letter, nonempty, normalize, word_id
from ..sources.schemas import ORDER_BITS, WORD

LISTS = ("topics", "glosses", "examples", "false_friends", "sources")


def derive(words: DataFrame) -> DataFrame:
    """``words`` with id, has_accent, accented_chars and length; an empty normalized is filled."""
    text = F.col("text")
    return words.withColumns(
        {
            "normalized": F.when(nonempty(F.col("normalized")), F.col("normalized")).otherwise(normalize(text)),
            "id": word_id(text, F.col("language")),
            "has_accent": has_accent(text),
            "accented_chars": accented_chars(text),
            "length": F.length(text),
        }
    )


def _first_given(name: str) -> Column:
    """The first non-empty value in arrival order; without one, the last value."""
    given = F.when(nonempty(F.col(name)), F.col("_low"))
    return F.coalesce(F.min_by(name, given), F.max_by(F.struct(name), "_high")[name])


def merge_words(words: DataFrame) -> DataFrame:
    """One word for each id, merged in arrival order.

    The text is the first with a letter beyond ASCII, else the last that isn't empty, else
    the first. Language: the first. A word without a normalized text has that of its own
    text before anything is merged; the first that isn't empty holds. Part of speech,
    frequency: the first that isn't empty. Translations: the first for each key. Lists:
    distinct entries in the order of their first appearance; a word that is alone keeps its
    lists as they are. ``_ord`` is the first arrival, by which the result can be ordered.

    Rows of equal content are counted first, by a hash aggregation; ids and rules are worked
    out on contents only. Contents are dealt by id, and list entries then grouped by themselves,
    so a word with any number of rows meets in one task only as its distinct contents.
    """
    return merge_contents(contents(words))


def merge_contents(counted: DataFrame) -> DataFrame:
    """The words that ``merge_words`` gives, from rows of ``contents``; a content may come several times."""
    counted = counted.repartition("id")  # all that follows is by id: contents are dealt once, and entries not at all
    foreign = F.when(has_foreign_letter(F.col("text")), F.col("_low"))
    filled = F.when(nonempty(F.col("text")), F.col("_high"))
    whole = F.struct(F.map_from_entries("_pairs").alias("translations"), *LISTS)
    base = counted.groupBy("id").agg(
        F.sum("_rows").alias("_n"),
        F.min("_low").alias("_ord"),
        F.coalesce(F.min_by("text", foreign), F.max_by("text", filled), F.min_by("text", "_low")).alias("text"),
        F.min_by("language", "_low").alias("language"),
        *[_first_given(name).alias(name) for name in ("normalized", "part_of_speech", "frequency")],
        F.min_by(whole, "_low").alias("_whole"),
    )
    merged = base.join(gathered_entries(distinct_entries(counted)), "id", "left")

    def chosen(name: str) -> Column:
        kind = WORD[name]
        together = F.coalesce(F.col(f"_all.{name}"), F.array().cast(kind))
        return F.when(F.col("_n") == 1, F.col(f"_whole.{name}")).otherwise(together).alias(name)

    translations = F.when(F.col("_n") == 1, F.col("_whole.translations")).otherwise(F.coalesce("_all.translations", F.create_map().cast(WORD["translations"])))
    plain = [translations.alias(n) if n == "translations" else chosen(n) if n in LISTS else F.col(n) for n in WORD]
    return merged.select(F.nullif("id", F.lit("")).alias("id"), *plain)


def counted_contents(words: DataFrame) -> DataFrame:
    """The distinct contents of words with their number of rows, first and last arrival."""
    content = words.select(*[F.col(n) for n in WORD if n != "translations"], F.map_entries("translations").alias("_pairs"))
    return content.groupBy(*[c for c in content.columns if c != "_ord"]).agg(F.count("*").alias("_rows"), F.min("_ord").alias("_low"), F.max("_ord").alias("_high"))


def identified(counted: DataFrame) -> DataFrame:
    """``counted_contents`` with their id and normalized text."""
    normalized = F.when(nonempty(F.col("normalized")), F.col("normalized")).otherwise(normalize(F.col("text")))
    # Never null, so that no test for null tells the two readers of the contents apart.
    return counted.withColumns({"normalized": normalized, "id": F.coalesce(word_id(F.col("text"), F.col("language")), F.lit(""))})


def contents(words: DataFrame) -> DataFrame:
    """The distinct contents of words with their id, number of rows, first and last arrival."""
    return identified(counted_contents(words))


_KINDS = {name: WORD[name].removeprefix("array<")[:-1] for name in LISTS}


def distinct_entries(counted: DataFrame) -> DataFrame:
    """(id, item, _place, value): each distinct list entry and translation of ``contents``' rows, at its first place."""

    def packed(kind: str, value: Column, key: Column) -> Column:
        fields = [(value if n == kind else F.lit(None)).cast(t).alias(n) for n, t in _KINDS.items()]
        return F.struct(F.lit(kind).alias("kind"), key.cast("string").alias("key"), *fields)

    def listed(name: str) -> Column:
        return F.transform(F.coalesce(name, F.array().cast(WORD[name])), lambda x: F.struct(packed(name, x, F.lit(None)).alias("item"), F.lit(None).cast("string").alias("value")))

    lists = [listed(name) for name in LISTS]
    pairs = F.transform(F.coalesce("_pairs", F.array()), lambda e: F.struct(packed("translations", F.lit(None), e["key"]).alias("item"), e["value"].alias("value")))
    # The test holds for all; it keeps every column, so that the shuffles of the contents are the other reader's too.
    every = F.xxhash64(*counted.columns).bitwiseAND(F.lit(0)) == 0
    single = counted.select("id", F.col("_low").alias("_ord"), F.posexplode(F.when(every, F.concat(*lists, pairs))).alias("_pos", "_e"))
    place = F.struct("_ord", "_pos")
    return single.groupBy("id", "_e.item").agg(F.min(place).alias("_place"), F.min_by("_e.value", place).alias("value"))


def gathered_entries(distinct: DataFrame) -> DataFrame:
    """(id, _all): the merged lists and translations of each id, from ``distinct_entries``."""
    gathered = distinct.groupBy("id").agg(F.collect_list(F.struct("_place", "item", "value")).alias("_items"))
    by_place = F.array_sort("_items", lambda x, y: F.when(x["_place"] < y["_place"], F.lit(-1)).otherwise(F.lit(1)))
    gathered = gathered.select("id", by_place.alias("_items"))

    def of_kind(kind: str) -> Column:
        return F.filter("_items", lambda x: x["item"]["kind"] == kind)

    def values(name: str) -> Column:
        return F.transform(of_kind(name), lambda x: x["item"][name])

    fields = [values(name).alias(name) for name in LISTS]
    translations = F.map_from_entries(F.transform(of_kind("translations"), lambda x: F.struct(x["item"]["key"], x["value"])))
    return gathered.select("id", F.struct(*fields, translations.alias("translations")).alias("_all"))


def union_sources(*sources: DataFrame) -> DataFrame:
    """The words of several sources, one source after the other in arrival order.

    ``_ord`` is below 2 ** 56 in every source, as the readers make it.
    """
    out = None
    for k, source in enumerate(sources):
        placed = source.withColumn("_ord", F.col("_ord") + F.lit(k << ORDER_BITS))
        out = placed if out is None else out.unionByName(placed)
    return out


def word_filter(*, has_accent: bool | None = None, has_translation: str | None = None, min_length: int | None = None, max_length: int | None = None, topics: Iterable[str] = (), languages: Iterable[str] = ()) -> Column:
    """The predicate over derived words of all conditions that are given.

    ``has_translation`` asks for a key only; lengths are inclusive and count code points;
    an empty ``topics`` or ``languages`` asks for nothing; languages compare with their case.
    """
    test = F.lit(True)
    if has_accent is not None:
        test = test & (F.col("has_accent") == has_accent)
    if has_translation is not None:
        test = test & F.coalesce(F.map_contains_key("translations", has_translation), F.lit(False))
    if min_length is not None:
        test = test & (F.length("text") >= min_length)
    if max_length is not None:
        test = test & (F.length("text") <= max_length)
    if wanted := list(topics):
        test = test & F.coalesce(F.arrays_overlap("topics", F.array(*[F.lit(t) for t in wanted])), F.lit(False))
    if codes := list(languages):
        test = test & F.col("language").isin(codes)
    return test
