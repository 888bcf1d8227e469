"""Text functions as Spark columns: accent folding, word ids, white space."""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from .languages import mapped

#: White space as Unicode has it, with the four information separators.
SPACE = r"[\s\x{1C}-\x{1F}\x{85}\p{Z}]"


@cache
def fold_table() -> tuple[str, str]:
    """Characters and their bases for ``translate``; combining marks have none and go.

    Made from the Unicode data: every character whose canonical decomposition, without
    marks of a combining class other than 0, is one character or nothing.
    """
    bases, marks, to = [], [], []
    for point in range(0x80, sys.maxunicode + 1):
        char = chr(point)
        if 0xAC00 <= point <= 0xD7A3 or 0xD800 <= point <= 0xDFFF:
            continue
        rest = [c for c in unicodedata.normalize("NFD", char) if not unicodedata.combining(c)]
        if not rest:
            marks.append(char)
        elif len(rest) == 1 and rest[0] != char:
            bases.append(char)
            to.append(rest[0])
    return "".join(bases + marks), "".join(to)


def strip(text: Column) -> Column:
    """Without white space, of any kind in Unicode, at both ends."""
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def nonempty(text: Column) -> Column:
    """Whether ``text`` is neither null nor empty."""
    return F.coalesce(text != "", F.lit(False))


def normalize(text: Column, language: str | Column | None = None) -> Column:
    """Lower case without accents; the language's letter map comes first.

    Characters that decompose into several letters (Hangul syllables and some Indic signs)
    stay composed; ``normalize_exact`` decomposes them too.
    """
    return F.lower(F.translate(mapped(text, language), *fold_table()))


# Fixed values of the Unicode standard: Hangul syllables, the Jamo that they are made of and their numbers.
SYLLABLES = (0xAC00, 0xD7A3)
LEADS, VOWELS, TAILS = (0x1100, 19), (0x1161, 21), (0x11A8, 27)


@cache
def several_letters() -> dict[str, str]:
    """Characters but Hangul syllables that decompose into several letters, and those; from the Unicode data."""
    out = {}
    for point in range(0x80, sys.maxunicode + 1):
        if not SYLLABLES[0] <= point <= SYLLABLES[1] and not 0xD800 <= point <= 0xDFFF:
            letters = "".join(c for c in unicodedata.normalize("NFD", chr(point)) if not unicodedata.combining(c))
            if len(letters) > 1:
                out[chr(point)] = letters
    return out


def _letters(char: Column) -> Column:
    """The letters of one character that may be a Hangul syllable or one of ``several_letters``."""
    jamo = lambda block, number: F.substring(F.lit("".join(map(chr, range(block[0], block[0] + block[1])))), number + 1, F.lit(1))
    place, per_lead = F.ascii(char) - SYLLABLES[0], VOWELS[1] * (TAILS[1] + 1)
    lead, tail = F.floor(place / per_lead).cast("int"), place % (TAILS[1] + 1)
    vowel = F.floor(place % per_lead / (TAILS[1] + 1)).cast("int")
    syllable = F.concat(jamo(LEADS, lead), jamo(VOWELS, vowel), F.when(tail > 0, jamo(TAILS, tail - 1)).otherwise(""))
    table = F.create_map(*[F.lit(x) for pair in several_letters().items() for x in pair])
    return F.when(char.between(*map(chr, SYLLABLES)), syllable).otherwise(F.coalesce(F.try_element_at(table, char), char))


def decomposed(text: Column) -> Column:
    """The canonical decomposition of ``text`` without marks of a combining class other than 0, for every script.

    Only texts with a character of several letters are taken apart. No mark that stays is ever
    moved by the decomposition, so characters can be folded one by one.
    """
    folded = F.translate(text, *fold_table())
    several = f"[{chr(SYLLABLES[0])}-{chr(SYLLABLES[1])}{''.join(several_letters())}]"
    return F.when(folded.rlike(several), F.array_join(F.transform(characters(folded), _letters), "")).otherwise(folded)


def normalize_exact(text: Column, language: str | Column | None = None) -> Column:
    """``normalize`` for every script: Hangul by arithmetic, other characters of several letters by a table."""
    return F.lower(decomposed(mapped(text, language)))


def has_accent(text: Column, language: str | Column | None = None) -> Column:
    """Whether folding changes the lower-cased text."""
    return normalize(text, language) != F.lower(text)


def characters(text: Column) -> Column:
    """The characters of a text, in order."""
    return F.filter(F.split(text, ""), lambda c: c != "")


def accented_chars(text: Column, language: str | Column | None = None) -> Column:
    """The characters that folding changes, in order, repeats kept."""
    return F.filter(characters(text), lambda c: normalize(c, language) != F.lower(c))


def word_id(text: Column, language: Column) -> Column:
    """The id of a word: 16 hex digits of a digest of its language and folded text."""
    return F.substring(F.sha1(F.concat(F.lower(language), F.lit("::"), normalize(text))), 1, 16)


def has_foreign_letter(text: Column) -> Column:
    """Whether the text has a letter beyond ASCII."""
    return F.coalesce(text.rlike(r"[\p{L}&&[^\x00-\x7F]]"), F.lit(False))
