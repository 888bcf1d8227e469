"""Alignment of the tokens of two tokenizers over one text, by their places in bytes."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import in_batches, small, store

#: Ids of either tokenizer are below this.
ID_BITS = 20
IDS = 1 << ID_BITS
#: Most rows of the table of id pairs that is sent to all tasks.
PAIRS = 1_000_000
#: What a worker remembers, twice at most: characters of a unit, units, and their tokens of A.
UNIT, REMEMBERED, TOKENS = 48, 100_000, 1_000_000
#: Units that are encoded as one text.
TOGETHER = 512
#: Characters of the texts that share a list of units, unless one text has more.
CHUNK = 150_000
SIDES = tuple(f"{s}_{c}" for s in "ab" for c in ("ids", "ends", "from"))

# A single space between two characters that are no white space: no token of either
# tokenizer reaches across it, so what comes before and after is encoded by itself.
_CUT = re.compile(r"(?<=[^\s▁]) (?=[^\s▁])")


# Fixed value: how byte-level BPE of this kind cuts a text before it merges.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: From here on libraries may differ in what is a letter; Latin letters are below.
BEYOND = "\u0250"
#: Longest unit for the faster library, whose pattern gives up on some 100,000 blanks and more in a row.
QUICK = 10_000


@dataclass(frozen=True)
class Tokenizers:
    """Files of the two tokenizers: a byte-level BPE (JSON) and a sentence-piece model."""

    byte_bpe: str = "/opt/tokenizers/byte_bpe_50k.json"
    piece_bpe: str = "/opt/tokenizers/piece_bpe_32k.model"


def byte_letters() -> dict[str, int]:
    """The byte of each letter of a byte-level vocabulary: printable Latin-1 stands for itself, the rest follows from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(others)}


class Encoder:
    """Both tokenizers in one worker, with the bytes of every token and what is known of the last units."""

    def __init__(self, files: Tokenizers) -> None:
        from sentencepiece import SentencePieceProcessor

        self.files, self.whole = files, None
        with open(files.byte_bpe, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters = byte_letters()
        self.a_bytes = [b""] * (max(model["vocab"].values()) + 1)
        for word, k in model["vocab"].items():
            self.a_bytes[k] = bytes(letters[c] for c in word) if all(c in letters for c in word) else b""
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        # In a vocabulary in the order of its merges, ids are the ranks that the faster library takes.
        ranked = all(model["vocab"].get(x + y) == 256 + k for k, (x, y) in enumerate(merges))
        self.fast = None
        if ranked:
            import tiktoken

            self.fast = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks={x: k for k, x in enumerate(self.a_bytes[: 256 + len(merges)])}, special_tokens={})
        self.b = SentencePieceProcessor(model_file=files.piece_bpe)
        pieces = [(self.b.is_byte(k), self.b.id_to_piece(k)) for k in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if raw else p.replace("▁", " ").encode() for raw, p in pieces]
        if any(re.search("[^▁]▁", p) for _, p in pieces):
            raise ValueError("a piece reaches across a word's start")
        if max(len(self.a_bytes), len(self.b_bytes)) > IDS:
            raise ValueError(f"ids must be below {IDS}")
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in y], dtype=np.int64) for y in (self.a_bytes, self.b_bytes))
        self.known, self.older = Known(), Known()

    def by_a(self, units: list[str]) -> list[list[int]]:
        """A's ids of a space and each unit: of plain letters and signs by the faster library, which cuts those alike."""
        plain = [self.fast is not None and len(u) <= QUICK and max(u) < BEYOND for u in units]
        quick = (self.fast.encode_ordinary(" " + u) for u, p in zip(units, plain, strict=True) if p)
        rest = [" " + u for u, p in zip(units, plain, strict=True) if not p]
        if rest and self.whole is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(self.files.byte_bpe)
            self.whole.encode_special_tokens = True  # their strings in a text are ordinary text
        slow = iter([e.ids for e in self.whole.encode_batch_fast(rest, add_special_tokens=False)] if rest else ())
        return [next(quick if p else slow) for p in plain]

    def _joined(self, units: list[str]) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """For both sides the ids of all units, encoded as one text, and each unit's number of tokens; None if one isn't spelt.

        Units begin and end with characters that are no white space, so no token reaches from one into the next.
        """
        line = " ".join(units)
        text = b" " + line.encode()
        lengths = np.array([len(u.encode()) for u in units] if len(text) > len(line) + 1 else [len(u) for u in units], np.int64)
        unit_ends, sides = np.cumsum(lengths + 1), []
        for ids, spelling, sizes in ((self.fast.encode_ordinary(" " + line), self.a_bytes, self.a_sizes), (self.b.encode(line), self.b_bytes, self.b_sizes)):
            if b"".join([spelling[k] for k in ids]) != text:
                return None
            found = np.array(ids, np.int64)
            ends = np.cumsum(sizes[found])
            to = np.searchsorted(ends, unit_ends)
            if (ends[to] != unit_ends).any():
                return None
            sides.append((found, np.diff(to + 1, prepend=0)))
        return sides

    def learn(self, units: Iterable[str]) -> None:
        """Encodes and aligns those of some distinct units that aren't known."""
        known, older = self.known, self.older.number
        new = [u for u in units if u not in known.number and u not in known.wrong]
        known.copy(self.older, [u for u in new if u in older])
        new = [u for u in new if u not in older]
        single, done, sides = [], [], ([], [])
        together = []
        for u in new:
            quick = self.fast is not None and len(u) <= QUICK and (u.isascii() or max(u) < BEYOND)
            (together if quick and not (u[0].isspace() or u[-1].isspace()) else single).append(u)
        for k in range(0, len(together), TOGETHER):
            piece = together[k : k + TOGETHER]
            found = self._joined(piece)
            if found is None:
                single += piece
                continue
            done += piece
            for side, x in zip(sides, found, strict=True):
                side.append(x)
        if single:
            alone = ([], [])
            for u, a, b in zip(single, self.by_a(single), self.b.encode(single, num_threads=1), strict=True):
                text = b" " + u.encode()
                if b"".join([self.a_bytes[x] for x in a]) == text == b"".join([self.b_bytes[x] for x in b]):
                    done.append(u)
                    alone[0].append(a)
                    alone[1].append(b)
                else:
                    known.wrong.add(u)
            for side, lists in zip(sides, alone, strict=True):
                side.append((np.array(list(chain.from_iterable(lists)), np.int64), np.array([len(x) for x in lists], np.int64)))
        if done:
            (a, n_a), (b, n_b) = ([np.concatenate(x) for x in zip(*side, strict=True)] for side in sides)
            known.add(done, (a, n_a, np.cumsum(self.a_sizes[a])), (b, n_b, np.cumsum(self.b_sizes[b])))

    def chunk(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The texts as numbers of known units, which both tokenizers encode by themselves and spell exactly: all numbers, and how many each text has."""
        if len(self.known) + len(self.known.wrong) > REMEMBERED or self.known.ids[0].n > TOKENS:
            self.known, self.older = Known(), self.known
        split = [_CUT.split(t) if t else [] for t in texts]
        self.learn(dict.fromkeys(chain.from_iterable(split)))
        wrong = self.known.wrong
        if wrong:  # such a text is a unit as a whole, or has no tokens
            for k in [k for k, x in enumerate(split) if not wrong.isdisjoint(x)]:
                self.learn([texts[k]])
                split[k] = [] if texts[k] in wrong else [texts[k]]
        numbers = np.fromiter(map(self.known.number.__getitem__, chain.from_iterable(split)), np.int64)
        self.known.forget_long()
        return numbers, np.array([len(x) for x in split], np.int64)


class Grown:
    """An array that grows at its end."""

    def __init__(self) -> None:
        self.held, self.n = np.zeros(1 << 12, np.int64), 0

    def extend(self, values: np.ndarray) -> None:
        if self.n + len(values) > len(self.held):
            self.held = np.concatenate([self.held[: self.n], np.zeros(self.n + 2 * len(values), np.int64)])
        self.held[self.n : self.n + len(values)] = values
        self.n += len(values)


class Ranges:
    """Lists of numbers, one after another."""

    def __init__(self) -> None:
        self.values, self.start, self.size = Grown(), Grown(), Grown()

    @property
    def n(self) -> int:
        return self.values.n

    def extend(self, values: np.ndarray, sizes: np.ndarray) -> None:
        self.start.extend(self.values.n + np.cumsum(sizes) - sizes)
        self.size.extend(sizes)
        self.values.extend(values)

    def take(self, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of these lists in turn, and where each list's begin, with the number of all."""
        size = self.size.held[lists]
        places = np.concatenate([[0], np.cumsum(size)])
        return self.values.held[np.repeat(self.start.held[lists] - places[:-1], size) + np.arange(places[-1])], places


class Known:
    """What a worker knows of units: their numbers, and by number the ids of both sides, links, and groups as text and number."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.wrong: set[str] = set()
        self.long: list[str] = []
        self.ids, self.links, self.groups, self.n_groups = (Ranges(), Ranges()), Ranges(), [], Grown()

    def __iter__(self) -> Iterator[str]:
        return iter(self.number)

    def __len__(self) -> int:
        return len(self.number)

    def _name(self, units: list[str]) -> None:
        self.number.update(zip(units, range(len(self.groups), len(self.groups) + len(units)), strict=True))
        self.long += [u for u in units if len(u) > UNIT]

    def forget_long(self) -> None:
        """Long units lose their names; a text that is worked on still has their numbers."""
        for u in self.long:
            del self.number[u]
        self.long = []

    def copy(self, other: Known, units: list[str]) -> None:
        """What ``other`` knows of ``units``."""
        lists = np.array([other.number[u] for u in units], np.int64)
        self._name(units)
        for kept, found in zip((*self.ids, self.links), (*other.ids, other.links), strict=True):
            values, places = found.take(lists)
            kept.extend(values, np.diff(places))
        self.groups += [other.groups[k] for k in lists.tolist()]
        self.n_groups.extend(other.n_groups.held[lists])

    def add(self, units: list[str], *sides: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
        """New units with the [ids, number of tokens, ends] of both sides."""
        self._name(units)
        for kept, (ids, count, _) in zip(self.ids, sides, strict=True):
            kept.extend(ids, count)
        links, sizes, text, n_groups = _units(*sides)
        self.links.extend(links, sizes)
        self.groups += text
        self.n_groups.extend(n_groups)


@lru_cache(maxsize=1)
def _encoder(files: Tokenizers) -> Encoder:
    return Encoder(files)


def _tokenized(files: Tokenizers):
    """The rows of ``tokenize``, from batches of doc_id and text."""

    def listed(values: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values.astype(np.int32)))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(files)
        for doc_ids, texts in _chunks(batches):
            units, counts = encoder.chunk(texts)
            distinct, units = np.unique(units, return_inverse=True)
            places = np.concatenate([[0], np.cumsum(counts)])
            sides, sums = [], []
            for kept, sizes in zip(encoder.known.ids, (encoder.a_sizes, encoder.b_sizes), strict=True):
                ids, start = kept.take(distinct)
                sides += [ids, np.cumsum(sizes[ids]), start]
                sums.append(pa.array(np.diff(np.concatenate([[0], np.cumsum(np.diff(start)[units])])[places])))
            of_docs = [doc_ids, pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), pa.array(units.astype(np.int32))), *sums]
            docs_list = pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), pa.StructArray.from_arrays(of_docs, ["doc_id", "units", "n_a", "n_b"]))
            yield pa.record_batch([docs_list, *map(listed, sides)], names=["docs", *SIDES])

    return rows


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str | None]]]:
    """doc_id and text of some documents at once."""
    for batch in batches:
        texts, start, held = batch.column("text").to_pylist(), 0, 0
        for k, text in enumerate(texts):
            if held and held + len(text or "") > CHUNK:
                yield batch.column("doc_id").slice(start, k - start), texts[start:k]
                start, held = k, 0
            held += len(text or "")
        yield batch.column("doc_id").slice(start), texts[start:]


def tokenize(docs: DataFrame, files: Tokenizers = Tokenizers()) -> DataFrame:  # noqa: B008 - frozen
    """The tokens of a space and each text, by both tokenizers.

    A row has some documents (``docs``: doc_id, units, n_a, n_b) and each of their distinct
    units once: units, mostly words, are the least pieces that both tokenizers encode by
    themselves, and a text is a list of their numbers. For a side s, ``s_ids`` and ``s_ends``
    are the tokens of all units in turn with their end offsets in bytes, ``s_from`` the place
    where each unit's tokens start (and the number of all). A text that is null or empty, or
    that the tokens of one side don't spell (which a model that changes characters can't), has no units.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    one = f"docs array<struct<doc_id:{id_type},units:array<int>,n_a:bigint,n_b:bigint>>"
    return in_batches(docs.select("doc_id", "text"), _tokenized(files), ", ".join([one, *(f"{c} array<int>" for c in SIDES)]))


@lru_cache
def _names(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The digits of each id of so many bits, as the bytes of a 64-bit number, and how many they are."""
    digits = np.array([str(k) for k in range(1 << bits)], "S8")
    return digits.view("<u8"), np.char.str_len(digits).astype(np.int64)


def _units(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
    """From [ids, number of each unit's tokens, ends] of both sides of some units: links, each unit's number of them, and its groups as text and number.

    Between two ends that follow each other, of whichever side, lies a part of one token of A and one
    of B, and two tokens that overlap have one such part in common: a part is a link.
    """
    (a_ids, a_count, a_ends), (b_ids, b_count, b_ends) = a, b
    ends = np.sort(np.concatenate([a_ends, b_ends]), kind="stable")
    ends = ends[np.diff(ends, prepend=0) > 0]
    i, j = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
    links = a_ids[i] * IDS + b_ids[j]
    common = ends[(a_ends[i] == ends) & (b_ends[j] == ends)]
    unit_ends = a_ends[np.cumsum(a_count) - 1]
    sizes, n_groups = (np.diff(np.searchsorted(x, unit_ends, side="right"), prepend=0) for x in (ends, common))
    # The tokens of both sides in the order of the text that names them: by groups, there A's before B's.
    of_a, of_b = np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)
    place_a = np.arange(len(a_ids)) + np.searchsorted(of_b, of_a)
    place_b = np.arange(len(b_ids)) + np.searchsorted(of_a, of_b, side="right")
    ids, sign = np.empty(len(a_ids) + len(b_ids), np.int64), np.empty(len(a_ids) + len(b_ids), np.uint64)
    ids[place_a], ids[place_b] = a_ids, b_ids
    for place, group, last in ((place_a, of_a, "|"), (place_b, of_b, ";")):
        sign[place] = np.where(np.diff(group, append=-1) == 0, ord(","), ord(last))
    digits, lengths = _names(int(ids.max()).bit_length())
    length = lengths[ids]
    named = (digits[ids] | sign << (8 * length).astype(np.uint64)).view(np.uint8)
    text = named[named != 0].tobytes().decode()
    bounds = np.concatenate([[0], np.cumsum(length + 1)])[np.cumsum(a_count + b_count)].tolist()
    return links, sizes, [text[x : y - 1] for x, y in zip([0, *bounds], bounds, strict=False)], n_groups


def align(docs: DataFrame, files: Tokenizers = Tokenizers()) -> DataFrame:  # noqa: B008 - frozen
    """A row per document: doc_id, n_a, n_b, n_groups, ``groups`` (as text) and ``links`` (a * IDS + b).

    Groups are what lies between the offsets at which tokens of both sides end. They are
    written ``a1,a2|b1;a3|b2,b3``, in order; links are in the order of the text. Both are made
    once for each unit that a worker meets and remembers, over the tokens of many units at once, and then put
    together for every text.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(files)
        for doc_ids, texts in _chunks(batches):
            units, counts = encoder.chunk(texts)
            known, places = encoder.known, np.concatenate([[0], np.cumsum(counts)])
            summed = lambda values: pa.array(np.diff(np.concatenate([[0], np.cumsum(values.held[units])])[places]))  # noqa: B023, E731
            links, starts = known.links.take(units)
            parts, bounds = list(map(known.groups.__getitem__, units.tolist())), places.tolist()
            groups = pa.array([";".join(parts[x:y]) for x, y in zip(bounds, bounds[1:], strict=False)], pa.string())
            columns = [doc_ids, *(summed(x.size) for x in known.ids), summed(known.n_groups), groups, pa.ListArray.from_arrays(pa.array(starts[places].astype(np.int32)), pa.array(links))]
            yield pa.record_batch(columns, names=names)

    columns = {"doc_id": id_type, "n_a": "long", "n_b": "long", "n_groups": "long", "groups": "string", "links": "array<long>"}
    names = list(columns)
    return in_batches(docs.select("doc_id", "text"), rows, ", ".join(f"{n} {t}" for n, t in columns.items()))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): how many rows of ``aligned`` hold each linked pair, and whether no pair of its A id has more."""
    counted = aligned.select(F.explode(F.array_distinct("links")).alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    own = W.partitionBy(F.shiftright("pair", ID_BITS))
    return counted.withColumn("best", F.col("n") == F.max("n").over(own))


def report(docs: DataFrame, files: Tokenizers = Tokenizers()) -> DataFrame:  # noqa: B008 - frozen
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    ``docs`` has doc_id and text; other columns count for nothing. Texts without tokens have
    zeros and an empty digest; rows that repeat a doc_id count each. No documents give no rows.

    Links are written once, as numbers, and read twice: for the counts and to add them up.
    The table of pairs is bounded by the vocabularies; it is sent to all tasks while it is small
    enough, so links aren't shuffled, and joined by shuffle beyond that, once per row and pair.
    """
    aligned = align(docs, files)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    rows = store(aligned.withColumns({"n_links": F.size("links").cast("long"), "groups_sha256": digest, "_row": F.monotonically_increasing_id()}).drop("groups"), "alignment")
    pairs = store(pair_counts(rows), "alignment-pairs")
    listed = small(pairs, PAIRS)
    links = rows.select("_row", F.explode("links").alias("pair"))
    if listed is pairs:
        links = links.groupBy("_row", "pair").agg(F.count("*").alias("times"))
    else:
        links = links.withColumn("times", F.lit(1).cast("long"))
    sums = links.join(listed, "pair").groupBy("_row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("times")).alias("count_sum"))
    none = F.lit(0).cast("long")
    out = rows.select("_row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(sums, "_row", "left")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", none).alias("n_best"), F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256")
