"""Secret scans: keyword automaton, anchored patterns near its hits, embedded checksums."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import in_batches
from .textscan import byte_view

# The keywords and patterns of the kinds.
ASSIGN = rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = rb"AKIA[A-Z0-9]+"
HEX = rb"[0-9a-f]+"
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
CHECKED = rb"(?:gh[pousr]|npm)_[A-Za-z0-9]{36}(?![A-Za-z0-9])"
CHECKED_WORDS = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")
KINDS = ("assign", "access", "hex", "checked")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, n_checked long, base_sha256 string, spans string"


def checksum_holds(token: bytes) -> bool:
    """Whether the last six characters are the base-62 CRC-32 of the thirty before them."""
    body, given = token[4:-6], token[-6:].decode()
    value, digits = zlib.crc32(body), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits == given


class Scanner:
    """Finds the secrets of one text, given as UTF-8 bytes."""

    def __init__(self) -> None:
        self.assign = re.compile(ASSIGN, re.IGNORECASE)
        self.access, self.checked = re.compile(ACCESS), re.compile(CHECKED)
        self.hex = re.compile(HEX)
        self.automaton = ahocorasick.Automaton()
        for kind, words in (("assign", ASSIGN_WORDS), ("access", ("akia",)), ("checked", CHECKED_WORDS)):
            for word in words:
                self.automaton.add_word(word, (kind, len(word)))
        self.automaton.make_automaton()
        self.is_hex = np.zeros(256, dtype=bool)
        self.is_hex[[*range(48, 58), *range(97, 103)]] = True

    def hex_runs(self, raw: bytes) -> Iterator[tuple[str, int, int]]:
        """Runs of at least LEAST_HEX digits: each covers a multiple of that length."""
        probes = np.frombuffer(raw, dtype=np.uint8)[LEAST_HEX - 1 :: LEAST_HEX]
        done = 0
        for k in np.flatnonzero(self.is_hex[probes]):
            at = int(k) * LEAST_HEX + LEAST_HEX - 1
            if at < done:
                continue
            start = at
            while start > done and self.is_hex[raw[start - 1]]:
                start -= 1
            done = self.hex.match(raw, start).end()
            if done - start >= LEAST_HEX:
                yield "hex", start, done

    def scan(self, raw: bytes) -> list[tuple[str, int, int]]:
        """Spans (kind, start, end) in bytes, by start and then kind."""
        spans, hits = list(self.hex_runs(raw)), []
        for last, (kind, n) in self.automaton.iter(raw.lower().decode("latin-1")):
            hits.append((last - n + 1, kind))
        ended = dict.fromkeys(KINDS, 0)
        for start, kind in sorted(hits):
            if start < ended[kind]:
                continue
            found = getattr(self, kind).match(raw, start)
            if not found:
                continue
            ended[kind] = found.end()
            if kind == "assign":
                holds = len(found[2]) >= LEAST_ASSIGN
            elif kind == "access":
                holds = len(found[0]) >= LEAST_ACCESS
            else:
                holds = checksum_holds(found[0])
            if holds:
                spans.append((kind, start, found.end()))
        return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def in_characters(raw: bytes, spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Byte positions turned into code points."""
    if not spans or raw.isascii():
        return spans
    heads = np.cumsum((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80)
    at = lambda k: int(heads[k - 1]) if k else 0
    return [(kind, at(start), at(end)) for kind, start, end in spans]


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scanner = Scanner()
    for batch in batches:
        data, offsets = byte_view(batch.column(1))
        rows = []
        for k in range(batch.num_rows):
            raw = data[offsets[k] : offsets[k + 1]].tobytes()
            spans = in_characters(raw, scanner.scan(raw))
            base = joined([s for s in spans if s[0] != "checked"])
            count = {kind: sum(s[0] == kind for s in spans) for kind in KINDS}
            rows.append((*(count[kind] for kind in KINDS), hashlib.sha256(base.encode()).hexdigest(), joined(spans)))
        columns = list(zip(*rows, strict=True)) or [()] * 6
        kinds = [pa.int64()] * 4 + [pa.string()] * 2
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names=names)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Spans of secrets in every text.

    ``docs`` needs doc_id and text; other columns are ignored. An Aho-Corasick automaton
    over the keywords runs once over the lower-cased bytes; the pattern of a kind is tried
    only anchored at that kind's hits, left to right and not inside an earlier match, which
    gives its leftmost non-overlapping matches. Hex runs have no keyword: every run long
    enough covers a multiple of the least length, so only those places are looked at.
    ``checked`` spans are tokens whose own checksum holds.

    Defined cases: null and empty texts have no spans (counts 0, the digest of an empty
    string, empty spans); repeated rows each give their row; positions are code points.

    Returns doc_id, n_assign, n_access, n_hex, n_checked, base_sha256, spans.
    """
    columns = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as binary) text")
    return in_batches(columns, _scan_batches, SCHEMA)
