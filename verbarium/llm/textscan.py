"""Vectorised words and word hashes over the raw UTF-8 bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes that are scanned at once; bounds the working memory whatever a text's length.
CHUNK = 1 << 20

_MASK = (1 << 64) - 1


def splitmix(x: int) -> int:
    """One step of SplitMix64: constants for the hashes below, equal on every machine."""
    x = (x + 0x9E3779B97F4A7C15) & _MASK
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & _MASK
    return x ^ (x >> 31)


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64 over an array."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words:
    """Splits bytes into words and hashes each word; ``keep`` says which bytes form words."""

    def __init__(self, keep: np.ndarray):
        self.keep = keep
        fold = np.arange(256)
        fold[65:91] += 32
        self.codes = np.array([splitmix(1000 + int(c)) for c in fold], dtype=np.uint64)
        self.base = splitmix(7) | 5
        self._powers(1 << 12)

    def _powers(self, n: int) -> None:
        one = np.ones(n, dtype=np.uint64)
        one[1:] = self.base
        self.power = np.multiply.accumulate(one)
        one[1:] = pow(self.base, -1, 1 << 64)
        self.inverse = np.multiply.accumulate(one)

    def scan(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and hashes of the words of ``buf``; no word crosses an offset."""
        n = len(buf)
        if n == 0:
            none = np.zeros(0, dtype=np.int64)
            return none, none, np.zeros(0, dtype=np.uint64)
        if n > len(self.power):
            self._powers(1 << int(n - 1).bit_length())
        inside = self.keep[buf]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        cut = offsets[(offsets > 0) & (offsets < n)]
        first[cut] = inside[cut]
        last[cut - 1] = inside[cut - 1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self.codes[buf] * self.power[:n], out=total[1:])
        hashes = (total[ends] - total[starts]) * self.inverse[starts]
        return starts, ends, mix(hashes + (ends - starts).astype(np.uint64))

    def cut(self, buf: np.ndarray, at: int) -> int:
        """The first place from ``at`` on that is not inside a word."""
        n = len(buf)
        while at < n:
            gap = np.flatnonzero(~self.keep[buf[at : at + CHUNK]])
            if len(gap):
                return at + int(gap[0])
            at += CHUNK
        return n


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Data bytes and row offsets of a binary or string column; nulls are empty rows."""
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        kind = np.int32
    else:
        kind = np.int64
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or offsets is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(n + 1, dtype=np.int64)
    ends = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def chunks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of about CHUNK bytes each; a longer row is a range of its own."""
    row, n = 0, len(offsets) - 1
    while row < n:
        last = int(np.searchsorted(offsets, offsets[row] + CHUNK, side="right")) - 1
        last = min(max(last, row + 1), n)
        yield row, last
        row = last


def scanned(words: Words, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, word starts, word ends, word hashes, word's row from the first).

    The word positions count from the first byte of the range. A row over CHUNK bytes is
    scanned in pieces, so only its words are held at once.
    """
    raw, offsets = byte_view(column)
    for a, b in chunks(offsets):
        buf = raw[offsets[a] : offsets[b]]
        if len(buf) <= 2 * CHUNK:
            local = offsets[a : b + 1] - offsets[a]
            starts, ends, hashes = words.scan(buf, local)
            row = np.searchsorted(local, starts, side="right") - 1
        else:
            parts, at = [], 0
            while at < len(buf):
                to = words.cut(buf, at + CHUNK)
                s, e, h = words.scan(buf[at:to], np.zeros(0, dtype=np.int64))
                parts.append((s + at, e + at, h))
                at = to
            starts, ends, hashes = (np.concatenate(x) for x in zip(*parts, strict=True))
            row = np.zeros(len(starts), dtype=np.int64)
        yield a, b, buf, starts, ends, hashes, row


def windows(hashes: np.ndarray, size: int, salt: int = 0) -> np.ndarray:
    """Hash of each run of ``size`` consecutive words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        out += hashes[k : k + n] * np.uint64(splitmix(50 + 1000 * salt + 64 * size + k) | 1)
    return mix(out)


def space_separated() -> Words:
    """Words are runs of bytes other than space and 09 to 0D."""
    keep = np.ones(256, dtype=bool)
    keep[[0x20, *range(0x09, 0x0E)]] = False
    return Words(keep)


def alphanumeric() -> Words:
    """Words are runs of ASCII letters and digits and of bytes of other characters."""
    keep = np.ones(256, dtype=bool)
    keep[:128] = False
    keep[48:58] = keep[65:91] = keep[97:123] = True
    return Words(keep)
