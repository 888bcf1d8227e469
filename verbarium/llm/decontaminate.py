"""Benchmark decontamination: windows of test words looked up in training texts."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, in_batches, store
from .textscan import alphanumeric, byte_view, scanned, windows

#: Bytes of benchmark text whose windows one broadcast holds, some 50 bytes a word; a larger
#: benchmark is looked up slice by slice, each by a scan of its own.
SLICE_BYTES = 8 << 20
#: Longer items are cut into parts of about so many bytes, each with the last words of the one before.
PART_BYTES = 1 << 20
#: Most bits of the first-stage table over window hashes.
TABLE_BITS = 24


class Windows:
    """The windows of benchmark items: ``size`` consecutive words, or all of a shorter item.

    For each length the distinct windows are held sorted by hash, each with the place of its
    first word in the lower-cased texts and the range of its items in a list: a window that
    many items share is confirmed once.
    """

    def __init__(self, items: list[tuple[str, bytes]], size: int):
        scanner = alphanumeric()
        self.words = alphanumeric()  # of its own, without the tables that this scan makes
        self.items = sorted({i for i, _ in items})
        number = {name: k for k, name in enumerate(self.items)}
        texts, starts, ends, hashes, rows, base = [], [], [], [], [], 0
        for a, _, buf, s, e, h, row in scanned(scanner, pa.array([t for _, t in items], pa.large_binary())):
            texts.append(buf.tobytes().lower())
            starts.append((s + base).astype(np.int32))
            ends.append((e + base).astype(np.int32))
            hashes.append(h)
            rows.append((row + a).astype(np.int32))
            base += len(buf)
        self.raw = b"".join(texts)
        joined = lambda parts, kind: np.concatenate([*parts, np.zeros(0, dtype=kind)])
        self.starts, self.ends, row = joined(starts, np.int32), joined(ends, np.int32), joined(rows, np.int32)
        words, owner = joined(hashes, np.uint64), np.array([number[i] for i, _ in items], dtype=np.int32)
        count = np.bincount(row, minlength=len(items))
        first = np.concatenate([[0], np.cumsum(count)])
        named = pa.array([self.raw[s:e] for s, e in zip(self.starts.tolist(), self.ends.tolist(), strict=True)], pa.binary()).dictionary_encode()
        numbers = named.indices.to_numpy().astype(np.int32)  # equal words have equal numbers
        self.known = {}
        for n in sorted({min(size, int(c)) for c in np.unique(count) if c}):
            h = windows(words, n)
            if n < size:
                at = first[np.flatnonzero(count == n)]
            else:
                at = np.flatnonzero(row[: len(h)] == row[n - 1 :])
            self.known[n] = self._listed(h[at], at.astype(np.int32), owner[row[at]], numbers, n)

    @staticmethod
    def _listed(h: np.ndarray, at: np.ndarray, item: np.ndarray, numbers: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
        order = np.lexsort((item, h))
        h, at, item = h[order], at[order], item[order]
        other = np.flatnonzero((h[1:] == h[:-1]) & np.any([numbers[at[1:] + i] != numbers[at[:-1] + i] for i in range(n)], axis=0))
        if len(other):  # unlike windows of one hash: by their words too
            order = np.lexsort((item, *(numbers[at + i] for i in range(n)), h))
            h, at, item = h[order], at[order], item[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | np.any([numbers[at[1:] + i] != numbers[at[:-1] + i] for i in range(n)], axis=0)
        kept = new.copy()
        kept[1:] |= item[1:] != item[:-1]
        owned = np.concatenate([np.cumsum(kept)[new] - 1, [kept.sum()]]).astype(np.int32)
        item, h, at = item[kept], h[new], at[new]
        bits = min(TABLE_BITS, max(12, len(h).bit_length() + 4))
        table = np.zeros(1 << bits, dtype=bool)
        table[h >> np.uint64(64 - bits)] = True
        return h, at, owned, item, table, np.uint64(64 - bits)

    def find(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, words: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, dict[int, np.ndarray]]:
        """Which words are inside an occurrence, and the items by row."""
        hit, met = np.zeros(len(words), dtype=bool), defaultdict(set)
        for n, (known, place, _, _, table, shift) in self.known.items():
            h = windows(words, n)
            at = np.flatnonzero(table[h >> shift])
            at = at[row[at] == row[at + n - 1]]
            lo, hi = np.searchsorted(known, h[at], side="left"), np.searchsorted(known, h[at], side="right")
            for j in np.flatnonzero(lo < hi).tolist():
                k = int(at[j])
                text = [buf[starts[w] : ends[w]].tobytes().lower() for w in range(k, k + n)]
                for e in range(int(lo[j]), int(hi[j])):  # the words themselves confirm; several windows of one hash are rare
                    w = int(place[e])
                    if all(self.raw[self.starts[w + i] : self.ends[w + i]] == text[i] for i in range(n)):
                        hit[k : k + n] = True
                        met[int(row[k])].add((n, e))
                        break
        owners = lambda n, e: self.known[n][3][self.known[n][2][e] : self.known[n][2][e + 1]]
        return hit, {k: np.unique(np.concatenate([owners(n, e) for n, e in sorted(found)])) for k, found in met.items()}


def _parts(size: int):
    """Cuts long texts of (item_id, text) at words, so that every window is whole in some part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                text = batch.column(1).slice(k, 1)
                raw = text[0].as_py()
                if len(raw) > PART_BYTES:
                    _, _, _, starts, ends, _, _ = next(scanned(alphanumeric(), text))
                    pieces, w = [], 0
                    while w < len(starts):
                        last = max(int(np.searchsorted(starts, starts[w] + PART_BYTES)), w + size)
                        pieces.append(raw[starts[w] : ends[min(last, len(ends)) - 1]])
                        if last >= len(starts):
                            break
                        w = last - size + 1
                else:
                    pieces = [raw]
                yield pa.RecordBatch.from_arrays([pa.array([batch.column(0)[k].as_py()] * len(pieces), pa.string()), pa.array(pieces, pa.binary())], names=["item_id", "text"])

    return run


def kept_text(raw: bytes, starts: list[int], ends: list[int], hit: list[bool]) -> bytes:
    """``raw`` without its hit spans, from the first hit word's start to the last one's end."""
    out, at, k = [], 0, 0
    while k < len(hit):
        if hit[k]:
            out.append(raw[at : starts[k]])
            while k + 1 < len(hit) and hit[k + 1]:
                k += 1
            at = ends[k]
        k += 1
    return b"".join([*out, raw[at:]])


#: What passes from slice to slice: the document, its hit words as ends of runs, its items.
STATE = "_row {row}, _runs array<int>, _items array<string>"
REPORT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def _scanner(shared, last: str | None):
    """The batch function of one slice; ``last`` is what the final slice returns."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        found: Windows = shared.value
        row_column, before, before_items = (batch.column(k) for k in range(3))
        text = pc.struct_field(row_column, "text")
        raw, offsets = byte_view(text)
        total, runs, items, cleaned = [0] * batch.num_rows, before.to_pylist(), before_items.to_pylist(), {}
        for a, b, buf, starts, ends, words, row in scanned(found.words, text):
            bounds = np.searchsorted(row, np.arange(b - a + 1))
            total[a:b] = np.diff(bounds).tolist()
            if not len(words):
                continue
            hit, owners = found.find(buf, starts, ends, words, row)
            for k in owners:
                items[a + k] = sorted({*items[a + k], *(found.items[i] for i in owners[k])})
            for k in sorted({*owners, *(k for k in range(b - a) if runs[a + k])}):
                lo, hi = int(bounds[k]), int(bounds[k + 1])
                mine = hit[lo:hi]
                for s, e in zip(runs[a + k][::2], runs[a + k][1::2], strict=True):
                    mine[s:e] = True
                runs[a + k] = np.flatnonzero(np.diff(mine, prepend=False, append=False)).tolist()
                if last == "spans":
                    base = int(offsets[a + k] - offsets[a])
                    cleaned[a + k] = kept_text(raw[offsets[a + k] : offsets[a + k + 1]].tobytes(), (starts[lo:hi] - base).tolist(), (ends[lo:hi] - base).tolist(), mine.tolist())
        if last == "report":
            n_hit = [sum(x[1::2]) - sum(x[::2]) for x in runs]
            shas = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]
            columns = [pc.struct_field(row_column, "doc_id"), pa.array(total, pa.int64()), pa.array(n_hit, pa.int64()), pa.array([len(x) for x in items], pa.int64()), pa.array(shas, pa.string()), pa.array([x > 0 for x in n_hit], pa.bool_())]
            return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in REPORT.split(", ")])
        if cleaned:
            kind = row_column.type
            fields = [pc.struct_field(row_column, f.name) for f in kind]
            texts = [cleaned[k].decode() if k in cleaned else text[k].as_py() for k in range(batch.num_rows)]
            fields = [pa.array(texts, f.type) if f.name == "text" else x for f, x in zip(kind, fields, strict=True)]
            row_column = pa.StructArray.from_arrays(fields, fields=list(kind))
        return pa.RecordBatch.from_arrays([row_column, pa.array(runs, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))], names=["_row", "_runs", "_items"])

    return lambda batches: map(one, batches)


def _scan(docs: DataFrame, benchmark: DataFrame, columns: list[str], size: int, last: str) -> DataFrame:
    spark = docs.sparkSession
    texts = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.encode("text", "UTF-8").alias("text")).where("item_id is not null and text is not null")
    texts = store(in_batches(texts.distinct(), _parts(size), "item_id string, text binary"), "decontaminate-items")
    total, count = texts.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)), F.count("*")).first()
    slices = 1 + int(total) // SLICE_BYTES
    mine = lambda: F.pmod(F.xxhash64("item_id", "text"), F.lit(slices))
    # Rows are distinct, so more slices part any that got too many; only a window of huge words stays over the bound.
    while slices < count and texts.groupBy(mine().alias("slice")).agg(F.sum(F.length("text")).alias("n")).agg(F.max("n")).first()[0] > 2 * SLICE_BYTES + PART_BYTES:
        slices *= 2
    state = docs.select(F.struct(*columns).alias("_row"), F.array().cast("array<int>").alias("_runs"), F.array().cast("array<string>").alias("_items"))
    schema = STATE.format(row=state.schema["_row"].dataType.simpleString())
    before = None
    for k in range(slices):
        sliced = texts if slices == 1 else texts.where(mine() == k)
        items = [(r["item_id"], bytes(r["text"])) for r in sliced.distinct().collect()]  # at most 2 * SLICE_BYTES + PART_BYTES
        final = k == slices - 1
        scanner = _scanner(spark.sparkContext.broadcast(Windows(items, size)), last if final else None)
        state = in_batches(state, scanner, REPORT if final and last == "report" else schema)
        if not final:
            state = store(state, "decontaminate-slice")
            if before is not None:
                drop(before)
            before = state
    drop(texts)
    return state


def report(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """Where benchmark text occurs in the documents.

    ``docs`` needs doc_id and text, ``benchmark`` item_id and text; other columns are
    ignored. Words are runs of lower-cased ASCII letters, digits and characters beyond
    ASCII. A window is ``size`` consecutive words of an item, or all words of a shorter
    one. Every task holds the windows of a bounded slice of the benchmark by their hashes, looks up
    each window of its documents and confirms a hit by the words themselves; a benchmark
    over SLICE_BYTES is scanned slice by slice, and a longer item in overlapping parts.

    Defined cases: null and empty texts have no words and no hits; items without words or
    with a null item_id never hit; equal items each count, rows of one item_id as one; repeated documents each give their row.

    Returns doc_id, n_words, n_hit (words inside an occurrence), n_items (items with an
    occurrence), items_sha256 (of their ids, sorted as strings, comma-joined), contaminated.
    """
    return _scan(docs, benchmark, [F.col("doc_id").cast("long").alias("doc_id"), F.col("text")], size, "report")


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", size: int = 10) -> DataFrame:
    """``docs`` without the documents that hold benchmark windows, or without those spans.

    ``remove`` is ``documents`` or ``spans``; a span is removed from its first word's start
    to its last word's end. Columns and other texts stay as they are. Cases as in ``report``.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove is documents or spans, not {remove}")
    state = _scan(docs, benchmark, [F.col(f"`{c}`") for c in docs.columns], size, remove)
    if remove == "documents":
        state = state.where(F.size("_runs") == 0)
    return state.select("_row.*")
