"""Quality classifier: positive-unlabelled learning with the non-negative risk."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop, in_batches, sample, small, store
from .textscan import byte_view, scanned, space_separated

#: The model is fitted on so many trusted positives, and so many unlabelled texts, at most, unless told otherwise.
SAMPLE_ROWS = 8000
FOLDS = 5
THRESHOLD = 0.3
#: Shares of the positives above the scores at which the class prior is read.
PRIOR_SHARES = (0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.99)
HIDDEN, STEPS, RATE, SEED = 12, 400, 0.02, 5

# Byte classes of the features.
CLASSES = ("upper", "lower", "digit", "blank", "newline", "stop", "bang", "bar", "symbol", "high")
FEATURES = ("size", "word_mean", "word_spread", "short", "long", "upper", "digit", "newline", "stop", "bang", "bar", "symbol", "high", "repeat", "distinct", "empty")


def _classes() -> np.ndarray:
    out = np.full(256, CLASSES.index("symbol"))
    for name, chars in (("blank", b" \t\r\x0b\x0c"), ("newline", b"\n"), ("stop", b".,;:?'\"()-"), ("bang", b"!"), ("bar", b"|")):
        out[list(chars)] = CLASSES.index(name)
    out[65:91], out[97:123], out[48:58], out[128:] = (CLASSES.index(c) for c in ("upper", "lower", "digit", "high"))
    return out


def features(column: pa.Array) -> np.ndarray:
    """(rows, FEATURES) of whole texts; null is an empty text."""
    out = np.zeros((len(column), len(FEATURES)))
    seen = np.zeros((len(column), len(CLASSES)))
    classes, words = _classes(), space_separated()
    _, offsets = byte_view(column)
    for a, b, buf, starts, ends, hashes, row in scanned(words, column):
        n = b - a
        for at in range(0, len(buf), 1 << 20):  # a long text is counted in pieces
            piece = buf[at : at + (1 << 20)]
            where = np.searchsorted(offsets[a : b + 1] - offsets[a], np.arange(at, at + len(piece)), side="right") - 1
            seen[a:b] += np.bincount(where * len(CLASSES) + classes[piece], minlength=n * len(CLASSES))[: n * len(CLASSES)].reshape(n, -1)
        count = np.bincount(row, minlength=n)
        size = (ends - starts).astype(float)
        held = np.maximum(count, 1)
        mean = np.bincount(row, size, minlength=n) / held
        same = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
        bounds = np.concatenate([[0], np.cumsum(count)])
        distinct = [len(np.unique(hashes[bounds[k] : bounds[k + 1]])) for k in range(n)]
        part = out[a:b]
        part[:, 0] = np.log1p(count)
        part[:, 1] = np.log1p(mean)
        part[:, 2] = np.log1p(np.sqrt(np.maximum(np.bincount(row, size**2, minlength=n) / held - mean**2, 0)))
        part[:, 3] = np.bincount(row, size <= 3, minlength=n) / held
        part[:, 4] = np.bincount(row, size >= 16, minlength=n) / held
        part[:, 13] = np.bincount(row[1:], same, minlength=n) / held
        part[:, 14] = np.log1p(distinct) / np.maximum(np.log1p(count), 1e-9)
        part[:, 15] = count == 0
    named = {c: seen[:, k] for k, c in enumerate(CLASSES)}
    letters = named["upper"] + named["lower"]
    visible = np.maximum(seen.sum(1) - named["blank"] - named["newline"], 1)
    out[:, 5] = named["upper"] / np.maximum(letters, 1)
    for k, name in ((6, "digit"), (8, "stop"), (9, "bang"), (10, "bar"), (11, "symbol"), (12, "high")):
        out[:, k] = np.sqrt(named[name] / visible)
    out[:, 7] = np.sqrt(named["newline"] / visible)
    out[seen.sum(1) == 0, 15] = 1
    return out


@dataclass
class Model:
    """One hidden layer over standardised features."""

    centre: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        z, _ = forward(self.weights, np.clip((x - self.centre) / self.scale, -8, 8))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def forward(weights: list[np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w, b, v, c = weights
    hidden = np.tanh(x @ w + b)
    return hidden @ v + c[0], hidden


def slopes(weights: list[np.ndarray], x: np.ndarray, hidden: np.ndarray, by_output: np.ndarray) -> list[np.ndarray]:
    inner = np.outer(by_output, weights[2]) * (1 - hidden**2)
    return [x.T @ inner, inner.sum(0), hidden.T @ by_output, np.array([by_output.sum()])]


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> Model:
    """Minimise prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)) with the logistic loss.

    Where the estimated risk of the negatives falls below zero, the step goes against it
    instead, as the non-negative estimator prescribes.
    """
    both = np.concatenate([positive, unlabelled])
    centre, scale = both.mean(0), np.maximum(both.std(0), 1e-3)
    p, u = (np.clip((x - centre) / scale, -8, 8) for x in (positive, unlabelled))
    rng = np.random.default_rng(SEED)
    weights = [rng.normal(0, 0.4, (p.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.4, HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, STEPS + 1):
        zp, hp = forward(weights, p)
        zu, hu = forward(weights, u)
        sp, su = 1 / (1 + np.exp(-np.clip(zp, -40, 40))), 1 / (1 + np.exp(-np.clip(zu, -40, 40)))
        negative_risk = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        of_negatives = [a + b for a, b in zip(slopes(weights, u, hu, su / len(u)), slopes(weights, p, hp, -prior * sp / len(p)), strict=True)]
        if negative_risk >= 0:
            total = [a + b for a, b in zip(of_negatives, slopes(weights, p, hp, -prior * (1 - sp) / len(p)), strict=True)]
        else:
            total = [-a for a in of_negatives]
        for k, g in enumerate(total):
            g = g + 1e-4 * weights[k]
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            weights[k] = weights[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Model(centre, scale, weights)


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of positives among the unlabelled, from both and no negatives.

    Above a score that few negatives reach, the unlabelled hold positives only: their share
    above it is the prior times the positives' share. Below, negatives make it larger. So the
    least ratio of the shares over several scores is the prior. Every other row fits the
    scoring model and the rest are counted, so that it doesn't count what it has learnt.
    """
    model = fit(positive[::2], unlabelled[::2], 0.5)
    if len(positive) < 2 or len(unlabelled) < 2:
        return 0.5
    of_p, of_u = np.sort(model.score(positive[1::2])), np.sort(model.score(unlabelled[1::2]))
    ratios = []
    for share in PRIOR_SHARES:
        at = of_p[min(int(len(of_p) * (1 - share)), len(of_p) - 1)]
        above = [1 - np.searchsorted(x, at) / len(x) for x in (of_p, of_u)]
        spread = np.sqrt(max(0, sum((1 - q) / max(q * len(x), 1) for q, x in zip(above, (of_p, of_u), strict=True))))
        ratio = above[1] / above[0]
        ratios.append((ratio * (1 + spread), ratio * (1 - spread)))  # few rows make no ratio the least
    # A deviation low: too high a prior calls negatives positive, too low a one lowers all scores alike.
    return float(np.clip(min(ratios)[1], 0.02, 0.98))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(FOLDS)) == 0, F.lit(False))


def _featured(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(batch.column(1))
            rows = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), rows], names=["kind", "x"])

    return in_batches(docs, run, "kind int, x array<double>")


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """Fit on documents and labels outside the held-out fold; None without a trusted positive.

    Trusted positives are labelled 1, and no other label is used; the unlabelled are documents
    of any kind. Of both, the ``sample_rows`` of smallest id hash are used at most, of rows of
    one doc_id one. The class prior is estimated from these (``class_prior``).
    """
    known = labels.where("doc_id is not null and quality = 1").where(~held_out())
    trusted = sample(known.select("doc_id"), "doc_id", sample_rows, 1).distinct()
    unknown = sample(docs.where("doc_id is not null").where(~held_out()).select("doc_id"), "doc_id", sample_rows, 2).distinct()
    ids = store(trusted.select("doc_id", F.lit(1).alias("kind")).union(unknown.select("doc_id", F.lit(0).alias("kind"))), "quality-sample")
    chosen = docs.select("doc_id", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text")).join(small(ids), "doc_id")
    chosen = chosen.groupBy("kind", "doc_id").agg(F.min("text").alias("text")).select("kind", "text")
    rows = _featured(chosen).collect()  # at most twice sample_rows
    drop(ids)
    kinds = np.array([r["kind"] for r in rows])
    x = np.array([r["x"] for r in rows], dtype=float).reshape(len(rows), len(FEATURES))
    x = x[np.lexsort([*x.T, kinds])]  # the same order, and so the same model, whatever order tasks end in
    kinds = np.sort(kinds)
    positive, unlabelled = x[kinds == 1], x[kinds == 0]
    if not len(positive) or not len(unlabelled):
        return None
    return fit(positive, unlabelled, class_prior(positive, unlabelled))


def _scored(docs: DataFrame, labels: DataFrame, sample_rows: int) -> DataFrame:
    """``row`` (all columns of a document) and its score."""
    model = train(docs, labels, sample_rows)
    packed = docs.select(F.struct("*").alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = pc.struct_field(batch.column(0), "text")
            score = model.score(features(text)) if model else np.ones(batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["row", "score"])

    return in_batches(packed, run, T.StructType([packed.schema["row"], T.StructField("score", T.DoubleType())]))


def score_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with its columns and ``held_out``, ``score`` and ``predicted``.

    ``docs`` needs doc_id and text, ``labels`` doc_id and quality. A text's byte and word
    statistics are its only features; labels, language, source and id are no inputs. The model
    is fitted on ``sample_rows`` trusted positives and as many unlabelled texts at most.

    Defined cases: null and blank texts are scored as empty texts; a null doc_id is not
    held out and is never trained on; labels other than 1 are ignored; with no
    trusted positive every score is 1; repeated rows each get their row; columns of
    ``docs`` named like an added one are replaced.
    """
    added = ("held_out", "score", "predicted")
    own = [F.col(f"row.`{c}`") for c in docs.columns if c not in added]
    return _scored(docs, labels, sample_rows).select(*own, held_out("row.doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs``, as they are, whose score is at least THRESHOLD."""
    return _scored(docs, labels, sample_rows).where(F.col("score") >= THRESHOLD).select("row.*")
