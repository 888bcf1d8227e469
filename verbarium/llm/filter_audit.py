"""Filter interaction audit: what each order of some filters keeps and removes, step by step."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import UPPER, store

#: The last filter: a text that a smaller doc_id has too.
REPEATED = "E"
#: Parts whose rows are made at once.
PARTS = 64
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def text_filters(text: Column) -> dict[str, Column]:
    """The failure conditions of filters A to D over a text that isn't null."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    count, distinct = F.size(words).cast("long"), F.size(F.array_distinct(words)).cast("long")
    capitals = F.regexp_count(text, F.lit(f"[{UPPER[0]}-{UPPER[-1]}]")).cast("long")
    return {
        "A": count < 200,
        "B": 100 * distinct < 50 * count,
        "C": 100 * capitals > 3 * F.length(text).cast("long"),
        "D": text.rlike(r"[#$%&*|]"),
    }


def matrices(filters: int) -> dict[str, np.ndarray]:
    """0/1 matrices of all masks by all steps of all orders, the orders one after another.

    Bit f of a mask says that a document fails filter f. A column is a step of an order; its
    entries say for each mask what becomes of such a document there.
    """
    mask = np.arange(1 << filters)[:, None]
    order = np.array(list(permutations(range(filters))))
    bit = 1 << order
    before = (np.cumsum(bit, axis=1) - bit).reshape(1, -1)
    bit = bit.reshape(1, -1)
    fails, gone = (mask & bit) != 0, (mask & before) != 0
    out = {"kept": (mask & (before | bit)) == 0, "removed": fails & ~gone, "redundant": fails & gone, "unique_fails": mask == bit}
    return {name: x.astype(np.int64) for name, x in out.items()}


def histograms(docs: DataFrame, labels: DataFrame, filters: Mapping[str, Column] | None = None) -> DataFrame:
    """(part, mask, n, good, toxic): the documents of each part by the set of filters that they fail.

    Bit k of ``mask`` is the k-th of ``filters`` (text_filters), and the last one REPEATED.
    Texts are equal if their SHA-256 and length are. Of the documents of a text those with the
    smallest doc_id pass REPEATED: they are found by a join on (text, doc_id), so that a text
    of which there are many copies isn't one key. A null doc_id is smaller than none and has
    none smaller.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    conditions = list((filters or text_filters(text)).values())
    mask = sum((c.cast("int") * (1 << k) for k, c in enumerate(conditions)), F.lit(0))
    digest = F.concat(F.unhex(F.sha2(text, 256)), F.to_binary(F.hex(F.octet_length(text)), F.lit("hex")))
    rows = store(docs.select("doc_id", F.coalesce(F.col("lang"), F.lit("")).alias("part"), mask.alias("mask"), digest.alias("digest")), "filter-masks")
    first = rows.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("_first", F.lit(True))
    labelled = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    joined = rows.join(first, ["digest", "doc_id"], "left").join(labelled, "doc_id", "left")
    repeated = F.col("doc_id").isNotNull() & F.col("_first").isNull()
    full = F.col("mask") + repeated.cast("int") * (1 << len(conditions))
    counted = lambda c: F.sum(F.coalesce(c, F.lit(0))).cast("long").alias(c)
    return joined.groupBy("part", full.alias("mask")).agg(F.count("*").alias("n"), counted("good"), counted("toxic"))


def products(counts: DataFrame, letters: str) -> DataFrame:
    """A row for every part, order and step, from ``histograms`` over the filters ``letters``.

    A part's three histograms (documents, good and toxic ones) are rows of a matrix over the
    masks, multiplied by the integer matrices of ``matrices``. A part is one row of at most
    ``2 ** len(letters)`` counts, so tasks share the parts.
    """
    size, n_orders = 1 << len(letters), factorial(len(letters))
    schema = "part string, filter_order string, step int, " + ", ".join(f"{m} long" for m in MEASURES)
    orders = ["".join(p) for p in permutations(letters)]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        outcome = matrices(len(letters))
        columns = np.array(orders).repeat(len(letters)), np.tile(np.arange(1, len(letters) + 1, dtype=np.int32), n_orders)
        filter_of = np.array(list(permutations(range(len(letters))))).reshape(-1)
        for batch in batches:
            for at in range(0, batch.num_rows, PARTS):
                part, some = batch.column("part").slice(at, PARTS), batch.column("counts").slice(at, PARTS)
                stacked = np.zeros((3, len(part), size), dtype=np.int64)
                cells = some.flatten()
                of_part = np.repeat(np.arange(len(part)), some.value_lengths().to_numpy())
                for k, name in enumerate(("n", "good", "toxic")):
                    stacked[k, of_part, cells.field("mask").to_numpy()] = cells.field(name).to_numpy()
                everything = stacked.reshape(3 * len(part), size)
                made = {name: (everything @ x).reshape(3, len(part), -1) for name, x in outcome.items()}
                by_filter = np.zeros((len(part), len(letters)), dtype=np.int64)
                np.add.at(by_filter, (slice(None), filter_of), made["removed"][0])
                values = {name: x[0] for name, x in made.items()} | {"good_lost": made["removed"][1], "toxic_lost": made["removed"][2], "shapley": by_filter[:, filter_of]}
                n = len(filter_of)
                out = [part.take(np.arange(len(part)).repeat(n)), pa.array(np.tile(columns[0], len(part))), pa.array(np.tile(columns[1], len(part)))]
                yield pa.record_batch([*out, *(pa.array(values[m].reshape(-1)) for m in MEASURES)], names=["part", "filter_order", "step", *MEASURES])

    by_part = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"))
    return by_part.mapInArrow(rows, schema)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What filters A to E keep and remove in every order, by part.

    ``docs`` has doc_id, text and lang, ``labels`` doc_id, quality and toxic; other columns
    count for nothing. A null text is empty, a null lang the part ''. Of several labels of a
    doc_id one that is 1 is enough; rows of one doc_id count each, and repeat no text of their
    own doc_id. No documents: no rows. Whole texts are read, and no count is an estimate.
    """
    return products(histograms(docs, labels), "ABCD" + REPEATED)
