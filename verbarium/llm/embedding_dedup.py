"""Near-duplicate embeddings: inverted lists, product codes of residuals, exact rerank."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, in_batches, sample, shuffle_partitions, small, store
from .components import components

#: Vectors are linked from this cosine on.
COSINE = 0.93
#: The index is fitted on so many vectors at most; every vector is indexed.
SAMPLE_ROWS = 20_000
#: Lists grow with the square root of the vectors, up to MOST_LISTS; a vector probes PROBES of them at most, unless told otherwise.
MOST_LISTS, PROBES = 4096, 16
#: Subspaces of the residuals, and codewords of each.
SUBSPACES, CODEWORDS = 8, 64
#: Index vectors of a list, and queries, that one task compares at once.
BLOCK, QUERIES = 1024, 16_384
IDS = 1_000_000


@dataclass
class Index:
    """Coarse centroids and the codewords of the residuals' subspaces, over unit vectors."""

    centroids: np.ndarray
    codewords: list[np.ndarray]
    cuts: list[tuple[int, int]]

    def probes(self, unit: np.ndarray, n: int | None, reach: float) -> tuple[np.ndarray, np.ndarray]:
        """The lists of each vector that can hold a vector within ``reach``, nearest first, ``n`` at most: one after another, and their number.

        A list holds what is nearer to its centroid than to others, so one that lies further
        than ``reach`` behind the plane half-way from the nearest centroid holds none.
        """
        norms, lists = (self.centroids**2).sum(1), len(self.centroids)
        most = lists if n is None else min(n, lists)
        flat, counts = [], []
        for at in range(0, len(unit), 1024):
            far = norms - 2 * unit[at : at + 1024] @ self.centroids.T
            home = far.argmin(1)
            between = np.sqrt(np.maximum(norms[home][:, None] - 2 * self.centroids[home] @ self.centroids.T + norms, 0))
            can = far - np.take_along_axis(far, home[:, None], 1) <= 2 * (reach + 1e-6) * between + 1e-9
            far[~can] = np.inf
            far[np.arange(len(home)), home] = -np.inf
            # Only the nearest are sorted; of equally far ones the first lists come first.
            near = np.sort(np.argpartition(far, most - 1, axis=1)[:, :most], axis=1) if most < lists else np.broadcast_to(np.arange(lists), far.shape)
            near = np.take_along_axis(near, np.argsort(np.take_along_axis(far, near, 1), axis=1, kind="stable"), 1)
            counts.append(np.minimum(can.sum(1), most))
            flat.append(near[np.arange(most) < counts[-1][:, None]].astype(np.int32))
        return np.concatenate([*flat, np.zeros(0, dtype=np.int32)]), np.concatenate([*counts, np.zeros(0, dtype=np.int64)])

    def encode(self, unit: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals and the distance of each vector from its decoded form."""
        rest = unit - self.centroids[home]
        codes = np.empty((len(unit), len(self.cuts)), dtype=np.uint8)
        off = np.zeros(len(unit))
        for k, (a, b) in enumerate(self.cuts):
            words, part = self.codewords[k], rest[:, a:b]
            codes[:, k] = np.argmin((words**2).sum(1) - 2 * part @ words.T, axis=1)
            off += ((part - words[codes[:, k]]) ** 2).sum(1)
        return codes, np.sqrt(off)

    def distances(self, unit: np.ndarray, at: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric distances of queries from coded vectors of list ``at``, by table lookup."""
        rest = unit - self.centroids[at]
        total = np.zeros((len(unit), len(codes)))
        for k, (a, b) in enumerate(self.cuts):
            words, part = self.codewords[k], rest[:, a:b]
            table = (part**2).sum(1)[:, None] - 2 * part @ words.T + (words**2).sum(1)
            total += table[:, codes[:, k]]
        return np.sqrt(np.maximum(total, 0))


def k_means(x: np.ndarray, k: int, rounds: int = 8, seed: int = 3) -> np.ndarray:
    """Centroids of distinct starting rows, by Lloyd's rounds."""
    distinct = np.unique(x, axis=0)
    k = min(k, len(distinct))
    centres = distinct[np.random.default_rng(seed).permutation(len(distinct))[:k]].copy()
    for _ in range(rounds):
        near = np.concatenate([np.argmin((centres**2).sum(1) - 2 * x[i : i + 2048] @ centres.T, axis=1) for i in range(0, len(x), 2048)])
        counts = np.bincount(near, minlength=k)
        sums = np.stack([np.bincount(near, x[:, j], minlength=k) for j in range(x.shape[1])], axis=1)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def fit_index(rows: np.ndarray, vectors: int) -> Index:
    """An index for ``vectors`` vectors, from a sample of unit vectors."""
    centroids = k_means(rows, max(1, min(MOST_LISTS, int(vectors**0.5), len(rows))))
    width = rows.shape[1]
    edges = np.linspace(0, width, min(SUBSPACES, width) + 1).astype(int)
    index = Index(centroids, [], [(int(a), int(b)) for a, b in zip(edges[:-1], edges[1:], strict=True)])
    rest = rows - centroids[index.probes(rows, 1, 0.0)[0]]
    index.codewords = [k_means(rest[:, a:b], CODEWORDS) for a, b in index.cuts]
    return index


def to_unit(x: np.ndarray) -> np.ndarray:
    """Rows as unit vectors; scaled by their largest component first, so that no square is too small or too large."""
    x = x / np.abs(x).max(1)[:, None]
    x = x / np.sqrt((x * x).sum(1))[:, None]
    assert np.isfinite(x).all(), "vectors are finite and not zero"
    return x


def _raw(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _lists(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(flat))


def _binary(rows: np.ndarray) -> pa.Array:
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(rows))])


def _fixed(column: pa.Array, width: int) -> np.ndarray:
    """The bytes of values of one length."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]].reshape(len(column), width)


PLACED = "rep long, label string, copies long, unit array<double>, home int, probes array<int>, code binary, off double"
PAIRED = "rep long, links long, root long"


def _joined(a: np.ndarray, b: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Give linked rows a of ``left`` and b of ``right`` the least of their labels, until nothing changes."""
    while True:
        before = left[a], right[b]
        np.minimum.at(left, a, before[1])
        np.minimum.at(right, b, left[a])
        if (left[a] == before[0]).all() and (right[b] == before[1]).all():
            return


class _Block:
    """Index rows of one list that arrive before the queries of their run."""

    def __init__(self, batches: list[pa.RecordBatch], lists: int):
        rows = pa.Table.from_batches(batches).combine_chunks()
        column = lambda name: rows[name].combine_chunks() if isinstance(rows[name], pa.ChunkedArray) else rows[name]
        self.ids, self.copies, self.off = (column(c).to_numpy() for c in ("rep", "copies", "off"))
        self.units = _raw(column("unit"))
        self.codes = _fixed(column("code"), min(SUBSPACES, self.units.shape[1]))
        self.asks = np.zeros((len(self.ids), lists), dtype=bool)
        probes = column("probes")
        self.asks[np.repeat(np.arange(len(self.ids)), np.diff(probes.offsets.to_numpy())), probes.flatten().to_numpy()] = True
        self.label = self.ids.copy()


def _searcher(shared):
    """Links between the index rows (role 0) and the queries (role 1) of each run of one list's blocks."""

    def links(block: _Block, at: int, query: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        reach = np.sqrt(2 - 2 * COSINE) + 1e-6
        ids, copies, home = (query.column(c).to_numpy() for c in ("rep", "copies", "home"))
        units = _raw(query.column("unit"))
        a, b = np.nonzero(index.distances(units, at, block.codes) <= reach + block.off)
        cosine = np.einsum("ij,ij->i", units[a], block.units[b])
        linked = (cosine >= COSINE) & (ids[a] != block.ids[b])
        a, b = a[linked], b[linked]
        if not len(a):
            return
        label = ids.copy()
        _joined(a, b, label, block.label)
        # An index row that never meets the query's list as a query itself counts its link here.
        alone = ~block.asks[b, home[a]]
        counts = np.bincount(a, block.copies[b], minlength=len(ids)), np.bincount(b[alone], copies[a[alone]], minlength=len(block.ids))
        for rows, reps, labels, number in ((np.unique(a), ids, label, counts[0]), (np.unique(b), block.ids, block.label, counts[1])):
            yield pa.RecordBatch.from_arrays([pa.array(reps[rows]), pa.array(number[rows].astype(np.int64)), pa.array(labels[rows])], names=["rep", "links", "root"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, known, block = None, [], None
        for batch in batches:
            keys = [batch.column(c) for c in ("label", "at", "block", "part", "role")]
            new = np.zeros(batch.num_rows, dtype=bool)
            new[:1] = True
            for key in keys:
                new[1:] |= pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)
            bounds = [*np.flatnonzero(new).tolist(), batch.num_rows]
            for first, end in zip(bounds, bounds[1:], strict=False):
                mine = tuple(key[first].as_py() for key in keys[:4])
                if mine != run:
                    run, known, block = mine, [], None
                if keys[4][first].as_py() == 0:
                    known.append(batch.slice(first, end - first))
                elif known:
                    block = block or _Block(known, len(shared.value.centroids))
                    for lo in range(first, end, 512):
                        yield from links(block, run[1], batch.slice(lo, min(512, end - lo)))

    return search


def _linked(distinct: DataFrame, probes: int | None) -> DataFrame:
    """PAIRED rows of vectors of one length: partial link counts, and a node of the same class."""
    spark = distinct.sparkSession
    rows = _sample_units(distinct)
    shared = spark.sparkContext.broadcast(fit_index(rows, distinct.count()))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                unit = to_unit(_raw(batch.column(3)))
                asked, number = shared.value.probes(unit, probes, np.sqrt(2 - 2 * COSINE))
                home = asked[np.cumsum(number) - number]
                codes, off = shared.value.encode(unit, home)
                columns = [*batch.columns[:3], _lists(unit.ravel(), np.full(len(unit), unit.shape[1])), pa.array(home), _lists(asked, number), _binary(codes), pa.array(off)]
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in PLACED.split(", ")])

    placed = store(in_batches(distinct.select("rep", "label", "copies", "embedding"), place, PLACED), "vectors-placed")
    queries = placed.select("rep", "label", "copies", "unit", "home", F.explode("probes").alias("at"))
    asked = queries.groupBy("label", "at").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("_parts"))
    held = placed.groupBy("label", F.col("home").alias("at")).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_blocks"))
    sizes = store(held.join(asked, ["label", "at"]), "vectors-sizes")
    own = lambda n: F.pmod(F.xxhash64("rep", F.lit(9)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    inside = placed.withColumn("at", F.col("home")).join(small(sizes), ["label", "at"])
    inside = inside.select("label", "at", own("_blocks").alias("block"), every("_parts").alias("part"), F.lit(0).alias("role"), "rep", "copies", "unit", "home", "probes", "code", "off")
    asking = queries.join(small(sizes), ["label", "at"])
    nothing = [F.lit(None).cast("array<int>").alias("probes"), F.lit(None).cast("binary").alias("code"), F.lit(None).cast("double").alias("off")]
    asking = asking.select("label", "at", every("_blocks").alias("block"), own("_parts").alias("part"), F.lit(1).alias("role"), "rep", "copies", "unit", "home", *nothing)
    key = ["label", "at", "block", "part"]
    dealt = inside.unionByName(asking).repartition(shuffle_partitions(spark), *key).sortWithinPartitions(*key, "role")
    return in_batches(dealt, _searcher(shared), PAIRED)


def _sample_units(distinct: DataFrame) -> np.ndarray:
    rows = sample(distinct.select("name", "embedding"), "name", SAMPLE_ROWS).collect()
    return to_unit(np.array([r["embedding"] for r in sorted(rows, key=lambda r: (r["name"], r["embedding"]))], dtype=float))


def near_vectors(vectors: DataFrame, probes: int | None = PROBES) -> DataFrame:
    """Links and classes of vectors of equal label with a cosine of at least COSINE.

    ``vectors`` needs vec_id (bigint), embedding (array of numbers) and label; other columns
    are ignored. Equal vectors of a label become one, with a count. A coarse index, fitted
    on a bounded sample, puts every vector into the list of its nearest centroid, with a
    product code of its residual and its distance from the decoded form. Each vector
    probes its ``probes`` nearest lists, less those that can't hold a near vector, or with
    None all that can: codes whose asymmetric distance, less that of the
    decoded form, is within reach are reranked by the cosine of the vectors in double
    precision. So pairs are lost only if neither probes the other's list, and with None no
    pair is lost. Links are counted and joined where they are found; pairs are never written out.

    Defined cases: vectors that are null, empty, zero or hold null or non-finite components,
    and rows with a null label or id, link with nothing and are kept; vectors of different
    lengths are not compared; equal vectors count each other; repeated rows count as
    vectors; rows of one vec_id but different labels or components are vectors of their own,
    each with its own links and class.

    Returns vec_id, n_links, component_id, kept.
    """
    values = F.col("embedding").cast("array<double>")
    table = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), values.alias("embedding"))
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    usable = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & sound, F.lit(False))
    table = table.select("vec_id", "label", "embedding", usable.alias("usable"), F.size("embedding").alias("width"), F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(2), "embedding").alias("h2"))
    key = ["label", "width", "h1", "h2"]
    distinct = table.where("usable").groupBy(*key).agg(F.min("vec_id").alias("name"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"))
    # Groups of equal vectors are the nodes, by numbers that hold once they are stored; a vec_id may be in several.
    distinct = store(distinct.withColumn("rep", F.monotonically_increasing_id()), "vectors-distinct")
    found = None
    for width in sorted(r[0] for r in distinct.select("width").distinct().collect()):  # the lengths of vectors: one, as a rule
        links = _linked(distinct.where(F.col("width") == width), probes)
        found = links if found is None else found.union(links)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], PAIRED)
    found = store(found, "vectors-links")
    classes = store(components(found.select(F.col("rep").alias("a"), F.col("root").alias("b"))), "vectors-classes")
    labels = classes.select(F.col("node").alias("_node"), "component")
    counts = store(found.groupBy(F.col("rep").alias("_rep")).agg(F.sum("links").alias("links")), "vectors-counts")
    groups = distinct.select(*key, "rep", "name", "copies").join(small(counts, IDS), F.col("rep") == F.col("_rep"), "left").join(small(labels, IDS), F.col("rep") == F.col("_node"), "left")
    groups = store(groups.select(*key, F.lit(True).alias("usable"), "name", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component"), "vectors-classed")
    least = store(groups.where(F.col("component").isNotNull()).groupBy(F.col("component").alias("_class")).agg(F.min("name").alias("_least")), "vectors-names")
    named = groups.join(small(least, IDS), F.col("component") == F.col("_class"), "left").select(*key, "usable", "n_links", F.coalesce("_least", "name").alias("component_id"))
    classed, groups = groups, store(named, "vectors-groups")
    for x in (distinct, found, classes, counts, classed, least):
        drop(x)
    result = table.drop("embedding").join(small(groups), [*key, "usable"], "left")
    component = F.coalesce("component_id", "vec_id")
    return result.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
