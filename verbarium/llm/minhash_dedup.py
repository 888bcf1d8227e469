"""Near-duplicate documents: SetSketch registers, bands, joint likelihood, full check."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import buckets
from .common import drop, in_batches, small, store
from .components import components
from .textscan import mix, scanned, space_separated, splitmix, windows

SHINGLE = 5
#: A link needs 100 * common >= PERCENT * union.
PERCENT = 75
#: BANDS bands of ROWS registers: two sets at the threshold share no band once in 200,000.
BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
#: SetSketch parameters: base, rate, largest register value.
BASE, RATE, LARGEST = 1.001, 20.0, 65535
#: Candidates go when their likeliest similarity is under this: five deviations below the threshold.
LEAST_ESTIMATE = PERCENT / 100 - 5 * (0.75 * 0.25 / REGISTERS) ** 0.5
#: Most document ids that a broadcast may hold.
IDS = 1_000_000
#: Most rounds of stars around a member of a bucket's largest component; what is left is compared exactly.
ROUNDS = 6

SKETCH_SCHEMA = "rid long, doc_id long, t long, n_shingles long, sid binary, regs binary"

_XOR = np.array([splitmix(10_000 + k) & 0xFFFFFFFF for k in range(REGISTERS)], dtype=np.uint32)
_TIMES = np.array([splitmix(20_000 + k) & 0xFFFFFFFF | 1 for k in range(REGISTERS)], dtype=np.uint32)


def shingle_sets(column: pa.Array) -> Iterator[tuple[int, list[np.ndarray], np.ndarray, np.ndarray]]:
    """(first row, sorted distinct shingle hashes of each row, all shingles, their rows)."""
    words = space_separated()
    for a, b, _, _, _, hashes, row in scanned(words, column):
        full = windows(hashes, SHINGLE)
        at = row[: len(full)]
        same = at == row[SHINGLE - 1 :] if len(full) else np.zeros(0, dtype=bool)
        full, at = full[same], at[same]
        counts = np.bincount(row, minlength=b - a)
        short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
        if len(short):
            first = np.concatenate([[0], np.cumsum(counts)])
            extra = np.array([windows(hashes[first[k] : first[k + 1]], int(counts[k]))[0] for k in short], dtype=np.uint64)
            full, at = np.concatenate([full, extra]), np.concatenate([at, short])
            order = np.argsort(at, kind="stable")
            full, at = full[order], at[order]
        bounds = np.searchsorted(at, np.arange(b - a + 1))
        yield a, [np.unique(full[bounds[k] : bounds[k + 1]]) for k in range(b - a)], full, at


def minima(shingles: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(rows, REGISTERS) least hash of each run of ``shingles`` that begins at ``starts``."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(starts), REGISTERS), dtype=np.uint32)
    hashed = np.empty_like(low)
    for k in range(REGISTERS):
        np.bitwise_xor(low, _XOR[k], out=hashed)
        np.multiply(hashed, _TIMES[k], out=hashed)
        out[:, k] = np.minimum.reduceat(hashed, starts)
    return out


def registers(least: np.ndarray) -> np.ndarray:
    """Truncated logarithms of exponential minima: larger for larger sets, merged by maximum."""
    exponential = -np.log1p(-(least + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, LARGEST).astype(np.uint16)


def likely(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray, similarity: float = LEAST_ESTIMATE) -> np.ndarray:
    """Whether the maximum-likelihood similarity of sketched sets is at least ``similarity``.

    The joint likelihood of how many registers are larger, smaller and equal is concave in
    the similarity, so its maximum lies at or above a point where its slope is not negative.
    """
    more, less = (ra > rb).sum(-1), (ra < rb).sum(-1)
    same = ra.shape[-1] - more - less
    u, v = na / (na + nb), nb / (na + nb)
    x, y = u - v * similarity, v - u * similarity
    possible = (x > 0) & (y > 0)
    x, y = np.where(possible, x, 0.25), np.where(possible, y, 0.25)
    c, log_b = (BASE - 1) / BASE, np.log(BASE)
    p, q = -np.log1p(-x * c) / log_b, -np.log1p(-y * c) / log_b
    dp, dq = c / (1 - x * c) / log_b, c / (1 - y * c) / log_b
    slope = same * (v * dp + u * dq) / np.maximum(1 - p - q, 1e-12) - more * v * dp / p - less * u * dq / q
    return possible & (slope >= 0)


def _set_id(shingles: np.ndarray) -> bytes:
    """128 bits that stand for a set of shingles."""
    return np.array([mix(shingles).sum(dtype=np.uint64), mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)], dtype=">u8").tobytes()


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (rid, doc_id, t, text)."""
    names = [f.split()[0] for f in SKETCH_SCHEMA.split(", ")]
    for batch in batches:
        sizes, sids, regs = [], [], []
        for _, sets, full, at in shingle_sets(batch.column(3)):
            held = np.flatnonzero(np.bincount(at, minlength=len(sets)))
            sketch = iter(registers(minima(full, np.searchsorted(at, held))) if len(held) else ())
            for s in sets:
                sizes.append(len(s))
                sids.append(_set_id(s) if len(s) else None)
                regs.append(next(sketch).astype("<u2").tobytes() if len(s) else None)
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sizes, pa.int64()), pa.array(sids, pa.binary()), pa.array(regs, pa.binary())], names=names)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u2").reshape(len(column), REGISTERS)


def _estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            a, b, na, nb, ra, rb = batch.columns
            keep = likely(_matrix(ra), _matrix(rb), na.to_numpy().astype(float), nb.to_numpy().astype(float))
            chosen = pa.array(keep)
            yield pa.RecordBatch.from_arrays([a.filter(chosen), b.filter(chosen)], names=["a", "b"])


def _alike(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Which of the ``others`` are linked with the set ``one``."""
    sizes = np.array([len(s) for s in others])
    together = np.concatenate(others)
    place = np.minimum(np.searchsorted(one, together), len(one) - 1)
    common = np.add.reduceat((one[place] == together).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)[:-1]]))
    return 100 * common >= PERCENT * (len(one) + sizes - common)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, shingles of a, shingles of b) whose full sets are similar enough."""
    for batch in batches:
        if batch.num_rows:
            sets = ([np.frombuffer(x.as_buffer(), dtype="<u8") for x in batch.column(k)] for k in (2, 3))
            chosen = pa.array([bool(_alike(a, [b])[0]) for a, b in zip(*sets, strict=True)])
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(chosen), batch.column(1).filter(chosen)], names=["a", "b"])


class Run:
    """The sets of one run of a bucket: which pairs of different components are to be checked."""

    def __init__(self, rows: pa.Table):
        column = lambda name: rows[name].to_numpy()
        self.band, self.rep, self.component = column("band")[0], column("rep"), column("component")
        self.n = column("n").astype(float)
        self.regs = np.frombuffer(b"".join(rows["regs"].to_pylist()), dtype="<u2").reshape(-1, REGISTERS)
        self.sides = buckets.Sides(column("left"), column("right"), column("own"), column("main"))

    def partners(self, i: int, root: np.ndarray) -> np.ndarray:
        """Sets that ``i`` may be linked with, of another root, and that share no earlier band with it."""
        js = self.sides.second(i)
        js = js[root[js] != root[i]]
        js = js[100 * np.minimum(self.n[js], self.n[i]) >= PERCENT * np.maximum(self.n[js], self.n[i])]
        if len(js):
            js = js[likely(self.regs[i][None], self.regs[js], np.full(len(js), self.n[i]), self.n[js])]
        if len(js) and self.band:
            upto = self.band * ROWS
            equal = (self.regs[js, :upto] == self.regs[i, :upto]).reshape(len(js), self.band, ROWS)
            js = js[~equal.all(2).any(1)]
        return js


PAIR = "a long, b long"
OPEN = f"{buckets.DEALT}, band int, rep long"


def _open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each run whose set is in a pair to be checked."""
    names = [f.split()[0] for f in OPEN.split(", ")]
    for rows in buckets.runs(batches):
        run = Run(rows)
        needed = np.zeros(rows.num_rows, dtype=bool)
        for i in run.sides.first:
            js = run.partners(i, run.component)
            if len(js):
                needed[i] = True
                needed[js] = True
        if needed.any():
            yield from rows.select(names).filter(pa.array(needed)).combine_chunks().to_batches()


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that join different components, found on the full sets inside each run.

    A link joins its components here too, so a component's sets are compared with a set
    only until one is linked with it.
    """
    for rows in buckets.runs(batches):
        run = Run(rows)
        sets = [np.frombuffer(x.as_buffer(), dtype="<u8") for x in rows["shingles"]]
        _, root = np.unique(run.component, return_inverse=True)
        a, b = [], []
        for i in run.sides.first:
            js = run.partners(i, root)
            if not len(js):
                continue
            for j in js[_alike(sets[i], [sets[j] for j in js])]:
                if root[j] != root[i]:
                    root[root == root[j]] = root[i]
                    a.append(int(run.rep[i]))
                    b.append(int(run.rep[j]))
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, sets, _, _ in shingle_sets(batch.column(0)):
            held = [x for x in sets if len(x)]
            yield pa.RecordBatch.from_arrays([pa.array([_set_id(x) for x in held], pa.binary()), pa.array([x.astype("<u8").tobytes() for x in held], pa.binary())], names=["sid", "shingles"])


def _shingles(nodes: DataFrame, sets: DataFrame, texts: DataFrame) -> DataFrame:
    """(rep, shingles): the full sets of ``nodes`` (a table of rep), from the texts that have them."""
    wanted = store(sets.join(small(nodes, IDS), "rep", "left_semi").select("rep", F.col("sid").alias("_sid"), F.col("own_id").alias("_id"), F.col("t").alias("_t")), "dedup-wanted")
    held = texts.join(small(wanted.select("_id", "_t").distinct(), IDS), (F.col("doc_id") == F.col("_id")) & (F.col("t") == F.col("_t")), "left_semi")
    packed = in_batches(held.select("text"), _packed, "sid binary, shingles binary")
    found = packed.join(small(wanted.select("rep", "_sid"), IDS), F.col("sid") == F.col("_sid"))
    return store(found.select("rep", "shingles").dropDuplicates(["rep"]), "dedup-shingles")


def _linked(pairs: DataFrame, sets: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) that are linked: by their sketches first, then by their full sets."""
    left = sets.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("regs").alias("ra"))
    right = sets.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("regs").alias("rb"))
    sketched = pairs.join(left, "a").join(right, "b").where(100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb"))
    candidates = store(in_batches(sketched.select("a", "b", "na", "nb", "ra", "rb"), _estimate, PAIR), "dedup-candidates")
    nodes = store(candidates.select(F.col("a").alias("rep")).union(candidates.select("b")).distinct(), "dedup-nodes")
    full = _shingles(nodes, sets, texts)
    both = candidates.join(full.toDF("b", "sb"), "b").join(full.toDF("a", "sa"), "a")
    links = store(in_batches(both.select("a", "b", "sa", "sb"), _verify, PAIR), "dedup-links")
    for table in (candidates, nodes, full):
        drop(table)
    return links


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Classes of documents whose sets of 5-word shingles are linked.

    ``docs`` needs doc_id (bigint) and text; other columns are ignored. Words are runs of
    characters other than space and 09 to 0D of the text with A-Z lower-cased; two sets are
    linked if 100 * common >= 75 * union.

    1. Each text's set is sketched into SetSketch registers; equal sets become one.
    2. Sets that share all registers of a band are candidates: each with the least member
       of its bucket, and with the least by a fixed hash. So a bucket gives no more pairs
       than members, however large a group of copies is.
    3. Candidates whose jointly estimated similarity could reach the threshold are checked
       on their full sets; links give components.
    4. While a bucket has many members outside its largest component, each of them is a
       candidate with another member of that component, as long as this finds links.
    5. Pairs of one bucket that are still in different components are all estimated, each in
       the first bucket that it shares (``buckets.deal``). Where the estimate
       could reach the threshold the full sets come to the task and are checked there, and
       only links that join components are written: no link that a band holds is lost, and
       no list of pairs is made.

    Defined cases: null and blank texts have an empty set and link with nothing; fewer
    words than five are one shingle; a null doc_id links with nothing, has a null component
    and is kept; repeated rows each give a row; rows of one doc_id with different texts are
    classed by their own texts.

    Returns doc_id, n_shingles, component_id, kept.
    """
    return _classed(docs).drop("t")


def _classed(docs: DataFrame) -> DataFrame:
    """``near_duplicates`` with t, a hash of the text."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("t"), F.col("text").cast("binary").alias("text"))
    numbered = texts.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "t", "text")
    sketches = store(in_batches(numbered, _sketch, SKETCH_SCHEMA), "dedup-sketches")
    # A set's node is the least row that has it: no two sets share one, whatever their doc_ids.
    usable = sketches.where("doc_id is not null and sid is not null")
    repeated = usable.groupBy("sid").agg(F.min("rid").alias("_rep"), F.min("doc_id").alias("_doc"), F.count("*").alias("_n")).where("_n > 1")
    repeated = store(repeated.select(F.col("sid").alias("_sid"), "_rep", "_doc"), "dedup-copies")
    of_set = lambda df: df.join(small(repeated), F.col("sid") == F.col("_sid"), "left").withColumn("rep", F.coalesce("_rep", "rid")).withColumn("doc", F.coalesce("_doc", "doc_id"))
    sets = store(of_set(usable).where("rid = rep").select("rep", "doc", "sid", F.col("doc_id").alias("own_id"), "t", F.col("n_shingles").alias("n"), "regs"), "dedup-sets")

    bands = F.array(*[F.xxhash64(F.lit(k), F.expr(f"substring(regs, {2 * ROWS * k + 1}, {2 * ROWS})")) for k in range(BANDS)])
    members = store(sets.select("rep", F.posexplode(bands).alias("band", "bucket")), "dedup-bands")
    order = F.struct(F.xxhash64("rep", F.lit(31)).alias("h"), F.col("rep").alias("rep"))
    heads = members.groupBy("bucket").agg(F.min("rep").alias("_low"), F.max("rep").alias("_high"), F.min(order)["rep"].alias("_any")).where("_low < _high")
    heads = heads.select(F.col("bucket").alias("_bucket"), F.array_distinct(F.array("_low", "_any")).alias("_heads"))
    grouped = store(members.join(heads, F.col("bucket") == F.col("_bucket")).select("bucket", "band", "rep", "_heads"), "dedup-buckets")
    drop(members)
    stars = grouped.select("rep", F.explode("_heads").alias("head")).where("rep <> head")
    links = _linked(store(stars.select(F.col("head").alias("a"), F.col("rep").alias("b")).distinct(), "dedup-stars"), sets, texts)
    classes = store(components(links), "dedup-classes")

    sizes = sets.select("rep", "n")
    grouped = store(grouped.join(sizes, "rep").select("bucket", "band", "rep", F.col("n").alias("weight")), "dedup-members")
    for turn in range(ROUNDS + 1):
        placed, mixed = _placed(grouped, classes, turn)
        if turn == ROUNDS or mixed.where(F.col("_others") > buckets.CROWD * buckets.BLOCK).isEmpty():
            break
        links = _linked(store(buckets.star_pairs(placed, mixed), "dedup-stars"), sets, texts)
        if links.isEmpty():
            break
        classes = _joined(classes, links)
    members = placed.join(small(mixed.select(F.col("_bucket").alias("bucket"))), "bucket", "left_semi")
    members = members.join(sets.select("rep", "n", "regs"), "rep")
    members = members.withColumn("node", F.col("rep"))
    dealt = buckets.gathered(buckets.deal(members, mixed, "band", "rep", "component", "n", "regs"))
    unsure = store(in_batches(dealt, _open, OPEN), "dedup-open")
    nodes = store(unsure.select("rep").distinct(), "dedup-nodes")
    full = _shingles(nodes, sets, texts)
    labels = classes.select(F.col("node").alias("_node"), "component")
    known = full.join(sets.select("rep", "n", "regs"), "rep").join(small(labels, IDS), F.col("rep") == F.col("_node"), "left")
    known = store(known.select("rep", F.coalesce("component", "rep").alias("component"), "n", "regs", "shingles"), "dedup-known")
    dealt = buckets.gathered(unsure.join(known, "rep")).select(*buckets.RUN, "own", "main", "band", "rep", "component", "n", "regs", "shingles")
    more = store(in_batches(dealt, _across, PAIR).distinct(), "dedup-more")
    if not more.isEmpty():
        classes = _joined(classes, more)

    # A class is named by its smallest doc_id.
    linked = store(classes.join(sets.select(F.col("rep").alias("node"), "doc"), "node"), "dedup-linked")
    named = linked.groupBy(F.col("component").alias("_c")).agg(F.min("doc").alias("component_id"))
    labels = store(linked.join(named, F.col("component") == F.col("_c")).select(F.col("node").alias("_node"), "component_id"), "dedup-labels")
    for table in (grouped, placed, mixed, unsure, nodes, full, known, more, linked, classes, sets):
        drop(table)
    result = of_set(sketches).join(small(labels, IDS), F.col("rep") == F.col("_node"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", F.when(F.col("sid").isNotNull(), F.col("doc")), "doc_id"))
    return result.select("doc_id", "t", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def _placed(grouped: DataFrame, classes: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """The members of the buckets with their components, and the buckets that have several."""
    labels = classes.select(F.col("node").alias("_node"), "component")
    placed = grouped.join(small(labels, IDS), F.col("rep") == F.col("_node"), "left")
    placed = store(placed.select("bucket", "band", "rep", F.col("rep").alias("node"), F.coalesce("component", "rep").alias("component"), "weight"), "dedup-placed")
    return placed, store(buckets.mixed(placed, seed), "dedup-mixed")


def _joined(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``classes`` with the components that ``links`` join as one."""
    return store(components(classes.select(F.col("node").alias("a"), F.col("component").alias("b")).union(links)), "dedup-classes")


def deduplicate(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each class: the one of the smallest doc_id.

    Documents that link with nothing stay; rows that repeat a kept document's doc_id and
    text stay with it. Columns stay as they are.
    """
    dropped = store(_classed(docs).where("not kept").select(F.col("doc_id").alias("_id"), F.col("t").alias("_t")).distinct(), "dedup-dropped")
    rows = docs.select(F.struct("*").alias("row"))
    return rows.join(small(dropped, IDS), (F.col("row.doc_id").cast("long") == F.col("_id")) & (F.xxhash64("row.text") == F.col("_t")), "left_anti").select("row.*")
