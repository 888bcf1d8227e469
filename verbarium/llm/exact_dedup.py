"""Exact dedup by an extendible-hash index that lies on shared files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import small, store

#: Keys that a bucket holds before it is split.
CAPACITY = 1 << 14
#: Most bits of a hash that tell buckets apart: a bound of the directory (2 ** CELL_BITS slots).
CELL_BITS = 20


@dataclass(frozen=True)
class Index:
    """The stored tables of an index.

    ``rows``: doc_id, hash, digest (SHA-256 of the text) and slot of every document.
    ``directory``: slot (the first ``depth`` bits of a hash), bucket, local_depth.
    ``entries``: bucket, hash, chain (place among the texts of one hash, from 1), digest (null
    where the hash has one text only), keep_id, group_size; sorted by bucket and hash.
    """

    rows: DataFrame
    directory: DataFrame
    entries: DataFrame
    depth: int


def hashed(text: Column, bits: int = 64) -> Column:
    """The first ``bits`` bits of the text's 64-bit hash, the others 0."""
    full = F.xxhash64(text)
    return full if bits == 64 else F.shiftleft(F.shiftrightunsigned(full, 64 - bits), 64 - bits)


def _cell(column: str = "hash", bits: int = CELL_BITS) -> Column:
    return F.shiftrightunsigned(column, 64 - bits).cast("long")


def directory_of(cells: DataFrame, capacity: int) -> tuple[DataFrame, int]:
    """(slot, bucket, local_depth) for all hashes counted in ``cells`` (cell, keys), and the directory's depth.

    Doubling splits a bucket that has over ``capacity`` keys by one more bit, again and again.
    So a run of first bits is a bucket if it is not overfull itself (or has all CELL_BITS bits)
    and the run without its last bit is; counting all runs of bits at once gives what splitting
    one by one would. ``cells`` has at most 2 ** CELL_BITS rows. A bucket is named by its first cell.
    """
    level = F.explode(F.sequence(F.lit(0), F.lit(CELL_BITS))).alias("local_depth")
    run = F.expr(f"cell div cast(pow(2, {CELL_BITS} - local_depth) as bigint)")
    counted = cells.select("cell", "keys", level).groupBy("local_depth", run.alias("run")).agg(F.sum("keys").alias("keys"))
    counted = store(counted, "exact-levels")
    above = counted.where(F.col("keys") > capacity).select((F.col("local_depth") + 1).alias("local_depth"), F.col("run").alias("_above"))
    holds = (F.col("keys") <= capacity) | (F.col("local_depth") == CELL_BITS)
    fits = counted.where(holds).withColumn("_above", F.expr("run div 2"))
    buckets = fits.where("local_depth = 0").unionByName(fits.where("local_depth > 0").join(above, ["local_depth", "_above"], "left_semi"))
    depth = buckets.agg(F.max("local_depth")).first()[0] or 0
    spread = F.expr(f"cast(pow(2, {depth} - local_depth) as bigint)")
    slots = F.sequence(F.col("run") * spread, (F.col("run") + 1) * spread - 1)
    named = F.expr(f"run * cast(pow(2, {CELL_BITS} - local_depth) as bigint)").alias("bucket")
    return store(buckets.select(F.explode(slots).alias("slot"), named, "local_depth"), "exact-directory"), depth


def build(docs: DataFrame, capacity: int = CAPACITY, hash_bits: int = 64) -> Index:
    """Index the texts of ``docs`` (doc_id, text).

    Hashes are counted first, over narrow rows; they give the directory. Texts whose hash is
    repeated are then compared byte by byte, as keys of an aggregation: each task sends a text
    once however many copies it has. Texts of other hashes stay where they are while the
    list of repeated hashes is small enough to be sent to all tasks; beyond that all texts take
    part, with the same result. Entries then go to the owner of their bucket, a range of hashes,
    where texts of one hash are chained, and which writes its buckets to shared files.

    ``hash_bits`` below 64 makes collisions likely, for tests.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    texts = docs.select("doc_id", text.alias("text"), hashed(text, hash_bits).alias("hash"))
    rows = store(texts.select("doc_id", "hash", F.unhex(F.sha2("text", 256)).alias("digest")), "exact-rows")
    keys = store(rows.groupBy("hash").agg(F.count("*").alias("n"), F.max("doc_id").alias("keep_id")), "exact-keys")
    directory, depth = directory_of(store(keys.groupBy(_cell().alias("cell")).agg(F.count("*").alias("keys")), "exact-cells"), capacity)

    repeated = keys.where("n > 1").select("hash")
    listed = small(repeated)
    some = texts.join(listed, "hash", "left_semi") if listed is not repeated else texts
    compared = some.groupBy("hash", "text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    compared = compared.select("hash", F.unhex(F.sha2("text", 256)).alias("digest"), "keep_id", "group_size")
    if listed is not repeated:
        alone = keys.where("n = 1").select("hash", F.lit(None).cast("binary").alias("digest"), "keep_id", F.lit(1).cast("long").alias("group_size"))
        compared = compared.unionByName(alone)

    slot = F.shiftrightunsigned("hash", 64 - depth).cast("long") if depth else F.lit(0).cast("long")
    owned = compared.withColumn("slot", slot).join(F.broadcast(directory.select("slot", "bucket")), "slot").repartition("bucket")
    chain = W.partitionBy("bucket", "hash").orderBy("digest")
    placed = owned.withColumns({"chain": F.row_number().over(chain), "_last": F.lag("digest").over(chain), "_others": F.lead("hash").over(chain)})
    twice = F.raise_error(F.lit("two different texts have one SHA-256"))
    told = (F.col("chain") > 1) | F.col("_others").isNotNull()
    digest = F.when(F.col("digest") == F.col("_last"), twice.cast("binary")).when(told, F.col("digest"))
    entries = placed.select("bucket", "hash", "chain", digest.alias("digest"), "keep_id", "group_size").sortWithinPartitions("bucket", "hash", "chain")
    return Index(rows, directory, store(entries, "exact-entries"), depth)


def groups(docs: DataFrame, capacity: int = CAPACITY, hash_bits: int = 64) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept and text_sha256.

    Texts are equal if all their bytes are; a null text is empty. Of equal texts the largest
    doc_id stays. A null doc_id is smaller than any other, so such rows stay only in a group
    that has no other (keep_id is null there); rows that repeat a doc_id and text share one
    verdict and count one by one. Other columns count for nothing; no documents give no rows.

    Every text that a hash has is an entry; where they are several, their digests, which
    ``build`` has seen to differ, tell which is a row's.
    """
    index = build(docs, capacity, hash_bits)
    entries = index.entries.select("hash", F.col("digest").alias("_digest"), "keep_id", "group_size")
    same = (F.col("rows.hash") == F.col("e.hash")) & (F.col("_digest").isNull() | (F.col("_digest") == F.col("digest")))
    joined = index.rows.alias("rows").join(entries.alias("e"), same)
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return joined.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def deduplicate(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The rows of ``docs`` that ``groups`` keeps, with all their columns; of rows that repeat a doc_id and text all stay."""
    stays = groups(docs, capacity).where("kept").select(F.col("doc_id").alias("_kept_id"), F.col("text_sha256").alias("_kept_text")).distinct()
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    return docs.join(stays, F.col("doc_id").eqNullSafe(F.col("_kept_id")) & (digest == F.col("_kept_text")), "left_semi")
