"""WARC archives in Zstandard: a writer, and a reader of dictionary-led record frames."""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard as zstd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_batches, new_path, sample, small, store

# Fixed values of the formats.
SKIPPABLE = 0x184D2A5D
ZSTD_MAGIC = 0xFD2FB528
VERSION, VERSIONS = b"WARC/1.1", (b"WARC/1.0", b"WARC/1.1")
HTTP = "application/http"
DATE = "2020-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Bytes of payload after which a task starts its next archive.
ARCHIVE_BYTES = 16 << 20
#: The dictionary is fitted on so many payloads at most, and so many bytes of each.
SAMPLE_ROWS, SAMPLE_BYTES, DICT_BYTES = 400, 16_384, 65_536

READ_SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


class BadArchive(ValueError):
    """An archive or record that breaks the format."""


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_urn(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def clean(value: str | None) -> str:
    """A header value: line breaks would end the header, so they are percent-encoded."""
    return (value or "").replace("\r", "%0D").replace("\n", "%0A").strip()


def record(page_id: int | None, url: str | None, payload: bytes, sha1: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record: a response with its payload, or a revisit without."""
    block = b"" if revisit else payload
    lines = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_urn(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{sha1}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("Content-Type", "text/html; charset=utf-8"),
        ("Content-Length", str(len(block))),
        ("X-Payload-Length", str(len(payload))),
    ]
    if page_id is not None:
        lines.append(("X-Page-ID", str(page_id)))
    if url is not None:
        lines.append(("WARC-Target-URI", clean(url)))
    if revisit:
        lines += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_urn(refers_to)), ("X-Refers-To-Page", str(refers_to))]
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n"
    return head + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Fields and payload of one record; raises BadArchive if a header or a length is wrong."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] not in VERSIONS:
        raise BadArchive("no WARC header")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise BadArchive(f"header line {line[:80]!r}")
        fields[name.strip().decode(errors="replace").lower()] = value.strip().decode(errors="replace")
    for need in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if need not in fields:
            raise BadArchive(f"no {need}")
    if not fields["content-length"].isdigit():
        raise BadArchive("content-length is no number")
    n = int(fields["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise BadArchive(f"the block has {len(rest) - 4} bytes, its header says {n}")
    block = rest[:n]
    told = fields.get("warc-block-digest", "")
    if told.startswith("sha1:") and told != f"sha1:{digest(block)}":
        raise BadArchive("block digest differs")
    payload = payload_of(fields, block)
    told = fields.get("warc-payload-digest", "")
    if fields["warc-type"] == "response" and told.startswith("sha1:") and told != f"sha1:{digest(payload)}":
        raise BadArchive("payload digest differs")
    return fields | {"block": block, "payload": payload}


def payload_of(fields: dict, block: bytes) -> bytes:
    """The payload of a record's block: what follows the HTTP header if it holds an HTTP message."""
    if fields.get("content-type", "").lower().startswith(HTTP):
        return block.partition(b"\r\n\r\n")[2]
    return block


def row_of(fields: dict) -> tuple:
    """READ_SCHEMA's columns of a parsed record.

    A response without a length or digest of its payload gets those of the payload that it
    has; other records get null. Ids are null in records of other writers.
    """
    number = lambda name: int(fields[name]) if name in fields else None
    try:
        page, size, first = number("x-page-id"), number("x-payload-length"), number("x-refers-to-page")
    except ValueError as e:
        raise BadArchive(str(e)) from e
    sha1 = fields["warc-payload-digest"].removeprefix("sha1:") if "warc-payload-digest" in fields else None
    if fields["warc-type"] == "response":
        size = len(fields["payload"]) if size is None else size
        sha1 = digest(fields["payload"]) if sha1 is None else sha1
    return page, fields.get("warc-target-uri"), size, sha1, fields["warc-type"], first, fields["payload"]


class ArchiveWriter:
    """Bytes of one archive: the dictionary's skippable frame, then a frame per record."""

    def __init__(self, dictionary: bytes):
        self.out = io.BytesIO()
        if dictionary:
            self.out.write(struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary)
        extra = {"dict_data": zstd.ZstdCompressionDict(dictionary)} if dictionary else {}
        self.zstd = zstd.ZstdCompressor(level=3, write_checksum=True, write_content_size=True, **extra)
        self.taken = 0

    def add(self, raw: bytes) -> None:
        self.out.write(self.zstd.compress(raw))
        self.taken += len(raw)


def frame_end(raw: memoryview, at: int) -> int:
    """Where the Zstandard frame at ``at`` ends, from its block headers."""
    try:
        parameters = zstd.get_frame_parameters(raw[at : at + 18])
        at += zstd.frame_header_size(raw[at : at + 18])
    except zstd.ZstdError as e:
        raise BadArchive(str(e)) from e
    while True:
        if at + 3 > len(raw):
            raise BadArchive("cut off inside a frame")
        head = int.from_bytes(raw[at : at + 3], "little")
        at += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
        if head & 1:
            break
    at += 4 * parameters.has_checksum
    if at > len(raw):
        raise BadArchive("cut off inside a frame")
    return at


def read_archive(content: bytes) -> Iterator[dict]:
    """The records of an archive, one per frame, checked."""
    raw, at, dictionary = memoryview(content), 0, b""
    if len(raw) >= 8 and struct.unpack_from("<I", raw)[0] == SKIPPABLE:
        n = struct.unpack_from("<I", raw, 4)[0]
        if 8 + n > len(raw):
            raise BadArchive("cut off inside the dictionary")
        dictionary, at = bytes(raw[8 : 8 + n]), 8 + n
        if dictionary[:4] == struct.pack("<I", ZSTD_MAGIC):  # the dictionary may be compressed itself
            dictionary = zstd.ZstdDecompressor().decompress(dictionary)
    extra = {"dict_data": zstd.ZstdCompressionDict(dictionary)} if dictionary else {}
    reader = zstd.ZstdDecompressor(**extra)
    while at < len(raw):
        end = frame_end(raw, at)
        try:
            data = reader.decompress(raw[at:end])
        except zstd.ZstdError as e:
            raise BadArchive(str(e)) from e
        yield parse(data)
        at = end


def fit_dictionary(pages: DataFrame) -> bytes:
    """A dictionary from a bounded sample: records of the pages of the SAMPLE_ROWS smallest id hashes."""
    ids = store(sample(pages.where("html is not null").select("page_id"), "page_id", SAMPLE_ROWS).distinct(), "warc-sample")
    taken = pages.join(small(ids), "page_id").select("page_id", F.coalesce("url", F.lit("")).alias("url"), F.substring(F.encode("html", "UTF-8"), 1, SAMPLE_BYTES).alias("p"))
    rows = sorted(taken.limit(4 * SAMPLE_ROWS).collect())
    samples = [record(r["page_id"], r["url"], bytes(r["p"]), digest(bytes(r["p"])), None, False) for r in rows if r["page_id"] is not None]
    if len(samples) < 20:
        return b""
    size = min(DICT_BYTES, sum(map(len, samples)) // 8)
    try:
        return zstd.train_dictionary(max(size, 1024), samples).as_bytes()
    except zstd.ZstdError:
        return b""  # too little to learn from: records are compressed without


def duplicates(pages: DataFrame, least_bytes: int) -> DataFrame:
    """Digests that several payloads of at least ``least_bytes`` have, with their smallest page."""
    sized = pages.select("page_id", F.length(F.encode(F.coalesce("html", F.lit("")), "UTF-8")).alias("n"), F.sha1(F.encode(F.coalesce("html", F.lit("")), "UTF-8")).alias("_sha1"))
    return sized.where(F.col("n") >= least_bytes).groupBy("_sha1").agg(F.min("page_id").alias("_first"), F.count("*").alias("_copies")).where("_copies > 1").drop("_copies")


def write_archives(pages: DataFrame, least_bytes: int = 0, path: str | None = None) -> str:
    """Write a WARC record per page into ``*.warc.zst`` archives of a folder; returns the folder.

    Of pages with equal payloads of at least ``least_bytes`` bytes, the one with the smallest
    page_id is a response and the others are revisits of it. Each task writes archives of
    about ARCHIVE_BYTES, under a name of its own that is put in place when the archive is whole;
    a task that runs again after a lost executor writes its archives anew, and only those that
    the successful attempts name in ``_index`` belong to the folder's content.
    """
    spark = pages.sparkSession
    path = path or new_path(spark, "warc")
    dictionary = fit_dictionary(pages)
    copies = store(duplicates(pages, least_bytes), "warc-copies")
    body = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", body.alias("payload")).withColumn("_sha", F.sha1("payload"))
    rows = rows.join(small(copies), F.col("_sha") == F.col("_sha1"), "left").select("page_id", "url", "payload", "_first")

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = pafs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", path))
        files.create_dir(folder, recursive=True)
        writer, names, counts, n = ArchiveWriter(dictionary), [], [], 0

        def close() -> None:
            name = f"{uuid.uuid4().hex}.warc.zst"
            with files.open_output_stream(f"{folder}/{name}.part") as out:
                out.write(writer.out.getbuffer())
            files.move(f"{folder}/{name}.part", f"{folder}/{name}")
            names.append(name)
            counts.append(n)

        for batch in batches:
            ids, urls, payloads, firsts = (batch.column(k) for k in range(4))
            for k in range(batch.num_rows):
                page, payload, first = ids[k].as_py(), payloads[k].as_py() or b"", firsts[k].as_py()
                # A repeated row of the response's page_id is its copy, not a revisit of itself.
                revisit = first is not None and page != first
                writer.add(record(page, urls[k].as_py(), payload, digest(payload), first, revisit))
                n += 1
                if writer.taken >= ARCHIVE_BYTES:
                    close()
                    writer, n = ArchiveWriter(dictionary), 0
        if n:
            close()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())], names=["name", "records"])

    in_batches(rows, save, "name string, records long").write.parquet(f"{path}/_index")
    return path


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives in ``path`` that its index names, one row each; of all ``*.warc.zst`` without an index.

    Raises BadArchive on a broken frame, header, length or digest, and when an archive has
    not the number of records that the index says. Archives of other writers may lack
    digests and payload lengths (``row_of``) and have HTTP messages and other record types.
    """
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(path)
    found = found.select(F.substring_index("path", "/", -1).alias("name"), "content")
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_index")
    if folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(folder):
        found = found.join(small(spark.read.schema("name string, records long").parquet(f"{path}/_index")), "name")
    else:
        found = found.withColumn("records", F.lit(None).cast("long"))
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                rows, size, total, told = [], 0, 0, batch.column(2)[k].as_py()
                for r in read_archive(batch.column(1)[k].as_buffer().to_pybytes()):
                    rows.append(row_of(r))
                    size, total = size + len(r["block"]), total + 1
                    if size >= 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                        rows, size = [], 0
                if told is not None and total != told:
                    raise BadArchive(f"{batch.column(0)[k]} has {total} records")
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return in_batches(found.select("name", "content", "records"), load, READ_SCHEMA)


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to archives and read them back.

    Defined cases: null html is an empty payload; a null url has no target header and
    reads back as null; a null page_id is never the first of its copies unless all are
    null, and reads back as null; rows that repeat the response's page_id are responses;
    an empty table gives no records; other columns are ignored.
    """
    return read_archives(pages.sparkSession, write_archives(pages, least_bytes))
