import base64
import hashlib
import struct

import numpy as np
import pytest
import zstandard as zstd
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import corpus_pipeline
from tests.oracle import same
from verbarium.llm import embedding_dedup, queries, url_filter, warc

SF = "/root/testdata/sf0.001"


def pages(spark, rows):
    return spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "page_id long, url string, html string")


HTML = [("http://a/1", "<p>é</p>"), ("http://a/2", None), (None, ""), ("http://a/\r\nX: y", "<p>é</p>"), ("http://a/5", "x" * 300_000), ("http://a/6", "<p>é</p>"), *[(f"http://b/{k}", f"<html>{k} " + "filler text " * 30) for k in range(60)]]


@pytest.mark.parametrize("least", [0, 5])
def test_warc_round_trip(spark, least):
    table = pages(spark, HTML).withColumn("payload", F.lit(1))
    got = {r["page_id"]: r for r in warc.round_trip(table, least).collect()}
    first = {}
    for k, (url, html) in enumerate(HTML):
        body = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        head = first.setdefault(digest, k) if len(body) >= least else k
        r = got[k]
        assert (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) == (len(body), digest, "response" if head == k else "revisit", None if head == k else head)
        assert bytes(r["payload"]) == (body if head == k else b"")
        assert r["url"] == (url if k != 3 else "http://a/%0D%0AX: y")
    assert len(got) == len(HTML) and warc.round_trip(table.where("false")).count() == 0


def test_warc_repeats_and_null_ids(spark):
    rows = spark.createDataFrame([(1, "u", "x"), (1, "u", "x"), (None, "u", "x"), (2, "u", "x")], "page_id long, url string, html string")
    got = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"]) for r in warc.round_trip(rows).collect())
    assert got == [(0, "revisit", 1), (1, "response", None), (1, "response", None), (2, "revisit", 1)]


def archive(dictionary=b""):
    writer = warc.ArchiveWriter(dictionary)
    for k in range(30):
        body = f"page {k} ".encode() * 20
        writer.add(warc.record(k, f"http://x/{k}", body, warc.digest(body), None, False))
    return writer.out.getvalue()


def test_archive_dictionary_is_its_first_frame():
    bodies = [f"page {k} ".encode() * 20 for k in range(300)]
    samples = [warc.record(k, f"http://x/{k}", b, warc.digest(b), None, False) for k, b in enumerate(bodies)]
    trained = zstd.train_dictionary(2048, samples).as_bytes()
    plain, led = archive(), archive(trained)
    assert struct.unpack_from("<I", led)[0] == warc.SKIPPABLE and len(led) - len(trained) < len(plain)
    assert [r["x-page-id"] for r in warc.read_archive(led)] == [str(k) for k in range(30)]
    packed = zstd.ZstdCompressor().compress(trained)
    inner = struct.pack("<II", warc.SKIPPABLE, len(packed)) + packed + led[8 + len(trained) :]
    assert len(list(warc.read_archive(inner))) == 30 and list(warc.read_archive(b"")) == []


def test_broken_archives_are_refused():
    good = archive()
    for bad in (good[:-3], good[: len(good) // 2], b"plain text that is no archive", struct.pack("<II", warc.SKIPPABLE, 99)):
        with pytest.raises(warc.BadArchive):
            list(warc.read_archive(bad))
    body = b"abc"
    raw = warc.record(1, "u", body, warc.digest(body), None, False)
    for bad in (raw.replace(b"Content-Length: 3", b"Content-Length: 4"), raw.replace(b"WARC-Type", b"X-Type"), raw.replace(b"abc\r\n", b"abd\r\n"), raw.replace(b"WARC/1.1", b"HTTP/1.1"), raw.replace(b"Content-Length: 3", b"Content-Length: x")):
        with pytest.raises(warc.BadArchive):
            warc.parse(bad)


def test_archives_of_other_writers(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"
    body = "<p>é</p>".encode()

    def foreign(kind, block, **fields):
        head = {"WARC-Type": kind, "WARC-Record-ID": "<urn:uuid:1>", "WARC-Date": "2024-01-01T00:00:00Z", "Content-Length": str(len(block))} | {k.replace("_", "-"): v for k, v in fields.items()}
        return b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"

    records = [foreign("warcinfo", b"software: x\r\n"), foreign("response", http + body, Content_Type="application/http; msgtype=response", WARC_Target_URI="http://a/", WARC_Payload_Digest=f"sha1:{warc.digest(body)}"), foreign("response", body), foreign("response", body, WARC_Block_Digest="md5:0")]
    folder = tmp_path / "archives"
    folder.mkdir()
    (folder / "x.warc.zst").write_bytes(b"".join(zstd.ZstdCompressor().compress(r) for r in records))
    rows = warc.read_archives(spark, str(folder)).collect()
    assert [(r["record_type"], r["url"], r["payload_bytes"], r["payload_digest"], r["page_id"]) for r in rows] == [("warcinfo", None, None, None, None), ("response", "http://a/", len(body), warc.digest(body), None), *[("response", None, len(body), warc.digest(body), None)] * 2]
    assert bytes(rows[1]["payload"]) == body
    for bad in (foreign("response", body, WARC_Payload_Digest="sha1:AAAA"), foreign("response", body, X_Page_ID="seven")):
        with pytest.raises(warc.BadArchive):
            warc.row_of(warc.parse(bad))


RULES = [*queries.URL_RULES, ("block", "b.org", "/x"), ("allow", "b.org", "/x"), ("block", "EXAMPLE.com", "/en/8"), ("block", None, "/"), ("other", "c.org", "/")]
URLS = ["http://Example.com/en/825?page=2", "https://www.example.com/en/1#top", "http://x.example.com/fr", "http://example.com", "http://badexample.com/en/x", "http://m.a.net/es/3", "http://a.net/ES/", "net/es/", "://net/es/x", "", None, "http://b.org/xyz", "http://b.org/y", "http://c.org/", "http://a.com:80/", "http://é.com/en/é?x/en/", "http://example.com?x=/en/", "http://example.com/en/9", "http://" + "a." * 50_000 + "net/es/x", "http://" + "." * 100_000, "http://www.example.com./en/", "http://.com/x", "http://m.example.com/en/" + "x" * 200_000]


def brute_url(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
    path = tail[: min([tail.index(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [(len(h + p), len(h), v, h.lower() + p) for v, h, p in RULES if h and v in ("allow", "block") and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)]
    best = max(fits, default=(0, 0, "allow", None))
    return host, path, best[3], best[2]


def test_urls(spark):
    table = pages(spark, [(u, "") for u in [*URLS, URLS[0]]]).withColumn("rule", F.lit("clash"))
    rules = url_filter.rule_table(spark, RULES)
    got = {r["page_id"]: tuple(r[c] for c in ("host", "path", "rule", "verdict")) for r in url_filter.filter_urls(table, rules).collect()}
    assert got == {k: brute_url(u) for k, u in enumerate([*URLS, URLS[0]])}
    assert url_filter.filter_urls(table.where("false"), rules).count() == 0
    assert {r["verdict"] for r in url_filter.filter_urls(table, rules.where("false"), "block").collect()} == {"block"}


def brute_vectors(rows):
    links = {k: set() for k, _, _ in rows}
    usable = [(k, np.array(v, dtype=float), label) for k, v, label in rows if v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    usable = [(k, v / np.abs(v).max(), label) for k, v, label in usable]
    for i, (a, x, la) in enumerate(usable):
        for b, y, lb in usable[:i]:
            if la == lb and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= embedding_dedup.COSINE:
                links[a].add(b)
                links[b].add(a)
    component = {}
    for k in sorted(links):
        todo = [k]
        while todo:
            n = todo.pop()
            if n not in component:
                component[n] = k
                todo += links[n]
    return {k: (len(links[k]), component[k], component[k] == k) for k in links}


def test_vectors_agree_with_brute_force(spark):
    rng = np.random.default_rng(6)
    rows = []
    for label in (0, 1):
        for centre in rng.normal(size=(8, 16)):
            rows += [(list(map(float, np.float32(centre + rng.normal(scale=rng.choice([0.0, 0.1, 0.3]), size=16)))), label) for _ in range(12)]
    rows += [(None, 1), ([], 1), ([0.0] * 16, 1), ([float("nan")] * 16, 1), ([float("inf")] * 16, 1), ([None] * 16, 1), (rows[0][0], None), ([1.0, 2.0], 1), ([1.0, 2.01], 1)]
    rows = [(k, v, label) for k, (v, label) in enumerate(rows)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("rep", F.lit(1))
    floats = [(k, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for k, v, label in rows]
    expected = brute_vectors(floats)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.near_vectors(table).collect()}
    found = sum(n for n, _, _ in got.values())
    wanted = sum(n for n, _, _ in expected.values())
    assert set(got) == set(expected) and found >= 0.9 * wanted and all(got[k][0] <= expected[k][0] for k in got)
    assert got == expected  # at this size every list is probed
    assert embedding_dedup.near_vectors(table.where("false")).count() == 0


def answers(frame):
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in frame.collect()}


def test_vectors_probe_few_of_many_lists(spark):
    rng = np.random.default_rng(11)
    rows = []
    for centre in rng.normal(size=(150, 24)):  # pairs about the threshold, and a dense group
        unit = centre / np.linalg.norm(centre)
        for cosine in (1.0, 0.95, 0.94, 0.92):
            away = rng.normal(size=24)
            away -= (away @ unit) * unit
            rows.append(list(cosine * unit + np.sqrt(1 - cosine**2) * away / np.linalg.norm(away)))
    rows += [list(rows[0] + rng.normal(scale=0.01, size=24)) for _ in range(60)]
    rows = [(k, list(map(float, v)), k % 2 if k < 600 else 0) for k, v in enumerate(rows)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    expected = brute_vectors(rows)
    lists = int(len(rows) ** 0.5)
    assert lists > 8 and answers(embedding_dedup.near_vectors(table, probes=None)) == expected
    got = answers(embedding_dedup.near_vectors(table, probes=8))
    assert sum(n for n, _, _ in got.values()) >= 0.9 * sum(n for n, _, _ in expected.values()) and all(got[k][0] <= expected[k][0] for k in got)


def test_vectors_of_extreme_lengths(spark, monkeypatch):
    rng = np.random.default_rng(13)
    base = rng.normal(size=(30, 8))
    scales = [1e-170, 1e-300, 1.0, 1e160, 1e300]
    rows = [(k * 5 + j, list(map(float, (v + rng.normal(scale=0.02, size=8)) * scale)), 0) for k, v in enumerate(base) for j, scale in enumerate(scales)]
    rows += [(9000, [5e-324] + [0.0] * 7, 0), (9001, [1.0] + [0.0] * 7, 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    expected = brute_vectors(rows)
    assert answers(embedding_dedup.near_vectors(table, probes=None)) == expected and sum(n for n, _, _ in expected.values()) >= 600
    monkeypatch.setattr(embedding_dedup, "BLOCK", 8)
    monkeypatch.setattr(embedding_dedup, "QUERIES", 16)
    monkeypatch.setattr(embedding_dedup, "IDS", 1)
    assert answers(embedding_dedup.near_vectors(table, probes=None)) == expected


def test_vectors_with_null_and_repeated_ids(spark):
    x, y = [1.0, 0.0, 0.1], [0.0, 1.0, 0.0]
    rows = [(None, x, 0), (4, x, 0), (4, x, 0), (4, y, 0), (6, y, 0), (7, x, None), (8, None, 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("n_links", F.lit("clash"))
    got = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"] or 0, r["kept"]) for r in embedding_dedup.near_vectors(table).collect())
    assert got == [(0, 0, 0, True), (4, 1, 4, True), (4, 1, 4, True), (4, 1, 4, True), (6, 1, 4, False), (7, 0, 7, True), (8, 0, 8, True)]


def test_vectors_of_one_id_under_two_labels(spark):
    x, y = [1.0, 0.0, 0.1], [0.0, 1.0, 0.0]
    rows = [(1, x, "a"), (2, x, "a"), (1, y, "b"), (3, [0.0, 1.0, 0.1], "b"), (5, x, "c"), (5, y, "c"), (7, [0.1, 1.0, 0.0], "c")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    got = sorted(tuple(r) for r in embedding_dedup.near_vectors(table).collect())
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (5, 0, 5, True), (5, 1, 5, True), (7, 1, 5, False)]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_agrees_with_sql(spark, name):
    same(entry_point.queries()[name](spark, SF), queries.ORACLE_SQL[name], SF)


def test_every_query_is_registered():
    assert [int(n.removeprefix("op").split("_")[0]) for n in queries.QUERIES] == list(range(1, 14)) and {*queries.QUERIES, "pipeline"} <= set(entry_point.queries())


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF)
        assert after.columns == docs.columns and after.count() <= before.count(), name
        before = after
    mixed = corpus_pipeline.run(spark, SF)
    assert set(docs.columns) <= set(mixed.columns) and 0 < mixed.count() <= before.count() and mixed.where("taken <= 0").count() == 0


def test_pipeline_stages_take_odd_tables(spark):
    odd = spark.createDataFrame([(1, None, None, None, None, 9.0, "k"), (2, "", "en", "a", 0, None, "k"), (None, "x y", "en", "a", 3, 1.0, None), (2, "", "en", "a", 0, None, "k")], "doc_id long, text string, lang string, source string, n_chars long, score double, kept string")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, SF).count() <= 4, name
        assert stage(spark, odd.where("false"), SF).count() == 0, name
