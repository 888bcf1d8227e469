"""Token alignment, filter audit and exact dedup against brute force."""

import hashlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

import __spark_entry__ as entry_point
from tests.oracle import same
from verbarium.llm import exact_dedup, filter_audit
from verbarium.llm import token_alignment as ta

SF = "/root/testdata/sf0.001"


def table(spark, rows, ddl="doc_id long, text string"):
    return spark.createDataFrame(rows, ddl)


# Token alignment -------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizers():
    files = ta.Tokenizers()
    a = Tokenizer.from_file(files.byte_bpe)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=files.piece_bpe)


def spelt(tokenizers, text):
    """[(id, bytes)] of both sides for a space and the text, encoded whole."""
    a, b = tokenizers
    letters = ta.byte_letters()
    of_a = [(k, bytes(letters[c] for c in a.id_to_token(k))) for k in a.encode(" " + text, add_special_tokens=False).ids]
    of_b = [(k, bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode()) for k in b.encode(text)]
    wanted = (" " + text).encode()
    fits = all(b"".join(x for _, x in side) == wanted for side in (of_a, of_b))
    return (of_a, of_b) if text and fits else ([], [])


def aligned(tokenizers, docs):
    """What the report says, by intervals: {doc_id: row}."""
    rows, links = {}, {}
    for doc_id, text in docs:
        sides = []
        for side in spelt(tokenizers, text or ""):
            end, out = 0, []
            for k, x in side:
                out.append((k, end, end + len(x)))
                end += len(x)
            sides.append(out)
        a, b = sides
        cuts = sorted({t[2] for t in a} & {t[2] for t in b})
        groups, low = [], 0
        for high in cuts:
            groups.append("|".join(",".join(str(k) for k, s, e in side if s >= low and e <= high) for side in sides))
            low = high
        pairs, j = [], 0
        for k, s, e in a:
            while j and b[j - 1][2] > s:
                j -= 1
            while j < len(b) and b[j][1] < e:
                if b[j][2] > s:
                    pairs.append((k, b[j][0]))
                j += 1
        links[doc_id] = pairs
        rows[doc_id] = [len(a), len(b), len(cuts), len(pairs), ";".join(groups)]
    count = Counter(p for x in links.values() for p in set(x))
    most = defaultdict(int)
    for (k, _), n in count.items():
        most[k] = max(most[k], n)
    return {d: (*r[:4], sum(count[p] == most[p[0]] for p in links[d]), sum(count[p] for p in links[d]), hashlib.sha256(r[4].encode()).hexdigest() if r[4] else "") for d, r in rows.items()}


def reported(df):
    return {r["doc_id"]: (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]) for r in df.collect()}


ODD = ["", None, " ", "   ", "a", " a", "a ", "two  spaces", "a\nb c\n\n d", "tab\tand \x85 nel", "▁", "a ▁ b", "x▁y z", "<|endoftext|> <s> </s> <unk>", "naïve café 東京タワー 😀👩‍👩‍👧", "'s 't don't I'll 123 456,789", "\x00\x01 \x7f", "a" * 5000, "ab " * 3000, "   b c ᠎d", "ﬁ ½ Å Å", "﻿bom x", "é é ́"]


def test_alignment_against_brute_force(spark, tokenizers):
    docs = [(k, t) for k, t in enumerate(ODD)] + [(100 + k, t) for k, t in enumerate(ODD[:4])]
    assert reported(ta.report(table(spark, docs))) == aligned(tokenizers, docs)


def test_alignment_query(spark, tokenizers):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert reported(entry_point.queries()["op11_token_alignment"](spark, SF)) == aligned(tokenizers, docs)


def test_alignment_by_shuffle(spark, tokenizers, monkeypatch):
    monkeypatch.setattr(ta, "PAIRS", 0)
    docs = [(k, t) for k, t in enumerate(["one two three", "one two", "three three one", None])]
    assert reported(ta.report(table(spark, docs))) == aligned(tokenizers, docs)


def test_alignment_of_odd_tables(spark, tokenizers):
    assert ta.report(table(spark, [])).count() == 0
    rows = table(spark, [(1, "same words", "x", 1), (1, "same words", "y", 2), (None, "same words", None, None)], "doc_id long, text string, links string, _row int")
    got = ta.report(rows).collect()
    assert len(got) == 3 and len({(r["n_links"], r["count_sum"], r["groups_sha256"]) for r in got}) == 1
    assert got[0]["count_sum"] == 3 * got[0]["n_links"]


def test_units_are_forgotten(monkeypatch):
    monkeypatch.setattr(ta, "REMEMBERED", 2)
    encoder = ta.Encoder(ta.Tokenizers())
    texts = ["one two three four", None, "five one " + "x" * 100, "two"]
    first, again = encoder.chunk(texts), encoder.chunk(texts)
    for x, y in zip(first, again, strict=True):
        assert all(np.array_equal(p, q) for p, q in zip(x, y, strict=True))
    assert all(len(u) <= ta.UNIT for u in encoder.known) and encoder.older


def test_texts_of_one_chunk(spark, tokenizers):
    docs = [(k, t) for k, t in enumerate(ODD[:12])]
    assert ta.tokenize(table(spark, docs).coalesce(1)).count() == 1
    assert reported(ta.report(table(spark, docs).coalesce(1))) == aligned(tokenizers, docs)


# Filter audit ----------------------------------------------------------------


def audited(docs, labels):
    """{(part, order, step): measures} by playing every order over every document."""
    first = {}
    for doc_id, text, _ in docs:
        t = text or ""
        if doc_id is not None:
            first[t] = min(first.get(t, doc_id), doc_id)
    failed = []
    for doc_id, text, lang in docs:
        t = text or ""
        words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", t) if w]
        f = {x for x, c in zip("ABCD", (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t), any(c in "#$%&*|" for c in t)), strict=True) if c}
        if doc_id is not None and doc_id > first[t]:
            f.add("E")
        of = [(q, x) for d, q, x in labels if d is not None and d == doc_id]
        failed.append((lang or "", f, any(q == 1 for q, _ in of), any(x == 1 for _, x in of)))
    out = {}
    for part in {p for p, *_ in failed}:
        total = Counter()
        for order in permutations("ABCDE"):
            left = [x[1:] for x in failed if x[0] == part]
            every = left
            for step, f in enumerate(order, 1):
                here = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                failing = sum(f in x[0] for x in every)
                out[part, "".join(order), step] = [len(left), len(here), failing - len(here), sum(x[0] == {f} for x in every), sum(x[1] for x in here), sum(x[2] for x in here)]
                total[f] += len(here)
        for order in permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                out[part, "".join(order), step].append(total[f])
    return out


LONG = " ".join(f"w{k}" for k in range(250))
DOCS = [
    (5, LONG, "en"), (3, LONG, "fr"), (3, LONG, "en"), (9, LONG, None), (1, None, "en"), (2, "", ""), (None, "", "en"), (None, LONG, "en"),
    (10, LONG + " # x", "en"), (11, "same " * 300, "en"), (12, LONG.upper(), "de"), (13, "A B　c", "de"), (14, "short | text", "de"), (15, "\x1cx " * 250, "de"),
]
LABELS = [(5, 1, 0), (5, 0, 1), (3, None, None), (9, 1, 1), (None, 1, 1), (11, 0, 1), (99, 1, 1), (13, 1, None)]


def audit_rows(df):
    return {(r["part"], r["filter_order"], r["step"]): [r[m] for m in filter_audit.MEASURES] for r in df.collect()}


def test_audit_against_brute_force(spark):
    docs, labels = table(spark, DOCS, "doc_id long, text string, lang string"), table(spark, LABELS, "doc_id long, quality int, toxic int")
    assert audit_rows(filter_audit.audit(docs, labels)) == audited(DOCS, LABELS)
    wide = docs.selectExpr("*", "1 as good", "2 as mask", "3 as part", "4 as n")
    assert audit_rows(filter_audit.audit(wide, labels)) == audited(DOCS, LABELS)


def test_audit_of_empty_tables(spark):
    docs, labels = table(spark, [], "doc_id long, text string, lang string"), table(spark, [], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs, labels).count() == 0
    some = table(spark, DOCS, "doc_id long, text string, lang string")
    assert audit_rows(filter_audit.audit(some, labels)) == audited(DOCS, [])


def test_audit_of_many_parts(spark):
    docs = [(k, LONG if k % 3 else "x", f"l{k % 150}") for k in range(300)]
    got = audit_rows(filter_audit.audit(table(spark, docs, "doc_id long, text string, lang string"), table(spark, LABELS, "doc_id long, quality int, toxic int")))
    assert len(got) == 150 * 600 and {k: v for k, v in got.items() if k[0] == "l7"} == {k: v for k, v in audited(docs, LABELS).items() if k[0] == "l7"}


def test_matrices():
    found = filter_audit.matrices(5)
    assert {x.shape for x in found.values()} == {(32, 600)} and {x.dtype for x in found.values()} == {np.dtype(np.int64)}
    # Every document is removed once at most, and at the last step kept or removed by then.
    removed = found["removed"].reshape(32, 120, 5)
    assert ((removed.sum(axis=2) + found["kept"].reshape(32, 120, 5)[:, :, 4]) == 1).all()


# Exact dedup -----------------------------------------------------------------


def grouped(docs):
    groups = defaultdict(list)
    for doc_id, text in docs:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max((d for d in ids if d is not None), default=None)
        out += [(d, keep, len(ids), d == keep, hashlib.sha256(text.encode()).hexdigest()) for d in ids]
    return sorted(out, key=repr)


def group_rows(df):
    return sorted([tuple(r[c] for c in ("doc_id", "keep_id", "group_size", "kept", "text_sha256")) for r in df.collect()], key=repr)


TEXTS = ["a", "a", "b", "", None, "a ", "A", "é", "é", "x" * 300_000, "x" * 300_000, "x" * 299_999]
ROWS = [*enumerate(TEXTS), (3, "b"), (3, ""), (3, ""), (None, "b"), (None, "only null"), (None, "only null")]


@pytest.mark.parametrize("bits", [64, 2, 1])
def test_groups_against_brute_force(spark, bits):
    assert group_rows(exact_dedup.groups(table(spark, ROWS), hash_bits=bits)) == grouped(ROWS)


@pytest.mark.parametrize("bits", [64, 4])
def test_groups_without_the_list_of_repeated_hashes(spark, monkeypatch, bits):
    monkeypatch.setattr(exact_dedup, "small", lambda df: df)
    assert group_rows(exact_dedup.groups(table(spark, ROWS), hash_bits=bits)) == grouped(ROWS)


def test_directory_splits_overfull_buckets(spark):
    docs = [(k, f"text {k % 700}") for k in range(1000)]
    index = exact_dedup.build(table(spark, docs), capacity=20)
    slots = {r["slot"]: r for r in index.directory.collect()}
    held = Counter(r["bucket"] for r in index.entries.collect())
    assert index.depth >= 6 and max(held.values()) <= 20 and sum(held.values()) == 700
    for r in index.entries.collect():
        slot = slots[(r["hash"] % (1 << 64)) >> (64 - index.depth)]
        assert slot["bucket"] == r["bucket"] and r["chain"] == 1 and r["digest"] is None
    # A bucket of fewer bits than the directory has several slots, and its other half holds keys too many for one.
    for bucket, n in Counter(r["bucket"] for r in slots.values()).items():
        depth = next(r["local_depth"] for r in slots.values() if r["bucket"] == bucket)
        assert n == 1 << (index.depth - depth)
        mates = {s["bucket"] for k, s in slots.items() if k >> (index.depth - depth + 1) == bucket >> (exact_dedup.CELL_BITS - depth + 1)}
        assert depth == 0 or sum(held[b] for b in mates) > 20


def test_collisions_are_chained(spark):
    index = exact_dedup.build(table(spark, [(k, f"t{k}") for k in range(40)]), capacity=4, hash_bits=2)
    chains = defaultdict(list)
    for r in index.entries.collect():
        chains[r["hash"]].append(r["chain"])
    assert sum(map(len, chains.values())) == 40 and all(sorted(c) == list(range(1, len(c) + 1)) for c in chains.values())


def test_deduplicate_keeps_rows_whole(spark):
    rows = [(1, "a", "x", True), (2, "a", "y", None), (None, "a", "z", None), (3, None, None, None), (4, "", "e", None)]
    left = exact_dedup.deduplicate(table(spark, rows, "doc_id long, text string, keep_id string, kept boolean"))
    assert sorted(left.collect()) == [(2, "a", "y", None), (4, "", "e", None)] and left.columns == ["doc_id", "text", "keep_id", "kept"]
    assert exact_dedup.groups(table(spark, [])).count() == 0


@pytest.mark.parametrize("name", ["op12_filter_audit", "op13_exact_dedup"])
def test_new_queries_agree_with_sql(spark, name):
    same(entry_point.queries()[name](spark, SF), entry_point.oracle_sql()[name], SF)


def test_no_python_in_exact_dedup(spark):
    plan = exact_dedup.groups(table(spark, ROWS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
