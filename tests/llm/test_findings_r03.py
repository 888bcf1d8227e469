import time
from pathlib import Path

import numpy as np
import pyarrow as pa

from verbarium.llm import line_dedup, token_alignment


def test_first_link_of_a_chunk_whose_first_end_is_of_b(spark, monkeypatch):
    """B ends its first token, the space alone, within A's first one; the pair is a link in every chunk."""
    monkeypatch.setattr(token_alignment, "CHUNK", 1)
    encoder = token_alignment.Encoder(token_alignment.Tokenizers())
    docs = ["1|2;3", "ﬁnal", "the quick", "1|2;3"]
    got = {r["doc_id"]: r for r in token_alignment.report(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").coalesce(1)).collect()}
    all_links = []
    for text in docs:
        sides = []
        for ids, sizes in ((encoder.by_a([text])[0], encoder.a_sizes), (encoder.b.encode(text), encoder.b_sizes)):
            ends = sizes[ids].cumsum().tolist()
            sides.append(list(zip(ids, [0, *ends], ends, strict=False)))
        all_links.append([(a, b) for a, a0, a1 in sides[0] for b, b0, b1 in sides[1] if a0 < b1 and b0 < a1])
    assert any(len(x) for x in all_links)
    for k, links in enumerate(all_links):
        held = [sum(pair in other for other in all_links) for pair in links]
        most = {a: max(sum((x, y) in other for other in all_links) for lk in all_links for x, y in lk if x == a) for a, _ in links}
        best = sum(n == most[a] for n, (a, _) in zip(held, links, strict=True))
        assert (got[k]["n_links"], got[k]["n_best"], got[k]["count_sum"]) == (len(links), best, sum(held))


def test_very_long_blanks(spark):
    """A million line feeds and more in a row, which the faster library's pattern gave up on."""
    text = "\n" * 1_000_000
    row = token_alignment.report(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row["n_a"] == 500_001 and row["n_b"] == 1_000_001 and len(row["groups_sha256"]) == 64


def test_texts_of_pairs_that_cannot_be_similar_are_not_moved(spark, monkeypatch):
    """Lines with a long passage in common are candidates; their counts of characters tell them apart before their texts meet."""
    compared, plain = [], line_dedup.in_batches
    monkeypatch.setattr(line_dedup, "in_batches", lambda df, *rest: compared.append(df.count() if "ta" in df.columns else 0) or plain(df, *rest))
    passage = " ".join(f"word{chr(97 + k)} and{chr(122 - k)}" for k in range(26))
    tails = ["jjjj qqqq jjjj qqqq jjjj qqqq jjjj qqqq jjjj qqqq", "zzzz xxxx zzzz xxxx zzzz xxxx zzzz xxxx zzzz xxxx", "vvvv kkkk vvvv kkkk vvvv kkkk vvvv kkkk vvvv kkkk"]
    lines = [*(f"{passage} {t}" for t in tails), f"{passage} {tails[0]}a"]
    # The last document comes twice, with the lines that its text alone is read for.
    docs = spark.createDataFrame([*enumerate(lines), (3, lines[3])], "doc_id long, text string")
    got = line_dedup.repeated_lines(docs).select("doc_id", "removed").collect()
    assert {(r["doc_id"], *r["removed"]) for r in got} == {(3, 0)}
    assert sum(compared) == 1


def test_sketches_never_exceed_the_edits():
    a = ["", "abc", "a" * 300, "naïve café 00", "the quick brown fox"]
    b = ["xyz", "cab", "a" * 290 + "b", "naive cafe 00", "the quick brown ox"]
    least = line_dedup.least_edits(line_dedup.sketches(a), line_dedup.sketches(b)).tolist()
    longer = [(x, y) if len(x) >= len(y) else (y, x) for x, y in zip(a, b, strict=True)]
    exact = [n if y else len(x) for (x, y), n in zip(longer, line_dedup.edits(longer, [400] * len(a)), strict=True)]
    assert all(n <= m for n, m in zip(least, exact, strict=True)) and least[0] == 3 and least[4] == 1


def test_units_are_aligned_outside_of_lambdas(spark):
    """Groups and links come of arrays of a chunk's tokens; interpreted functions took most of the time."""
    docs = spark.createDataFrame([(1, "the quick naïve ﬁnal 1|2;3"), (2, None), (3, "the the quick")], "doc_id long, text string")
    aligned = token_alignment.align(docs.coalesce(1))
    plan = aligned._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and plan.count("MapInArrow") == 1
    rows = {r["doc_id"]: r for r in aligned.collect()}
    assert (rows[2]["groups"], rows[2]["n_groups"], rows[2]["links"]) == ("", 0, [])
    for k in (1, 3):
        groups = [[side.split(",") for side in g.split("|")] for g in rows[k]["groups"].split(";")]
        assert rows[k]["n_groups"] == len(groups) and [sum(len(g[s]) for g in groups) for s in (0, 1)] == [rows[k]["n_a"], rows[k]["n_b"]]
        pairs = {(int(a), int(b)) for x, y in groups for a in x for b in y}
        assert {(x >> token_alignment.ID_BITS, x % token_alignment.IDS) for x in rows[k]["links"]} <= pairs


def test_members_whose_sketches_tell_them_apart_are_not_moved(spark, monkeypatch):
    """Lines of a dense bucket have a passage in common; no text of theirs meets another if their counts of characters differ."""
    gathered, plain = [], line_dedup.in_batches
    monkeypatch.setattr(line_dedup, "in_batches", lambda df, *rest: ("bucket" in df.columns and gathered.append((df.count(), "text" in df.columns))) or plain(df, *rest))
    passage = " ".join(f"word{chr(97 + k)} and{chr(122 - k)}" for k in range(26))
    tails = [" ".join(2 * [4 * chr(97 + 2 * k), 4 * chr(98 + 2 * k)] * 2) + " " + 8 * chr(97 + 2 * k) for k in range(12)]
    docs = spark.createDataFrame(list(enumerate(f"{passage} {t}" for t in tails)), "doc_id long, text string")
    assert line_dedup.repeated_lines(docs).count() == 0
    assert [n > 0 for n, _ in gathered] == [True, False]


def test_shuffle_files_of_line_dedup_go_with_their_step(spark):
    """What steps shuffle is stored before the next one begins. A stage that adaptive execution gave up may leave a file."""
    dirs = [d.toString() for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    files = lambda: {str(f) for d in dirs for f in Path(d).rglob("shuffle_*.data")}
    before, name = files(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(name)
    lines = [f"a line of number {'abcdefgh'[k % 8] * 30} and more of it {'xyz'[k % 3]}" for k in range(60)]
    out = line_dedup.dedup_lines(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"))
    until = time.time() + 30
    while len(files() - before) > 3 and time.time() < until:
        time.sleep(0.2)
    assert len(files() - before) <= 3
    assert out.where("size(removed) > 0").count() > 30 and spark.conf.get(name) == setting


def test_lines_are_read_by_their_positions(spark):
    """A text's asked lines are normalised and no others; positions count empty and short lines."""
    lines = ["", "Intro", "The quick brown fox jumps over the lazy dog and runs, away!", "x", "The quick brown fox jumps over the lazy dog and runs, aways!"]
    asked = [{"line": 7, "pos": 4}, {"line": 5, "pos": 2}]
    batch = pa.record_batch([pa.array(["\n".join(lines).encode()]), pa.array([asked])], names=["text", "asked"])
    rows = pa.Table.from_batches(line_dedup._texts(iter([batch]))).to_pylist()
    assert [(r["line"], r["text"]) for r in rows] == [(7, "the quick brown fox jumps over the lazy dog and runs aways"), (5, "the quick brown fox jumps over the lazy dog and runs away")]
    assert [r["length"] for r in rows] == [len(r["text"]) for r in rows]


def test_words_are_encoded_together_and_aligned_once(monkeypatch):
    """A call to each tokenizer takes many plain words; what a worker remembers is neither encoded nor aligned again."""
    encoder, calls, aligned, plain = token_alignment.Encoder(token_alignment.Tokenizers()), [], [], token_alignment._units
    monkeypatch.setattr(token_alignment, "_units", lambda a, b: aligned.append(len(a[1])) or plain(a, b))
    alone = {}
    words = [f"w{k}ord's" for k in range(300)] + ["'s", "1|2;3", "naïve", "½x", "a  b", "ﬁnal", "tab\tin"]
    for u in words:
        alone[u] = (encoder.by_a([u])[0], encoder.b.encode(u))
    quick, b = encoder.fast, encoder.b
    encoder.fast = type("Counted", (), {"encode_ordinary": lambda self, x: calls.append(x) or quick.encode_ordinary(x)})()
    texts = [" ".join(words[:300]), " ".join(words[:304]), None, "a  b", "tab\tin " + words[3]]
    units, counts = encoder.chunk(texts)
    assert len(calls) <= 12 and sum(aligned) == len(set(units.tolist()))
    again, _ = encoder.chunk(texts)
    assert again.tolist() == units.tolist() and sum(aligned) == len(set(units.tolist()))
    for u in ("w7ord's", "'s", "1|2;3", "naïve"):
        k = np.array([encoder.known.number[u]])
        assert tuple(side.take(k)[0].tolist() for side in encoder.known.ids) == alone[u]
    assert b is encoder.b and counts.tolist()[2] == 0
