"""The whole pipeline, and the quality model's parts, against plain versions."""

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tests.llm.test_text_operators import AWKWARD, WORD, brute_hits, brute_lines, brute_near, letters, prose
from verbarium.llm import quality


def brute_features(text):
    raw = (text or "").encode()
    sizes = np.array([len(w.encode()) for w in WORD.findall(text or "")], dtype=float)
    kinds = {name: sum(c in chars for c in raw) for name, chars in (("digit", b"0123456789"), ("newline", b"\n"), ("stop", b".,;:?'\"()-"), ("bang", b"!"), ("bar", b"|"))}
    kinds["high"] = sum(c >= 128 for c in raw)
    upper, lower, blank = (sum(test(c) for c in raw) for test in (lambda c: 65 <= c <= 90, lambda c: 97 <= c <= 122, lambda c: c in b" \t\r\x0b\x0c"))
    kinds["symbol"] = len(raw) - upper - lower - blank - sum(kinds.values())
    visible, n = max(len(raw) - blank - kinds["newline"], 1), len(sizes)
    folded = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in WORD.findall(text or "")]
    share = lambda test: sum(map(test, sizes)) / max(n, 1)
    named = {
        "size": np.log1p(n),
        "word_mean": np.log1p(sizes.mean() if n else 0),
        "word_spread": np.log1p(sizes.std() if n else 0),
        "short": share(lambda x: x <= 3),
        "long": share(lambda x: x >= 16),
        "upper": upper / max(upper + lower, 1),
        "repeat": sum(a == b for a, b in zip(folded, folded[1:], strict=False)) / max(n, 1),
        "distinct": np.log1p(len(set(folded))) / max(np.log1p(n), 1e-9),
        "empty": float(n == 0),
    }
    return [named[f] if f in named else np.sqrt(kinds[f] / visible) for f in quality.FEATURES]


def test_features_agree_with_plain_ones():
    rng = np.random.default_rng(1)
    signs = list("aZé!|.5#\n\t  漢-")
    texts = [*AWKWARD, prose(3), *("".join(rng.choice(signs, n)) for n in (1, 5, 80, 900)), "the the The end", "word " * 500_000]
    got = quality.features(pa.array([None if t is None else t.encode() for t in texts], pa.binary()))
    assert len(texts[-1]) > 2 << 20 and np.allclose(got, [brute_features(t) for t in texts], atol=1e-9)


@pytest.mark.parametrize("prior", [0.1, 0.9])
def test_slopes_agree_with_differences(prior):
    rng = np.random.default_rng(2)
    p, u = rng.normal(1, 1, (40, 5)), rng.normal(0, 1, (70, 5))
    weights = [rng.normal(0, 0.4, (5, 3)), rng.normal(0, 0.1, 3), rng.normal(0, 0.4, 3), np.zeros(1)]
    loss = lambda z: np.logaddexp(0, z).mean()

    def risk(weights):
        zp, zu = quality.forward(weights, p)[0], quality.forward(weights, u)[0]
        return prior * loss(-zp) + loss(zu) - prior * loss(zp)

    (zp, hp), (zu, hu) = quality.forward(weights, p), quality.forward(weights, u)
    sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
    parts = [quality.slopes(weights, u, hu, su / len(u)), quality.slopes(weights, p, hp, -prior * sp / len(p)), quality.slopes(weights, p, hp, -prior * (1 - sp) / len(p))]
    for k, w in enumerate(weights):
        for at in np.ndindex(w.shape):
            steps = []
            for sign in (1, -1):
                moved = [x.copy() for x in weights]
                moved[k][at] += sign * 1e-5
                steps.append(risk(moved))
            assert sum(x[k][at] for x in parts) == pytest.approx((steps[0] - steps[1]) / 2e-5, abs=1e-6)


@pytest.mark.parametrize("share", [0.2, 0.5, 0.85])
def test_prior_from_positives_and_unlabelled_rows(share):
    rng = np.random.default_rng(3)
    good, bad = rng.normal(1.5, 1, (4000, 6)), rng.normal(-1.5, 1, (3000, 6))
    n = int(3000 * share)
    unlabelled = np.concatenate([good[1000 : 1000 + n], bad[: 3000 - n]])[rng.permutation(3000)]
    assert quality.class_prior(good[:1000], unlabelled) == pytest.approx(share, abs=0.08)


def brute_mix(docs):
    size = {k: len(WORD.findall(t or "")) for k, t, _ in docs}
    totals = defaultdict(int)
    for k, _, s in docs:
        totals[s] += size[k]
    ordered = sorted(totals, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(ordered)}
    target, open_, left = {}, set(totals), 1.5 * sum(totals.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level >= 2 * totals[s]}
        target |= {s: 2.0 * totals[s] for s in over} if over else {s: weight[s] * level for s in open_}
        left -= sum(target[s] for s in over)
        open_ = open_ - over if over else set()
    taken = {}
    for source in totals:
        rest = int(np.floor(target[source] + 0.5))
        whole = rest // totals[source] if totals[source] else 0
        rest -= whole * totals[source]
        mine = sorted((int(hashlib.md5(f"17:{k}".encode()).hexdigest()[:13], 16), size[k], k) for k, _, s in docs if s == source)
        for _, n, k in mine:
            extra = min(n, max(rest, 0))
            rest -= n
            taken[k] = whole * n + extra
    return {k: n for k, n in taken.items() if n > 0}


def test_pipeline_agrees_with_plain_stages(spark, tmp_path):
    rng = np.random.default_rng(4)
    line = lambda *seed: " ".join(letters(list(seed), 14)).capitalize() + "."
    repeated, passage = [line(900, k) for k in range(3)], " ".join(letters(77, 14))
    texts, good = [], 56
    for k in range(48):
        lines = [line(k, j) for j in range(3)]
        if k % 5 == 0:
            lines.insert(2, repeated[k % 3])
        if k % 7 == 1:
            lines.append(line(k, 9)[:-1] + " " + passage + ".")
        texts.append("\n".join(lines))
    for k in range(0, 48, 6):  # near copies: the same words in other lines, with one more at the end
        texts[k] = "\n".join(line(k, j) for j in range(6))
        words = texts[k].split()
        texts.append("\n".join(" ".join(words[max(at, 0) : at + 14]) for at in range(-7, len(words), 14)) + " more")
    texts += [" ".join(f"{w.upper()}!!!|" for w in letters(2000 + k, 40)) for k in range(24)] + AWKWARD
    docs = [(k, t, "en", f"s{k % 4}", len(t or "")) for k, t in enumerate(texts)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, int(k < good), 0) for k in range(good + 24) if rng.random() < 0.9], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    items = [(1, passage), (2, "one")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    model = quality.train(spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/labels.parquet"))
    kept = [(k, t) for (k, t, *_), x in zip(docs, model.score(np.array([brute_features(d[1]) for d in docs])), strict=True) if x >= quality.THRESHOLD]
    assert sum(k < good for k, _ in kept) >= 50 and sum(good <= k < good + 24 for k, _ in kept) <= 4
    removed, left = brute_lines([t for _, t in kept]), []
    for at, (k, t) in enumerate(kept):
        text = t if at not in removed else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in removed[at])
        if at not in removed or WORD.search(text):
            left.append((k, text))
    assert 5 <= sum(map(len, removed.values()))
    near = brute_near(dict(left))
    once = [(k, t) for k, t in left if near[k][1] == k]
    clean = [(k, t, docs[k][3]) for k, t in once if not brute_hits(t, items)[-1]]
    assert len(left) > len(once) > len(clean) > 30
    expected = brute_mix(clean)
    got = {r["doc_id"]: (r["text"], r["taken"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == {k: (t, expected[k]) for k, t, _ in clean if k in expected}
