from collections import Counter
from datetime import datetime, timedelta

import pytest

from verbarium.operators.selection import PER_WORD, ROOM, SPARE, select_for_learners, shared_order

NOW = datetime(2024, 1, 1)
RECORD = "user_id string, word_id string, seen_count long, error_count long, last_seen_at timestamp_ntz, is_useless boolean"


def pool(spark, tiers):
    rows = [(k, f"{tier or 'none'}{k}", tier) for k, tier in enumerate(t for t, size in tiers for _ in range(size))]
    return spark.createDataFrame(rows, "_ord long, id string, frequency string")


def records(spark, rows=()):
    return spark.createDataFrame(list(rows), RECORD)


def learners(spark, n):
    return spark.range(n).selectExpr("cast(id as string) as user_id")


def chi_square(found, shares):
    total = sum(found.values())
    return sum((found[k] - total * p) ** 2 / (total * p) for k, p in shares.items())


def test_shared_order_counts_every_tier(spark):
    got = shared_order(pool(spark, [("high", 700), (None, 40), ("rare", 2)])).collect()
    for tier, size in (("high", 700), ("", 42)):
        assert sorted(r["pos"] for r in got if r["tier"] == tier) == list(range(size))


@pytest.mark.parametrize("sizes", [(2, 3, 1), (200, 300, 100)])
def test_first_draws_follow_the_weights(spark, sizes):
    """Keys for each word (small tiers) and jumps (large ones): tiers by their weight, words of a tier evenly."""
    words = pool(spark, list(zip(("high", "medium", "low"), sizes, strict=True)))
    drawn = select_for_learners(words, records(spark), learners(spark, 3000), 2, NOW, 5).collect()
    weights = {"high": 1.2 * sizes[0], "medium": 1.0 * sizes[1], "low": 0.8 * sizes[2]}
    shares = {t: w / sum(weights.values()) for t, w in weights.items()}
    first = [r for r in drawn if r["rank"] == 1]
    assert len(first) == 3000 and len(drawn) == 6000 and len({(r["user_id"], r["id"]) for r in drawn}) == 6000
    assert chi_square(Counter(r["tier"] for r in first), shares) < 13.8  # 0.001 of two degrees of freedom
    tenths = Counter((r["tier"], 10 * r["pos"] // size) for r in first for size in [sizes[("high", "medium", "low").index(r["tier"])]] if size >= 100)
    expected = {(t, k): shares[t] / 10 for t in shares for k in range(10)}
    assert not tenths or chi_square(tenths, expected) < 58.3  # 0.001 of 29


@pytest.mark.parametrize("size", [6, 400])
def test_second_draws_leave_the_first_out(spark, size):
    """Two words with heavy records among unseen ones: the pair comes with the chance of drawing one by one."""
    words = pool(spark, [("medium", size)])
    ids = sorted(r["id"] for r in words.collect())
    seen = [(str(u), ids[k], 1, errors, None, False) for u in range(2000) for k, errors in ((0, 5 * size), (1, 2 * size))]
    drawn = select_for_learners(words, records(spark, seen), learners(spark, 2000), 2, NOW, 9).collect()
    pairs = {}
    for r in drawn:
        pairs.setdefault(r["user_id"], {})[r["rank"]] = r["id"]
    a, b, rest = 1 + 15.0 * size, 1 + 6.0 * size, 5.0 * (size - 2)
    total = a + b + rest
    shares = {"ab": a / total * b / (b + rest), "ba": b / total * a / (a + rest)}
    shares["other"] = 1 - sum(shares.values())
    kinds = Counter("ab" if (p[1], p[2]) == (ids[0], ids[1]) else "ba" if (p[1], p[2]) == (ids[1], ids[0]) else "other" for p in pairs.values())
    assert chi_square(kinds, shares) < 13.8


def test_records_and_limits(spark):
    words = pool(spark, [("high", 3), (None, 400)])
    useless = [("0", f"high{k}", 1, 0, None, True) for k in range(3)] + [("0", "none7", 2, 1, NOW, False), ("1", "unknown", 1, 1, None, False), (None, "high1", 1, 1, None, False)]
    who = learners(spark, 3).union(learners(spark, 1)).union(spark.createDataFrame([(None,)], "user_id string"))
    drawn = select_for_learners(words, records(spark, useless), who, 30, NOW, 1).collect()
    assert Counter(r["user_id"] for r in drawn) == {"0": 30, "1": 30, "2": 30} and len({(r["user_id"], r["pos"], r["tier"]) for r in drawn}) == 90
    assert not [r for r in drawn if r["user_id"] == "0" and (r["tier"] == "high" or r["id"] == "none7")]
    assert sorted(r["rank"] for r in drawn if r["user_id"] == "2") == list(range(1, 31))
    everything = select_for_learners(words, records(spark, useless), who, 1000, NOW, 1).collect()
    assert Counter(r["user_id"] for r in everything) == {"0": 399, "1": 403, "2": 403}
    assert select_for_learners(words, records(spark), who, 0, NOW).count() == 0
    assert select_for_learners(words.limit(0), records(spark, useless), who, 3, NOW).count() == 0
    assert select_for_learners(words, records(spark), who.limit(0), 3, NOW).count() == 0


def test_rows_grow_with_learners_and_records(spark):
    plan = select_for_learners(pool(spark, [("high", 4000)]), records(spark), learners(spark, 9), 3, NOW)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "WindowGroupLimit" in plan
    assert ROOM * 3 < 4000 and PER_WORD * 3 + SPARE < 4000


def test_recent_words_come_seldom(spark):
    words = pool(spark, [("medium", 2)])
    rows = [(str(u), "medium0", 1, 0, NOW - timedelta(hours=1), False) for u in range(2000)]
    first = Counter(r["id"] for r in select_for_learners(words, records(spark, rows), learners(spark, 2000), 1, NOW, 2).collect())
    assert chi_square(first, {"medium0": 0.5 / 5.5, "medium1": 5 / 5.5}) < 10.8
