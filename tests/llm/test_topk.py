import math
import random

import pytest

from ledgerloom.llm import topk


def brute(rows, queries, k):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, v in ok:
        if q in queries:
            scored = sorted((-max(-(2**61), min(2**61, sum(a * b for a, b in zip(v, w)))), i) for i, w in ok if i != q and len(w) == len(v))
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize("bins", [2, 2048])
def test_against_brute_force(spark, monkeypatch, bins):
    monkeypatch.setattr(topk, "BINS", bins)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    dice = random.Random(bins)
    rows = [(i, [dice.choice([-0.5, 0.25, 0.1, 1.5]) for _ in range(4)]) for i in range(120)]
    rows += [(200 + i, [0.5] * 4) for i in range(60)]  # ties at the kth score
    rows += [(300, None), (301, [None, 1.0, 1.0, 1.0]), (302, [float("nan")] * 4), (303, [float("inf")] * 4), (310, [1.0, 2.0]), (350, [3.0, 1.0]), (400, [])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, score string").repartition(5)
    got = {tuple(r) for r in topk.top_k(df, df.filter("vec_id % 50 = 0"), 5).collect()}
    assert got == brute(rows, set(range(0, 500, 50)), 5)


@pytest.mark.parametrize("bins", [64, 2048])
def test_large_finite_values_are_exact(spark, monkeypatch, bins):
    """Products over 2^53, over 2^63, and parts whose squares no float holds."""
    monkeypatch.setattr(topk, "BINS", bins)
    monkeypatch.setattr(topk, "QUERY_CELLS", 7)
    dice = random.Random(1)
    rows = [(i, [dice.choice([1.0, -1.0]) * dice.random() * 2.0 ** dice.choice([0, 20, 24, 30]) for _ in range(3)]) for i in range(80)]
    rows += [(100, [1e17, 1.0, -1e17]), (101, [1e17, 3.0, 1e17]), (150, [1e290, 0.0, 1.0]), (151, [-1e290, 1e-9, 7.0]), (152, [0.0, 3e13, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = {tuple(r) for r in topk.top_k(df, df.filter("vec_id % 50 = 0"), 5).collect()}
    assert got == brute(rows, {0, 50, 100, 150}, 5)


def test_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(df, df.filter("vec_id = 0"), 5).collect()] == [(0, 1, 1, 256 * 512)]
    assert topk.top_k(df.limit(0), df.limit(0), 5).collect() == []
    assert topk.top_k(df, df.filter("vec_id = 9"), 5).collect() == []
