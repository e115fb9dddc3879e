import random

import pytest

from ledgerloom.llm import mixing


def highest_quotients(shares, seats):
    got = [0] * len(shares)
    for _ in range(seats):
        i = max(range(len(shares)), key=lambda k: (shares[k] / (2 * got[k] + 1), -k))
        got[i] += 1
    return got


@pytest.mark.parametrize("seed", range(6))
def test_apportionment(seed):
    dice = random.Random(seed)
    shares = [dice.choice([0.0, 1.0, 5.0, 5.0, dice.uniform(0, 90)]) for _ in range(dice.randint(1, 9))] + [2.0]
    for seats in (0, 1, 7, 200):
        assert mixing.sainte_lague(shares, seats) == highest_quotients(shares, seats)
    assert mixing.sainte_lague([0.0], 5) == [0]


def test_targets_reshare_the_excess():
    sizes, weights = [10, 1000, 1000, 5], [3, 1, 2, 3]
    t = mixing.targets(sizes, weights)
    assert t[0] == 30 and t[3] == 15 and sum(t) == pytest.approx(2015) and t[2] == pytest.approx(2 * t[1])
    assert mixing.targets([0, 0], [1, 2]) == [0.0, 0.0] and mixing.targets([], []) == []


def test_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 40)
    dice = random.Random(5)
    rows = [(i, "w " * dice.randint(0, 30), dice.choice(["a", "b", "é", None]), 1) for i in range(400)]
    rows += [(400, None, "a", 1), (401, "", "b", 1), (402, "\u00a0x\u2003y z\x0bq", "a", 1), (7, "w w", "a", 1), (7, "w w", "a", 1), (None, "w", None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, target int").repartition(3)
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(df.repartition(7)).collect()))
    by = {}
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        by.setdefault((r.source, r.source_size, r.target), []).append(r)
    assert sum(r.size for r in got if r.doc_id == 402) == 3
    assert [k[0] for k in sorted(by, key=lambda k: (k[0] is None, k[0] or ""))] == ["a", "b", "é", None]
    for (_, size, target), own in by.items():
        assert sum(r.size for r in own) == size and abs(sum(r.taken for r in own) - target) <= 2
    assert mixing.mix(df.limit(0)).collect() == []
    assert [r.taken for r in mixing.mix(df.filter("doc_id = 400")).collect()] == [0]
