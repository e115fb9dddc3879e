import random
from datetime import date, timedelta
from decimal import Decimal

import pytest

from ledgerloom.functions.rowwise import outflow_z_score
from ledgerloom.operators import anomalies

SCHEMA = "transaction_id int, user_id string, category string, posted_date date, amount decimal(18,2), flow string, is_planted_anomaly boolean, account_id string, merchant string"
START = date(2026, 1, 1)


def frame(spark, values):
    """values: (day, magnitude)."""
    rows = [(k, "u", "c", START + timedelta(d), -Decimal(str(m)), "outflow", False, "a", "m") for k, (d, m) in enumerate(values)]
    return spark.createDataFrame(rows, SCHEMA)


def scores(spark, values, **kw):
    return {r.transaction_id: r for r in anomalies.score_anomalies(frame(spark, values), **kw).collect()}


def test_no_spread_in_recent_has_no_fallback(spark):
    r = scores(spark, [(0, 1), (1, 99), *((200 + d, 5) for d in range(5)), (210, 50)])[7]
    assert r.baseline_scope == "recent" and r.baseline_count == 5 and r.z_score is None and not r.is_anomaly and r.baseline_stddev == 0


def test_history_when_recent_is_short(spark):
    r = scores(spark, [*((d, 10 + d) for d in range(4)), (200, 11), (201, 12), (205, 90)])[6]
    assert r.baseline_scope == "history" and r.baseline_count == 6 and r.is_anomaly


def test_own_day_and_window_edges(spark):
    r = scores(spark, [*((d, 10 + d) for d in range(5)), (94, 10), (94, 500)], window_days=90)
    assert r[5].baseline_count == r[6].baseline_count == 5 and r[5].baseline_scope == "history"  # only day 4 is 90 days back
    r = scores(spark, [*((10, 10 + d) for d in range(5)), (100, 10)], window_days=90)
    assert r[5].baseline_scope == "recent"
    r = scores(spark, [*((10, 10 + d) for d in range(5)), (101, 10)], window_days=90)
    assert r[5].baseline_scope == "history"


def test_z_of_the_threshold_is_not_flagged(spark):
    r = scores(spark, [(0, 1), (1, 2), (2, 3), (3, 5)], min_history=3, z_threshold=3.0)[3]
    assert r.z_score == pytest.approx(3.0) and not r.is_anomaly


@pytest.mark.parametrize("seed", range(3))
def test_random_rows_match_rowwise(spark, seed):
    dice = random.Random(seed)
    values = sorted((dice.randint(0, 60), round(dice.uniform(1, 50), 2)) for _ in range(150))
    got = scores(spark, values, window_days=10)
    for k, (day, m) in enumerate(values):
        want = outflow_z_score(m, [x for d, x in values if day - 10 <= d < day], [x for d, x in values if d < day])
        assert got[k].z_score == (None if want is None else pytest.approx(want, abs=1e-9))


def test_recall(spark):
    empty = anomalies.anomaly_recall(anomalies.score_anomalies(frame(spark, []))).collect()
    assert [(r.planted, r.caught, r.flagged, r.recall, r.precision) for r in empty] == [(0, 0, 0, None, None)]
    assert anomalies.anomalies(anomalies.score_anomalies(frame(spark, [(0, 1)]))).collect() == []


def test_recall_by_user(spark):
    rows = [("a", True, True), ("a", True, False), ("a", False, True), ("b", None, False), ("c", True, True)]
    df = spark.createDataFrame(rows, "user_id string, is_planted_anomaly boolean, is_anomaly boolean")
    got = anomalies.anomaly_recall(df, by=("user_id",)).orderBy("user_id").collect()
    assert [(r.user_id, r.planted, r.caught, r.flagged, r.recall, r.precision) for r in got] == [("a", 2, 1, 2, 0.5, 0.5), ("b", 0, 0, 0, None, None), ("c", 1, 1, 1, 1.0, 1.0)]


def test_amounts_of_the_whole_contract(spark):
    """Squares of the largest amounts pass 38 digits; the scores then come from floats."""
    from datetime import date, timedelta
    from decimal import Decimal

    from ledgerloom.operators.anomalies import score_anomalies

    top = Decimal("9999999999999999.99")
    amounts = [-top, -top / 2, -top, -top / 2] * 60 + [-top]
    rows = [("u", "c", "outflow", date(2024, 1, 1) + timedelta(days=i // 30), a.quantize(Decimal("0.01"))) for i, a in enumerate(amounts)]
    df = spark.createDataFrame(rows, "user_id string, category string, flow string, posted_date date, amount decimal(18,2)")
    last = score_anomalies(df).orderBy("posted_date").collect()[-1]
    assert last.baseline_count == 240 and abs(last.baseline_mean / 7.5e15 - 1) < 1e-9 and abs(last.z_score - 0.998) < 0.01
