"""Outflows scored against the same user's and category's earlier days.

Days are summed first, as exact counts, cents and squared cents. The windows then run over
days, so that a category with very many rows is as long as its days, and zero spread is an
exact test.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.schema import ANOMALIES

GROUP = ("user_id", "category")


def _moments(frame) -> Column:
    """n, s and d of a frame; q too, null where a day's or their sum passes 38 digits."""
    total = lambda c: F.try_sum(c).over(frame)
    lost = F.max(F.col("q").isNull()).over(frame)
    return F.struct(F.coalesce(total("n"), F.lit(0)).alias("n"), total("s").alias("s"), F.when(~lost, total("q")).alias("q"), total("d").alias("d"))


def score_anomalies(txns: DataFrame, window_days: int = 90, min_history: int = 5, z_threshold: float = 3.0) -> DataFrame:
    """Every outflow with its baseline, z_score and is_anomaly.

    The baseline is of the window_days days before, if they hold min_history outflows, else
    of all days before; the row's own day is in neither. z_score is null without min_history
    rows or without spread. Only z above the threshold is an anomaly.
    """
    out = txns.filter(F.col("flow") == "outflow").withColumn("_day", F.unix_date("posted_date"))
    cents = (-F.col("amount") * 100).cast("decimal(18,0)")
    days = out.groupBy(*GROUP, "_day").agg(
        F.count("amount").alias("n"), F.sum(cents).cast("decimal(38,0)").alias("s"), F.try_sum((cents * cents).cast("decimal(38,0)")).cast("decimal(38,0)").alias("q"),
        F.sum(cents.cast("double") * cents.cast("double")).alias("d"))
    line = Window.partitionBy(*GROUP).orderBy("_day")
    both = days.withColumns({"_recent": _moments(line.rangeBetween(-window_days, -1)), "_all": _moments(line.rangeBetween(Window.unboundedPreceding, -1))})
    recent = F.col("_recent")["n"] >= min_history
    n, s, q, d = (F.col("_base")[x] for x in "nsqd")
    # exact, but for amounts whose squares pass 38 digits
    exact = F.try_subtract(F.try_multiply(n.cast("decimal(20,0)"), q), F.try_multiply(s, s)).cast("double")
    spread = F.coalesce(exact, n * d - s.cast("double") * s.cast("double"))
    baselines = (
        both.select(*GROUP, "_day", F.when(recent, "recent").otherwise("history").alias("baseline_scope"), F.when(recent, F.col("_recent")).otherwise(F.col("_all")).alias("_base"))
        .select(
            *[F.col(c).alias(f"_of_{c}") for c in (*GROUP, "_day")], "baseline_scope", n.alias("baseline_count"),
            F.when(n > 0, s.cast("double") / n / F.lit(100.0)).alias("baseline_mean"),
            F.when(n > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / n / (n - 1)) / F.lit(100.0)).alias("baseline_stddev"),
            ((n >= min_history) & (spread > 0)).alias("_fit"),
        )
    )
    on = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in (*GROUP, "_day")]
    return (
        out.join(baselines, on, "left")
        .select(*txns.columns, (-F.col("amount")).cast("double").alias("magnitude"), "baseline_scope", "baseline_count", "baseline_mean", "baseline_stddev", "_fit")
        .withColumn("z_score", F.when(F.col("_fit"), (F.col("magnitude") - F.col("baseline_mean")) / F.col("baseline_stddev")))
        .withColumn("is_anomaly", F.coalesce(F.col("z_score") > z_threshold, F.lit(False)))
        .drop("_fit")
    )


def anomalies(scored: DataFrame) -> DataFrame:
    return scored.filter("is_anomaly").select(*ANOMALIES)


def anomaly_recall(scored: DataFrame, window_days: int = 90, z_threshold: float = 3.0, by: tuple[str, ...] = ()) -> DataFrame:
    """Planted, caught and flagged outflows; recall and precision, null where there are none.

    One row, also of an empty table; or, with columns to go by, one for each of their values.
    """
    planted, flagged = F.coalesce("is_planted_anomaly", F.lit(False)), F.col("is_anomaly")
    ratio = lambda of: F.when(F.col(of) > 0, F.col("caught") / F.col(of))
    return (
        scored.groupBy(*by).agg(F.count_if(planted).alias("planted"), F.count_if(planted & flagged).alias("caught"), F.count_if(flagged).alias("flagged"))
        .withColumns({
            "recall": ratio("planted"), "precision": ratio("flagged"),
            "z_threshold": F.lit(float(z_threshold)), "window_days": F.lit(window_days), "computed_at": F.current_timestamp(),
        })
    )
