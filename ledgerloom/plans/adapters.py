"""Ledger and snapshot views over the test tables, with the contracts of the raw sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.functions.rules import Rule

RULES = [
    Rule(10, "description", "contains", "purch", "Shopping"),
    Rule(20, "merchant", "equals", "SIGNUP", "Income"),
    Rule(30, "description", "starts_with", "view ", "Browsing"),
    Rule(40, "merchant", "regex", "click|view", "Engagement"),
]


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions from events."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    user = F.concat(F.lit("u"), F.lpad(F.col("user_id").cast("string"), 6, "0"))
    kind = F.when(F.col("event_id") % 3 == 0, "-chk").when(F.col("event_id") % 3 == 1, "-sav").otherwise("-crd")
    sign = F.when(F.col("event_type").isin("signup", "click"), 1).otherwise(-1)
    return e.select(
        user.alias("user_id"), F.concat(user, kind).alias("account_id"),
        F.concat(F.lit("t"), F.lpad(F.col("event_id").cast("string"), 9, "0")).alias("transaction_id"),
        F.col("ts").cast("date").alias("posted_date"),
        (sign * F.floor(F.col("value") + 1)).cast("decimal(18,2)").alias("amount"),
        F.col("event_type").alias("merchant"), F.concat(F.upper("event_type"), F.lit(" EVENT")).alias("description"),
        F.when(F.col("event_id") % 25 == 0, "Travel").alias("user_category"),
        (F.col("value") > 150).alias("is_planted_anomaly"),
    )


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month-end balances from counts of orders."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    user = F.concat(F.lit("u"), F.lpad(F.floor(F.col("o_custkey") / 15).cast("string"), 6, "0"))
    return (
        o.groupBy(user.alias("user_id"), F.concat(user, F.lit("-"), F.col("o_orderstatus")).alias("account_id"), F.last_day(F.col("o_orderdate").cast("date")).alias("snapshot_date"))
        .agg(F.count("*").cast("decimal(18,2)").alias("balance"))
    )


def loaded_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots of two loads, the second with a third of them corrected, some in two files."""
    first = snapshots(spark, sf_dir)
    load = lambda df, day, file, more: df.select(
        "user_id", "account_id", "snapshot_date", (F.col("balance") + more).cast("decimal(18,2)").alias("balance"),
        F.lit(day).cast("date").alias("ingest_ts"), F.lit(file).alias("source_file"))
    again = first.filter(F.dayofmonth("snapshot_date") == 30)
    return load(first, "2024-01-01", "a", 0).unionByName(load(again, "2024-01-02", "b", 1)).unionByName(load(again.filter("balance > 1"), "2024-01-02", "c", 2))
