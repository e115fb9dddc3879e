"""The layered jobs: raw files to bronze, silver and gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.errors import ContractError
from ledgerloom.functions.contracts import check_unique
from ledgerloom.functions.rules import Rule
from ledgerloom.operators import anomalies, balances, ledger, metrics
from ledgerloom.schema import AUDIT
from ledgerloom.sources import files
from ledgerloom.sources.settings import Settings
from ledgerloom.sources.tables import write_table


def bronze(spark: SparkSession, settings: Settings, root: str) -> dict[str, int]:
    found = files.ingest_all(spark, root)
    return {table: write_table(df, settings.table(f"bronze_{table}"), rows) for table, (df, rows) in found.items()}


def silver(spark: SparkSession, settings: Settings, rules: list[Rule]) -> dict[str, int]:
    """Deduplicated rows are kept once, as they are counted, checked and joined with themselves."""
    rows = ledger.dedup_transactions(spark.table(settings.table("bronze_transactions")).drop(*AUDIT)).persist()
    try:
        check_unique(rows, "transactions", "transaction_id")
        paired = ledger.pair_transfers(ledger.categorize(rows, rules), settings.transfer_window_days)
        out = {"silver_transactions": write_table(paired.select(*ledger.SILVER_TRANSACTIONS), settings.table("silver_transactions"), rows.count())}
    finally:
        rows.unpersist()
    latest = balances.latest_snapshots(spark.table(settings.table("bronze_balance_snapshots")))
    name = settings.table("silver_account_balance_history")
    out["silver_account_balance_history"] = write_table(balances.balance_history(latest), name)
    check_history(spark.table(name))
    return out


def check_history(history: DataFrame) -> None:
    """Every account has one current version, and every version ends after it starts."""
    check_unique(history.filter("is_current"), "balance history", "user_id", "account_id")
    if not history.filter("valid_to <= valid_from").isEmpty():
        raise ContractError("balance history: a version ends before it starts")


def gold(spark: SparkSession, settings: Settings) -> dict[str, int]:
    txns = spark.table(settings.table("silver_transactions"))
    history = spark.table(settings.table("silver_account_balance_history"))
    days, z = settings.anomaly_window_days, settings.anomaly_z_threshold
    scored = anomalies.score_anomalies(txns, days, settings.anomaly_min_history, z).persist()
    totals = metrics.monthly_totals(txns).persist()
    made = {
        "gold_monthly_spend_by_category": metrics.spend_of(totals),
        "gold_cash_flow_monthly": metrics.cash_flow_of(totals),
        "gold_net_worth_daily": balances.net_worth_daily(history),
        "gold_anomalies": anomalies.anomalies(scored),
        "gold_anomaly_recall": anomalies.anomaly_recall(scored, days, z),
    }
    try:
        return {name: write_table(df, settings.table(name)) for name, df in made.items()}
    finally:
        scored.unpersist()
        totals.unpersist()
