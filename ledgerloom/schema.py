"""Column contracts of the raw sets and columns of the derived tables."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def _contract(*columns: tuple[str, T.DataType], nullable: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType([T.StructField(name, kind, name in nullable) for name, kind in columns])


_S, _D = T.StringType(), T.DateType()

CONTRACTS: dict[str, T.StructType] = {
    "accounts": _contract(("user_id", _S), ("account_id", _S), ("account_type", _S), ("institution", _S), ("opened_date", _D)),
    "transactions": _contract(
        ("user_id", _S), ("account_id", _S), ("transaction_id", _S), ("posted_date", _D), ("amount", MONEY),
        ("merchant", _S), ("description", _S), ("user_category", _S), ("is_planted_anomaly", T.BooleanType()),
        nullable=("user_category",),
    ),
    "balance_snapshots": _contract(("user_id", _S), ("account_id", _S), ("snapshot_date", _D), ("balance", MONEY)),
}

AUDIT = ("ingest_ts", "source_file")
SILVER_TRANSACTIONS = (
    "user_id", "account_id", "transaction_id", "posted_date", "amount", "merchant", "description", "user_category",
    "category", "category_source", "flow", "transfer_partner_id", "is_planted_anomaly",
)
BALANCE_HISTORY = ("balance_sk", "user_id", "account_id", "balance", "valid_from", "valid_to", "is_current", "last_observed_date")
ANOMALIES = (
    "user_id", "account_id", "transaction_id", "posted_date", "merchant", "category", "amount", "magnitude",
    "baseline_scope", "baseline_mean", "baseline_stddev", "baseline_count", "z_score",
)
