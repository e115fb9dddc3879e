"""The engine's registered queries and, for each, the same in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.errors import RowCountError
from ledgerloom.functions import contracts
from ledgerloom.functions.rules import rules_frame
from ledgerloom.operators import anomalies as scoring, balances, ledger as ops, metrics
from ledgerloom.plans import adapters
from ledgerloom.schema import AUDIT
from ledgerloom.sources import files, synth
from ledgerloom.sources.tables import write_table

WINDOW_DAYS = 4
GENERATED_USERS, GENERATED_MONTHS = 40, 6


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.silver_transactions(adapters.ledger(spark, sf_dir), adapters.RULES, WINDOW_DAYS)


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ("baseline_mean", "baseline_stddev", "z_score")})


def _scored(days: int):
    def run(spark, sf_dir):
        return _rounded(scoring.score_anomalies(_silver(spark, sf_dir), days)).select(
            "transaction_id", "category", "magnitude", "baseline_scope", "baseline_count", "baseline_mean", "baseline_stddev", "z_score", "is_anomaly")

    return run


def _validation(spark, sf_dir):
    raw = adapters.ledger(spark, sf_dir)
    spoiled = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns]).withColumns({
        "amount": F.when(F.substring("transaction_id", -2, 2) == "07", "twelve").otherwise(F.col("amount").cast("string")),
        "posted_date": F.when(F.substring("transaction_id", -2, 2) == "13", F.concat(F.lit("13/"), F.substring("posted_date", 6, 2))).otherwise(F.col("posted_date")),
        "merchant": F.when(F.substring("transaction_id", -2, 2) != "19", F.col("merchant")),
    })
    return contracts.report(spoiled, "transactions")


def _folder(spark) -> str:
    """A new folder that driver and executors share; a temporary one in local mode only."""
    import tempfile
    import uuid

    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"{shared}/ledger-{uuid.uuid4().hex}" if shared else tempfile.mkdtemp(prefix="ledgerloom-")


def _ingested(spark, sf_dir):
    """The ledger, written as CSV files and read back through the contract."""
    root = _folder(spark)
    texts = adapters.ledger(spark, sf_dir)
    texts.select(*[F.col(c).cast("string").alias(c) for c in texts.columns]).write.option("header", True).option("emptyValue", "").csv(f"{root}/transactions")
    return files.ingest(spark, root, "transactions")[0].drop(*AUDIT)


def _guarded(spark, sf_dir):
    """Rows by merchant of a table that was written twice with the right number of rows and once with a wrong one."""
    name = "ledgerloom_guarded_write"
    ledger_ = adapters.ledger(spark, sf_dir)
    rows = ledger_.count()
    write_table(ledger_.limit(3), name)
    write_table(ledger_, name, rows)
    try:
        write_table(ledger_.limit(5), name, rows)
        refused = False
    except RowCountError:
        refused = True
    found = [tuple(r) for r in spark.table(name).groupBy("merchant").count().collect()]
    spark.sql(f"DROP TABLE {name}")
    return spark.createDataFrame([(*r, refused) for r in found], "merchant string, rows long, refused boolean")


def _generated(table):
    return lambda s, d: synth.generate(s, table, GENERATED_USERS, GENERATED_MONTHS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "ledger": adapters.ledger,
    "dedup_transactions": lambda s, d: ops.dedup_transactions(adapters.ledger(s, d)),
    "categorize_rules": lambda s, d: ops.categorize(adapters.ledger(s, d), adapters.RULES).select("transaction_id", "category", "category_source"),
    "transfer_candidates": lambda s, d: ops.transfer_candidates(ops.dedup_transactions(adapters.ledger(s, d)), WINDOW_DAYS),
    "pair_transfers": lambda s, d: ops.pair_transfers(ops.dedup_transactions(adapters.ledger(s, d)), WINDOW_DAYS).select("transaction_id", "transfer_partner_id", "flow"),
    "silver_transactions": _silver,
    "snapshot_latest": lambda s, d: balances.latest_snapshots(adapters.loaded_snapshots(s, d)),
    "balance_history": lambda s, d: balances.balance_history(adapters.snapshots(s, d)),
    "net_worth_daily": lambda s, d: balances.net_worth_daily(balances.balance_history(adapters.snapshots(s, d))).withColumn("net_worth", F.col("net_worth").cast("decimal(28,2)")),
    "monthly_spend_by_category": lambda s, d: metrics.monthly_spend_by_category(_silver(s, d)).withColumn("spend", F.col("spend").cast("decimal(28,2)")),
    "cash_flow_monthly": lambda s, d: metrics.cash_flow_monthly(_silver(s, d)).withColumn("net", F.col("net").cast("decimal(28,2)")),
    "score_anomalies_90d": _scored(90),
    "score_anomalies_7d": _scored(7),
    "anomalies": lambda s, d: _rounded(scoring.anomalies(scoring.score_anomalies(_silver(s, d), 7))),
    "anomaly_recall": lambda s, d: scoring.anomaly_recall(scoring.score_anomalies(_silver(s, d), 7), 7).drop("computed_at").withColumns({c: F.round(c, 6) for c in ("recall", "precision")}),
    "anomaly_recall_by_user": lambda s, d: scoring.anomaly_recall(scoring.score_anomalies(_silver(s, d), 7), 7, by=("user_id",)).drop("computed_at").withColumns({c: F.round(c, 6) for c in ("recall", "precision")}),
    "validation_report": _validation,
    "rules_relation": lambda s, d: rules_frame(s, adapters.RULES),
    "ingest_transactions": _ingested,
    "guarded_write": _guarded,
    "generated_accounts": lambda s, d: _generated("accounts")(s, d).select("user_id", "account_id", "account_type"),
    "generated_snapshots": lambda s, d: _generated("balance_snapshots")(s, d).select("user_id", "account_id", "snapshot_date"),
    "generated_duplicates": lambda s, d: _generated("transactions")(s, d).groupBy("user_id").agg(F.min("transaction_id").alias("first_id"), (F.max(F.substring("transaction_id", -6, 6).cast("long")) + 1 - F.count_distinct("transaction_id")).alias("gaps"), F.min(F.col("amount") != 0).alias("signed")),
}

_LEDGER = """ledger AS (
  SELECT 'u' || lpad(user_id::VARCHAR, 6, '0') AS user_id,
         'u' || lpad(user_id::VARCHAR, 6, '0') || CASE event_id % 3 WHEN 0 THEN '-chk' WHEN 1 THEN '-sav' ELSE '-crd' END AS account_id,
         't' || lpad(event_id::VARCHAR, 9, '0') AS transaction_id, ts::DATE AS posted_date,
         (CASE WHEN event_type IN ('signup', 'click') THEN 1 ELSE -1 END * floor(value + 1))::DECIMAL(18,2) AS amount,
         event_type AS merchant, upper(event_type) || ' EVENT' AS description,
         CASE WHEN event_id % 25 = 0 THEN 'Travel' END AS user_category, value > 150 AS is_planted_anomaly
  FROM events
)"""
_DEDUP = _LEDGER + """, deduped AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, account_id, posted_date, amount, description ORDER BY transaction_id) AS place FROM ledger
  ) WHERE place = 1
)"""
_CATEGORY = """CASE WHEN contains(lower(description), 'purch') THEN 'Shopping' WHEN lower(merchant) = 'signup' THEN 'Income'
              WHEN starts_with(lower(description), 'view ') THEN 'Browsing' WHEN regexp_matches(merchant, '(?i)click|view') THEN 'Engagement' END"""
_PAIRS = _DEDUP + """, candidates AS (
  SELECT o.transaction_id AS out_id, i.transaction_id AS in_id, abs(i.posted_date - o.posted_date)::INTEGER AS gap
  FROM deduped o JOIN deduped i ON o.user_id = i.user_id AND o.account_id <> i.account_id AND i.amount = -o.amount
  WHERE o.amount < 0 AND i.amount > 0 AND o.user_category IS NULL AND i.user_category IS NULL AND abs(i.posted_date - o.posted_date) <= 4
), pairs AS (
  SELECT out_id, in_id FROM (
    SELECT *, row_number() OVER (PARTITION BY out_id ORDER BY gap, in_id) AS a, row_number() OVER (PARTITION BY in_id ORDER BY gap, out_id) AS b FROM candidates
  ) WHERE a = 1 AND b = 1
), partners AS (
  SELECT out_id AS transaction_id, in_id AS transfer_partner_id FROM pairs UNION ALL SELECT in_id, out_id FROM pairs
)"""
_SILVER = _PAIRS + f""", silver AS (
  SELECT d.user_id, d.account_id, d.transaction_id, d.posted_date, d.amount, d.merchant, d.description, d.user_category,
         coalesce(d.user_category, {_CATEGORY}, 'Uncategorized') AS category,
         CASE WHEN d.user_category IS NOT NULL THEN 'user' WHEN {_CATEGORY} IS NOT NULL THEN 'rule' ELSE 'none' END AS category_source,
         CASE WHEN p.transfer_partner_id IS NOT NULL THEN 'transfer' WHEN d.amount > 0 THEN 'inflow' ELSE 'outflow' END AS flow,
         p.transfer_partner_id, d.is_planted_anomaly
  FROM deduped d LEFT JOIN partners p USING (transaction_id)
)"""
_SNAPSHOTS = """snapshots AS (
  SELECT 'u' || lpad(floor(o_custkey / 15)::BIGINT::VARCHAR, 6, '0') AS user_id,
         'u' || lpad(floor(o_custkey / 15)::BIGINT::VARCHAR, 6, '0') || '-' || o_orderstatus AS account_id,
         last_day(o_orderdate::DATE) AS snapshot_date, count(*)::DECIMAL(18,2) AS balance
  FROM orders GROUP BY ALL
)"""
_HISTORY = _SNAPSHOTS + """, marked AS (
  SELECT *, CASE WHEN lag(balance) OVER w IS DISTINCT FROM balance OR row_number() OVER w = 1 THEN 1 ELSE 0 END AS start
  FROM snapshots WINDOW w AS (PARTITION BY user_id, account_id ORDER BY snapshot_date)
), numbered AS (
  SELECT *, sum(start) OVER (PARTITION BY user_id, account_id ORDER BY snapshot_date ROWS UNBOUNDED PRECEDING) AS run FROM marked
), runs AS (
  SELECT user_id, account_id, run, min(snapshot_date) AS valid_from, max(snapshot_date) AS last_observed_date, min(balance) AS balance FROM numbered GROUP BY ALL
), history AS (
  SELECT sha256(user_id || '|' || account_id || '|' || valid_from::VARCHAR) AS balance_sk, user_id, account_id, balance, valid_from,
         lead(valid_from) OVER w AS valid_to, lead(valid_from) OVER w IS NULL AS is_current, last_observed_date
  FROM runs WINDOW w AS (PARTITION BY user_id, account_id ORDER BY valid_from)
)"""


def _scores(days: int) -> str:
    return _SILVER + f""", framed AS (
  SELECT *, -amount::DOUBLE AS magnitude,
         count(-amount) OVER r AS rn, avg(-amount::DOUBLE) OVER r AS rm, stddev_samp(-amount::DOUBLE) OVER r AS rs,
         count(-amount) OVER h AS hn, avg(-amount::DOUBLE) OVER h AS hm, stddev_samp(-amount::DOUBLE) OVER h AS hs
  FROM silver WHERE flow = 'outflow'
  WINDOW r AS (PARTITION BY user_id, category ORDER BY posted_date RANGE BETWEEN INTERVAL {days} DAY PRECEDING AND INTERVAL 1 DAY PRECEDING),
         h AS (PARTITION BY user_id, category ORDER BY posted_date RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING)
), chosen AS (
  SELECT *, CASE WHEN rn >= 5 THEN 'recent' ELSE 'history' END AS baseline_scope, CASE WHEN rn >= 5 THEN rn ELSE hn END AS baseline_count,
         CASE WHEN rn >= 5 THEN rm ELSE hm END AS mean, CASE WHEN rn >= 5 THEN rs ELSE hs END AS deviation
  FROM framed
), z AS (
  SELECT *, CASE WHEN baseline_count >= 5 AND deviation > 1e-9 THEN (magnitude - mean) / deviation END AS score FROM chosen
), scored AS (
  SELECT user_id, account_id, transaction_id, posted_date, merchant, category, amount, magnitude, baseline_scope, round(mean, 6) AS baseline_mean,
         round(deviation, 6) AS baseline_stddev, baseline_count, round(score, 6) AS z_score, coalesce(score > 3, false) AS is_anomaly, is_planted_anomaly
  FROM z
)"""


_SCORE_COLUMNS = "transaction_id, category, magnitude, baseline_scope, baseline_count, baseline_mean, baseline_stddev, z_score, is_anomaly"

ORACLES: dict[str, str] = {
    "ledger": f"WITH {_LEDGER} SELECT * FROM ledger",
    "dedup_transactions": f"WITH {_DEDUP} SELECT * FROM deduped",
    "categorize_rules": f"""WITH {_LEDGER} SELECT transaction_id, coalesce(user_category, {_CATEGORY}, 'Uncategorized') AS category,
        CASE WHEN user_category IS NOT NULL THEN 'user' WHEN {_CATEGORY} IS NOT NULL THEN 'rule' ELSE 'none' END AS category_source FROM ledger""",
    "transfer_candidates": f"WITH {_PAIRS} SELECT * FROM candidates",
    "pair_transfers": f"WITH {_SILVER} SELECT transaction_id, transfer_partner_id, flow FROM silver",
    "silver_transactions": f"WITH {_SILVER} SELECT * FROM silver",
    "snapshot_latest": f"""WITH {_SNAPSHOTS}, loaded AS (
        SELECT *, DATE '2024-01-01' AS ingest_ts, 'a' AS source_file FROM snapshots
        UNION ALL SELECT user_id, account_id, snapshot_date, (balance + 1)::DECIMAL(18,2), DATE '2024-01-02', 'b' FROM snapshots WHERE day(snapshot_date) = 30
        UNION ALL SELECT user_id, account_id, snapshot_date, (balance + 2)::DECIMAL(18,2), DATE '2024-01-02', 'c' FROM snapshots WHERE day(snapshot_date) = 30 AND balance > 1
      ) SELECT user_id, account_id, snapshot_date, balance FROM loaded
      QUALIFY row_number() OVER (PARTITION BY user_id, account_id, snapshot_date ORDER BY ingest_ts DESC, source_file DESC, balance DESC) = 1""",
    "balance_history": f"WITH {_HISTORY} SELECT * FROM history",
    "net_worth_daily": f"""WITH {_HISTORY}, days AS (
        SELECT user_id, balance, unnest(generate_series(valid_from, coalesce(valid_to - 1, last_observed_date), INTERVAL 1 DAY))::DATE AS as_of_date FROM history
      ), daily AS (SELECT user_id, as_of_date, sum(balance)::DECIMAL(28,2) AS net_worth, count(*) AS known FROM days GROUP BY ALL
      ), accounts AS (SELECT user_id, count(DISTINCT account_id) AS account_count FROM history GROUP BY ALL)
      SELECT user_id, as_of_date, net_worth, account_count FROM daily JOIN accounts USING (user_id) WHERE known = account_count""",
    "monthly_spend_by_category": f"""WITH {_SILVER} SELECT user_id, strftime(posted_date, '%Y-%m') AS month, category, (-sum(amount))::DECIMAL(28,2) AS spend, count(*) AS transactions
        FROM silver WHERE flow = 'outflow' GROUP BY ALL""",
    "cash_flow_monthly": f"""WITH {_SILVER} SELECT user_id, strftime(posted_date, '%Y-%m') AS month, sum(greatest(amount, 0))::DECIMAL(28,2) AS inflow,
        (-sum(least(amount, 0)))::DECIMAL(28,2) AS outflow, sum(amount)::DECIMAL(28,2) AS net FROM silver WHERE flow <> 'transfer' GROUP BY ALL""",
    "score_anomalies_90d": f"WITH {_scores(90)} SELECT {_SCORE_COLUMNS} FROM scored",
    "score_anomalies_7d": f"WITH {_scores(7)} SELECT {_SCORE_COLUMNS} FROM scored",
    "anomalies": f"WITH {_scores(7)} SELECT * EXCLUDE (is_anomaly, is_planted_anomaly) FROM scored WHERE is_anomaly",
    "anomaly_recall": f"""WITH {_scores(7)}, counts AS (
        SELECT count(*) FILTER (is_planted_anomaly) AS planted, count(*) FILTER (is_planted_anomaly AND is_anomaly) AS caught, count(*) FILTER (is_anomaly) AS flagged FROM scored)
      SELECT planted, caught, flagged, round(caught / nullif(planted, 0)::DOUBLE, 6) AS recall, round(caught / nullif(flagged, 0)::DOUBLE, 6) AS "precision", 3.0::DOUBLE AS z_threshold, 7 AS window_days FROM counts""",
    "anomaly_recall_by_user": f"""WITH {_scores(7)}, counts AS (
        SELECT user_id, count(*) FILTER (is_planted_anomaly) AS planted, count(*) FILTER (is_planted_anomaly AND is_anomaly) AS caught, count(*) FILTER (is_anomaly) AS flagged FROM scored GROUP BY user_id)
      SELECT user_id, planted, caught, flagged, round(caught / nullif(planted, 0)::DOUBLE, 6) AS recall, round(caught / nullif(flagged, 0)::DOUBLE, 6) AS "precision", 3.0::DOUBLE AS z_threshold, 7 AS window_days FROM counts""",
    "rules_relation": """SELECT * FROM (VALUES (10, 'description', 'contains', 'purch', 'Shopping'), (20, 'merchant', 'equals', 'SIGNUP', 'Income'),
        (30, 'description', 'starts_with', 'view ', 'Browsing'), (40, 'merchant', 'regex', 'click|view', 'Engagement')) r(priority, field, operator, "value", category)""",
    "ingest_transactions": f"WITH {_LEDGER} SELECT * FROM ledger",
    "guarded_write": f"WITH {_LEDGER} SELECT merchant, count(*) AS rows, true AS refused FROM ledger GROUP BY merchant",
    "generated_accounts": f"""SELECT 'u' || lpad(u::VARCHAR, 6, '0') AS user_id, 'u' || lpad(u::VARCHAR, 6, '0') || '-' || k AS account_id, t AS account_type
        FROM range({GENERATED_USERS}) r(u), (VALUES ('chk', 'checking'), ('sav', 'savings'), ('crd', 'card')) a(k, t)""",
    "generated_snapshots": f"""SELECT 'u' || lpad(u::VARCHAR, 6, '0') AS user_id, 'u' || lpad(u::VARCHAR, 6, '0') || '-' || k AS account_id,
        last_day((DATE '2024-09-01' + to_months(m::INTEGER))::DATE) AS snapshot_date FROM range({GENERATED_USERS}) r(u), range({GENERATED_MONTHS}) n(m), (VALUES ('chk'), ('sav'), ('crd')) a(k)""",
    "generated_duplicates": f"""SELECT 'u' || lpad(u::VARCHAR, 6, '0') AS user_id, 'u' || lpad(u::VARCHAR, 6, '0') || '-000000' AS first_id, 0::BIGINT AS gaps, true AS signed
        FROM range({GENERATED_USERS}) r(u)""",
    "validation_report": f"""WITH {_LEDGER}, raw AS (
        SELECT *, right(transaction_id, 2) AS tail FROM ledger
      ), c AS (
        SELECT count(*) AS rows, count(*) FILTER (user_category IS NULL) AS free, count(*) FILTER (tail = '07') AS words, count(*) FILTER (tail = '13') AS slashes, count(*) FILTER (tail = '19') AS gone,
               min('13/' || strftime(posted_date, '%m')) FILTER (tail = '13') AS slash FROM raw
      ) SELECT v.* FROM c, LATERAL (VALUES ('user_id', rows, false, 0::BIGINT, 0::BIGINT, NULL), ('account_id', rows, false, 0, 0, NULL), ('transaction_id', rows, false, 0, 0, NULL),
        ('posted_date', rows, false, 0, slashes, slash), ('amount', rows, false, 0, words, CASE WHEN words > 0 THEN 'twelve' END), ('merchant', rows, false, gone, 0, NULL),
        ('description', rows, false, 0, 0, NULL), ('user_category', rows, true, free, 0, NULL), ('is_planted_anomaly', rows, false, 0, 0, NULL)) v("column", rows, nullable, missing, invalid, example)""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
