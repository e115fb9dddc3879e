import hashlib
from pathlib import Path

import pytest

from ledgerloom.__main__ import main
from ledgerloom.errors import ContractError, RowCountError
from ledgerloom.functions import contracts
from ledgerloom.schema import CONTRACTS
from ledgerloom.sources import files, settings, synth, tables
from ledgerloom.streaming import incremental

HEAD = "user_id,account_id,transaction_id,posted_date,amount,merchant,description,user_category,is_planted_anomaly\n"


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), ", ".join(f"{n} string" for n in CONTRACTS["transactions"].names))


GOOD = ("u", "a", "t1", "2026-03-01", "-1.50", "m", "d", None, "false")


@pytest.mark.parametrize("at, value, message", [
    (3, "03/01/2026", "posted_date"), (3, "20260301", "posted_date"), (3, "2026-02-30", "posted_date"), (4, "twelve", "amount"), (4, "NaN", "amount"),
    (4, "2.345", "amount"), (8, "yes", "is_planted"), (5, None, "merchant"), (5, "", "merchant"),
])
def test_every_row_is_checked(spark, at, value, message):
    bad = GOOD[:at] + (value,) + GOOD[at + 1 :]
    with pytest.raises(ContractError, match=message):
        contracts.check_rows(raw(spark, *[GOOD] * 1500, bad), "transactions")
    assert contracts.check_rows(raw(spark, GOOD), "transactions") == 1


@pytest.mark.parametrize("amounts, message", [([], "no rows"), (["1", None], "missing"), (["1", "x"], "missing"), (["-1", "0"], "zero"), (["1", "2"], "positive")])
def test_signed_amounts(spark, amounts, message):
    df = spark.createDataFrame([(a,) for a in amounts], "amount string")
    with pytest.raises(ContractError, match=message):
        contracts.check_signed_amounts(df, "transactions")


def test_all_negative_amounts_pass(spark):
    contracts.check_signed_amounts(spark.createDataFrame([("-1",), ("-2",)], "amount string"), "transactions")


def test_columns():
    contracts.check_columns(reversed(CONTRACTS["accounts"].names), "accounts")
    with pytest.raises(ContractError, match="opened_date.*extra"):
        contracts.check_columns([*CONTRACTS["accounts"].names[:-1], "extra"], "accounts")


def test_scan_reads_folders_and_rejects_another_order(spark, tmp_path):
    put(tmp_path / "transactions/bucket=01/x.csv", HEAD + "u,a,t1,2026-03-01,-1.50,m,d,,false\n")
    put(tmp_path / "transactions/bucket=02/y.csv", HEAD + "u,a,t2,2026-03-02,2,m,d,Own,true\n")
    put(tmp_path / "transactions/notes.txt", "no")
    df, n = files.ingest(spark, str(tmp_path), "transactions")
    rows = {r.transaction_id: r for r in df.collect()}
    assert n == 2 and rows["t1"].user_category is None and rows["t2"].is_planted_anomaly and rows["t1"].source_file.endswith("x.csv")
    put(tmp_path / "transactions/z.csv", HEAD.replace("merchant,description", "description,merchant") + "u,a,t3,2026-03-02,2,d,m,,true\n")
    with pytest.raises(Exception, match="header|Header"):
        files.scan(spark, str(tmp_path), "transactions").collect()


def test_guarded_write(spark):
    df = spark.range(5)
    assert tables.write_table(df, "guarded", 5) == 5
    with pytest.raises(RowCountError):
        tables.write_table(df.limit(3), "guarded", 4)
    assert spark.table("guarded").count() == 5
    assert tables.write_table(df.selectExpr("id", "id as b"), "guarded") == 5 and spark.table("guarded").columns == ["id", "b"]
    spark.sql("DROP TABLE guarded")


def test_settings(tmp_path):
    assert settings.load_settings(database=None).anomaly_window_days == 90 and len(settings.load_rules()) == 10
    assert settings.load_settings(database="a.b").table("t") == "a.b.t"
    assert settings.load_settings(database="b", catalog="a").table("t") == "a.b.t"
    for text in ("database: x\ncatalog: a b", "database: x\nodd: 1", "database: 'x\n'", "database: x\nanomaly_min_history: 1", "transfer_window_days: 4", "- 1"):
        put(tmp_path / "s.yml", text)
        with pytest.raises(ContractError):
            settings.load_settings(tmp_path / "s.yml")
    put(tmp_path / "r.yml", "rules: []")
    with pytest.raises(ContractError):
        settings.load_rules(tmp_path / "r.yml")


def test_sample_is_stable(tmp_path):
    assert synth.write_sample(tmp_path) == {"accounts": 15, "transactions": 403, "balance_snapshots": 45}
    # Of the public sample files accounts and balance_snapshots, byte for byte
    digest = {p.stem: hashlib.sha256(p.read_bytes()).hexdigest()[:12] for p in Path(tmp_path).glob("*.csv")}
    assert digest == {"accounts": "7b17c79a936b", "balance_snapshots": "47c9d560ea4c", "transactions": "2a6022394ebc"}


def test_households():
    homes = [synth.Household(42, k, 12).tables() for k in range(40)]
    again = synth.Household(42, 7, 12).tables()
    assert again == homes[7]
    outs = [t for h in homes for t in h["transactions"] if t[4] < 0]
    assert 0.002 < sum(t[8] for t in outs) / len(outs) < 0.01
    for h in homes:
        clean = synth.Household(42, homes.index(h), 12).tables(duplicate_rate=0)
        by = {}
        for u, a, day, b in h["balance_snapshots"]:
            by.setdefault(a, []).append((day, b))
        for a, line in by.items():
            for (d0, b0), (d1, b1) in zip(line, line[1:]):
                assert b1 - b0 == sum(t[4] for t in clean["transactions"] if t[1] == a and d0 < t[3] <= d1)


def test_jobs_end_to_end(spark, tmp_path):
    main(["synth", "--out", str(tmp_path), "--users", "6", "--months", "4"])
    for argv in (["bronze", "--root", str(tmp_path)], ["silver"], ["gold"]):
        main([*argv, "--database", "household"])
    made = lambda t: spark.table(f"household.{t}")
    want = sum(len(synth.Household(42, k, 4).tables()["transactions"]) for k in range(6))
    assert made("bronze_transactions").count() == want
    s = made("silver_transactions")
    legs = s.filter("description rlike 'TRANSFER|AUTOPAY|THANK YOU'")
    assert legs.filter("flow = 'transfer'").count() / legs.count() > 0.9
    assert s.filter("flow = 'transfer' and not description rlike 'TRANSFER|AUTOPAY|THANK YOU'").count() == 0
    assert made("gold_anomaly_recall").count() == 1 and made("gold_net_worth_daily").count() > 0
    spark.sql("DROP DATABASE household CASCADE")


def test_incremental_ingest(spark, tmp_path):
    put(tmp_path / "in/transactions/x.csv", HEAD + "u,a,t1,2026-03-01,-1.50,m,d,,false\n")
    go = lambda: incremental.ingest_new(spark, str(tmp_path / "in"), "transactions", str(tmp_path / "out"), str(tmp_path / "state"))
    assert go() == 1 and go() == 0
    put(tmp_path / "in/transactions/y.csv", HEAD + "u,a,t2,2026-03-01,-1.50,m,d,,false\n")
    assert go() == 1 and incremental.read_batches(spark, str(tmp_path / "out")).count() == 2
    put(tmp_path / "in/transactions/z.csv", HEAD + "u,a,t3,2026-03-41,-1.50,m,d,,false\n")
    with pytest.raises(ContractError):
        go()


def test_an_interrupted_swap_comes_back(spark):
    from ledgerloom.sources import tables

    spark.createDataFrame([(1,)], "a int").write.mode("overwrite").saveAsTable("swap__before")
    spark.sql("DROP TABLE IF EXISTS swap")
    tables.restore(spark, "swap")
    assert spark.table("swap").count() == 1 and not spark.catalog.tableExists("swap__before")
    assert tables.write_table(spark.range(4), "swap", 4) == 4 and spark.table("swap").columns == ["id"]
    assert not spark.catalog.tableExists("swap__before") and not spark.catalog.tableExists("swap__staged")
    spark.sql("DROP TABLE swap")
