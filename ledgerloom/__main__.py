"""Command line: python -m ledgerloom synth | bronze | silver | gold."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ledgerloom.plans import layers
from ledgerloom.sources import settings, synth


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="ledgerloom", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    make = jobs.add_parser("synth", help="write synthetic CSV sets")
    make.add_argument("--out", required=True)
    make.add_argument("--users", type=int, default=1000)
    make.add_argument("--months", type=int, default=24)
    make.add_argument("--seed", type=int, default=42)
    make.add_argument("--start-month", default=synth.START_MONTH)
    make.add_argument("--sample", action="store_true", help="a small set in single files")
    for job in ("bronze", "silver", "gold"):
        one = jobs.add_parser(job)
        one.add_argument("--database", help="overrides the settings file")
        one.add_argument("--catalog", help="overrides the settings file")
        one.add_argument("--settings")
        if job == "bronze":
            one.add_argument("--root", required=True, help="folder of the raw CSV sets")
        if job == "silver":
            one.add_argument("--rules")
    a = parser.parse_args(argv)
    if a.job == "synth" and a.sample:
        print(synth.write_sample(a.out, seed=a.seed))
        return
    spark = SparkSession.builder.getOrCreate()
    if a.job == "synth":
        synth.write_dataset(spark, a.out, a.users, a.months, a.seed, a.start_month)
        return
    s = settings.load_settings(a.settings, database=a.database, catalog=a.catalog)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {s.namespace}")
    if a.job == "bronze":
        made = layers.bronze(spark, s, a.root)
    elif a.job == "silver":
        made = layers.silver(spark, s, settings.load_rules(a.rules))
    else:
        made = layers.gold(spark, s)
        spark.table(s.table("gold_anomaly_recall")).show(truncate=False)
    for name, rows in made.items():
        print(f"{name}: {rows} rows")


if __name__ == "__main__":
    main()
