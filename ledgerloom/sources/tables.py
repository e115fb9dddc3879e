"""Guarded table writes: staged and counted while they are written, then published."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ledgerloom.errors import RowCountError


def write_table(df: DataFrame, name: str, expected_rows: int | None = None) -> int:
    """Replace the table, schema too, with df's rows; returns their number.

    The rows are counted by the write itself. Where they aren't as many as expected, the
    staged rows go and the table stays as it was. The old table is kept under another name
    until the new one has its place, and comes back if that fails, or if a run before ended
    in between.
    """
    spark, staged, old, seen = df.sparkSession, f"{name}__staged", f"{name}__before", Observation("written")
    restore(spark, name)
    spark.sql(f"DROP TABLE IF EXISTS {staged}")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").saveAsTable(staged)
    rows = seen.get["rows"]
    if expected_rows is not None and rows != expected_rows:
        spark.sql(f"DROP TABLE {staged}")
        raise RowCountError(f"{name}: {rows} rows were written, the source has {expected_rows}")
    try:
        if spark.catalog.tableExists(name):
            spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
        spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    finally:
        restore(spark, name)
    return rows


def restore(spark: SparkSession, name: str) -> None:
    """Drop the old table if the new one has its place, else bring it back."""
    old = f"{name}__before"
    if spark.catalog.tableExists(old):
        spark.sql(f"DROP TABLE {old}" if spark.catalog.tableExists(name) else f"ALTER TABLE {old} RENAME TO {name}")
