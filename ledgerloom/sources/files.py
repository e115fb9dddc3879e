"""Raw CSV sets: scanned as texts, checked over all rows, then typed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerloom.functions import contracts
from ledgerloom.schema import CONTRACTS


def scan(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All CSV files under root/table as texts.

    The first file's header gives the columns' order; a file whose header has another order
    fails when it is read, instead of binding by position.
    """
    reader = spark.read.option("header", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
    path = f"{root.rstrip('/')}/{table}"
    names = reader.option("inferSchema", False).csv(path).columns
    contracts.check_columns(names, table)
    return reader.schema(T.StructType([T.StructField(n, T.StringType()) for n in names])).option("enforceSchema", False).csv(path)


def typed(raw: DataFrame, table: str) -> DataFrame:
    """Contract columns in order and type; an empty text is null."""
    value = lambda f: F.nullif(F.trim(f.name) if not isinstance(f.dataType, T.StringType) else F.col(f.name), F.lit(""))
    return raw.select(
        *[value(f).cast(f.dataType).alias(f.name) for f in CONTRACTS[table]],
        F.current_timestamp().alias("ingest_ts"),
        F.col("_metadata.file_path").alias("source_file"),
    )


def ingest(spark: SparkSession, root: str, table: str) -> tuple[DataFrame, int]:
    """The typed rows of a set, and how many there are; every row is checked first."""
    raw = scan(spark, root, table)
    return typed(raw, table), contracts.check_rows(raw, table)


def ingest_all(spark: SparkSession, root: str) -> dict[str, tuple[DataFrame, int]]:
    """All sets; nothing is returned, and so nothing written, unless all of them are valid."""
    return {table: ingest(spark, root, table) for table in CONTRACTS}
