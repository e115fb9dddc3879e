"""Incremental ingest: files that are new since the last run, through Structured Streaming."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, types as T

from ledgerloom.errors import ContractError
from ledgerloom.functions import contracts
from ledgerloom.schema import CONTRACTS
from ledgerloom.sources.files import typed


def ingest_new(spark: SparkSession, root: str, table: str, target: str, checkpoint: str) -> int:
    """Append the valid rows of files not seen before to the Parquet folder target, then stop.

    Files must have the contract's columns in order. A batch with a row that breaks the
    contract fails as a whole, and comes again with the next run.
    """
    schema = T.StructType([T.StructField(f.name, T.StringType()) for f in CONTRACTS[table]])
    stream = spark.readStream.schema(schema).option("header", True).option("enforceSchema", False).option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").csv(f"{root.rstrip('/')}/{table}")
    seen = [0]

    def keep(batch: DataFrame, number: int) -> None:
        seen[0] += contracts.check_rows(batch, table)
        typed(batch, table).write.mode("overwrite").parquet(f"{target}/batch={number}")

    query = stream.select("*", "_metadata").writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    run = query.start()
    try:
        run.awaitTermination()
    except StreamingQueryException as e:
        raise ContractError(str(e)) from e
    return seen[0]


def read_batches(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.option("basePath", target).parquet(f"{target}/batch=*").drop("batch")
