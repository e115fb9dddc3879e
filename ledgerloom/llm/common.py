"""Helpers that the text operators share: bounded Arrow batches, lineage cuts, fixed word rules."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

# Fixed value: what parts words, as a character class for Java and Python patterns.
BLANKS = r"\x20\x09-\x0D"
BLANK_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(df: DataFrame) -> DataFrame:
    """Keep the batches that go to Python small, whatever the length of a row.

    Spark reads these settings when the plan runs, so they stay; a session that asks for
    smaller batches keeps its own.
    """
    conf = df.sparkSession.conf
    for name, most in (("maxRecordsPerBatch", 2048), ("maxBytesPerBatch", 4 << 20)):
        now = df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(conf.get(f"spark.sql.execution.arrow.{name}"))
        if not 0 < now <= most:
            conf.set(f"spark.sql.execution.arrow.{name}", str(most))
    return df


def keyed_text(docs: DataFrame, *more: str) -> DataFrame:
    """Only the columns an operator reads, so that other columns can't clash with its own."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        *[F.col(c) for c in more],
    )


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir; a temporary one in local mode only."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None and spark.sparkContext.getCheckpointDir() is None:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="ledgerloom-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return spark.sparkContext.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """An eager checkpoint in the shared folder."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder: for tables of which later steps read some columns only."""
    path = f"{checkpoint_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def release(*frames: DataFrame) -> None:
    """Delete the files of the checkpoints and written tables that these frames read and no later step does."""
    for df in frames:
        leaves = df._jdf.queryExecution().analyzed().collectLeaves()
        for plan in (leaves.apply(i) for i in range(leaves.size())):
            if plan.getClass().getSimpleName() == "LogicalRDD" and (file := plan.rdd().getCheckpointFile()).isDefined():
                remove(df.sparkSession, file.get())
        for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
            if path.rpartition("/")[2].startswith("table-") and checkpoint_folder(df.sparkSession).split(":")[-1].strip("/") in path:
                remove(df.sparkSession, path)


def slices(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
