"""From raw documents to token ids: quality, toxicity, near duplicates, source mix, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents, whatever other columns and names these have. Every row has its own
verdicts, also where doc_ids are null or repeat. Quality and toxicity carry a row through
their operators whole; the join and the mix get a row's number, and only their decisions
come back. An empty table goes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm import jaccard_join, mixing, quality_rules, sentence_pieces, toxicity
from ledgerloom.llm.common import cut_lineage, release, table, written

#: SQL can't express the estimates, the network or the model's merges.
ORACLE_SQL = None


def numbered(docs: DataFrame) -> DataFrame:
    """row, a number of its own for each row, and doc, the row itself.

    A scanned table's rows have the same place in the same split however often they are
    read; anything else is fixed by a checkpoint.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc"))
    return rows if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation" else cut_lineage(rows)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the base rules and the estimates keep; null, empty and short texts go."""
    rows = docs.select(F.struct("*").alias("doc"), "text", "lang", "source")
    return quality_rules.verdicts(rows, "doc").filter("kept").select("carry.*")


def nontoxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the network, taught by labels, doesn't call toxic; texts without words stay."""
    rows = docs.select("doc_id", "text", F.struct("*").alias("doc"))
    return toxicity.score(rows, table(spark, sf_dir, "labels"), carry=["doc"]).filter("predicted = 0").select("doc.*")


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class: that of the least doc_id (null first), of its rows the one with the least hash of the text.

    Null and empty texts and those without words are classes of their own, so they stay.
    """
    rows = numbered(docs)
    classes = jaccard_join.join(rows.select(F.col("row").alias("doc_id"), "doc.text")).select(F.col("doc_id").alias("row"), "class_id")
    first = F.min(F.struct("doc_id", "h", "row")).alias("first")
    firsts = rows.select("row", "doc.doc_id", F.xxhash64("doc.text").alias("h")).join(classes, "row").groupBy("class_id").agg(first).select("first.row")
    return rows.join(firsts, "row", "left_semi").select("doc.*")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, to the nearest whole copy.

    No more than one document of each shard is taken in part, so sources keep their targets
    but for that part's rounding. Texts without words have no size and aren't taken.
    """
    rows = numbered(docs)
    share = F.col("taken") / F.greatest(F.col("size"), F.lit(1))
    taken = mixing.mix(rows.select(F.col("row").alias("doc_id"), "doc.text", "doc.source"))
    copies = taken.select(F.col("doc_id").alias("row"), F.floor(share + F.lit(0.5)).cast("int").alias("copies")).filter("copies > 0")
    return rows.join(copies, "row").select("doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc.*")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids and round trip of every row; a null or empty text has no ids."""
    return sentence_pieces.encode(docs)


STAGES = [
    ("quality rules", quality),
    ("toxicity", nontoxic),
    ("n-gram Jaccard join", distinct),
    ("mixing sources to target weights", mixed),
    ("SentencePiece encoding", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written to the shared folder, and the ones before deleted."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, written(stage(spark, docs, sf_dir))
        if number:
            release(before)
    return STAGES[-1][1](spark, docs, sf_dir)


def queries():
    return {"pipeline": run}


def oracle_sql():
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
