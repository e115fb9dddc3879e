"""Exact top-k by inner product, through distributed histogram selection.

Every query is scored against every candidate, block by block. A query's kth score is
located digit by digit: each pass scores all blocks, counts the scores inside the interval
that is still open into equal bins, sums the counts over all blocks and keeps the bin that
holds the kth score, until a bin is one integer wide. A block leaves out bins under its own
kth score of a query, which can't hold the global one. Then a last pass keeps scores above
the kth and, of those equal to it, the smallest ids. Products that floats can't hold are
made of whole numbers of any length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ledgerloom.llm.common import bound_batches, cut_lineage, release

BINS = 1 << 11
#: Queries, and their components, that are scored in one pass.
QUERY_BLOCK, QUERY_CELLS = 1 << 14, 1 << 22
CELLS, HELD = 1 << 22, 1 << 18
#: Floats add whole products exactly up to EXACT; scores end at MOST.
EXACT, MOST = 2.0**52, 1 << 61
RESULT = "query_id long, rank int, vec_id long, score long"


def quantize(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id and v (floor(scale * x) as doubles, 1e300 at most); rows with a null or non-finite part go."""
    x = F.col("embedding").cast("array<double>")
    fits = lambda e: F.abs(e * F.lit(float(scale))) < F.lit(EXACT)
    large = lambda e: F.greatest(F.least(e * F.lit(float(scale)), F.lit(1e300)), F.lit(-1e300))
    whole = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("embedding"))
        .filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & whole)
        .select("vec_id", F.transform("embedding", lambda e: F.when(fits(e), F.floor(F.when(fits(e), e * F.lit(float(scale)))).cast("double")).otherwise(large(e))).alias("v"))
    )


def blocks(batches):
    """Ids and one matrix for each length of vectors in a batch."""
    for b in batches:
        ids = b.column("vec_id").to_numpy(zero_copy_only=False)
        v = b.column("v")
        flat, ends = v.flatten().to_numpy(zero_copy_only=False), v.offsets.to_numpy().astype(np.int64)
        length, start = np.diff(ends), ends[:-1] - ends[0]
        for n in np.unique(length):
            at = np.flatnonzero(length == n)
            yield int(n), ids[at], flat[start[at][:, None] + np.arange(n)[None, :]]


def scored(queries: np.ndarray, matrix: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whole inner products, cut off at MOST; lengths: those of the matrix's rows."""
    with np.errstate(all="ignore"):
        wide = np.sqrt((queries * queries).sum(1))[:, None] * lengths[None, :] >= EXACT
        s = queries @ matrix.T
    if not wide.any():
        return s.astype(np.int64)
    s = np.where(wide, 0, s).astype(np.int64)
    rows, columns = np.flatnonzero(wide.any(1)), np.flatnonzero(wide.any(0))
    whole = lambda m: np.array([[int(x) for x in r] for r in m], object)
    exact = whole(queries[rows]) @ whole(matrix[columns]).T
    s[np.ix_(rows, columns)] = np.array([[max(-MOST, min(MOST, x)) for x in r] for r in exact], np.int64)
    return s


class Queries:
    """A block of queries with, for each, the open interval of scores and the rank left in it."""

    def __init__(self, rows, k: int):
        self.ids = np.array([r[0] for r in rows], np.int64)
        self.vectors = [np.array(r[1], np.float64) for r in rows]
        self.low = np.zeros(len(rows), np.int64)
        self.left = np.full(len(rows), k, np.int64)
        self.width = 1
        self.total = np.zeros(len(rows), np.int64)
        self.of = {}
        for n in {len(v) for v in self.vectors}:
            at = np.array([i for i, v in enumerate(self.vectors) if len(v) == n])
            self.of[n] = (at, np.stack([self.vectors[i] for i in at]))

    def scores(self, batches):
        """Query numbers, candidate ids and the matrix of their scores, a query's own row at the least integer."""
        for n, ids, matrix in blocks(batches):
            if n not in self.of:
                continue
            at, queries = self.of[n]
            step = max(1, CELLS // max(len(ids), 1))
            with np.errstate(over="ignore"):
                lengths = np.sqrt((matrix * matrix).sum(1))
            for i in range(0, len(at), step):
                s = scored(queries[i : i + step], matrix, lengths)
                own = self.ids[at[i : i + step]][:, None] == ids[None, :]
                s[own] = np.iinfo(np.int64).min
                yield at[i : i + step], ids, s, own


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: the k highest scores of each query.

    vectors and queries: vec_id and embedding. Candidates are all rows whose vec_id isn't
    the query's; ties go to the smaller vec_id. Rows with a null id, a null vector or null
    or non-finite parts take no part; vectors of another length aren't scored with a query;
    an empty vector scores 0. A candidate row that repeats counts as often; a query id that
    repeats is taken once (its least vector). Fewer than k candidates give all of them;
    empty tables give an empty result. Other columns are not read. All finite vectors take
    part, and scores are exact up to MOST = 2^61, where larger ones are cut off (a score is
    a long); parts over 1e300 / scale count as that.
    """
    spark = vectors.sparkSession
    candidates = bound_batches(quantize(vectors, scale))
    asked = cut_lineage(quantize(queries, scale).groupBy("vec_id").agg(F.min("v").alias("v")))
    norm = lambda d: d.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).first()[0]
    (n, cells), top = asked.agg(F.count("*"), F.sum(F.size("v"))).first(), norm(candidates)
    out = spark.createDataFrame([], RESULT)
    if not n or top is None:
        return out
    reach = int(min(np.sqrt(top) * np.sqrt(norm(asked)), MOST)) + 2
    parts = max(-(-n // QUERY_BLOCK), -(-cells // QUERY_CELLS))
    for part in range(parts):
        rows = asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(parts)) == part).collect()
        if rows:
            found = select_block(candidates, Queries(rows, k), k, reach)
            out = out.unionByName(found)
    release(asked)
    return out


def select_block(candidates: DataFrame, q: Queries, k: int, reach: int) -> DataFrame:
    q.low[:] = -reach
    q.width = 1
    while q.width < 2 * reach + 1:
        q.width *= BINS
    while q.width > 1:
        step = q.width // BINS

        def count(batches, q=q, step=step):
            made = {}
            for at, _, s, own in q.scores(batches):
                kk = min(k, s.shape[1])
                floor = np.partition(s, s.shape[1] - kk, axis=1)[:, s.shape[1] - kk]
                low = q.low[at]
                i, j = np.nonzero((s >= np.maximum(low, floor)[:, None]) & ~own)
                bin_ = (s[i, j] - low[i]) // step
                cell, number = np.unique((at[i] * BINS + bin_)[bin_ < BINS], return_counts=True)
                for c, x in zip(cell.tolist(), number.tolist()):
                    made[c] = made.get(c, 0) + x
                if len(made) > HELD:
                    yield pa.RecordBatch.from_pydict({"cell": pa.array(made.keys(), pa.int64()), "n": pa.array(made.values(), pa.int64())})
                    made = {}
            yield pa.RecordBatch.from_pydict({"cell": pa.array(made.keys(), pa.int64()), "n": pa.array(made.values(), pa.int64())})

        histogram = candidates.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
        query, bin_ = F.expr(f"cell div {BINS}"), F.col("cell") % BINS
        spark = candidates.sparkSession
        need = spark.createDataFrame([(i, int(x)) for i, x in enumerate(q.left)], "query long, need long")
        above = Window.partitionBy("query").orderBy(F.desc("bin"))
        cut = (
            histogram.select(query.alias("query"), bin_.alias("bin"), "n")
            .withColumn("upto", F.sum("n").over(above))
            .join(need, "query")
            .withColumn("first", F.min(F.when(F.col("upto") >= F.col("need"), -F.col("bin"))).over(Window.partitionBy("query")))
            .filter((F.col("bin") == -F.col("first")))
            .select("query", "bin", (F.col("need") - F.col("upto") + F.col("n")).alias("need"))
            .collect()
        )
        known = np.zeros(len(q.ids), bool)
        for query_, bin_value, rank in cut:
            known[query_] = True
            q.low[query_] += bin_value * step
            q.left[query_] = rank
        q.left[~known] = np.iinfo(np.int32).max  # fewer than k candidates: all of them are wanted
        q.width = step

    def keep(batches):
        for at, ids, s, own in q.scores(batches):
            low = q.low[at][:, None]
            i, j = np.nonzero((s > low) & ~own)
            ti, tj = np.nonzero((s == low) & ~own)
            if len(ti):  # of equal scores no more than k from a block can count, those with the least ids
                order = np.lexsort((ids[tj], ti))
                ti, tj = ti[order], tj[order]
                first = np.r_[True, ti[1:] != ti[:-1]]
                place = np.arange(len(ti)) - np.maximum.accumulate(np.where(first, np.arange(len(ti)), 0))
                i, j = np.r_[i, ti[place < k]], np.r_[j, tj[place < k]]
            yield pa.RecordBatch.from_pydict({"query_id": q.ids[at[i]], "vec_id": ids[j], "score": s[i, j]})

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        candidates.mapInArrow(keep, "query_id long, vec_id long, score long")
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
