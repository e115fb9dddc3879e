"""Mixing sources to target weights by Sainte-Laguë apportionment.

The corpus is counted in equal blocks of words. Blocks go to the sources by the highest
quotients target / (2 j + 1), then within a source to its shards by their sizes. A shard's
documents stand in a seeded order, end to end; the mix takes the shard's quota of blocks
from the start of that line, and from its start again where the quota is longer than it.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.llm.common import BLANKS, cut_lineage

BLOCKS = 1_000_000
SHARD_WORDS, SHARDS = 1 << 16, 20_000
#: Sources or shards that are sent to all executors; more of them are joined by a shuffle.
ROWS_TO_SEND = 200_000
MOST = 3
RESULT = ["doc_id", "size", "source_size", "target", "taken", "source"]


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{BLANKS}]+")), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: list[float]) -> list[float]:
    """Shares of all words by weight, none above MOST times its size; the excess is reshared."""
    total = sum(sizes)
    order = sorted((i for i in range(len(sizes))), key=lambda i: (MOST * sizes[i] / weights[i], i))
    out, rest, weight = [0.0] * len(sizes), total, sum(weights)
    for k, i in enumerate(order):
        if MOST * sizes[i] * weight >= rest * weights[i]:
            for j in order[k:]:
                out[j] = rest * weights[j] / weight
            break
        out[i] = float(MOST * sizes[i])
        rest -= MOST * sizes[i]
        weight -= weights[i]
    return out


def sainte_lague(shares: list[float], seats: int) -> list[int]:
    """Seats by the highest quotients share / (2 j + 1); equal ones go to the earlier share."""
    total = sum(shares)
    if not seats or total <= 0:
        return [0] * len(shares)
    low, high = total / (seats + len(shares) + 1), 2.0 * total
    given = lambda d: [int(s / d + 0.5) for s in shares]
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(given(mid)) > seats else (low, mid)
    got = [max(x - 1, 0) for x in given(high)]
    heap = [(-s / (2 * g + 1), i) for i, (s, g) in enumerate(zip(shares, got)) if s > 0]
    heapq.heapify(heap)
    for _ in range(seats - sum(got)):
        _, i = heapq.heappop(heap)
        got[i] += 1
        heapq.heappush(heap, (-shares[i] / (2 * got[i] + 1), i))
    return got


def mix(docs: DataFrame, weights=(1, 2, 3), seed: int = 0, blocks: int = BLOCKS) -> DataFrame:
    """doc_id, size, source_size, target, taken and source of every row.

    size: words of the text (null: 0). Sources in code point order, null last, weigh the
    given weights, repeating. taken: words that the mix takes, repeats counted, from 0 to
    MOST times size; rows that repeat each give a row and are taken on their own. Documents
    are dealt to shards by doc_id and text. Sources are totalled on the driver, and shards:
    no more than SHARDS and one for each source. Long texts count whole.
    A corpus without words has targets of 0; an empty table gives an empty result. Other
    columns are not read.
    """
    spark = docs.sparkSession
    send = lambda df, rows: F.broadcast(df) if rows <= ROWS_TO_SEND else df
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), part("doc_id"), F.lit(":"), part("text")))
    sized = cut_lineage(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        words(F.col("text").cast("string")).alias("size"),
        F.conv(F.substring(digest, 1, 8), 16, 10).cast("long").alias("deal"),
        F.substring(digest, 9, 16).alias("place"),
    ))
    found = sorted(((r[0], r[1]) for r in sized.groupBy("source").agg(F.sum("size")).collect()), key=lambda r: (r[0] is None, r[0] or ""))
    sizes, total = [r[1] for r in found], sum(r[1] for r in found)
    aims = targets(sizes, [weights[i % len(weights)] for i in range(len(found))])
    block = max(1, total // blocks)
    seats = sainte_lague(aims, total // block)
    per_shard = max(SHARD_WORDS, -(-total // SHARDS))
    shards = [max(1, -(-s // per_shard)) for s in sizes]
    sources = spark.createDataFrame(
        [(i, r[0], r[1], a, n) for i, (r, a, n) in enumerate(zip(found, aims, shards))],
        "number int, source string, source_size long, target double, shards long")
    dealt = (
        sized.join(send(sources, len(found)), sized["source"].eqNullSafe(sources["source"]))
        .select("doc_id", sized["source"], "size", "place", "number", "source_size", "target", (F.col("deal") % F.col("shards")).cast("int").alias("shard"))
    )
    of = {}
    for number, shard, words_ in dealt.groupBy("number", "shard").agg(F.sum("size")).collect():
        of.setdefault(number, []).append((shard, words_))
    quotas = []
    for number, own in of.items():
        own.sort()
        for (shard, words_), n in zip(own, sainte_lague([float(w) for _, w in own], seats[number])):
            quotas.append((number, shard, words_, min(n * block, MOST * words_)))
    quota = spark.createDataFrame(quotas, "number int, shard int, shard_size long, quota long")
    line = Window.partitionBy("number", "shard").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("size").over(line), F.lit(0))
    whole = F.expr("quota div greatest(shard_size, 1)")
    return (
        dealt.withColumn("before", before)
        .join(send(quota, len(quotas)), ["number", "shard"])
        .withColumn("taken", whole * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), F.col("quota") - whole * F.col("shard_size") - F.col("before"))))
        .select(*RESULT)
    )
