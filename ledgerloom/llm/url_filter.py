"""URL rules by a sort-merge range join.

A host's labels in reverse order make its canonical key, so a rule's host and all its
subdomains are one interval of keys. Pages and rules are sorted together, dealt into key
ranges with about equal rows (a host with many pages spans several ranges, parted by a
salt); a rule goes to each range its interval meets. A sweep over each sorted range keeps
the stack of intervals that are open, each with its rules by path; a page's path looks up
its beginnings there, of the lengths that occur, and the longest rule decides.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.common import bound_batches, slices

RULE_SCHEMA = "verdict string, host string, path string"
RESULT = "page_id long, host string, path string, rule string, verdict string"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ROWS_PER_RANGE, BOUNDS_PER_RANGE = 200_000, 64


def canonical(pages: DataFrame) -> DataFrame:
    """page_id, host, path and key of each page."""
    rest = F.coalesce(F.expr("if(instr(url, '://') > 0, substring(url, instr(url, '://') + 3), '')"), F.lit(""))
    host = F.translate(F.regexp_extract(F.col("_rest"), r"^[^/?#]*", 0), UPPER, LOWER)
    return (
        pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
        .select("page_id", rest.alias("_rest"))
        .select("page_id", host.alias("host"), F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1).alias("path"))
        .withColumn("key", reversed_key(F.col("host")))
    )


def reversed_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def apply_rules(pages: DataFrame, rules: DataFrame | Iterable[tuple[str, str, str]], otherwise: str = "allow") -> DataFrame:
    """page_id, host, path, rule and verdict of every page.

    rules: (verdict, host, path) rows, of any number; hosts count in lower case. The longest rule (host and path
    together; of equal ones that with the longer host) decides; rules that repeat count
    once, and where verdicts differ for one host and path, block stands. A page that no
    rule fits has a null rule and the verdict otherwise. A null url, or one without ://,
    has an empty host and path. Pages that repeat each give a row; other columns are not
    read; an empty table gives an empty result, an empty rule list null rules.
    """
    spark = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(list(rules), RULE_SCHEMA)
    rules = rules.filter("host is not null and path is not null").withColumn("host", F.translate("host", UPPER, LOWER)).groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    rules = rules.withColumn("key", reversed_key(F.col("host")))
    pages = canonical(pages).withColumn("salt", F.xxhash64("page_id", "path"))
    bounds = range_bounds(pages)

    def number(key: str, salt: int) -> int:
        return bisect_right(bounds, (key, salt))

    def deal_pages(batches):
        for b in batches:
            at = [number(k, s) for k, s in zip(b.column("key").to_pylist(), b.column("salt").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int32()), b.column("key"), pa.array([1] * len(at), pa.int32()), b.column("page_id"),
                 b.column("host"), b.column("path"), pa.nulls(len(at), pa.string())],
                names=["at", "key", "kind", "page_id", "host", "path", "verdict"])

    def deal_rules(batches):
        lowest, highest = -(1 << 63), (1 << 63) - 1
        for b in batches:
            for x in b.to_pylist():
                ends = range(number(x["key"], lowest), number(x["key"] + "\U0010ffff", highest) + 1)
                for i in range(0, len(ends), 4096):
                    part = list(ends[i : i + 4096])
                    n = len(part)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(part, pa.int32()), *(pa.array([v] * n, t) for v, t in ((x["key"], pa.string()), (0, pa.int32()), (None, pa.int64()), (x["host"], pa.string()), (x["path"], pa.string()), (x["verdict"], pa.string())))],
                        names=["at", "key", "kind", "page_id", "host", "path", "verdict"])

    dealt = "at int, key string, kind int, page_id long, host string, path string, verdict string"
    events = bound_batches(pages).mapInArrow(deal_pages, dealt).unionByName(rules.select("host", "path", "verdict", "key").mapInArrow(deal_rules, dealt))
    ranges = events.repartitionById(len(bounds) + 1, F.col("at")).sortWithinPartitions("at", "key", "kind", "path")
    return ranges.mapInArrow(lambda batches: sweep(batches, otherwise), RESULT)


def range_bounds(pages: DataFrame) -> list[tuple[str, int]]:
    """Bounds of the key ranges, from a sample whose size follows the number of ranges only."""
    spark = pages.sparkSession
    rows = pages.count()
    ranges = min(max(slices(spark), -(-rows // ROWS_PER_RANGE)), 20_000)
    if ranges < 2 or rows < 2:
        return []
    share = min(1.0, BOUNDS_PER_RANGE * ranges / rows)
    found = sorted((r[0], r[1]) for r in pages.select("key", "salt").sample(share, seed=7).collect())
    return sorted({found[len(found) * i // ranges] for i in range(1, ranges)}) if found else []


class Interval:
    """The rules of one key: by path, and the paths' lengths, longest first."""

    def __init__(self, key: str, host: str):
        self.key, self.host, self.rules, self.lengths = key, host, {}, []

    def add(self, path: str, verdict: str) -> None:
        self.rules[path] = verdict
        if len(path) not in self.lengths:
            self.lengths = sorted([*self.lengths, len(path)], reverse=True)

    def longest(self, path: str) -> str | None:
        return next((path[:n] for n in self.lengths if n <= len(path) and path[:n] in self.rules), None)


def sweep(batches, otherwise: str):
    """Pages of sorted events with the rule that decides; holds only the open intervals."""
    stack: list[Interval] = []
    now = None
    for b in batches:
        at, key, kind, page, host, path, verdict = (b.column(c).to_pylist() for c in ("at", "key", "kind", "page_id", "host", "path", "verdict"))
        out = []
        for i in range(len(at)):
            if at[i] != now:
                now, stack = at[i], []
            while stack and not key[i].startswith(stack[-1].key):
                stack.pop()
            if not kind[i]:
                if not stack or stack[-1].key != key[i]:
                    stack.append(Interval(key[i], host[i]))
                stack[-1].add(path[i], verdict[i])
            else:
                fits = ((len(x.host) + len(found), len(x.host), x, found) for x in stack if (found := x.longest(path[i])) is not None)
                best = max(fits, key=lambda r: r[:2], default=None)
                out.append((page[i], host[i], path[i], best[2].host + best[3] if best else None, best[2].rules[best[3]] if best else otherwise))
        if out:
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), *(pa.array(c, pa.string()) for c in cols[1:])], names=["page_id", "host", "path", "rule", "verdict"])
