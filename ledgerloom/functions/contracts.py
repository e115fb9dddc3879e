"""Contract checks over every row, in one aggregate.

Raw columns are texts. A value is missing if null or empty, and valid if it has its type's
one written form: ISO dates, decimals of two places at most, true or false.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerloom.errors import ContractError
from ledgerloom.schema import CONTRACTS

DATE_FORM = r"^\d{4}-\d{2}-\d{2}$"
DECIMAL_FORM = r"^[+-]?(\d+(\.\d{0,2}0*)?|\.\d{1,2}0*)$"
#: Tables whose amounts must have signs.
SIGNED = ("transactions",)
INT_FORM = r"^[+-]?\d+$"


def missing(c: Column) -> Column:
    return c.isNull() | (c == "")


def valid(c: Column, kind: T.DataType) -> Column:
    """Whether a text that isn't missing has a value of the type."""
    text = F.trim(c)
    if isinstance(kind, T.DateType):
        return text.rlike(DATE_FORM) & text.try_cast("date").isNotNull()
    if isinstance(kind, T.DecimalType):
        return text.rlike(DECIMAL_FORM) & text.try_cast(kind).isNotNull()
    if isinstance(kind, T.BooleanType):
        return F.lower(text).isin("true", "false")
    if isinstance(kind, (T.IntegerType, T.LongType)):
        return text.rlike(INT_FORM) & text.try_cast(kind).isNotNull()
    return F.lit(True)


def check_columns(actual: Iterable[str], table: str) -> None:
    """The same columns as the contract's, in any order."""
    have, want = list(actual), CONTRACTS[table].names
    lost, odd = [c for c in want if c not in have], [c for c in have if c not in want]
    if lost or odd:
        raise ContractError(f"{table}: columns missing: {lost}; not in the contract: {odd}")


def counts(raw: DataFrame, table: str) -> DataFrame:
    """One row: rows, and of each column how many miss a value, how many have a bad one, and the least bad one; of amounts their signs."""
    aggs = [F.count("*").alias("rows")]
    for f in CONTRACTS[table]:
        c = F.col(f.name).cast("string")
        bad = ~missing(c) & ~F.coalesce(valid(c, f.dataType), F.lit(False))
        aggs.append(F.struct(
            F.count_if(missing(c)).alias("missing"), F.count_if(bad).alias("invalid"), F.min(F.when(bad, c)).alias("example"),
        ).alias(f.name))
    return raw.agg(*aggs, *([signs().alias("_signs")] if table in SIGNED else []))


def signs() -> Column:
    amount = F.col("amount").cast("string").try_cast("decimal(38,10)")
    return F.struct(F.count("*").alias("n"), F.count_if(amount.isNull()).alias("lost"), F.count_if(amount == 0).alias("zero"), F.count_if(amount > 0).alias("up"))


def report(raw: DataFrame, table: str) -> DataFrame:
    """A row for each column: rows, how many miss a value, how many have a bad one, and the least bad one."""
    column = lambda f: F.struct(F.lit(f.name).alias("column"), F.col("rows"), F.lit(f.nullable).alias("nullable"), *[F.col(f.name)[x].alias(x) for x in ("missing", "invalid", "example")])
    return counts(raw, table).select(F.inline(F.array(*map(column, CONTRACTS[table]))))


def check_rows(raw: DataFrame, table: str) -> int:
    """The number of rows, or an error that names every bad column with a value, or what is wrong with amounts' signs; one scan."""
    found = counts(raw, table).first()
    problems = []
    for f in CONTRACTS[table]:
        r = found[f.name]
        if r.missing and not f.nullable:
            problems.append(f"{f.name}: {r.missing} rows without a value")
        if r.invalid:
            problems.append(f"{f.name}: {r.invalid} values such as {r.example!r} aren't {f.dataType.simpleString()}")
    if problems:
        raise ContractError(f"{table}: " + "; ".join(problems))
    if table in SIGNED:
        judge_signs(found["_signs"], table)
    return found.rows


def check_signed_amounts(raw: DataFrame, table: str) -> None:
    """There are rows, all with an amount that isn't zero, and not all of them inflows."""
    judge_signs(raw.agg(signs().alias("s")).first().s, table)


def judge_signs(r, table: str) -> None:
    for bad, text in ((not r.n, "no rows"), (r.lost, f"{r.lost} are missing or not numbers"), (r.zero, f"{r.zero} are zero"), (r.n and r.up == r.n, "all are positive: the feed seems to have no signs")):
        if bad:
            raise ContractError(f"{table}.amount: {text}")


def check_unique(rows: DataFrame, table: str, *key: str) -> None:
    twice = rows.groupBy(*key).count().filter("count > 1").limit(1).collect()
    if twice:
        raise ContractError(f"{table}: {', '.join(key)} repeats: {[twice[0][k] for k in key]}")
