"""Deterministic synthetic households.

A household's rows follow from the seed and its number alone, so any executor can make any
of them: Spark deals the numbers out, and each task runs its households' own generators.
"""

from __future__ import annotations

import csv
import random
from calendar import monthrange
from collections.abc import Iterator
from datetime import date, timedelta
from decimal import Decimal
from operator import attrgetter
from pathlib import Path
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerloom.errors import ContractError
from ledgerloom.schema import CONTRACTS

# Names, prices in cents and rates of the generated data.
START_MONTH = "2024-09"
BUCKETS = 16
PLANT_RATE = 0.008
DUPLICATE_RATE = 0.002
BANKS = ("Harbor Bank", "Summit Credit Union", "Prairie Savings")
CARD_ISSUERS = ("Pioneer Card Services", "Lakeside Card Co", "Beacon Card")
EMPLOYERS = ("Northwind", "Bluepeak Labs", "Cedar Logistics")
LANDLORDS = ("Oakline Property Mgmt", "Riverside Apartments")
SUBSCRIPTIONS = (
    ("Streamly", 1549), ("Tunewave", 1099), ("CloudVault", 299), ("FitHub Gym", 3900),
    ("NewsDaily", 800), ("GameArc", 1499), ("Readly Books", 1199), ("Podnest Premium", 599),
)
GROCERS = ("Greenleaf Market", "Harvest Grocer", "Corner Pantry")
DINERS = ("Blue Door Cafe", "Luna Noodle Bar", "Sprout Salads", "Ember Pizza")


class Entry(NamedTuple):
    day: date
    account: str
    text: str
    cents: int
    merchant: str
    planted: bool = False
    label: str | None = None


def month_starts(first: str, months: int) -> list[date]:
    serial = int(first[:4]) * 12 + int(first[5:]) - 1
    return [date(k // 12, k % 12 + 1, 1) for k in range(serial, serial + months)]


class Household:
    """One user's fixed traits; the order of the draws is part of the data."""

    def __init__(self, seed: int, number: int, months: int, start: str = START_MONTH):
        self.dice = dice = random.Random(f"{seed}:{number}")
        self.user, self.starts = f"u{number:06d}", month_starts(start, months)
        self.bank, self.issuer = dice.choice(BANKS), dice.choice(CARD_ISSUERS)
        self.opened = [self.starts[0] - timedelta(days=dice.randint(30, 3000)) for _ in range(3)]
        self.opening = [dice.randint(150_000, 600_000), dice.randint(200_000, 2_500_000), 0]
        self.employer, self.pay = dice.choice(EMPLOYERS), dice.randint(180_000, 420_000)
        self.landlord, self.rent = dice.choice(LANDLORDS), dice.randint(110_000, 260_000)
        count = dice.randint(3, 6)
        chosen = dice.sample(SUBSCRIPTIONS, count)
        self.subscriptions = list(zip(chosen, [dice.randint(1, 28) for _ in chosen]))
        self.grocery, self.dining = dice.randint(7_000, 16_000), dice.randint(1_800, 4_500)
        self.grocery_weekday = dice.randint(0, 6)

    def account(self, kind: str) -> str:
        return f"{self.user}-{kind}"

    def accounts(self) -> Iterator[tuple]:
        kinds = (("chk", "checking", self.bank), ("sav", "savings", self.bank), ("crd", "card", self.issuer))
        for (short, kind, institution), opened in zip(kinds, self.opened):
            yield self.user, self.account(short), kind, institution, opened

    def purchase(self, day: date, shops: tuple[str, ...], usual: int) -> Entry:
        dice, shop = self.dice, self.dice.choice(shops)
        cents = max(150, int(dice.gauss(usual, usual * 0.25)))
        label = None
        if planted := dice.random() < PLANT_RATE:
            cents = int(usual * dice.uniform(5, 10))
        elif shop == "Corner Pantry":
            label = "Groceries" if dice.random() < 0.5 else None
        elif shop in DINERS:
            label = "Travel" if dice.random() < 0.02 else None
        return Entry(day, self.account("crd"), f"{shop.upper()} CARD PURCHASE", -cents, shop, planted, label)

    def month(self, first: date, card_due: int) -> Iterator[Entry]:
        dice, days = self.dice, monthrange(first.year, first.month)[1]
        chk, sav, crd = map(self.account, ("chk", "sav", "crd"))
        for day in (1, 15):
            yield Entry(first.replace(day=day), chk, f"{self.employer.upper()} PAYROLL DIRECT DEP", self.pay, f"{self.employer} Payroll")
        yield Entry(first, chk, f"{self.landlord.upper()} RENT", -self.rent, self.landlord)
        for (name, cents), day in self.subscriptions:
            yield Entry(first.replace(day=min(day, days)), crd, f"{name.upper()} RECURRING", -cents, name)
        for week in range(1, days + 1, 7):
            if (day := week + self.grocery_weekday) <= days:
                yield self.purchase(first.replace(day=day), GROCERS, self.grocery)
            for _ in range(dice.randint(1, 3)):
                yield self.purchase(first.replace(day=dice.randint(week, min(week + 6, days))), DINERS, self.dining)
        for _ in range(dice.randint(1, 2)):
            cents, day, lag = dice.randint(15_000, 90_000), dice.randint(2, 24), dice.randint(0, 4)
            yield Entry(first.replace(day=day), chk, "TRANSFER TO SAVINGS", -cents, self.bank)
            yield Entry(first.replace(day=day + lag), sav, "TRANSFER FROM CHECKING", cents, self.bank)
        if card_due:
            lag = dice.randint(0, 3)
            yield Entry(first.replace(day=5), chk, f"{self.issuer.upper()} AUTOPAY PAYMENT", -card_due, self.issuer)
            yield Entry(first.replace(day=5 + lag), crd, "PAYMENT RECEIVED THANK YOU", card_due, self.issuer)

    def entries(self) -> list[Entry]:
        out, due, card = [], 0, self.account("crd")
        for first in self.starts:
            month = list(self.month(first, due))
            due = -sum(e.cents for e in month if e.account == card and e.cents < 0)
            out += month
        return sorted(out, key=attrgetter("day", "account", "text", "cents"))

    def tables(self, duplicate_rate: float = DUPLICATE_RATE) -> dict[str, list[tuple]]:
        """Rows of each raw set, in contract order."""
        money, entries, txns = (lambda c: Decimal(c).scaleb(-2)), self.entries(), []
        for e in entries:
            for _ in range(1 + (self.dice.random() < duplicate_rate)):
                txns.append((self.user, e.account, f"{self.user}-{len(txns):06d}", e.day, money(e.cents), e.merchant, e.text, e.label, e.planted))
        balances = []
        for kind, start in zip(("chk", "sav", "crd"), self.opening):
            own = [e for e in entries if e.account == self.account(kind)]
            for first in self.starts:
                end = first.replace(day=monthrange(first.year, first.month)[1])
                balances.append((self.user, self.account(kind), end, money(start + sum(e.cents for e in own if e.day <= end))))
        return {"accounts": list(self.accounts()), "transactions": txns, "balance_snapshots": balances}


def generate(spark: SparkSession, table: str, users: int, months: int, seed: int = 42, start: str = START_MONTH, duplicate_rate: float = DUPLICATE_RATE, buckets: int = BUCKETS) -> DataFrame:
    """A raw set of users households, made on the executors, with the bucket of each row."""
    import pandas as pd

    schema = T.StructType([T.StructField("bucket", T.StringType()), *[T.StructField(f.name, f.dataType) for f in CONTRACTS[table]]])

    def make(frames):
        for frame in frames:
            for number in frame["id"]:
                rows = Household(seed, int(number), months, start).tables(duplicate_rate)[table]
                yield pd.DataFrame([(f"{number % buckets:02d}", *r) for r in rows], columns=schema.names)

    return spark.range(users).mapInPandas(make, schema)


def write_dataset(spark: SparkSession, out: str, users: int, months: int, seed: int = 42, start: str = START_MONTH) -> None:
    """CSV sets under out/<table>/bucket=NN/."""
    if users < 1 or months < 1:
        raise ContractError("users and months must be 1 at least")
    for table in CONTRACTS:
        rows = generate(spark, table, users, months, seed, start)
        text = rows.select("bucket", *[F.col(f.name).cast("string").alias(f.name) for f in CONTRACTS[table]])
        text.repartition("bucket").write.mode("overwrite").partitionBy("bucket").option("header", True).option("emptyValue", "").csv(f"{out.rstrip('/')}/{table}")


def write_sample(out: str | Path, users: int = 5, months: int = 3, seed: int = 42) -> dict[str, int]:
    """One CSV file for each set, of few households; returns the rows of each."""
    homes = [Household(seed, k, months).tables() for k in range(users)]
    form = lambda v: "" if v is None else str(v).lower() if isinstance(v, bool) else str(v)
    Path(out).mkdir(parents=True, exist_ok=True)
    for table in CONTRACTS:
        with open(Path(out) / f"{table}.csv", "w", encoding="utf-8", newline="") as file:
            writer = csv.writer(file, lineterminator="\n")
            writer.writerow(CONTRACTS[table].names)
            writer.writerows([form(v) for v in row] for home in homes for row in home[table])
    return {table: sum(len(h[table]) for h in homes) for table in CONTRACTS}
