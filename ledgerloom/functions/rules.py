"""Category rules: checked when they are made, and compiled to one expression.

The rules become a chain of WHENs in priority order, so categorizing needs no join, window
or shuffle, and the first match wins by construction.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import asdict, astuple, dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.errors import ContractError

UNCATEGORIZED = "Uncategorized"
FIELDS = ("merchant", "description")


@dataclass(frozen=True, order=True)
class Rule:
    priority: int
    field: str
    operator: str
    value: str
    category: str

    def __post_init__(self) -> None:
        problem = None
        if type(self.priority) is not int:
            problem = "priority must be an integer"
        elif self.field not in FIELDS:
            problem = f"field must be one of {', '.join(FIELDS)}"
        elif self.operator not in MATCHERS:
            problem = f"operator must be one of {', '.join(MATCHERS)}"
        elif not all(isinstance(x, str) and x for x in (self.value, self.category)):
            problem = "value and category must be texts with at least one character"
        elif self.operator == "regex":
            try:
                re.compile(self.value)
            except re.error as e:
                problem = f"its pattern doesn't compile: {e}"
        if problem:
            raise ContractError(f"rule {asdict(self)}: {problem}")

    def column(self) -> Column:
        """Whether a row matches; a null field counts as an empty text."""
        return MATCHERS[self.operator](F.coalesce(F.col(self.field), F.lit("")), self.value)


#: Case-insensitive matchers; a pattern may match anywhere, by Unicode's cases.
MATCHERS = {
    "contains": lambda text, v: F.lower(text).contains(F.lower(F.lit(v))),
    "equals": lambda text, v: F.lower(text) == F.lower(F.lit(v)),
    "starts_with": lambda text, v: F.lower(text).startswith(F.lower(F.lit(v))),
    "regex": lambda text, v: text.rlike(f"(?iu){v}"),
}


def make_rule(entry: Mapping) -> Rule:
    """A rule from a mapping that has a rule's keys and no other."""
    names = [f.name for f in fields(Rule)]
    if odd := set(names) ^ set(entry):
        raise ContractError(f"rule {dict(entry)}: keys missing or not known: {', '.join(sorted(map(str, odd)))}")
    return Rule(**{n: entry[n] for n in names})


def sort_rules(rules: Iterable[Rule]) -> list[Rule]:
    """By priority, which must be unique."""
    out = sorted(rules, key=lambda r: r.priority)
    for one, other in zip(out, out[1:]):
        if one.priority == other.priority:
            raise ContractError(f"two rules have priority {one.priority}")
    return out


def rule_category(rules: Iterable[Rule]) -> Column:
    """The category of the first rule that matches a row, else null."""
    chain = None
    for r in sort_rules(rules):
        chain = F.when(r.column(), F.lit(r.category)) if chain is None else chain.when(r.column(), F.lit(r.category))
    return F.lit(None).cast("string") if chain is None else chain


def rules_frame(spark: SparkSession, rules: Iterable[Rule]) -> DataFrame:
    """The rules as a relation, in priority order, for reports and for keeping them in a table."""
    return spark.createDataFrame([astuple(r) for r in sort_rules(rules)], "priority int, field string, operator string, value string, category string")
