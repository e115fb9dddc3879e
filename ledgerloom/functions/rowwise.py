"""The same semantics for single rows in plain Python: for services, and as the tests' oracle."""

from __future__ import annotations

import re
import statistics
from collections.abc import Iterable, Mapping, Sequence
from datetime import date
from decimal import Decimal

from ledgerloom.functions.rules import UNCATEGORIZED, Rule, sort_rules


def matches(rule: Rule, row: Mapping) -> bool:
    text = row.get(rule.field) or ""
    if rule.operator == "regex":
        return bool(re.search(rule.value, text, re.I))
    low, value = text.lower(), rule.value.lower()
    return {"equals": low == value, "contains": value in low, "starts_with": low[: len(value)] == value}[rule.operator]


def first_category(rules: Iterable[Rule], row: Mapping) -> str | None:
    return next((r.category for r in sort_rules(rules) if matches(r, row)), None)


def category(rules: Iterable[Rule], row: Mapping) -> str:
    own = row.get("user_category")
    return own if own is not None else first_category(rules, row) or UNCATEGORIZED


def _day(value) -> int:
    return (value if isinstance(value, date) else date.fromisoformat(str(value))).toordinal()


def transfer_partners(rows: Iterable[Mapping], window_days: int = 4) -> dict[str, str]:
    """Each paired transaction's partner: the pairs in which both sides rank the other first."""
    open_ = [(r["transaction_id"], r["user_id"], r["account_id"], _day(r["posted_date"]), Decimal(str(r["amount"]))) for r in rows if r.get("user_category") is None]
    ranked: dict[str, list[tuple[int, str]]] = {}
    for out in (x for x in open_ if x[4] < 0):
        for into in (x for x in open_ if x[4] == -out[4]):
            gap = abs(out[3] - into[3])
            if out[1] == into[1] and out[2] != into[2] and gap <= window_days:
                ranked.setdefault(out[0], []).append((gap, into[0]))
                ranked.setdefault(into[0], []).append((gap, out[0]))
    first = {k: min(v)[1] for k, v in ranked.items()}
    return {k: v for k, v in first.items() if first[v] == k}


def outflow_z_score(magnitude: float, recent: Sequence[float], history: Sequence[float], min_history: int = 5) -> float | None:
    """Of a magnitude against the recent values if there are min_history, else all earlier ones."""
    base = next((b for b in (recent, history) if len(b) >= min_history), None)
    if base is None or len(set(base)) == 1:
        return None
    return (magnitude - statistics.fmean(base)) / statistics.stdev(base)
