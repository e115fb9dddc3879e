import random

import pytest

from ledgerloom.errors import ContractError
from ledgerloom.functions import rowwise
from ledgerloom.functions.rules import Rule, make_rule, rules_frame, sort_rules
from ledgerloom.operators.ledger import categorize

RULES = [
    Rule(30, "description", "regex", r"gro+cer|\bcafe\b", "Food"),
    Rule(10, "merchant", "contains", "pay", "Income"),
    Rule(20, "description", "starts_with", "move ", "Transfer"),
    Rule(40, "merchant", "equals", "Acme", "Work"),
]
GOOD = {"priority": 1, "field": "merchant", "operator": "equals", "value": "x", "category": "y"}


@pytest.mark.parametrize("change", [
    {"priority": True}, {"priority": "1"}, {"field": "amount"}, {"operator": "like"}, {"value": ""}, {"category": None},
    {"operator": "regex", "value": "("}, {"extra": 1},
])
def test_bad_rules(change):
    with pytest.raises(ContractError):
        make_rule(GOOD | change)


def test_missing_key_and_equal_priorities():
    with pytest.raises(ContractError, match="category"):
        make_rule({k: v for k, v in GOOD.items() if k != "category"})
    with pytest.raises(ContractError, match="priority 1"):
        sort_rules([make_rule(GOOD), make_rule(GOOD)])
    assert [r.priority for r in sort_rules(RULES)] == [10, 20, 30, 40]


def test_matches_rowwise(spark):
    r = random.Random(1)
    texts = [None, "", "ACME", "acme", "Payday", "MOVE to", "move", "remove it", "Groocer", "Cafe x", "CAFÉ", "İstanbul"]
    rows = [(i, r.choice(texts), r.choice(texts), r.choice([None, None, "", "Own"])) for i in range(300)]
    df = spark.createDataFrame(rows, "transaction_id int, merchant string, description string, user_category string")
    for out in categorize(df, RULES).collect():
        row = out.asDict()
        assert out.category == rowwise.category(RULES, row), row
        own, rule = row["user_category"] is not None, rowwise.first_category(RULES, row)
        assert out.category_source == ("user" if own else "rule" if rule else "none")


def test_edges(spark):
    df = spark.createDataFrame([(None, None, None)], "merchant string, description string, user_category string")
    assert categorize(df, [Rule(1, "merchant", "regex", "a*", "Any")]).first().category == "Any"
    assert categorize(df, []).first().category == "Uncategorized"
    upper = spark.createDataFrame([("CAFÉ", None, None)], df.schema)
    assert categorize(upper, [Rule(1, "merchant", "regex", "café", "Food")]).first().category == "Food"
    plan = categorize(df, RULES)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" not in plan


def test_rules_as_a_relation(spark):
    rows = rules_frame(spark, RULES).collect()
    assert [r.priority for r in rows] == [10, 20, 30, 40] and [make_rule(r.asDict()) for r in rows] == sort_rules(RULES)
    assert rules_frame(spark, []).count() == 0
