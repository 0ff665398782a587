"""Three-valued matching of movements against rules."""

import pytest
from toys import movements, usage_rules

from pyspark.sql import functions as F

from checks import queries
from meterbook.functions.storage import stored
from meterbook.operators import line_rules
from meterbook.operators.matching import compile_rules, match_rules

COUNTRY = '{"country":["MX"]}'


def charged(spark, rule, movement):
    pairs = match_rules(movements(spark, movement), compile_rules(usage_rules(spark, rule)))
    return [r[0] for r in pairs.select("should_be_charged").collect()]


@pytest.mark.parametrize("rule, movement, expected", [
    ({"property_filters_json": COUNTRY, "properties_to_negate": '["country"]'}, {"country": None}, False),
    ({"property_filters_json": COUNTRY, "properties_to_negate": '["country"]'}, {"country": "CO"}, True),
    ({"property_filters_json": COUNTRY, "properties_to_negate": '["country"]'}, {"country": "MX"}, False),
    ({"property_filters_json": '{"flow":["PAYIN"]}'}, {"flow": None}, False),
    ({"property_filters_json": '{"flow":["payin"]}'}, {"flow": "PayIn"}, True),
    ({"property_filters_json": None}, {"flow": None}, True),
    ({"property_filters_json": "{}"}, {"flow": "X"}, True),
    ({"property_filters_json": '{"flow":"PAYIN"}'}, {"flow": "OTHER"}, True),  # no array: ignored
    ({"property_filters_json": '{"transaction_type":["ACH_FAST"]}'}, {"transaction_type": "ACH"}, True),  # part of the text
    ({"property_filters_json": '{"flow":["A"]}', "properties_to_negate": "[]"}, {"flow": "A"}, True),
    ({"property_filters_json": '{"flow":["A"]}', "properties_to_negate": '["status"]'}, {"flow": "A"}, False),  # nothing to compare
    ({"property_filters_json": COUNTRY, "properties_to_negate": '["COUNTRY"]'}, {"country": "CO"}, False),  # names keep their case
    ({"property_filters_json": "{broken"}, {"flow": "A"}, True),
])
def test_charging(spark, rule, movement, expected):
    assert charged(spark, rule, movement) == [expected]


def test_all_pairs_or_only_the_charged_ones(spark):
    moved = movements(spark, {"flow": "A"}, {"flow": "B"}, {"flow": "A", "client_id": "other"})
    rules = compile_rules(usage_rules(spark, {"property_filters_json": '{"flow":["A"]}'}, {"product_name": "Discount"}))
    assert match_rules(moved, rules).count() == 2  # the discount is no usage rule, the other client has no rule
    assert match_rules(moved, rules, charged_only=True).count() == 1


def test_reason(spark):
    rule = {"property_filters_json": '{"flow":["A"],"country":["MX"]}', "properties_to_negate": '["country"]'}
    pairs = match_rules(movements(spark, {"flow": "A", "country": "CO"}), compile_rules(usage_rules(spark, rule)), with_reason=True)
    assert [r[0] for r in pairs.select("match_reason").collect()] == ["FLOW, NOT_COUNTRY"]


def test_rules_per_contract_line_match_like_rules_per_client(spark):
    lines = usage_rules(spark, {"property_filters_json": '{"flow":["A"]}'}, {"product_name": "Q"}, {"product_name": "R", "price_structure_month": None})
    lines = lines.drop("client_id").withColumn("raw_client_id", F.when(F.col("product_name") != "Q", "c1,c2,c1").otherwise("c1"))
    moved = movements(spark, *[{"client_id": c, "flow": f} for c in ("c1", "c2", "c3") for f in ("A", "B")])
    per_client = match_rules(moved, compile_rules(lines))
    contracts = compile_rules(lines, clients=False)
    assert contracts.count() == 3 and "client_id" not in contracts.columns
    whole = match_rules(moved, contracts)
    assert whole.columns == per_client.columns and whole.count() == per_client.count() == 6
    assert whole.exceptAll(per_client).isEmpty() and per_client.exceptAll(whole).isEmpty()
    assert "Broadcast" not in whole._jdf.queryExecution().executedPlan().toString()


def test_movements_are_matched_once_for_all_rules(spark, small, monkeypatch):
    s, plans = queries.Stages(spark, small), []
    s.lines  # stored before

    def noted(df, *codec):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return stored(df, *codec)

    monkeypatch.setattr(queries, "stored", noted)
    found = s.all_rules
    assert sum("Join Inner" in line and "_raw_client_id" in line for text in plans for line in text.splitlines()) == 1
    whole = line_rules.all_rules(s.rules, s.matches).select(*found.columns)
    assert found.count() == whole.count() and found.exceptAll(whole).isEmpty()
