"""JSON is parsed once per contract line, and only tables that are read are stored."""

import datetime as dt
from decimal import Decimal

import pytest
from toys import source_tables

from checks import queries
from meterbook.functions.columns import array_lists, pricing
from meterbook.functions.storage import stored
from meterbook.operators import line_rules
from meterbook.operators.invoice_rules import per_client, rule_lines

AS_OF = dt.date(2025, 5, 15)
MAY = dt.datetime(2025, 5, 1)
ODD = [
    None, "", "[]", "5", "{}", '{"pricingType":"LINEAR"', '{"pricingType":"LINEAR","tiers":"x","price":3}', '{"tiers":[{"price":"1"},null],"pricingType":"VOLUME"}',
    '{"flow":["A"],"status":"x"}', '{"status":{"a":1},"flow":["A",null]}', '{"flow":["A"],"status":["x"]',
]


def lines_of(spark, aliases):
    line = {"invoice_id": "i1", "currency": "USD", "billing_period_start": MAY}
    return rule_lines(source_tables(
        spark, customers=[{"id": "seq_1", "legal_name": "One", "customer_aliases": aliases}],
        invoices=[{"id": "i1", "customer_id": "seq_1", "billing_period_start": MAY, "status": "FINAL"}],
        invoice_line_items=[
            {**line, "id": "l1", "price_id": "p1", "title": "Fee", "net_total": Decimal("10.50")},
            {**line, "id": "l2", "price_id": "p2", "title": "Discount", "net_total": Decimal("-3.50")},
            {**line, "id": "l3", "title": "True up charge", "net_total": Decimal("7.00")},
        ],
        prices=[{"id": "p1", "product_name": "Platform Fee"}, {"id": "p2", "product_name": "A"}],
        billing_schedule_phase_prices=[{"price_id": "p1", "status": "ACTIVE", "phase_start_date": dt.date(2025, 1, 1),
                                        "price_structure": '{"pricingType":"FIXED","price":"100.50"}'}],
    ), AS_OF)


@pytest.mark.parametrize("aliases, clients", [("c1,c2,c2", 2), ("c1", 1), ("", 1), (None, 0)])
def test_rules_of_lines_are_made_before_lines_are_repeated_per_client(spark, aliases, clients):
    lines = stored(lines_of(spark, aliases))
    before, no_usage = per_client(lines), line_rules.discount_rules(per_client(lines)).limit(0)
    for rules in (line_rules.platform_fee_rules, line_rules.discount_rules, line_rules.true_up_rules,
                  lambda rows: line_rules.rules_of_lines(rows, no_usage)):
        one, other = rules(lines), rules(before)
        assert one.schema == other.schema and one.count() == other.count() and one.exceptAll(other).isEmpty()
    assert line_rules.rules_of_lines(lines, no_usage).count() == 3 * clients
    plan = line_rules.discount_rules(lines)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" in plan and "from_json" not in plan.split("Generate explode")[0]  # parsed below, per line


def test_a_text_is_parsed_whole_and_once(spark):
    texts = spark.createDataFrame([(x,) for x in ODD], "text string")
    plan = texts.select(pricing("text").alias("p"), array_lists("text")["flow"].alias("flow"))._jdf.queryExecution().optimizedPlan().toString()
    # a parser for a single field would be one of many
    assert "from_json(StructField(price,StringType,true), text" not in plan
    assert "from_json(StructField(flow,ArrayType(StringType,true),true), text" not in plan
    found = texts.select("text", pricing("text").alias("p"), array_lists("text").alias("l")).collect()
    kinds = {r.text: (r.p.pricing_type, r.p.line_price, r.p.tiers is None) for r in found}
    assert kinds['{"pricingType":"LINEAR","tiers":"x","price":3}'] == ("LINEAR", "3", True)
    assert kinds['{"tiers":[{"price":"1"},null],"pricingType":"VOLUME"}'] == ("VOLUME", None, False)
    assert kinds["{}"] == kinds[None] == kinds['{"pricingType":"LINEAR"'] == (None, None, True)
    lists = {r.text: r.l and (r.l.flow, r.l.status) for r in found}
    assert lists['{"flow":["A"],"status":"x"}'] == (["A"], None) and lists['{"status":{"a":1},"flow":["A",null]}'] == (["A", None], None)


def test_only_tables_that_are_read_are_stored(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(queries, "stored", lambda df, *codec: kept.append(df) or df)
    tables = queries.StoredTables({name: spark.createDataFrame([(name,)], "name string") for name in "abc"})
    assert list(tables) == ["a", "b", "c"] and len(tables) == 3 and not kept
    assert tables["b"].first().name == "b" and tables["b"] is tables["b"] and len(kept) == 1
    assert [df.first().name for df in {**tables}.values()] == ["a", "b", "c"] and len(kept) == 3
