"""Windows, invoice versions and line rules."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from toys import source_tables

from meterbook.operators.invoice_rules import invoice_rules
from meterbook.operators.line_revenue import fixed_line_revenue, platform_fee_mart, specific_discounts
from meterbook.operators.line_rules import all_rules, discount_rules, platform_fee_rules, true_up_rules, unmatched_true_ups
from meterbook.operators.payouts import classify_payouts
from meterbook.operators.summaries import invoiced_summary, reconciliation
from meterbook.sources.feeds import billing_window, merge_horizon, movement_union, read_sources, source_profile
from meterbook.sources.schemas import SOURCES

AS_OF = dt.date(2025, 5, 15)
MAY = dt.datetime(2025, 5, 1)


@pytest.mark.parametrize("as_of, first", [
    (dt.date(2026, 5, 15), dt.date(2026, 1, 1)), (dt.date(2026, 8, 15), dt.date(2026, 5, 1)),
    (dt.date(2026, 1, 31), dt.date(2025, 10, 1)), (dt.date(2024, 5, 1), dt.date(2024, 2, 1)),
])
def test_billing_window(as_of, first):
    assert billing_window(as_of) == (first, as_of)


def test_merge_horizon_is_a_whole_month():
    assert merge_horizon(dt.date(2025, 5, 31)) == dt.date(2025, 2, 1)
    assert merge_horizon(dt.date(2025, 2, 28)) == dt.date(2024, 11, 1)


def feed_row(**values):
    at = dt.datetime(2025, 5, 3, 10)
    return {"id": "a", "client_id": "c1", "total_amount": Decimal("5.00"), "utc_created_at": at, "updated_at": at,
            "eventtimestamp": at, "flow": "PAYIN", **values}


def test_union_overrides_the_client_and_cuts_the_last_day(spark):
    last_night = dt.datetime(2025, 5, 15, 23)
    sources = source_tables(
        spark,
        payin_transactions=[feed_row(), feed_row(id="b", client_id_edit="c9"), feed_row(id="late", utc_created_at=last_night)],
        dac_transactions=[feed_row(id="c", eventtimestamp=last_night), feed_row(id="old", eventtimestamp=dt.datetime(2024, 12, 31))],
    )
    rows = movement_union(sources, AS_OF).select("mm_id", "client_id").collect()
    assert sorted(map(tuple, rows)) == [("a", "c1"), ("b", "c9"), ("c", "c1")]


def contract(spark, lines=({},), phases=({},), aliases="c1,c2", invoices=({},), prices=None):
    """One customer with one invoice for May unless said otherwise."""
    return source_tables(
        spark,
        customers=[{"id": "seq_1", "legal_name": "One", "customer_aliases": aliases}],
        sales_customers=[{"sequence_id": "seq_1", "group_id": "g1"}],
        invoices=[{"id": f"i{n}", "customer_id": "seq_1", "billing_period_start": MAY, "billing_period_end": dt.datetime(2025, 5, 31),
                   "status": "FINAL", **row} for n, row in enumerate(invoices)],
        invoice_line_items=[{"id": f"l{n}", "invoice_id": "i0", "price_id": "p1", "billing_schedule_id": "b1", "title": "Pay", "currency": "USD",
                             "billing_period_start": MAY, "net_total": Decimal("10.50"), "quantity": Decimal(2), **row} for n, row in enumerate(lines)],
        prices=prices or [{"id": "p1", "product_name": "Pay"}],
        billing_schedule_phase_prices=[{"price_id": "p1", "billing_schedule_id": "b1", "status": "ACTIVE", "phase_start_date": dt.date(2025, 1, 1),
                                        "price_structure": '{"pricingType":"LINEAR","pricePerUnit":"1","usageMetricId":"u1"}', **row} for row in phases],
        usage_metrics=[{"id": "u1", "name": "Pays", "property_filters": '{"flow":["PAYIN"]}'}],
    )


def test_rules_per_alias_with_metric(spark):
    rules = invoice_rules(contract(spark, aliases="c1,c2,c1"), AS_OF).orderBy("client_id").collect()
    assert [(r.client_id, r.usage_metric, r.group_id, r.consumes_saas) for r in rules] == [("c1", "Pays", "g1", False), ("c2", "Pays", "g1", False)]


def test_missing_calculation_time_is_the_latest_version(spark):
    sources = contract(
        spark, invoices=[{"calculated_at": dt.datetime(2025, 5, 1)}, {"calculated_at": None}],
        lines=[{}, {"invoice_id": "i1", "net_total": Decimal("99")}],
    )
    assert {r.net_total for r in invoice_rules(sources, AS_OF).collect()} == {Decimal("99.00")}


def test_month_and_time_are_the_lines_own(spark):
    april = {"billing_period_start": dt.datetime(2025, 4, 1), "calculated_at": dt.datetime(2025, 6, 2)}
    row = invoice_rules(contract(spark, lines=[april], invoices=[{"calculated_at": dt.datetime(2025, 6, 1)}], aliases="c1"), AS_OF).first()
    assert (row.month, row.billing_month, row.calculated_at) == (dt.date(2025, 4, 1), dt.date(2025, 5, 1), dt.datetime(2025, 6, 2))


@pytest.mark.parametrize("phase, structure", [
    ({"phase_archived_at": MAY}, "gone"), ({"status": "DRAFT"}, None), ({"phase_end_date": dt.date(2025, 4, 30)}, None),
    ({"status": None}, "there"), ({"phase_end_date": dt.date(2025, 5, 1)}, "there"),
])
def test_phase_in_force(spark, phase, structure):
    rows = invoice_rules(contract(spark, phases=[phase], aliases="c1"), AS_OF).collect()
    found = "gone" if not rows else ("there" if rows[0].price_structure_json else None)
    assert found == structure


def test_customers_without_aliases_and_deleted_lines_drop_out(spark):
    assert invoice_rules(contract(spark, aliases=None), AS_OF).isEmpty()
    assert invoice_rules(contract(spark, lines=[{"deleted_at": MAY}]), AS_OF).isEmpty()


def line_rules_of(spark, **kw):
    return invoice_rules(contract(spark, **kw), AS_OF)


def test_discount_price_comes_from_the_net_total(spark):
    rules = line_rules_of(spark, lines=[{"title": "Discount", "price_id": None, "net_total": Decimal("-3.50")}], aliases="c1")
    row = discount_rules(rules).first()
    assert (row.matched_product_name, row.price_structure_json) == ("Discount||Discount", '{"price":-3.50,"pricingType":"FIXED"}')
    nothing = line_rules_of(spark, lines=[{"title": "Discount", "price_id": None, "net_total": None}], aliases="c1")
    assert discount_rules(nothing).first().price_structure_json is None


FEE = {"prices": [{"id": "p1", "product_name": "Platform Fee"}], "phases": [{"price_structure": '{"pricingType":"FIXED","price":"100.50"}'}]}


def test_fee_price_is_rounded_to_whole_units(spark):
    rules = platform_fee_rules(line_rules_of(spark, **FEE))
    row = fixed_line_revenue(rules, "fee").collect()
    assert [(float(r.revenue), r.remaining_minimum, r.revenue_type) for r in row] == [(101.0, None, "non_consuming")]
    assert float(fixed_line_revenue(rules, "fee", exact_cents=True).first().revenue) == 100.5


def test_fee_without_transactions_and_discount_has_no_adjusted_revenue(spark):
    rules = line_rules_of(spark, **FEE)
    fee = fixed_line_revenue(platform_fee_rules(rules), "fee")
    none = spark.createDataFrame([], "sequence_customer_id string, transaction_month date, trx_receiving_platform_fee bigint")
    specific = specific_discounts(fixed_line_revenue(platform_fee_rules(rules), "discount"))
    assert platform_fee_mart(fee, none, specific).first().revenue_total_adjusted is None
    some = spark.createDataFrame([("seq_1", MAY.date(), 2)], none.schema)
    assert platform_fee_mart(fee, some, specific).first().revenue_total_adjusted == 0


def test_two_specific_discounts_give_two_fee_rows(spark):
    fee_line, one, two = {}, {"title": "Discount", "price_id": "p2"}, {"title": "New discount", "price_id": "p3"}
    rules = line_rules_of(
        spark, lines=[fee_line, one, two], phases=FEE["phases"], aliases="c1",
        prices=[{"id": "p1", "product_name": "Platform Fee"}, {"id": "p2", "product_name": "A"}, {"id": "p3", "product_name": "B"}],
    )
    none = spark.createDataFrame([], "sequence_customer_id string, transaction_month date, trx_receiving_platform_fee bigint")
    discounts = fixed_line_revenue(discount_rules(rules), "discount")
    mart = platform_fee_mart(fixed_line_revenue(platform_fee_rules(rules), "fee"), none, specific_discounts(discounts))
    assert [float(r.revenue_total_adjusted) for r in mart.collect()] == [112, 112]  # 101 + 11, twice


def test_true_up_only_without_charged_saas_matches(spark):
    rules = line_rules_of(spark, lines=[{"title": "True up charge", "price_id": None}], aliases="c1")
    schema = "sequence_customer_id string, transaction_month date, trx_count bigint"
    present = spark.createDataFrame([("seq_1", MAY.date(), 1)], schema)
    assert unmatched_true_ups(true_up_rules(rules), present).isEmpty()
    assert unmatched_true_ups(true_up_rules(rules), spark.createDataFrame([], schema)).count() == 1
    assert all_rules(rules, true_up_rules(rules).limit(0)).count() == 1


def summary(spark, revenue, customer="seq_1"):
    return spark.createDataFrame(
        [(customer, "g1", "Pay", "LINEAR", "count", MAY.date(), "USD", Decimal(revenue), Decimal(1))],
        "sequence_customer_id string, group_id string, product_name string, pricing_type string, tier_application_basis string,"
        " transaction_month date, currency string, calculated_revenue decimal(38,8), tier_application_value decimal(28,2)",
    )


@pytest.mark.parametrize("calculated, invoiced, percent", [("110", "90", 20.0), ("0", "0", 0.0), ("5", "-5", 0.0), ("90", "110", -20.0)])
def test_percent_difference(spark, calculated, invoiced, percent):
    billed = invoiced_summary(contract(spark, lines=[{"net_total": Decimal(invoiced)}]))
    row = reconciliation(summary(spark, calculated), billed).collect()
    assert [float(r.relative_percentage_difference) for r in row] == [percent]


def test_one_sided_rows_are_kept(spark):
    assert reconciliation(summary(spark, "5", "other"), invoiced_summary(contract(spark))).count() == 2


def test_voided_and_unknown_status_are_not_invoiced(spark):
    for status in ("VOIDED", None):
        assert invoiced_summary(contract(spark, invoices=[{"status": status}])).isEmpty()


def test_payout_day_is_local(spark):
    movement = {"id": "x", "client_id": "c", "type": "ach", "status_state": "finished", "source_geography": "col",
                "underlying_institution": "1051", "created_at": dt.datetime(2025, 5, 1, 3), "amount": Decimal(1)}
    raw = source_tables(spark, money_movements=[movement])["money_movements"]
    row = classify_payouts(raw, dt.date(2025, 4, 1)).first()
    assert (row.eventtimestamp, row.origin_bank, row.origination_system) == (dt.date(2025, 4, 30), "BANCO DAVIVIENDA SA", "OTHER")
    assert classify_payouts(raw, dt.date(2025, 5, 1)).isEmpty()
    assert classify_payouts(raw, dt.date(2025, 4, 1), excluded_clients=["c"]).isEmpty()


def test_sources_are_read_with_their_declared_columns(spark, tmp_path):
    spark.createDataFrame([("p1", "Pay", 1)], "id string, product_name string, more int").write.parquet(f"{tmp_path}/prices")
    assert read_sources(spark, {"prices": f"{tmp_path}/prices"})["prices"].schema == SOURCES["prices"]
    with pytest.raises(ValueError):
        read_sources(spark, {"nothing": "x"})


def test_one_error_lists_all_that_is_wrong_with_the_sources(spark, tmp_path):
    spark.createDataFrame([("p1", [1])], "id string, product_name array<int>").write.parquet(f"{tmp_path}/prices")
    spark.createDataFrame([("s1",)], "sequence_id string").write.parquet(f"{tmp_path}/sales")
    spark.createDataFrame([("i", 1.5)], "id string, net_total double").write.parquet(f"{tmp_path}/lines")
    places = {"prices": f"{tmp_path}/prices", "sales_customers": f"{tmp_path}/sales", "invoice_line_items": f"{tmp_path}/lines"}
    with pytest.raises(ValueError) as error:
        read_sources(spark, places)
    for part in ("prices.product_name is array<int>, not string", "sales_customers.group_id is missing", "net_total is double, not decimal(18,2)"):
        assert part in str(error.value)
    padded = read_sources(spark, {"sales_customers": places["sales_customers"]}, pad=True)["sales_customers"]
    assert padded.collect() == [("s1", None)] and padded.schema == SOURCES["sales_customers"]
    with pytest.raises(ValueError, match="is double"):
        read_sources(spark, places, pad=True)


def test_types_that_keep_every_value_are_cast(spark, tmp_path):
    rows = spark.sql("select 7 as id, 'c' as customer_id, timestamp_ntz'2025-05-01 00:00:00' as billing_period_start, date'2025-05-31' as billing_period_end, "
                     "cast(null as timestamp_ntz) as calculated_at, true as status, 1 as more")
    rows.write.parquet(f"{tmp_path}/invoices")
    invoices = read_sources(spark, {"invoices": f"{tmp_path}/invoices"})["invoices"]
    assert invoices.schema == SOURCES["invoices"]
    assert invoices.first() == ("7", "c", MAY, dt.datetime(2025, 5, 31), None, "true")
    profile = {r.field: r for r in source_profile({"invoices": invoices}).collect()}
    assert (profile["calculated_at"].entries, profile["calculated_at"].filled, profile["calculated_at"].smallest) == (1, 0, None)
    assert profile["billing_period_end"].largest == "2025-05-31 00:00:00"


def test_lines_are_ranked_before_they_meet_customers(spark):
    text = invoice_rules(contract(spark), AS_OF)._jdf.queryExecution().optimizedPlan().toString()
    depth = {part: min(i for i, line in enumerate(text.splitlines()) if part in line) for part in ("legal_name", "WindowGroupLimit", "Window [")}
    above = text.splitlines()[:depth["Window ["]]
    assert sum("Join LeftOuter" in line for line in above) == 3 and depth["WindowGroupLimit"] > depth["Window ["]


def test_repeated_customers_and_metrics_do_not_multiply_lines(spark):
    sources = contract(spark)
    for name in ("customers", "sales_customers", "usage_metrics"):
        more = sources[name].withColumn(sources[name].columns[-1], F.lit("zzz"))
        sources[name] = sources[name].unionByName(more)
    rules = invoice_rules(sources, AS_OF).orderBy("client_id").collect()
    assert [(r.client_id, r.group_id) for r in rules] == [("c1", "g1"), ("c2", "g1")]


def test_tables_that_grow_are_joined_by_merge_and_lines_dealt_once(spark):
    from meterbook.operators.invoice_rules import rule_lines

    planned = rule_lines(source_tables(spark), dt.date(2025, 5, 15))._jdf.queryExecution()
    assert planned.optimizedPlan().toString().count("strategy=merge") == 5  # all but the usage metrics
    assert planned.executedPlan().toString().count("REPARTITION_BY_NUM") == 1
