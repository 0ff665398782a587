"""Tier choice, minimum and running sums on hand-worked cases."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from toys import by_id, linear, rule_rows, tiered

from meterbook.operators import ordered
from meterbook.operators.allocation import allocate, month_shares
from meterbook.operators import rating
from meterbook.operators.rating import rate_transactions, tier_selection

FLAT = [(20, 3, False, 0), (10, None, False, 0)]
PERCENT = [(1, 100, True, 0), (2, None, True, 0)]


def revenues(spark, rows):
    return [r[0] for r in by_id(rate_transactions(rule_rows(spark, rows)), "revenue")]


def test_volume_reprices_the_whole_month(spark):
    assert revenues(spark, [{"price_structure_json": tiered("VOLUME", *FLAT)}] * 5) == [10] * 5


def test_graduated_keeps_each_rows_tier(spark):
    assert revenues(spark, [{"price_structure_json": tiered("GRADUATED", *FLAT)}] * 5) == [20, 20, 20, 10, 10]


def test_percentage_tiers_follow_the_running_amount(spark):
    rows = [{"price_structure_json": tiered("GRADUATED", *PERCENT), "amount": 60}] * 2
    assert revenues(spark, rows) == [pytest.approx(0.6), pytest.approx(1.2)]


def test_first_fitting_tier_wins_a_tie(spark):
    structure = tiered("VOLUME", (5, 100, False, 0), (4, 500, False, 0), (3, None, False, 0))
    rated = tier_selection(rule_rows(spark, [{"price_structure_json": structure}] * 50))
    assert {r[0] for r in rated.select("tier_upper_bound").collect()} == {100}


def test_fee_is_added_to_every_transaction(spark):
    rows = [{"price_structure_json": tiered("VOLUME", (20, None, False, 2.5))}] * 2
    assert revenues(spark, rows) == [22.5, 22.5]


def test_bounded_percentage_tier_goes_before_flat_tier(spark):
    structure = tiered("GRADUATED", (9, 5, False, 0), (1, 1000, True, 0))
    assert revenues(spark, [{"price_structure_json": structure, "amount": 200}]) == [2]


def test_no_tiers_no_percentage_flag_and_other_types(spark):
    rows = [
        {"price_structure_json": tiered("VOLUME")},
        {"price_structure_json": '{"pricingType":"LINEAR","pricePerUnit":"3"}', "matched_product_name": "Q"},
        {"price_structure_json": '{"pricingType":"FIXED","price":"3"}', "matched_product_name": "R"},
    ]
    assert revenues(spark, rows) == [0, 0]  # the FIXED row is not rated


def test_lower_case_pricing_type_and_number_values(spark):
    structure = json.dumps({"pricingType": "graduated", "tiers": [{"price": 7, "fee": 1, "upperBound": 10, "isPricePercentage": False}]})
    assert revenues(spark, [{"price_structure_json": structure}]) == [8]


def test_minimum_is_used_up_in_time_order(spark):
    rows = [{"price_structure_json": linear(10, False), "consumes_saas": True, "price_minimum_amount": 25}] * 4
    rated = by_id(rate_transactions(rule_rows(spark, rows)), "saas_revenue", "not_saas_revenue", "remaining_minimum", "revenue_type")
    assert rated == [(10, 0, 15, "saas"), (10, 0, 5, "saas"), (5, 5, 0, "mixed"), (0, 10, 0, "post_minimum")]


def test_other_products_do_not_use_the_minimum(spark):
    rows = [
        {"consumes_saas": True, "price_structure_json": linear(10, False), "price_minimum_amount": 15},
        {"matched_product_name": "Q", "price_structure_json": linear(50, False)},
        {"consumes_saas": True, "price_structure_json": linear(10, False), "price_minimum_amount": 15},
    ]
    rated = by_id(rate_transactions(rule_rows(spark, rows)), "saas_revenue", "not_saas_revenue", "revenue_type")
    assert rated == [(10, 0, "saas"), (0, 50, "non_consuming"), (5, 5, "mixed")]


def test_unrated_discounts_count_in_order_and_minimum(spark):
    rows = [
        {"matched_product_name": "Discount||X", "price_structure_json": '{"pricingType":"FIXED","price":"3"}', "price_minimum_amount": 99},
        {"consumes_saas": True, "price_structure_json": linear(10, False), "price_minimum_amount": 5},
    ]
    rated = by_id(rate_transactions(rule_rows(spark, rows)), "mm_id", "global_transaction_order", "price_minimum_revenue", "cumulative_saas_revenue_global_before")
    assert rated == [("mm0001", 2, 99, None)]


def test_copies_of_a_tiered_match_leave_one_row_linear_ones_stay(spark):
    at = dt.datetime(2025, 5, 2)
    copies = [{"mm_id": "same", "local_created_at": at, "hash_match": "h", "client_id": c} for c in ("c1", "c2", "c3")]
    tiers = [{**c, "price_structure_json": tiered("GRADUATED", *FLAT)} for c in copies]
    assert revenues(spark, tiers) == [20]
    assert len(revenues(spark, copies)) == 3


def test_running_sums_start_with_null(spark):
    rated = by_id(rate_transactions(rule_rows(spark, [{}, {}])), "cumulative_amount", "cumulative_amount_before", "cumulative_revenue_before")
    assert rated == [(100, None, None), (200, 100, 1)]


@pytest.mark.parametrize("chunks", [2, 5, 23, 80])
def test_groups_cut_into_chunks_are_rated_as_whole_ones(spark, chunks):
    kinds = [linear("0.5", True), tiered("VOLUME", *FLAT), tiered("GRADUATED", *PERCENT), '{"pricingType":"FIXED","price":"1"}']
    rows = [
        {
            "mm_id": f"mm{n % 37:03d}", "local_created_at": dt.datetime(2025, 5, 1) + dt.timedelta(minutes=n % 11),
            "amount": n * 7 % 90 if n % 9 else None, "matched_product_name": f"P{n % 4}", "price_structure_json": kinds[n % 4],
            "consumes_saas": n % 3 == 0, "price_minimum_amount": 5 if n % 2 else None,
            "sequence_customer_id": None if n % 40 == 7 else ("hot" if n % 5 else f"seq_{n % 3}"), "client_id": f"c{n}",
        }
        for n in range(160)
    ]
    rules = rule_rows(spark, rows)
    whole, split = rate_transactions(rules, 1), rate_transactions(rules, chunks)
    groups = rating._placed(rules, chunks).groups
    assert rating._placed(rules, 1).groups.cut_rows.isEmpty() and (chunks < 5 or not groups.cut_rows.isEmpty())
    assert whole.count() == split.count() > 100
    assert whole.exceptAll(split).isEmpty() and split.exceptAll(whole).isEmpty()


def test_result_does_not_depend_on_input_order(spark):
    rows = [{"price_structure_json": tiered("VOLUME", *FLAT), "amount": n, "consumes_saas": True, "price_minimum_amount": 30} for n in range(20)]
    rules = rule_rows(spark, rows)
    again = rules.orderBy(F.desc("mm_id")).repartition(3)
    assert rate_transactions(rules).exceptAll(rate_transactions(again)).isEmpty()


def test_split_adds_up_and_shares_add_up(spark):
    rows = [{"price_structure_json": linear("1.5", True), "amount": 7 * n, "consumes_saas": n % 2 == 0, "price_minimum_amount": 40} for n in range(30)]
    rated = rate_transactions(rule_rows(spark, rows))
    assert rated.filter("saas_revenue + not_saas_revenue <> revenue").isEmpty()
    fees = rated.select("sequence_customer_id", "transaction_month").distinct().withColumn("total_platform_fee", F.lit("90.00").cast("decimal(28,8)"))
    allocated = allocate(rated, fees, month_shares(rated))
    shares = allocated.agg(F.sum("platform_fee_share"), F.min("platform_fee_share"), F.count("*")).first()
    assert (float(shares[0]), float(shares[1]), shares[2]) == (90, 3, 30)


def test_rows_pass_the_windows_once(spark):
    """All rows are shuffled once after they are placed; what is carried comes from stored rows of cut groups."""
    rules = rule_rows(spark, [{"price_structure_json": tiered("VOLUME", *FLAT)}] * 20)
    plan = rate_transactions(rules, 4)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1 and plan.count("Window [") <= 6 and "LeftSemi" not in plan


def test_only_groups_larger_than_a_chunk_are_placed(spark):
    rows = [{"sequence_customer_id": "big"}] * 90 + [{"sequence_customer_id": f"s{n}"} for n in range(30)]
    groups = ordered.place(rule_rows(spark, rows), rating.GROUP, rating.KEY_ORDER, 4)
    chunks = {(r[0], r[1]) for r in groups.rows.select("sequence_customer_id", ordered.CHUNK).collect()}
    assert {c for s, c in chunks if s != "big"} == {0} and len({c for s, c in chunks if s == "big"}) > 1 and ("big", 0) not in chunks
    assert groups.rows.count() == 120 and groups.cut_rows.count() == 90


def test_chunks_grow_with_the_rows_and_their_number_holds(spark, monkeypatch):
    monkeypatch.setattr(ordered, "CHUNK_ROWS", 10)
    rated = rate_transactions(rule_rows(spark, [{"sequence_customer_id": f"s{n % 40}"} for n in range(120)]))
    assert rated.rdd.getNumPartitions() == 12 and rated.count() == 120


def test_texts_of_contract_lines_are_not_shuffled_with_the_rows(spark, monkeypatch):
    kinds = [linear("0.5", True), tiered("VOLUME", *FLAT), None]
    rows = [{
        "price_structure_json": kinds[n % 3], "property_filters_json": [None, '{"flow":["A"]}'][n % 2], "properties_to_negate": [None, "", "flow"][n // 2 % 3],
        "matched_product_name": f"P{n % 3}", "amount": n, "sequence_customer_id": "hot" if n % 3 else None,
    } for n in range(60)]
    rules = rule_rows(spark, rows)
    keyed = rate_transactions(rules, 4)
    repartition = keyed._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")[1]
    assert "Project" in repartition and "_text_1" in repartition
    monkeypatch.setattr(rating, "BROADCAST_BYTES", 0)
    carried = rate_transactions(rules, 4)
    assert "_text_1" not in carried._jdf.queryExecution().optimizedPlan().toString()
    assert keyed.count() == carried.count() > 0
    assert keyed.exceptAll(carried).isEmpty() and carried.exceptAll(keyed).isEmpty()
    assert {r[0] for r in keyed.select("properties_to_negate").distinct().collect()} == {None, "", "flow"}


def test_texts_and_unused_columns_pass_no_window_of_their_own(spark):
    rows = [{"price_structure_json": tiered("VOLUME", *FLAT), "amount": n, "property_filters_json": f'{{"flow":["{n % 3}"]}}'} for n in range(9)]
    rated = rate_transactions(rule_rows(spark, rows), 4)
    lines = rated._jdf.queryExecution().optimizedPlan().toString().splitlines()
    windows = [n for n, line in enumerate(lines) if "Window [" in line]
    between = lines[windows[0]:windows[-1]]
    assert any("_others" in line for line in between) and not any(c in line for line in between for c in ("property_filters_json", "origin_bank"))
    assert {r[0] for r in rated.select("property_filters_json").collect()} == {f'{{"flow":["{n}"]}}' for n in range(3)}
