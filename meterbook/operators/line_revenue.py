"""Revenue of the rules that are no usage: platform fees, discounts and true-ups, and their marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import any_of, greatest_or_null, pricing, whole
from ..sources.schemas import LINE_PRICE, REVENUE, REVENUE_ROW, conform

GROUP = ["sequence_customer_id", "transaction_month"]
LINE_KEY = ["sequence_customer_id", "matched_product_name", "transaction_month", "amount"]

# which rules, pricing type, charged, revenue type (None: by whether the line consumes the minimum)
_KINDS = {
    "fee": ("FIXED", True, None),
    "discount": ("DISCOUNT", False, "DISCOUNT"),
    "true_up": ("TRUE_UP_CHARGE", False, "TRUE_UP_CHARGE"),
}


def _belongs(kind: str) -> Column:
    product = F.upper("matched_product_name")
    if kind == "fee":
        return (product == "PLATFORM FEE") & (F.col("pricing.pricing_type") == "FIXED")
    return product.contains({"discount": "DISCOUNT", "true_up": "TRUE UP CHARGE"}[kind])


def line_rule_rows(rules: DataFrame) -> DataFrame:
    """The few rule rows that any of the three kinds uses, to be stored once instead of scanning all rules three times."""
    return rules.filter(any_of([F.coalesce(_belongs(kind), F.lit(False)) for kind in _KINDS]))


def fixed_line_revenue(rules: DataFrame, kind: str, exact_cents: bool = False) -> DataFrame:
    """Revenue rows of one kind of line: "fee", "discount" or "true_up".

    Prices are rounded to whole units first, as the billing they reproduce does; `exact_cents` keeps the cents.
    """
    pricing_type, charged, revenue_type = _KINDS[kind]
    if "pricing" not in rules.columns:
        rules = rules.withColumn("pricing", pricing("price_structure_json"))
    text = F.col("pricing.line_price")
    price = (text if exact_cents else whole(text)).cast(LINE_PRICE)
    zero = F.lit(0).cast(LINE_PRICE)
    minimum = F.col("price_minimum_amount").cast(LINE_PRICE)
    saas = F.col("consumes_saas")
    rows = rules.filter(_belongs(kind)).select(
        "sequence_customer_id", "group_id", "matched_product_name", "local_created_at", "transaction_month",
        F.lit(1).alias("transaction_count"),
        "price_structure_json",
        minimum.alias("price_minimum_revenue"),
        F.lit(pricing_type).alias("pricing_type"),
        "consumes_saas",
        F.lit(charged).alias("should_be_charged"),
        "currency",
        price.alias("price_per_unit"),
        price.alias("revenue"),
        price.alias("cumulative_revenue"),
        zero.alias("cumulative_revenue_before"),
        F.when(saas, price).otherwise(zero).alias("saas_revenue"),
        F.when(~saas, price).otherwise(zero).alias("not_saas_revenue"),
        (F.lit(revenue_type) if revenue_type else F.when(~saas, "non_consuming").otherwise("saas")).alias("revenue_type"),
        (greatest_or_null(minimum - price, zero) if kind == "fee" else zero).alias("remaining_minimum"),
        "property_filters_json", "properties_to_negate", "local_updated_at",
    )
    return conform(rows, REVENUE_ROW).distinct()


def platform_fee_totals(fee_lines: DataFrame) -> DataFrame:
    return fee_lines.groupBy(*GROUP).agg(F.sum("revenue").alias("total_platform_fee"))


def _discount_totals(discount_lines: DataFrame) -> DataFrame:
    return discount_lines.groupBy(*GROUP, "matched_product_name").agg(F.sum("revenue").alias("total_discount")).select(
        *GROUP, F.split_part("matched_product_name", F.lit("||"), F.lit(2)).alias("discount_applies_to"), "total_discount"
    )


def general_discounts(discount_lines: DataFrame) -> DataFrame:
    """Totals of the discounts on everything, one row per discount name."""
    return _discount_totals(discount_lines).filter(F.upper("discount_applies_to") == "DISCOUNT")


def specific_discounts(discount_lines: DataFrame) -> DataFrame:
    """Totals of the discounts on one product, one row per discount name."""
    return _discount_totals(discount_lines).filter(F.upper("discount_applies_to") != "DISCOUNT")


def _has_transactions() -> Column:
    return F.col("trx_receiving_platform_fee") > 0


def _adjusted(lines: DataFrame, value: Column) -> DataFrame:
    return conform(lines.withColumn("revenue_total_adjusted", value.cast(REVENUE)), REVENUE_ROW)


def platform_fee_mart(fee_lines: DataFrame, fee_counts: DataFrame, specific: DataFrame) -> DataFrame:
    """Fee rows: nothing left when transactions carry the fee, else the fee plus each specific discount.

    Several specific discounts in a month give several rows; without any the adjusted revenue is NULL.
    """
    joined = fee_lines.join(fee_counts, GROUP, "left").join(specific, GROUP, "left")
    return _adjusted(
        joined, F.when(_has_transactions(), F.lit(0)).otherwise(F.col("revenue") + F.col("total_discount"))
    )


def discount_mart(discount_lines: DataFrame, fee_counts: DataFrame) -> DataFrame:
    joined = discount_lines.join(fee_counts, GROUP, "left")
    return _adjusted(joined, F.when(_has_transactions(), F.lit(0)).otherwise(F.col("revenue")))


def true_up_mart(true_up_lines: DataFrame) -> DataFrame:
    return conform(true_up_lines, REVENUE_ROW)
