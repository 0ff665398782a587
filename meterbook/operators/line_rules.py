"""Rules that come from invoice lines instead of movements: platform fee, discounts, true-up; and the union of all."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import month_of, pricing
from ..functions.columns import row_key
from ..sources.schemas import RULE_ROW, conform
from .invoice_rules import per_client
from .matching import MERGE_KEY


def _line_rows(lines: DataFrame, name: Column, structure: Column, *, client: bool = True) -> DataFrame:
    """Rule rows of invoice lines, which come per client or, better, before that step: JSON is then parsed once per
    line and the result repeated per client. Without `client` the rows do not say whose they are."""
    repeated = "client_id" not in lines.columns
    if repeated:
        lines = lines.filter(F.col("raw_client_id").isNotNull())
    rows = lines.select(
        F.lit(None).cast("string").alias("mm_id"),
        F.lit(None).cast("decimal(18,2)").alias("amount"),
        "raw_client_id" if repeated else "client_id",
        "sequence_customer_id", "group_id",
        F.col("month").cast("timestamp_ntz").alias("local_created_at"),
        name.alias("matched_product_name"),
        structure.alias("price_structure_json"),
        "price_minimum_amount", "consumes_saas",
        F.lit(True).alias("should_be_charged"),
        "currency", "property_filters_json",
        month_of("month").alias("transaction_month"),
        F.col("month").cast("timestamp_ntz").alias("local_updated_at"),
    )
    rows = rows.withColumns({"hash_match": row_key(*MERGE_KEY), "pricing": pricing("price_structure_json")})
    if repeated:
        rows = per_client(rows)
    return conform(rows if client else rows.drop("client_id"), RULE_ROW, "pricing")


def _net_total_as(pricing_type: str) -> Column:
    """The line's own structure, or one made of its net total (NULL without a net total)."""
    made = F.concat(
        F.lit('{"price":'), F.col("net_total").cast("string"), F.lit(f',"pricingType":"{pricing_type}"}}')
    )
    return F.coalesce("price_structure_json", made)


def platform_fee_rules(invoice_rules: DataFrame) -> DataFrame:
    """Fixed platform fees, charged whatever the usage."""
    lines = invoice_rules.filter(
        (F.upper("product_name") == "PLATFORM FEE")
        & (F.get_json_object("price_structure_json", "$.pricingType") == "FIXED")
    )
    return _line_rows(lines, F.col("product_name"), F.col("price_structure_json"))


def discount_rules(invoice_rules: DataFrame) -> DataFrame:
    """Discount lines, named `title||product`."""
    lines = invoice_rules.filter(F.upper("title").isin("DISCOUNT", "NEW DISCOUNT"))
    suffix = F.when(F.col("product_name").isNotNull(), F.concat(F.lit("||"), F.col("product_name"))).otherwise("")
    return _line_rows(lines, F.concat("title", suffix), _net_total_as("FIXED"))


def true_up_rules(invoice_rules: DataFrame) -> DataFrame:
    """All true-up lines; `unmatched_true_ups` keeps those that apply."""
    lines = invoice_rules.filter(F.upper("title") == "TRUE UP CHARGE")
    return _line_rows(lines, F.col("title"), _net_total_as("TRUE_UP_CHARGE"), client=False)


def saas_match_counts(matches: DataFrame) -> DataFrame:
    """Charged matches that consume the minimum, per customer and month."""
    return (
        matches.filter(F.col("consumes_saas") & F.col("should_be_charged"))
        .groupBy("sequence_customer_id", "transaction_month")
        .agg(F.count(F.lit(1)).alias("trx_count"))
    )


def unmatched_true_ups(true_ups: DataFrame, saas_counts: DataFrame) -> DataFrame:
    """True-up lines of the customer-months in which no charged match consumed the minimum."""
    return true_ups.join(
        saas_counts.select("sequence_customer_id", "transaction_month"),
        ["sequence_customer_id", "transaction_month"], "left_anti",
    ).select(*true_ups.columns)


def rules_of_lines(invoice_rules: DataFrame, matches: DataFrame) -> DataFrame:
    """The rule rows that come from lines: platform fees, true-ups that apply, discounts."""
    families = [
        platform_fee_rules(invoice_rules),
        unmatched_true_ups(true_up_rules(invoice_rules), saas_match_counts(matches)),
        discount_rules(invoice_rules),
    ]
    return reduce(DataFrame.unionByName, families)


def all_rules(invoice_rules: DataFrame, matches: DataFrame) -> DataFrame:
    """Every rule row: usage matches and those of lines. The matches are read twice, so they had better be stored."""
    return matches.unionByName(rules_of_lines(invoice_rules, matches))
