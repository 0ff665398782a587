"""Pricing rules in force per client and month, taken from the latest invoice lines."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import month_of, valid_json
from ..functions.storage import dealt, merged
from ..sources.feeds import billing_window, instant, on_days

OPEN_END = dt.date(2099, 1, 1)


def phase_in_force(period_start: str) -> Column:
    """The price phase is active or completed (or has no status) and covers the start of the billing period."""
    start = F.col(period_start)
    return (
        (F.col("phase.status").isin("ACTIVE", "COMPLETED") | F.col("phase.status").isNull())
        & (start >= F.col("phase.phase_start_date").cast("timestamp_ntz"))
        & (start <= F.coalesce(F.col("phase.phase_end_date").cast("timestamp_ntz"), instant(OPEN_END)))
    )


def priced_lines(sources: dict[str, DataFrame], as_of: dt.date) -> DataFrame:
    """Every invoice line of the window with its price and the price phase in force."""
    first, last = billing_window(as_of)
    invoice = sources["invoices"].filter(on_days("billing_period_start", first, last)).alias("invoice")
    line = sources["invoice_line_items"].alias("line")
    price = sources["prices"].alias("price")
    phase = sources["billing_schedule_phase_prices"].alias("phase")
    joined = (
        invoice.join(merged(line), F.col("invoice.id") == F.col("line.invoice_id"), "left")
        .join(merged(price), F.col("line.price_id") == F.col("price.id"), "left")
        .join(
            merged(phase),
            (F.col("price.id") == F.col("phase.price_id")) & phase_in_force("invoice.billing_period_start"),
            "left",
        )
        # after the joins on purpose: a line whose only phase is archived disappears
        .filter(F.col("line.deleted_at").isNull() & F.col("phase.phase_archived_at").isNull())
    )
    # a NULL title is no discount
    is_discount = F.coalesce(F.col("line.title") == "Discount", F.lit(False))
    zero = F.lit(0).cast("decimal(18,2)")
    return joined.select(
        F.col("invoice.customer_id").alias("sequence_customer_id"),
        F.col("line.id").alias("invoice_line_item_id"),
        F.col("price.id").alias("price_id"),
        F.col("phase.status").alias("status"),
        F.col("phase.price_minimum_amount").alias("price_minimum_amount"),
        F.col("phase.price_minimum_amount").isNotNull().alias("consumes_saas"),
        F.col("phase.price_structure").alias("price_structure"),
        month_of("invoice.billing_period_start").alias("billing_month"),
        F.col("line.modified_at").alias("modified_at"),
        is_discount.alias("is_discount"),
        F.when(is_discount, F.col("line.net_total")).otherwise(zero).alias("discount_amount"),
        F.coalesce("price.product_name", "line.title").alias("product_name"),
        F.col("line.title").alias("title"),
        F.col("line.currency").alias("currency"),
        F.col("line.net_total").alias("net_total"),
        F.col("line.gross_total").alias("gross_total"),
        F.col("line.calculated_at").alias("calculated_at"),
        F.to_date("line.billing_period_start").alias("month"),
        month_of("invoice.billing_period_start").alias("price_structure_month"),
        F.col("invoice.billing_period_start").alias("_period_start"),
        F.col("invoice.calculated_at").alias("_invoice_calculated_at"),
    )


def latest_lines(lines: DataFrame) -> DataFrame:
    """The line of the last calculated invoice per customer, period, discount flag and product.

    A missing time counts as latest. Period and calculation are the invoice's; a line may be billed for another period.
    """
    lines = dealt(lines, "sequence_customer_id")
    newest = Window.partitionBy("sequence_customer_id", "_period_start", "is_discount", "product_name").orderBy(
        F.col("_invoice_calculated_at").desc_nulls_first(),
        F.col("modified_at").desc_nulls_first(),
        # the rest only makes the choice repeatable
        F.col("invoice_line_item_id").asc_nulls_last(),
        F.col("price_structure").asc_nulls_last(),
        F.col("price_minimum_amount").asc_nulls_last(),
        F.col("status").asc_nulls_last(),
    )
    return lines.withColumn("rn", F.row_number().over(newest)).filter("rn = 1").drop("_period_start", "_invoice_calculated_at")


def _one_each(table: DataFrame, key: str) -> DataFrame:
    """One row per key, the smallest by its other columns, so that joining the table never multiplies lines."""
    others = [c for c in table.columns if c != key]
    ranked = [x for c in others for x in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))]
    return table.groupBy(key).agg(F.min(F.struct(*ranked)).alias("least")).select(key, *[f"least.{c}" for c in others])


def described(lines: DataFrame, sources: dict[str, DataFrame]) -> DataFrame:
    """The lines with their metric, their customer and its group; a customer, metric or group that is not there leaves NULL."""
    metric = _one_each(sources["usage_metrics"].select("id", "name", "property_filters", "properties_to_negate"), "id").alias("metric")
    customer = _one_each(sources["customers"].select("id", "legal_name", "customer_aliases"), "id").alias("customer")
    sales = _one_each(sources["sales_customers"].select("sequence_id", "group_id"), "sequence_id").alias("sales")
    owner = F.col("line.sequence_customer_id")
    joined = (
        lines.alias("line")
        .join(metric, F.col("metric.id") == F.get_json_object("line.price_structure", "$.usageMetricId"), "left")
        .join(merged(customer), owner == F.col("customer.id"), "left")
        # by the line's own customer, so that the lines stay as they are dealt; a group without a customer is not known
        .join(merged(sales), (owner == F.col("sales.sequence_id")) & F.col("customer.id").isNotNull(), "left")
    )
    return joined.select(
        "line.sequence_customer_id",
        F.col("customer.customer_aliases").alias("raw_client_id"),
        F.col("customer.legal_name").alias("sequence_client_name"),
        "line.invoice_line_item_id", "line.price_id", "sales.group_id", "line.status", "line.price_minimum_amount",
        "line.consumes_saas", "line.price_structure",
        F.col("metric.name").alias("usage_metric"),
        "metric.property_filters", "metric.properties_to_negate",
        *[f"line.{c}" for c in lines.columns[lines.columns.index("billing_month"):]],
    )


def rule_lines(sources: dict[str, DataFrame], as_of: dt.date) -> DataFrame:
    """The latest invoice lines with their checked JSON, before they are repeated per client.

    Lines are ranked when they have their price; only the latest ones meet metrics, customers and groups.
    """
    return described(latest_lines(priced_lines(sources, as_of)), sources).withColumns({
        "property_filters_json": valid_json("property_filters"),
        "price_structure_json": valid_json("price_structure"),
    })


def per_client(lines: DataFrame) -> DataFrame:
    """One row per client alias; customers without aliases drop out."""
    return lines.select(F.explode(F.array_distinct(F.split("raw_client_id", ","))).alias("client_id"), "*")


def invoice_rules(sources: dict[str, DataFrame], as_of: dt.date) -> DataFrame:
    """The pricing rules in force: one row per client and latest invoice line."""
    return per_client(rule_lines(sources, as_of))
