"""Monthly summaries of calculated and invoiced revenue, and their reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.columns import month_of
from .invoice_rules import phase_in_force

SUMMARY_COLUMNS = [
    "sequence_customer_id", "group_id", "product_name", "pricing_type", "tier_application_basis", "transaction_month",
    "currency", "calculated_revenue", "tier_application_value",
]


def product_summary(calculated: DataFrame) -> DataFrame:
    """Highest running revenue per customer, product and month, with the amount or count its tier is applied to."""
    keys = SUMMARY_COLUMNS[:7]
    return calculated.groupBy(*keys).agg(
        F.max("accumulated_revenue").alias("calculated_revenue"),
        F.max("accumulated_amount").alias("_amount"),
        F.max("transaction_count").cast("decimal(28,2)").alias("_count"),
    ).withColumn(
        "tier_application_value",
        F.when(F.col("tier_application_basis") == "amount", F.col("_amount")).otherwise(F.col("_count")),
    ).select(*SUMMARY_COLUMNS)


_SAAS_GROUP = ["sequence_customer_id", "group_id", "pricing_type"]


def _saas_rows(calculated: DataFrame) -> DataFrame:
    return calculated.filter("is_saas_transaction")


def _monthly_saas_counts(calculated: DataFrame) -> DataFrame:
    return _saas_rows(calculated).groupBy(*_SAAS_GROUP, "transaction_month").agg(
        F.max("transaction_count").alias("transaction_count")
    )


def saas_group_months(calculated: DataFrame) -> DataFrame:
    """Highest transaction count per minimum-consuming group, for every month that occurs (NULL where it has none).

    The months are one short array, so completing them is an explode and no join of two tables.
    """
    groups = _saas_rows(calculated).select(*_SAAS_GROUP, "minimum_revenue").distinct()
    months = calculated.agg(F.collect_set("transaction_month")).scalar()
    complete = groups.withColumn("_months", months).withColumn("transaction_month", F.explode("_months"))
    return complete.join(_monthly_saas_counts(calculated), [*_SAAS_GROUP, "transaction_month"], "left").select(
        "sequence_customer_id", "group_id", F.lit("true up charge").alias("product_name"), "pricing_type",
        F.lit("amount").alias("tier_application_basis"), "transaction_month", "minimum_revenue", "transaction_count",
    )


def remaining_minimum_summary(calculated: DataFrame) -> DataFrame:
    """Least minimum left per customer, group and month: what a true-up would charge.

    Several transaction counts in a customer-month (one per pricing type) give several equal rows. Only months with
    transactions appear, so the empty months of `saas_group_months` need not be built here; both sides are summed up
    before they are joined.
    """
    counts = (
        _monthly_saas_counts(calculated)
        # a group without id or pricing type never finds its own rows again
        .filter("transaction_count > 0 and group_id is not null and pricing_type is not null")
        .select("sequence_customer_id", "transaction_month", "transaction_count").distinct()
    )
    least = (
        calculated.filter(~F.col("product_name").ilike("%discount%"))
        .groupBy("sequence_customer_id", "group_id", "transaction_month", "currency")
        .agg(F.min("remaining_minimum_amount").alias("calculated_revenue"))
    )
    return least.join(counts, ["sequence_customer_id", "transaction_month"]).select(
        "sequence_customer_id", "group_id", F.lit("true up charge").alias("product_name"),
        F.lit(None).cast("string").alias("pricing_type"), F.lit("amount").alias("tier_application_basis"),
        "transaction_month", "currency", F.col("calculated_revenue").cast("decimal(38,8)").alias("calculated_revenue"),
        F.lit(1).cast("decimal(28,2)").alias("tier_application_value"),
    )


def calculated_summary(calculated: DataFrame) -> DataFrame:
    return product_summary(calculated).unionByName(remaining_minimum_summary(calculated))


def _normal_name(column: str):
    name = F.lower(column)
    return F.when(name == "new discount", "discount").otherwise(name)


def invoiced_summary(sources: dict[str, DataFrame]) -> DataFrame:
    """Invoiced totals per customer, product and month, from the latest version of each line that is not voided."""
    invoice = sources["invoices"].filter("status <> 'VOIDED'").alias("invoice")
    line = sources["invoice_line_items"].alias("line")
    customer = sources["customers"].alias("customer")
    price = sources["prices"].alias("price")
    phase = sources["billing_schedule_phase_prices"].alias("phase")
    lines = (
        invoice.join(line, F.col("line.invoice_id") == F.col("invoice.id"), "left")
        .join(customer, F.col("invoice.customer_id") == F.col("customer.id"), "left")
        .join(price, F.col("line.price_id") == F.col("price.id"), "left")
        .join(
            phase,
            (F.col("line.price_id") == F.col("phase.price_id"))
            & (F.col("line.billing_schedule_id") == F.col("phase.billing_schedule_id"))
            & phase_in_force("invoice.billing_period_start"),
            "left",
        )
        .filter(F.col("phase.phase_archived_at").isNull() & F.col("line.deleted_at").isNull())
    ).select(
        F.col("customer.id").alias("customer_id"), "customer.legal_name", "line.title", "price.product_name",
        "invoice.billing_period_start", "invoice.calculated_at", F.col("line.id").alias("line_id"),
        F.round("line.net_total").alias("net_total"), "line.quantity",
    )
    # titles and products are told apart as written, before they are normalized
    newest = Window.partitionBy("customer_id", "billing_period_start", "title", "product_name").orderBy(
        F.col("calculated_at").desc_nulls_first(), F.col("line_id").asc_nulls_last()
    )
    latest = lines.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1")
    named = latest.withColumns({"title": _normal_name("title"), "product_name": _normal_name("product_name")})
    return named.groupBy(
        "legal_name", "customer_id",
        F.when(F.col("title").ilike("%discount%"), "discount")
        .otherwise(F.coalesce("product_name", "title")).alias("product_name"),
        month_of("billing_period_start").alias("transaction_month"),
    ).agg(F.sum("net_total").alias("net_total"), F.sum("quantity").alias("tier_application_value"))


def reconciliation(calculated: DataFrame, invoiced: DataFrame) -> DataFrame:
    """Calculated beside invoiced revenue per customer, product and month, with the symmetric percent difference."""
    b = calculated.withColumn(
        "_product",
        F.when(F.col("product_name").like("%Discount%"), "discount").otherwise(F.lower("product_name")),
    ).alias("b")
    s = invoiced.withColumn("_product", F.lower("product_name")).alias("s")
    joined = b.join(
        s,
        (F.col("b.sequence_customer_id") == F.col("s.customer_id"))
        & (F.col("b._product") == F.col("s._product"))
        & (F.col("b.transaction_month") == F.col("s.transaction_month")),
        "full",
    )
    zero = F.lit(0).cast("decimal(18,0)")
    calculated_revenue = F.coalesce("b.calculated_revenue", zero)
    net_total = F.coalesce("s.net_total", zero)
    rows = joined.select(
        F.col("s.legal_name").alias("group_name"), "b.group_id", "b.sequence_customer_id",
        F.col("b.product_name").alias("calculated_product_name"),
        F.col("s.product_name").alias("sequence_product_name"),
        F.col("s.transaction_month").alias("billing_period"), "b.currency", "b.pricing_type",
        F.when(F.col("b.tier_application_basis").isNull(), F.col("b.pricing_type"))
        .otherwise(F.upper("b.tier_application_basis")).alias("tier_application_basis"),
        F.round("b.tier_application_value", 0).alias("calculated_tier_application_value"),
        F.round("s.tier_application_value", 0).alias("sequence_tier_application_value"),
        F.round(calculated_revenue, 0).cast("decimal(18,0)").alias("calculated_revenue_"),
        F.round(net_total, 0).cast("decimal(18,0)").alias("sequence_revenue_"),
        F.round(calculated_revenue - net_total, 0).cast("decimal(18,0)").alias("_difference"),
    )
    c, i = F.col("calculated_revenue_"), F.col("sequence_revenue_")
    percent = F.round((c - i) * 200 / F.nullif(c + i, zero), 2)
    return rows.withColumn(
        "relative_percentage_difference", F.coalesce(percent, zero).cast("decimal(18,2)")
    )


def reconciliation_report(rows: DataFrame) -> DataFrame:
    """The reconciliation in reading order."""
    return rows.orderBy(*[
        F.col(c).asc_nulls_last() for c in ("group_name", "billing_period", "calculated_product_name", "_difference")
    ])
