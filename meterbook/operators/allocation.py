"""Spreading the platform fee and the unused minimum over the rated transactions; the union of all revenue."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.schemas import LINE_PRICE, REVENUE, REVENUE_ROW, conform
from .line_revenue import GROUP
from .matching import NON_USAGE_PRODUCTS

#: Customer-months that are sent to all executors, by estimate 250 MB; more of them are joined by a shuffle.
BROADCAST_ROWS = 2_000_000


def month_shares(rated: DataFrame) -> DataFrame:
    """Per customer and month: how many transactions share the fee and the minimum, and the least minimum left.

    Copies of one match count once: rating has marked the first of them. So this is one grouping whose sums are formed
    before the shuffle.
    """
    usage = ~F.upper("matched_product_name").isin(NON_USAGE_PRODUCTS)
    return rated.groupBy(*GROUP).agg(
        F.count_if(usage & F.col("first_copy")).alias("trx_receiving_platform_fee"),
        F.count_if(usage & F.col("first_saas_copy")).alias("saas_trx_receiving_remaining_min"),
        F.min("remaining_minimum").alias("least_remaining_minimum"),
    )


def fee_share_counts(shares: DataFrame) -> DataFrame:
    """Transactions that share the platform fee."""
    return shares.filter("trx_receiving_platform_fee > 0").select(*GROUP, "trx_receiving_platform_fee")


def saas_share_counts(shares: DataFrame) -> DataFrame:
    """Transactions that share the unused minimum."""
    return shares.filter("saas_trx_receiving_remaining_min > 0").select(*GROUP, "saas_trx_receiving_remaining_min")


def _share(total: str, parts: str) -> Column:
    return (F.col(total).cast("decimal(20,8)") / F.col(parts).cast("decimal(12,0)")).cast(REVENUE)


def allocate(rated: DataFrame, fee_totals: DataFrame, shares: DataFrame) -> DataFrame:
    """Revenue rows of the rated transactions with their shares of the month's fee and unused minimum."""
    monthly = shares.join(fee_totals, GROUP, "left")
    few = shares.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    joined = rated.join(F.broadcast(monthly) if few else monthly, GROUP, "left")
    takes_part = ~F.upper("matched_product_name").isin("PLATFORM FEE", "DISCOUNT")
    nothing = F.lit(0).cast(REVENUE)
    fee = F.when(takes_part & (F.col("trx_receiving_platform_fee") > 0), _share("total_platform_fee", "trx_receiving_platform_fee"))
    minimum = F.when(
        takes_part & F.col("consumes_saas") & F.col("should_be_charged") & (F.col("saas_trx_receiving_remaining_min") > 0),
        _share("least_remaining_minimum", "saas_trx_receiving_remaining_min"),
    )
    linear = F.col("pricing_type") == "LINEAR"
    shared = joined.withColumns({
        "platform_fee_share": F.coalesce(fee, nothing),
        "remaining_minimum_saas_share": F.coalesce(minimum, nothing),
        "is_percentage": F.when(linear, F.col("linear_is_percentage")).otherwise(F.col("eff_tier_is_percentage")),
        "price_per_unit": F.when(linear, F.col("linear_price_per_unit")).otherwise(F.col("eff_tier_price")),
        "price_minimum_revenue": F.col("price_minimum_revenue").cast(LINE_PRICE),
    }).withColumn(
        "revenue_total_adjusted", F.col("revenue") + F.col("platform_fee_share") + F.col("remaining_minimum_saas_share")
    )
    return conform(shared, REVENUE_ROW)


# output name: revenue row column
CALCULATED = {
    "money_movement_id": "mm_id", "client_id": "client_id", "sequence_customer_id": "sequence_customer_id",
    "group_id": "group_id", "product_name": "matched_product_name", "transaction_flow": "flow",
    "transaction_type": "transaction_type", "local_created_at": "local_created_at",
    "transaction_month": "transaction_month", "transaction_count": "transaction_count", "amount": "amount",
    "minimum_revenue": "price_minimum_revenue", "pricing_type": "pricing_type", "is_saas_transaction": "consumes_saas",
    "is_charged": "should_be_charged", "revenue": "revenue", "accumulated_revenue": "cumulative_revenue",
    "accumulated_amount": "cumulative_amount", "saas_revenue_amount": "saas_revenue",
    "non_saas_revenue_amount": "not_saas_revenue", "revenue_type": "revenue_type",
    "local_updated_at": "local_updated_at", "currency": "currency", "remaining_minimum_amount": "remaining_minimum",
    "tier_application_basis": "tier_application_basis",
}


def revenue_calculated(*marts: DataFrame) -> DataFrame:
    """The revenue marts as one table under its public column names."""
    union = reduce(DataFrame.unionByName, [conform(m, REVENUE_ROW) for m in marts])
    return union.select(*[F.col(source).alias(name) for name, source in CALCULATED.items()])
