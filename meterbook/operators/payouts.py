"""Classifying raw money movements as payouts, and one client's latest invoice structure."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import month_of
from ..sources.feeds import instant, on_days

# Institution codes and the banks they stand for ("9999" is the billing house itself).
BANKS = {
    "1001": "BANCO DE BOGOTA",
    "1007": "BANCOLOMBIA",
    "1013": "BBVA COLOMBIA",
    "1019": "SCOTIABANK COLPATRIA S.A",
    "1023": "BANCO DE OCCIDENTE",
    "1051": "BANCO DAVIVIENDA SA",
    "1066": "BANCO COOPERATIVO COOPCENTRAL",
    "1507": "NEQUI",
}
HOUSE_CODE = "9999"

# Pairs of source and destination institutions whose transfers are immediate.
FAST_PAIRS = {"1023": ["1001", "1002", "1052"], "1007": ["1507"], "1051": ["1551"]}

# Movement types and final states that are billed.
PAYOUT_TYPES = ["payout", "ach", "fast_pay", "spei", "spei_card"]
FINAL_STATES = ["finished", "completed"]

ZONES = {"col": "America/Bogota", "mex": "America/Mexico_City"}
COUNTRIES = {"col": "COLOMBIA", "mex": "MEXICO"}


def _lookup(column: str, values: dict[str, str], default: str) -> Column:
    result = F.lit(default)
    for key, value in values.items():
        result = F.when(F.col(column) == key, value).otherwise(result)
    return result


def local_day(timestamp: str) -> Column:
    """The calendar day of a UTC time in the time zone of the movement's country."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), _lookup("source_geography", ZONES, "UTC"), F.col(timestamp)))


def _transfer_method() -> Column:
    source, destination = F.col("source_account_institution_code"), F.col("destination_account_institution_code")
    fast = source == destination
    for code, partners in FAST_PAIRS.items():
        fast = fast | ((source == code) & destination.isin(partners))
    kind = F.col("type")
    return (
        F.when(
            kind == "payout",
            F.when(destination.isNull() | source.isNull(), "UNKNOWN").when(fast, "FAST_PAY").otherwise("ACH"),
        )
        .when(kind.isin("spei", "spei_card"), "SPEI").when(kind == "fast_pay", "FAST_PAY").when(kind == "ach", "ACH")
        .otherwise("UNKNOWN")
    )


def classify_payouts(
    movements: DataFrame, month: dt.date, client_id: str | None = None, house: str = "HOUSE",
    excluded_clients: list[str] = (),
) -> DataFrame:
    """Billable payouts of one local month with their derived properties; of all clients unless one is given.

    `house` is the name of the company that bills: accounts at providers carrying it are its own balances.
    An underlying institution without a known code is UNKNOWN, so the supplier's code is never consulted.
    """
    day = local_day("created_at")
    kind = F.col("type")
    named = F.upper("source_account_institution_name")
    own = F.lower("source_account_provider_id").contains(house.lower())
    bank = _lookup("underlying_institution", {**BANKS, HOUSE_CODE: house}, "UNKNOWN")
    kept = movements.filter(
        # the local month lies within a day of the same UTC month: a plain range that prunes row groups first
        on_days("created_at", month - dt.timedelta(days=1), month + dt.timedelta(days=32))
        & (month_of(day) == F.lit(month))
        & kind.isin(PAYOUT_TYPES) & F.col("status_state").isin(FINAL_STATES)
    )
    if excluded_clients:
        kept = kept.filter(~F.col("client_id").isin(list(excluded_clients)))
    if client_id is not None:
        kept = kept.filter(F.col("client_id") == client_id)
    return kept.select(
        "amount", F.col("id").alias("mm_id"), "client_id", F.lit(f"{house} BILLING").alias("eventtype"),
        day.alias("eventtimestamp"), F.lit("PAYOUT").alias("flow"), F.upper("type").alias("transaction_type"),
        F.when(F.col("origin_channel") == "api", "API").when(F.col("origin_channel").isNotNull(), "PORTAL")
        .otherwise("OTHER").alias("origination_system"),
        F.when(own, f"{house} BALANCE").otherwise("CONNECT").alias("source_account_type"),
        _transfer_method().alias("transfer_method"),
        F.coalesce(F.upper("destination_account_institution_name"), F.lit("UNKNOWN")).alias("destination_bank"),
        F.coalesce(
            F.when(kind.isin("payout", "spei", "spei_card"), named).when(kind.isin("fast_pay", "ach"), bank),
            F.lit("UNKNOWN"),
        ).alias("origin_bank"),
        _lookup("source_geography", COUNTRIES, "OTHER").alias("country"),
    )


def client_invoice_structure(
    sources: dict[str, DataFrame], client_id: str, period_start: dt.date, period_end: dt.date
) -> DataFrame:
    """The priced lines of one client's invoice for a billing period, in their latest calculation."""
    has_client = F.array_contains(F.split("customer_aliases", ","), client_id)
    invoice = (
        sources["invoices"]
        .filter(on_days("billing_period_start", period_start, period_start) & on_days("billing_period_end", period_end, period_end))
        .join(sources["customers"].filter(has_client).select(F.col("id").alias("customer_id")), "customer_id", "left_semi")
        .select(F.col("id").alias("invoice_id"))
    )
    line = sources["invoice_line_items"].join(invoice, "invoice_id").alias("line")
    price = sources["prices"].alias("price")
    phase = sources["billing_schedule_phase_prices"].filter("status = 'ACTIVE' and phase_archived_at is null").alias("phase")
    metric = sources["usage_metrics"].alias("metric")
    latest = Window.partitionBy("line.invoice_id").orderBy(F.col("line.calculated_at").desc_nulls_first())
    # a customer may have several invoices in the period: one customer's lines, so ranking them is a small job
    newest = line.withColumn("_rank", F.dense_rank().over(latest)).filter("_rank = 1").drop("_rank").alias("line")
    lines = (
        newest.join(price, F.col("line.price_id") == F.col("price.id"), "left")
        .join(phase, F.col("price.id") == F.col("phase.price_id"), "left")
        .join(metric, F.col("metric.id") == F.get_json_object("phase.price_structure", "$.usageMetricId"), "left")
        .select(
            F.to_date("line.billing_period_start").alias("month"), "line.invoice_id", "line.title", "price.product_name",
            F.col("metric.name").alias("usage_metric"), "phase.price_minimum_amount",
            F.col("phase.price_minimum_amount").isNotNull().alias("consumes_saas"), "line.quantity", "line.rate",
            "metric.property_filters", "phase.price_structure", "line.currency", "line.net_total", "line.gross_total",
            "line.calculated_at",
        )
    )
    # latest over all invoices, a missing time first: one aggregate instead of a window without partitions
    newest_time = newest.agg(
        F.when(F.count(F.lit(1)) == F.count("calculated_at"), F.max("calculated_at")).alias("t")
    ).scalar()
    return lines.withColumn("_t", newest_time).filter(F.col("calculated_at").eqNullSafe(F.col("_t"))).drop("_t").withColumn(
        "date_numing", F.lit(1)
    )
