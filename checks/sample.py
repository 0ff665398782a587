"""Billing sources derived from order data, for tests and benchmarks.

Every order becomes one money movement of its customer, every fifteen customers form one billing customer, and each
billing customer gets the contract of `catalogue` with two invoice versions per month. All tables grow with the data.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from checks import catalogue
from meterbook.sources.schemas import SOURCES, conform

AS_OF = dt.date(1998, 4, 15)

_CUSTOMER_NO = f"cast((c_custkey - c_custkey % {catalogue.CLIENTS_PER_CUSTOMER}) / {catalogue.CLIENTS_PER_CUSTOMER} as bigint)"


def _each(df: DataFrame, names: list[str], rows: list[tuple]) -> DataFrame:
    """Repeat every row once per catalogue entry."""
    def literal(value) -> Column:
        return F.lit(value) if value is not None else F.lit(None).cast("string")

    entries = F.array(*[F.struct(*[literal(v).alias(n) for n, v in zip(names, row)]) for row in rows])
    return df.select("*", F.explode(entries).alias("_e")).select("*", "_e.*").drop("_e")


def _minutes(count: str, start: str) -> str:
    return f"timestampadd(MINUTE, cast({count} as int), {start})"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    return (
        orders.join(customer, F.expr("o_custkey = c_custkey"))
        .join(nation, F.expr("c_nationkey = n_nationkey"))
        .withColumn(
            "created",
            F.expr(_minutes("o_orderkey * 7919 % 172800", "timestamp_ntz'1997-12-20 00:00:00'")),
        )
    )


def _movements(orders: DataFrame) -> DataFrame:
    columns = {
        "id": "'mm_' || o_orderkey",
        "client_id": "'c' || o_custkey",
        "client_id_edit": "case when o_orderkey % 97 = 0 then 'c' || (o_custkey + 1) end",
        "total_amount": "cast(o_totalprice as decimal(18,2))",
        "utc_created_at": "created",
        "updated_at": _minutes("o_orderkey % 5 * 1440", "created"),
        "eventtype": "'BILLING'",
        "eventtimestamp": _minutes("o_orderkey % 48 * 60", "created"),
        "flow": "case substr(o_orderpriority, 1, 1) when '1' then 'PAYOUT' when '2' then 'PAYOUT'"
                " when '3' then 'RECHARGE' else 'PAYIN' end",
        "transaction_type": "case substr(o_orderpriority, 1, 1) when '1' then 'ACH' when '2' then 'FAST_PAY'"
                            " when '3' then 'BALANCE RECHARGE' when '4' then 'DAC_DEBIT' else 'PSE' end",
        "origination_system": "case o_orderkey % 3 when 0 then 'Api' when 1 then 'Portal' end",
        "source_account_type": "case when o_orderkey % 4 = 0 then 'CONNECT' else 'OWN BALANCE' end",
        "transfer_method": "case when substr(o_orderpriority, 1, 1) = '2' then 'FAST_PAY' else 'ACH' end",
        "destination_bank": "c_mktsegment",
        "origin_bank": "n_name",
        "country": "case n_regionkey when 0 then 'COLOMBIA' when 1 then 'MEXICO' when 2 then null else 'OTHER' end",
        "status": "case o_orderstatus when 'F' then 'FINISHED' when 'O' then 'COMPLETED' end",
    }
    return orders.select("o_orderpriority", *[F.expr(e).alias(n) for n, e in columns.items()])


def _money_movements(orders: DataFrame) -> DataFrame:
    columns = {
        "id": "'raw_' || o_orderkey",
        "client_id": "'c' || o_custkey",
        "type": "case when o_orderkey % 17 = 0 then 'refund' else case substr(o_orderpriority, 1, 1) when '1' then 'ach'"
                " when '2' then 'fast_pay' when '3' then 'payout' when '4' then 'spei' else 'spei_card' end end",
        "status_state": "case o_orderstatus when 'F' then 'finished' when 'O' then 'completed' else 'failed' end",
        "source_geography": "case n_regionkey when 0 then 'col' when 1 then 'mex' when 2 then 'usa' end",
        "origin_channel": "case o_orderkey % 3 when 0 then 'api' when 1 then 'portal' end",
        "supplier": "'sup_' || case o_orderkey % 4 when 0 then '1007' when 1 then '1051' when 2 then '9999' else '0000' end",
        "source_account_provider_id": "case o_orderkey % 4 when 0 then 'bank_x' when 1 then 'prov_HOUSE_1' when 3 then 'house' end",
        "source_account_institution_code": "case o_orderkey % 7 when 0 then '1023' when 1 then '1007' when 2 then '1051'"
                                           " when 3 then '1001' when 4 then null else '1013' end",
        "source_account_institution_name": "case when o_orderkey % 11 = 0 then null else lower(n_name) end",
        "destination_account_institution_code": "case o_orderkey % 5 when 0 then '1001' when 1 then '1507' when 2 then '1551'"
                                                " when 3 then '1013' end",
        "destination_account_institution_name": "case when o_orderkey % 13 = 0 then null else lower(c_mktsegment) end",
        "underlying_institution": "case o_orderkey % 8 when 0 then '1051' when 1 then '1066' when 2 then '1023'"
                                  " when 3 then '1001' when 4 then '9999' when 5 then '1019' when 6 then 'zzzz' end",
        "amount": "cast(o_totalprice as decimal(18,2))",
        "created_at": "created",
    }
    return orders.select(*[F.expr(e).alias(n) for n, e in columns.items()])


def sample_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All source tables, by name, derived from the order tables in `sf_dir`."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    clients = customer.select(F.expr(_CUSTOMER_NO).alias("no"), F.expr("'c' || c_custkey").alias("client"))
    # at most CLIENTS_PER_CUSTOMER aliases each
    contracts = clients.groupBy("no").agg(F.array_sort(F.collect_list("client")).alias("aliases"))

    customers = contracts.select(
        F.expr("'seq_' || no").alias("id"),
        F.expr("'Customer ' || no").alias("legal_name"),
        F.expr("case when no % 50 <> 49 then array_join(aliases, ',') end").alias("customer_aliases"),
    )
    sales_customers = contracts.filter("no % 11 <> 10").select(
        F.expr("'seq_' || no").alias("sequence_id"), F.expr("'grp_' || no % 7").alias("group_id")
    )

    lines = _each(contracts.select("no"), ["code", "pos", "title", "product", "net"], catalogue.LINES)
    prices = lines.filter("product is not null").select(
        F.expr("'pr_' || no || '_' || code").alias("id"), F.col("product").alias("product_name")
    )
    phases = _each(
        contracts.select("no"),
        ["code", "status", "start", "stop", "archived", "minimum", "structure"],
        catalogue.PHASES,
    ).select(
        F.expr("'pr_' || no || '_' || code").alias("price_id"),
        F.expr("'bs_' || no").alias("billing_schedule_id"),
        "status",
        F.expr("case when no % 5 <> 4 then cast(minimum as decimal(18,2)) * (1 + no % 3) end").alias("price_minimum_amount"),
        F.col("structure").alias("price_structure"),
        F.expr("cast(start as date)").alias("phase_start_date"),
        F.expr("cast(stop as date)").alias("phase_end_date"),
        F.expr("case when archived then timestamp_ntz'1998-01-10 00:00:00' end").alias("phase_archived_at"),
    )
    discount_phases = phases.filter("price_id like '%_priority'").withColumn(
        "price_id", F.expr("replace(price_id, '_priority', '_disc_bank')")
    )

    versions = _each(
        _each(contracts.select("no"), ["m", "first_day", "last_day"], catalogue.MONTHS), ["v"], [(1,), (2,)]
    ).withColumns({
        "invoice_id": F.expr("'inv_' || no || '_' || m || '_' || v"),
        "period_start": F.expr("cast(first_day as timestamp_ntz)"),
        "calculated": F.expr(
            "case when v = 2 and no % 10 = 3 then null else "
            + _minutes("(35 + v + no % 3) * 1440", "cast(first_day as timestamp_ntz)") + " end"
        ),
    })
    invoices = versions.select(
        F.col("invoice_id").alias("id"),
        F.expr("'seq_' || no").alias("customer_id"),
        F.col("period_start").alias("billing_period_start"),
        F.expr("cast(last_day as timestamp_ntz)").alias("billing_period_end"),
        F.col("calculated").alias("calculated_at"),
        F.expr("case when v = 1 and no % 8 = 5 then 'VOIDED' when v = 1 and no % 8 = 6 then null else 'FINAL' end").alias("status"),
    )
    items = _each(versions, ["code", "pos", "title", "product", "net"], catalogue.LINES).select(
        F.expr("invoice_id || '_' || code").alias("id"),
        "invoice_id",
        F.expr("case when product is not null then 'pr_' || no || '_' || code end").alias("price_id"),
        F.expr("'bs_' || no").alias("billing_schedule_id"),
        "title",
        F.expr("case when no % 2 = 0 then 'COP' else 'USD' end").alias("currency"),
        F.expr("cast(net as decimal(18,2)) + v * 10 + no % 4").alias("net_total"),
        F.expr("(cast(net as decimal(18,2)) + v * 10) * 2").alias("gross_total"),
        F.expr("m * 10 + pos").alias("quantity"),
        F.expr("cast(net as decimal(18,2)) / 10").alias("rate"),
        # some lines are calculated later than their invoice, and some are billed for the month before
        F.expr("case when pos % 3 = 2 then " + _minutes("2880", "calculated") + " else calculated end").alias("calculated_at"),
        F.expr("case when pos = 4 then null else " + _minutes("pos * 60", "calculated") + " end").alias("modified_at"),
        F.expr("case when v = 2 and (no + pos) % 13 = 0 then " + _minutes("0", "period_start") + " end").alias("deleted_at"),
        F.expr("case when pos % 4 = 3 and no % 3 = 1 then period_start - interval '1' month else period_start end").alias("billing_period_start"),
    )
    metrics = spark.createDataFrame(catalogue.METRICS, SOURCES["usage_metrics"])

    orders = _orders(spark, sf_dir)
    movements = _movements(orders)

    def feed(priorities: str) -> DataFrame:
        return movements.filter(f"substr(o_orderpriority, 1, 1) in ({priorities})")

    tables = {
        "invoices": invoices,
        "invoice_line_items": items,
        "prices": prices,
        "billing_schedule_phase_prices": phases.unionByName(discount_phases),
        "usage_metrics": metrics,
        "customers": customers,
        "sales_customers": sales_customers,
        "payout_transactions": feed("'1', '2'"),
        "payin_transactions": feed("'5'"),
        "dac_transactions": feed("'4'"),
        "balance_recharges": feed("'3'"),
        "money_movements": _money_movements(orders),
    }
    return {name: conform(df, SOURCES[name]) for name, df in tables.items()}
