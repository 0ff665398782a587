"""One Spark query per operator, over the billing sources that `sample` derives from the whole order tables."""

from __future__ import annotations

import atexit
import datetime as dt
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from meterbook.functions.columns import array_lists, greatest_or_null, pricing, row_key, valid_json
from meterbook.functions.storage import dealt, shared_folder, stored
from meterbook.operators import (
    allocation, invoice_rules, line_revenue, line_rules, match_exact, matching, payouts, rating, summaries,
)
from meterbook.plans.upsert import publish_view, rewrite_months, upsert, write_table
from meterbook.sources import feeds
from checks.sample import AS_OF, sample_sources
from meterbook.sources.schemas import PRICE_STRUCTURE, PROPERTIES

CLIENT = "c20"
EXCLUDED = ["c3", "c5", "c8"]
CLIENT_MONTH = ["client_id", "month"]


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and times as text, so that both engines hand over comparable values."""
    def column(field: T.StructField):
        c = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return c.cast("double").alias(field.name)
        if isinstance(field.dataType, (T.DateType, T.TimestampNTZType, T.TimestampType)):
            return c.cast("string").alias(field.name)
        return c

    return df.select(*[column(f) for f in df.schema.fields])


def shared(spark: SparkSession) -> SparkSession:
    """The session; a local one that has no folder for stored tables gets a temporary one, removed at exit."""
    context = spark.sparkContext
    if not (spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()):
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="meterbook-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return spark


def unhashed(rows: DataFrame) -> DataFrame:
    """The rows, stored without the hash of their match: it would take up most of the room."""
    return matching.hashed(stored(rows.drop("hash_match"), "zstd"), rows.columns)


class StoredTables(Mapping):
    """Tables by name, each stored when it is first asked for."""

    def __init__(self, tables: dict[str, DataFrame]):
        self._tables, self._stored = tables, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._stored:
            self._stored[name] = stored(self._tables[name])
        return self._stored[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)


class Stages:
    """The steps of one data set. Those that the pipeline stores as tables are stored here too, once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = shared(spark), sf_dir

    @cached_property
    def sources(self) -> Mapping[str, DataFrame]:
        return StoredTables(sample_sources(self.spark, self.sf_dir))

    @cached_property
    def lines(self) -> DataFrame:
        return stored(invoice_rules.rule_lines(self.sources, AS_OF))

    @cached_property
    def rules(self) -> DataFrame:
        return invoice_rules.per_client(self.lines)

    @cached_property
    def movements(self) -> DataFrame:
        return feeds.movement_union(self.sources, AS_OF)

    @cached_property
    def compiled(self) -> DataFrame:
        return matching.compile_rules(self.lines)

    @cached_property
    def contracts(self) -> DataFrame:
        return matching.compile_rules(self.lines, clients=False)

    @cached_property
    def matches(self) -> DataFrame:
        return matching.match_rules(self.movements, self.contracts)

    @cached_property
    def all_rules(self) -> DataFrame:
        matches = unhashed(self.matches)  # matched once
        return matches.unionByName(unhashed(line_rules.rules_of_lines(self.lines, matches)))

    @cached_property
    def rated(self) -> DataFrame:
        return unhashed(rating.rate_transactions(self.all_rules))

    @cached_property
    def line_rows(self) -> DataFrame:
        return stored(line_revenue.line_rule_rows(self.all_rules))

    def base(self, kind: str) -> DataFrame:
        return line_revenue.fixed_line_revenue(self.line_rows, kind)

    @cached_property
    def fee_totals(self) -> DataFrame:
        return line_revenue.platform_fee_totals(self.base("fee"))

    @cached_property
    def shares(self) -> DataFrame:
        return stored(allocation.month_shares(self.rated))

    @cached_property
    def fee_counts(self) -> DataFrame:
        return allocation.fee_share_counts(self.shares)

    @cached_property
    def allocated(self) -> DataFrame:
        return allocation.allocate(self.rated, self.fee_totals, self.shares)

    @cached_property
    def fee_mart(self) -> DataFrame:
        specific = line_revenue.specific_discounts(self.base("discount"))
        return line_revenue.platform_fee_mart(self.base("fee"), self.fee_counts, specific)

    @cached_property
    def discount_mart(self) -> DataFrame:
        return line_revenue.discount_mart(self.base("discount"), self.fee_counts)

    @cached_property
    def true_up_mart(self) -> DataFrame:
        return line_revenue.true_up_mart(self.base("true_up"))

    @cached_property
    def revenue(self) -> DataFrame:
        return allocation.revenue_calculated(self.allocated, self.fee_mart, self.discount_mart, self.true_up_mart)

    @cached_property
    def calculated(self) -> DataFrame:
        return stored(self.revenue, "zstd")  # for those that read it more than once

    @cached_property
    def invoiced(self) -> DataFrame:
        return summaries.invoiced_summary(self.sources)

    @cached_property
    def exact_rules(self) -> DataFrame:
        return self.rules.select(
            *CLIENT_MONTH, "product_name", "price_structure", "price_minimum_amount", "consumes_saas", "property_filters"
        ).distinct()

    @cached_property
    def exact_movements(self) -> DataFrame:
        return self.movements.withColumnRenamed("event_month", "month")

    @cached_property
    def exact(self) -> DataFrame:
        return match_exact.match_exact(self.exact_movements, self.exact_rules, CLIENT_MONTH, PROPERTIES)

    @cached_property
    def summarized(self) -> dict[str, DataFrame]:
        return match_exact.rate_and_summarize(self.exact_movements, self.exact_rules, CLIENT_MONTH, PROPERTIES)

    @cached_property
    def exact_rated(self) -> DataFrame:
        return self.summarized["rated"]

    @cached_property
    def orders(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/orders.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/events.parquet")


_stages: dict[tuple[str, str], Stages] = {}


def stages(spark: SparkSession, sf_dir: str) -> Stages:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stages:
        _stages[key] = Stages(spark, sf_dir)
    return _stages[key]


def feed_window_scan(s: Stages) -> DataFrame:
    parts = [feeds.feed_window(s.sources[f], AS_OF).withColumn("feed", F.lit(f)) for f in feeds.FEEDS]
    return reduce(DataFrame.unionByName, parts)


def read_sources(s: Stages) -> DataFrame:
    """What is in the columns of all sources, written to folders of their own and opened by name."""
    folder = f"{shared_folder(s.spark)}/sources-{uuid.uuid4().hex}"
    for name, df in s.sources.items():
        write_table(df, f"{folder}/{name}")
    return feeds.source_profile(feeds.read_sources(s.spark, {name: f"{folder}/{name}" for name in s.sources}))


def client_pull(s: Stages) -> DataFrame:
    parts = [
        feeds.client_pull(s.sources[f], CLIENT, dt.date(1998, 2, 1), dt.date(1998, 2, 28)) for f in feeds.FEEDS
    ]
    return reduce(DataFrame.unionByName, parts)


def match_reason(s: Stages) -> DataFrame:
    return matching.match_rules(s.movements, s.contracts, with_reason=True).select(
        "mm_id", "client_id", "matched_product_name", "should_be_charged", "match_reason"
    )


def tier_selection(s: Stages) -> DataFrame:
    return rating.tier_selection(s.all_rules).select(
        "mm_id", "client_id", "sequence_customer_id", "matched_product_name", "transaction_month", "transaction_count",
        "cumulative_amount", "pricing_type", "tier_price", "tier_fee", "tier_upper_bound", "tier_is_percentage",
    )


def volume_latest_tier(s: Stages) -> DataFrame:
    return rating.tier_selection(s.all_rules).filter("pricing_type = 'VOLUME'").select(
        "sequence_customer_id", "transaction_month", "matched_product_name", "eff_tier_price", "eff_tier_fee",
        "eff_tier_is_percentage", "tier_application_basis",
    ).distinct()


def rated_transactions(s: Stages) -> DataFrame:
    return s.rated.select(
        "mm_id", "client_id", "sequence_customer_id", "matched_product_name", "transaction_month", "transaction_count",
        "amount", "pricing_type", "eff_tier_price", "eff_tier_fee", "eff_tier_is_percentage", "tier_application_basis",
        "revenue", "cumulative_revenue", "cumulative_revenue_before",
    )


def saas_minimum_split(s: Stages) -> DataFrame:
    return s.rated.select(
        "mm_id", "client_id", "sequence_customer_id", "matched_product_name", "transaction_month",
        "global_transaction_order", "revenue", "cumulative_revenue_global", "cumulative_revenue_global_before",
        "cumulative_saas_revenue_global", "cumulative_saas_revenue_global_before", "price_minimum_revenue",
        "saas_revenue", "not_saas_revenue", "remaining_minimum", "revenue_type",
    )


def fixed_line_revenue(s: Stages) -> DataFrame:
    return reduce(DataFrame.unionByName, [s.base(kind) for kind in ("fee", "discount", "true_up")])


def exact_pairs(s: Stages) -> DataFrame:
    return s.exact.select("mm_id", *CLIENT_MONTH, F.posexplode_outer("matches").alias("pos", "m")).select(
        "mm_id", *CLIENT_MONTH, F.col("pos").cast("bigint").alias("pos"),
        *[f"m.{f}" for f in ("match", "price_structure", "price_minimum_amount", "consumes_saas")],
    )


def _details(s: Stages, kind: str) -> DataFrame:
    return s.exact_rated.select("mm_id", F.explode("details").alias("d")).select("mm_id", "d.*").filter(
        F.col("pricing_type") == kind
    )


def linear_detail(s: Stages) -> DataFrame:
    return _details(s, "LINEAR").drop("tier_selected", "fee", "transaction_count")


def volume_detail(s: Stages) -> DataFrame:
    return _details(s, "VOLUME")


def match_count_revenue(s: Stages) -> DataFrame:
    return s.exact_rated.select("mm_id", "client_id", "amount", F.size("details").cast("bigint").alias("priced_rules"), "revenue")


def flag_matches(s: Stages) -> DataFrame:
    config = {"flow": ["PAYIN", "RECHARGE"], "origination_system": ["Api"], "validation": ["x"]}
    return match_exact.flag_matches(s.exact_movements, config, "any_cash_in").select("mm_id", "client_id", "any_cash_in")


def upsert_incremental(s: Stages) -> DataFrame:
    """Stored rules of all months but the newest values, merged with the rules of the last three months."""
    columns = [*matching.MERGE_KEY, "transaction_month", "price_minimum_amount", "should_be_charged"]
    rows = dealt(s.all_rules.select(*columns), *matching.MERGE_KEY).distinct()  # dealt once, for this and for the merge
    stored = rows.withColumn("price_minimum_amount", F.lit(None).cast("decimal(18,2)"))
    recent = rows.filter(F.col("transaction_month") >= F.lit(feeds.merge_horizon(dt.date(1998, 5, 15))))
    return upsert(stored, recent, matching.MERGE_KEY, on_duplicate="keep")


def incremental_run(s: Stages) -> DataFrame:
    """A table by month after two runs of its writer: all months, then the last ones anew, of which April has nothing left."""
    columns = [*matching.MERGE_KEY, "transaction_month", "price_minimum_amount", "should_be_charged"]
    rows, path = s.all_rules.select(*columns).distinct(), f"{shared_folder(s.spark)}/incremental-{uuid.uuid4().hex}"
    rewrite_months(rows.withColumn("price_minimum_amount", F.lit(None).cast("decimal(18,2)")), path, [])
    first, last = feeds.merge_horizon(dt.date(1998, 5, 15)), dt.date(1998, 5, 15)
    recent = rows.filter((F.col("transaction_month") >= F.lit(first)) & (F.col("transaction_month") != F.lit(dt.date(1998, 4, 1))))
    return rewrite_months(recent, path, feeds.months_between(first, last))


def table_sink(s: Stages) -> DataFrame:
    """The latest invoice lines as another session reads them, where a table of other rows and columns was before."""
    path = f"{shared_folder(s.spark)}/lines-{uuid.uuid4().hex}"
    write_table(s.line_rows, path)
    write_table(s.lines, path)
    return s.spark.newSession().read.parquet(path).select(
        "sequence_customer_id", "invoice_line_item_id", "group_id", "product_name", "usage_metric", "price_minimum_amount",
        "net_total", "billing_month", "price_structure_json",
    )


def view_sink(s: Stages) -> DataFrame:
    """The rules per client as another session finds them under their name."""
    name = f"rules_{uuid.uuid4().hex}"
    publish_view(s.rules, name)
    return s.spark.newSession().table(f"global_temp.{name}")


def fn_date(s: Stages) -> DataFrame:
    day = F.to_date("o_orderdate")
    return s.orders.select(
        "o_orderkey", F.trunc("o_orderdate", "MM").alias("month"), day.alias("day"), F.last_day(day).alias("month_end"),
        F.add_months(day, -3).alias("three_months_back"),
        F.convert_timezone(F.lit("UTC"), F.when(F.col("o_orderkey") % 2 == 0, "America/Bogota").otherwise("America/Mexico_City"),
                           F.col("o_orderdate").cast("timestamp_ntz")).alias("local_time"),
    )


def fn_conditional(s: Stages) -> DataFrame:
    status, key = F.col("o_orderstatus"), F.col("o_orderkey")
    maybe = F.when(key % 3 == 0, F.col("o_custkey"))
    return s.orders.select(
        "o_orderkey",
        F.when(status == "F", "finished").otherwise("open").alias("iff"),
        F.when(key % 4 == 0, "a").when(key % 4 == 1, "b").alias("searched_case"),
        F.coalesce(maybe, F.lit(-1)).alias("coalesced"),
        F.nullif(key % 5, F.lit(0)).alias("null_if_zero"),
        key.between(10, 1000).alias("in_range"), status.isin("F", "O").alias("in_list"),
        ((maybe > 5) & (key % 2 == 0)).alias("three_valued_and"), ((maybe > 5) | (key % 2 == 0)).alias("three_valued_or"),
        (~(maybe > 5)).alias("three_valued_not"),
    ).withColumn("later_alias", F.concat("iff", F.lit("-"), F.coalesce("searched_case", F.lit("none"))))


def fn_numeric(s: Stages) -> DataFrame:
    price = F.col("o_totalprice").cast("decimal(18,2)")
    maybe = F.when(F.col("o_orderkey") % 3 == 0, price)
    return s.orders.select(
        "o_orderkey", greatest_or_null(maybe, F.lit(1000).cast("decimal(18,2)")).alias("greatest_or_null"),
        F.round(price, 0).alias("rounded"), F.round(price, 1).alias("rounded_one"), price.cast("decimal(10,2)").alias("number_10_2"),
        price.cast("string").cast("decimal(38,0)").alias("text_to_number"), F.col("o_orderkey").cast("string").alias("as_text"),
        (price * F.lit("0.0025").cast("decimal(10,4)")).alias("percent"), (price - maybe).alias("difference"), (-price).alias("negated"),
    )


def fn_string(s: Stages) -> DataFrame:
    priority = F.col("o_orderpriority")
    return s.orders.select(
        "o_orderkey", F.upper(F.lower(priority)).alias("upper"), F.lower(priority).alias("lower"),
        F.concat(priority, F.lit("||"), "o_orderstatus").alias("joined"), F.contains(priority, F.lit("E")).alias("contained"),
        F.size(F.split(priority, "-")).cast("bigint").alias("parts"),
        F.split_part(F.concat(priority, F.lit("||"), "o_orderstatus"), F.lit("||"), F.lit(2)).alias("second"),
        F.split_part(priority, F.lit("||"), F.lit(2)).alias("missing_part"), F.right(priority, F.lit(4)).alias("last_four"),
        F.lower(F.trim(F.concat(F.lit("  "), priority, F.lit(" ")))).alias("normal"),
        priority.like("%IGH%").alias("is_like"), priority.ilike("%urgent%").alias("is_ilike"), (~priority.ilike("%low%")).alias("not_ilike"),
    )


def fn_hash(s: Stages) -> DataFrame:
    maybe = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderstatus"))
    return s.orders.select(
        "o_orderkey", row_key("o_orderkey", maybe, "o_orderpriority").alias("row_hash"),
        row_key(maybe, F.lit("a")).alias("null_first"), row_key(F.lit("a"), maybe).alias("null_last"),
    )


def fn_json(s: Stages) -> DataFrame:
    listed = F.concat(F.lit('{"flow":["'), "event_type", F.lit('","b"],"status":"'), "event_type", F.lit('"}'))
    odd = F.col("event_id") % 2 == 1
    rows = s.events.select(
        "event_id", "event_type", "props", listed.alias("filters"),
        F.when(odd, F.lit("{broken")).otherwise(F.col("props")).alias("maybe"),
        F.when(odd, listed).alias("sometimes"),
    )
    return rows.select(
        "event_id", valid_json("maybe").alias("checked"),
        F.get_json_object("props", "$.k").cast("bigint").alias("path"),
        F.array_join(array_lists("filters")["flow"], ",").alias("array_text"),
        F.array_join(array_lists("filters")["status"], ",").alias("scalar_is_no_array"),
        F.array_join(array_lists("sometimes")["flow"], ",").alias("missing_json"),
        F.concat_ws(", ", F.when(odd, "ODD"), F.when(F.col("event_type") == "click", "CLICK")).alias("compact"),
        F.from_json(F.concat(F.lit('{"price":'), F.get_json_object("props", "$.k"), F.lit(',"pricingType":"FIXED"}')), PRICE_STRUCTURE)["price"]
            .cast("decimal(38,0)").alias("made_price"),
        pricing("props")["pricing_type"].alias("no_pricing"),
    )


_QUERIES: dict[str, Callable[[Stages], DataFrame]] = {
    "read_sources": read_sources,
    "feed_window_scan": feed_window_scan,
    "movement_union": lambda s: s.movements,
    "client_pull": client_pull,
    "invoice_rules": lambda s: s.rules,
    "compile_rules": lambda s: s.compiled.drop("pricing"),
    "match_rules": lambda s: s.matches.drop("pricing"),
    "match_reason": match_reason,
    "fee_rules": lambda s: line_rules.platform_fee_rules(s.rules).drop("pricing"),
    "discount_rules": lambda s: line_rules.discount_rules(s.rules).drop("pricing"),
    "true_up_rules": lambda s: line_rules.unmatched_true_ups(
        line_rules.true_up_rules(s.rules), line_rules.saas_match_counts(s.matches)).drop("pricing"),
    "saas_match_counts": lambda s: line_rules.saas_match_counts(s.matches),
    "all_rules": lambda s: s.all_rules.drop("pricing"),
    "running_counts_amounts": lambda s: rating.running_counts(s.all_rules),
    "tier_selection": tier_selection,
    "volume_latest_tier": volume_latest_tier,
    "rated_transactions": rated_transactions,
    "saas_minimum_split": saas_minimum_split,
    "fixed_line_revenue": fixed_line_revenue,
    "fee_totals": lambda s: s.fee_totals,
    "discount_general": lambda s: line_revenue.general_discounts(s.base("discount")),
    "discount_specific": lambda s: line_revenue.specific_discounts(s.base("discount")),
    "fee_share_counts": lambda s: s.fee_counts,
    "saas_share_counts": lambda s: allocation.saas_share_counts(s.shares),
    "revenue_allocated": lambda s: s.allocated,
    "fee_mart": lambda s: s.fee_mart,
    "discount_mart": lambda s: s.discount_mart,
    "true_up_mart": lambda s: s.true_up_mart,
    "revenue_calculated": lambda s: s.revenue,
    "product_summary": lambda s: summaries.product_summary(s.calculated),
    "saas_group_months": lambda s: summaries.saas_group_months(s.calculated),
    "remaining_minimum_summary": lambda s: summaries.remaining_minimum_summary(s.calculated),
    "calculated_summary": lambda s: summaries.calculated_summary(s.calculated),
    "invoiced_summary": lambda s: s.invoiced,
    "reconciliation": lambda s: summaries.reconciliation_report(
        summaries.reconciliation(summaries.calculated_summary(s.calculated), s.invoiced)),
    "match_exact": exact_pairs,
    "match_counts": lambda s: match_exact.match_counts(s.exact, CLIENT_MONTH),
    "linear_detail": linear_detail,
    "volume_detail": volume_detail,
    "match_count_revenue": match_count_revenue,
    "revenue_totals": lambda s: match_exact.revenue_totals(s.exact_rated),
    "match_revenue": lambda s: match_exact.match_revenue(s.exact_rated),
    "top_matches": lambda s: match_exact.top_matches(s.exact_rated),
    "match_stats": lambda s: match_exact.match_statistics(s.exact),
    "per_match_totals": lambda s: match_exact.match_totals(s.exact_rated),
    "rate_and_summarize": lambda s: s.summarized["summary"],
    "input_profile": lambda s: match_exact.input_profile(s.exact_movements, s.exact_rules),
    "flag_matches": flag_matches,
    "classify_payouts": lambda s: payouts.classify_payouts(
        s.sources["money_movements"], dt.date(1998, 2, 1), excluded_clients=EXCLUDED),
    "client_invoice_structure": lambda s: payouts.client_invoice_structure(
        s.sources, CLIENT, dt.date(1998, 2, 1), dt.date(1998, 2, 28)),
    "upsert_incremental": upsert_incremental,
    "incremental_run": incremental_run,
    "table_sink": table_sink,
    "view_sink": view_sink,
    "fn_date": fn_date,
    "fn_conditional": fn_conditional,
    "fn_numeric": fn_numeric,
    "fn_string": fn_string,
    "fn_hash": fn_hash,
    "fn_json": fn_json,
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each customer owes per product and month, after tiers and minimum."""
    return plain(summaries.product_summary(stages(spark, sf_dir).calculated))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(query):
        return lambda spark, sf_dir: plain(query(stages(spark, sf_dir)))

    return {name: bind(query) for name, query in _QUERIES.items()}
