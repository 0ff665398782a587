"""Testing every movement against the usage rules of its client and month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import all_of, any_of, array_lists, month_of, pricing, row_key
from ..functions.storage import dealt, merged
from ..sources.schemas import PROPERTIES, RULE_ROW, conform
from .invoice_rules import per_client

NON_USAGE_PRODUCTS = ["DISCOUNT", "PLATFORM FEE", "TRUE UP CHARGE"]

MERGE_KEY = ["mm_id", "sequence_customer_id", "matched_product_name", "local_created_at", "amount"]


def hashed(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of rows that were kept without their `hash_match`, which is made anew where it is read."""
    return rows.withColumn("hash_match", row_key(*MERGE_KEY)).select(*columns)


def compile_rules(lines: DataFrame, *, clients: bool = True) -> DataFrame:
    """The distinct usage rules with their filter lists and negation flags.

    Takes rules per client or, better, the invoice lines before that step: JSON is then parsed once per contract line
    and the result repeated per client; without `clients` it stays one row per contract line with the `raw_client_id`
    list, for `match_rules`. Filter lists are kept as one upper-case text per property, because a
    movement's value only has to occur somewhere in that text.
    """
    client = "client_id" if "client_id" in lines.columns else "raw_client_id"
    rules = dealt(lines, "sequence_customer_id").filter(
        F.col("price_structure_json").isNotNull() & ~F.upper("product_name").isin(NON_USAGE_PRODUCTS)
    ).select(
        client, "sequence_customer_id", "group_id", "product_name", "price_structure_json",
        "price_minimum_amount", "consumes_saas", "property_filters_json",
        F.array_join(F.from_json("properties_to_negate", "array<string>"), ",").alias("properties_to_negate_str"),
        "price_structure_month", "currency",
    ).distinct()
    compiled = rules.withColumns({
        "_lists": array_lists("property_filters_json"), "pricing": pricing("price_structure_json"),
    }).withColumns({
        **{f"{p}_filters": F.upper(F.array_join(F.col("_lists")[p], ",")) for p in PROPERTIES},
        **{f"negate_{p}": F.contains("properties_to_negate_str", F.lit(p)) for p in PROPERTIES},
    }).drop("_lists")
    return compiled if client == "client_id" or not clients else per_client(compiled).drop(client)


def _matches(prop: str) -> Column:
    return F.contains(F.col(f"r.{prop}_filters"), F.upper(F.col(f"m.{prop}")))


def _charged() -> Column:
    """Whether a pair is charged. NULLs are meant to spread: an undecided pair is not charged."""
    positive = all_of([
        F.when(F.col(f"r.negate_{p}"), F.lit(True)).otherwise(F.col(f"r.{p}_filters").isNull() | _matches(p))
        for p in PROPERTIES
    ])
    negative = any_of([F.col(f"r.negate_{p}") & _matches(p) for p in PROPERTIES])
    negates = F.col("r.properties_to_negate_str").isNotNull()
    return F.coalesce(positive & (~negates | ~negative), F.lit(False))


def _reason() -> Column:
    parts = []
    for p in PROPERTIES:
        negate = F.col(f"r.negate_{p}")
        parts.append(F.when(_matches(p) & ~negate, F.lit(p.upper())))
        parts.append(F.when(~_matches(p) & negate, F.lit("NOT_" + p.upper())))
    return F.concat_ws(", ", *parts)


def match_rules(
    movements: DataFrame, rules: DataFrame, *, charged_only: bool = False, with_reason: bool = False
) -> DataFrame:
    """Rule rows for every movement and rule of the same client and month, charged or not.

    Rules come per client or, better, per contract line with the list of its clients: then the movements find these
    lists first, by short rows, and the wide rules are never repeated per client. `charged_only` drops the uncharged
    pairs inside the join. Rules are not broadcast, and Spark splits hot clients in the sort-merge join.
    """
    columns, owner = movements.columns, "client_id"
    if owner not in rules.columns:
        owner = "raw_client_id"
        lists = per_client(rules.select(owner, "price_structure_month").distinct())
        movements = movements.alias("m").join(
            merged(lists.alias("l")),
            (F.col("m.client_id") == F.col("l.client_id")) & (F.col("m.event_month") == F.col("l.price_structure_month")),
        ).select("m.*", F.col(f"l.{owner}").alias(f"_{owner}"))
    key = owner if owner == "client_id" else f"_{owner}"
    pairs = movements.alias("m").join(
        merged(rules.alias("r")),
        (F.col(f"m.{key}") == F.col(f"r.{owner}")) & (F.col("m.event_month") == F.col("r.price_structure_month")),
    ).select(
        *[f"m.{c}" for c in columns], "r.sequence_customer_id", "r.group_id",
        F.col("r.product_name").alias("matched_product_name"),
        "r.price_structure_json", "r.price_minimum_amount", "r.consumes_saas", "r.property_filters_json",
        F.col("r.properties_to_negate_str").alias("properties_to_negate"), "r.currency", "r.pricing",
        _charged().alias("should_be_charged"),
        *([_reason().alias("match_reason")] if with_reason else []),
    )
    if charged_only:
        pairs = pairs.filter("should_be_charged")
    pairs = pairs.withColumns({
        "transaction_month": month_of("local_created_at"),
        "local_updated_at": F.col("updated_at"),
        "hash_match": row_key(*MERGE_KEY),
    })
    return conform(pairs, RULE_ROW, "pricing", *(["match_reason"] if with_reason else []))
