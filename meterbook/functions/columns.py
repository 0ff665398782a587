"""Column expressions used by several operators; all stay inside Spark's built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from ..sources.schemas import PRICE_STRUCTURE, PROPERTIES, RATE


def all_of(conditions: list[Column]) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result = result & condition
    return result


def any_of(conditions: list[Column]) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result = result | condition
    return result


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def greatest_or_null(a: Column, b: Column) -> Column:
    """The larger value, NULL as soon as one of them is NULL (Spark's own `greatest` skips NULLs)."""
    return F.when(a.isNull() | b.isNull(), None).otherwise(F.greatest(a, b))


def add_skipping_null(a: Column, b: Column) -> Column:
    """Sum of the values that are present, NULL if none is; how `sum` treats NULLs."""
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)


def row_key(*columns: Column | str) -> Column:
    """One text key for several columns in which NULLs keep their place."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("\\N")) for c in columns]
    return F.md5(F.concat_ws("\x1f", *parts))


def month_of(column: Column | str) -> Column:
    return F.trunc(F.to_date(column), "MM")


def valid_json(text: str) -> Column:
    """The text itself if it is JSON, else NULL."""
    return F.when(F.try_parse_json(text).isNotNull(), F.col(text))


#: The default, but with an option given Spark parses a text once, and not once for each field that is used.
ONCE = {"mode": "PERMISSIVE"}


def array_lists(text: str) -> Column:
    """The property filters as a struct of string arrays; a filter that is not an array becomes NULL."""
    schema = T.StructType([T.StructField(p, T.ArrayType(T.StringType())) for p in PROPERTIES])
    return F.from_json(text, schema, ONCE)


def whole(text: Column) -> Column:
    return text.cast("decimal(38,0)")


def pricing(text: str) -> Column:
    """A price structure parsed into typed fields (see `schemas.PRICING`)."""
    parsed = F.from_json(text, PRICE_STRUCTURE, ONCE)
    tiers = F.transform(
        parsed["tiers"],
        lambda t: F.struct(
            t["price"].cast(RATE).alias("price"),
            t["fee"].cast(RATE).alias("fee"),
            whole(t["upperBound"]).cast("bigint").alias("upper_bound"),
            t["isPricePercentage"].cast("boolean").alias("is_percentage"),
        ),
    )
    return F.struct(
        parsed["pricingType"].alias("pricing_type"),
        parsed["pricePerUnit"].cast(RATE).alias("unit_price"),
        parsed["isPricePercentage"].cast("boolean").alias("is_percentage"),
        parsed["price"].alias("line_price"),
        tiers.alias("tiers"),
    )
