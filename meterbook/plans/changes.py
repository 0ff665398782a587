"""Which customer-months a run has to price again: fingerprints of their rule rows, kept from one run to the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .upsert import MONTH

GROUP = [MONTH, "sequence_customer_id"]

#: To be raised when the same rule rows shall give other results.
VERSION = 1

#: In place of the number of rows while a run replaces what it wrote for a customer-month: equal to no fingerprint.
IN_DOUBT = -1


def fingerprints(rules: DataFrame, *options: object) -> DataFrame:
    """One row per customer-month: its number of rule rows and two sums of hashes of them, whatever their order.

    The options of the run that change results are part of the hashes. Spark's hash passes over NULLs, so it is told
    where they are. `pricing` is left out, as it comes from the price structure's text.
    """
    values = [F.col(c) for c in rules.columns if c != "pricing"]
    known = [c.isNotNull() for c in values]

    def total(seed: int):
        salt = F.lit(":".join(map(str, (VERSION, seed, *options))))
        return F.sum(F.xxhash64(salt, *values, *known).cast("decimal(20,0)")).cast("decimal(38,0)")

    return rules.groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("rule_rows"), total(1).alias("first_sum"), total(2).alias("second_sum"))


def changed_groups(old: DataFrame, new: DataFrame) -> DataFrame:
    """The customer-months whose fingerprints differ, or that only one side has."""
    both = old.select(*new.columns).unionByName(new)
    return both.groupBy(*new.columns).count().filter("count = 1").select(*GROUP).distinct()


def in_doubt(old: DataFrame, changed: DataFrame) -> DataFrame:
    """Fingerprints to keep while a run replaces the changed customer-months: theirs equal no others."""
    same = [old[k].eqNullSafe(F.col(f"_r_{k}")) for k in GROUP]
    renamed = changed.select(*[F.col(k).alias(f"_r_{k}") for k in GROUP])
    nothing = F.lit(0).cast("decimal(38,0)")
    marked = changed.select(*GROUP, F.lit(IN_DOUBT).cast("bigint").alias("rule_rows"), nothing.alias("first_sum"), nothing.alias("second_sum"))
    return old.join(renamed, same, "left_anti").unionByName(marked)
