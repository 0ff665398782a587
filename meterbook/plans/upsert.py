"""Incremental upsert by key: as a plan over two DataFrames, and into a Parquet table partitioned by month."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.columns import same
from ..functions.storage import files, merged, remove, stored

MONTH = "transaction_month"


def only_unique(new: DataFrame, keys: list[str], on_duplicate: str) -> DataFrame:
    """Treat rows of `new` that share a complete key; rows with a NULL in their key are never duplicates."""
    if on_duplicate == "keep":
        return new
    complete = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    if on_duplicate == "error":
        twice = new.filter(complete).groupBy(*keys).count().filter("count > 1").limit(1).collect()
        if twice:
            raise ValueError(f"several new rows share the key {twice[0].asDict()}")
        return new
    if on_duplicate == "first":
        others = [F.col(c).cast("string").asc_nulls_last() for c in new.columns if c not in keys and c != "pricing"]
        ranked = new.filter(complete).withColumn(
            "_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*others))
        ).filter("_rn = 1").drop("_rn")
        return ranked.unionByName(new.filter(~complete))
    raise ValueError(f"on_duplicate: {on_duplicate}")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], on_duplicate: str = "error") -> DataFrame:
    """`old` without the rows whose key occurs in `new`, plus `new`. NULL equals NULL, so a second run changes nothing.

    on_duplicate, for new rows with one complete key: "error", "first" (in a fixed order) or "keep".
    """
    new = only_unique(new, keys, on_duplicate)
    # never broadcast: stored keys look small by their files. Copies do no harm in this join, and removing them is a shuffle more.
    replaced = merged(new.select(*[F.col(k).alias(f"_k_{k}") for k in keys]))
    # complete keys, nearly all, meet by plain equality: rows that were dealt by the key are then not dealt again
    equal = reduce(Column.__and__, [F.col(k) == F.col(f"_k_{k}") for k in keys])
    alike = reduce(Column.__and__, [same(F.col(k), F.col(f"_k_{k}")) for k in keys])
    whole, new_whole = (reduce(Column.__and__, [F.col(f"{mark}{k}").isNotNull() for k in keys]) for mark in ("", "_k_"))
    kept = [
        old.filter(whole).join(replaced.filter(new_whole), equal, "left_anti"),
        old.filter(~whole).join(replaced.filter(~new_whole), alike, "left_anti"),
    ]
    # in the same two parts, so that the first is the very rows that the merge reads
    added = [new.filter(whole), new.filter(~whole)]
    return reduce(DataFrame.unionByName, [*kept, *added])


def existing_table(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return None
        raise


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Full rebuild of a table."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """A view for this session, and as `global_temp.<name>` for all sessions of the application."""
    df.createOrReplaceTempView(name)
    df.createOrReplaceGlobalTempView(name)
    return df


def replace_months(df: DataFrame, path: str) -> DataFrame:
    """Write the months that occur in `df` in place of what the table at `path` has for them; others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def rewrite_months(df: DataFrame, path: str, months: list[dt.date]) -> DataFrame:
    """Write what `df` has in place of the months it occurs in, then clear those of the given months that it has nothing for.

    Months are published before any is cleared, so readers find each month's old rows or its new ones. A run that dies
    while it writes leaves the table as it was; one that dies before it clears leaves months that should be empty, which
    the next run clears, as it recomputes whole months. A month was written if its files have other names than before.
    """
    spark = df.sparkSession
    folders = {month: f"{path}/{MONTH}={month:%Y-%m-%d}" for month in months}
    before = {month: files(spark, folder) for month, folder in folders.items()}
    written = replace_months(df, path)
    for month, folder in folders.items():
        if before[month] and files(spark, folder) == before[month]:
            remove(spark, folder)
    # listed anew: what was cleared is not part of the table
    return spark.read.schema(df.schema).parquet(path).select(*df.columns) if months else written


def upsert_table(new: DataFrame, path: str, keys: list[str], on_duplicate: str = "error") -> DataFrame:
    """Upsert into the table at `path`, rewriting only the months that occur in `new`.

    Only the new rows are stored apart, as they are read for their months, their keys and themselves. Spark writes the
    merged months beside the table and moves them into place when the job is complete, so it may read what it replaces.
    """
    spark = new.sparkSession
    old = existing_table(spark, path)
    if old is None:
        merged = only_unique(new, keys, on_duplicate)
    else:
        new = stored(new)
        months = [r[0] for r in new.select(MONTH).distinct().collect()]  # one row per calendar month
        present = F.col(MONTH).isin([m for m in months if m is not None])
        if None in months:
            present = present | F.col(MONTH).isNull()
        merged = upsert(old.filter(present).select(*new.columns), new, keys, on_duplicate)
    return replace_months(merged.select(*new.columns), path)
