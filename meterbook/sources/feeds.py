"""Reading the sources and cutting the movement feeds to the billing window."""

from __future__ import annotations

import calendar
import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .schemas import SOURCES, conform, problems

FEEDS = ["payout_transactions", "payin_transactions", "dac_transactions", "balance_recharges"]


def read_sources(spark: SparkSession, locations: dict[str, str], *, pad: bool = False) -> dict[str, DataFrame]:
    """Open the source tables: a location with a slash is a Parquet path, any other a catalog table.

    Tables that are not used may be left out. Columns that are not declared are never read. All tables are compared with
    their declared columns before any row is read; one ValueError lists every missing column (with `pad` they are NULL
    instead) and every column of a type whose values would not survive the cast. Whole numbers may stand for decimals
    and text, narrower scales for wider ones, dates for times; times with a zone are read in the session's. A decimal of
    more digits is accepted, and a value that does not fit then stops the job.
    """
    unknown = set(locations) - set(SOURCES)
    if unknown:
        raise ValueError(f"unknown sources: {sorted(unknown)}")
    opened = {name: spark.read.parquet(where) if "/" in where else spark.table(where) for name, where in locations.items()}
    wrong = [
        f"{name}.{text}" for name, df in opened.items() for text in problems(df, SOURCES[name])
        if not (pad and " is missing (" in text)
    ]
    if wrong:
        raise ValueError("sources do not have their declared columns: " + "; ".join(wrong))
    return {name: conform(df, SOURCES[name]) for name, df in opened.items()}


def source_profile(sources: dict[str, DataFrame]) -> DataFrame:
    """(source, entries, field, kind, filled, smallest, largest) of all columns, the ends as text; each table is read once."""
    def profile(name: str, df: DataFrame) -> DataFrame:
        facts = [
            F.struct(F.lit(f.name).alias("field"), F.lit(f.dataType.simpleString()).alias("kind"), F.count(f.name).alias("filled"),
                     F.min(f.name).cast("string").alias("smallest"), F.max(f.name).cast("string").alias("largest")).alias(f"of_{f.name}")
            for f in df.schema.fields
        ]
        one = df.agg(F.count(F.lit(1)).alias("entries"), *facts)
        return one.select(F.lit(name).alias("source"), "entries", F.inline(F.array(*[f"of_{c}" for c in df.columns])))

    return reduce(DataFrame.unionByName, [profile(name, df) for name, df in sources.items()])


def month_start(day: dt.date) -> dt.date:
    return day.replace(day=1)


def add_months(day: dt.date, months: int) -> dt.date:
    """Calendar month arithmetic, clipped to the last day of the month."""
    index = day.year * 12 + day.month - 1 + months
    year, month = divmod(index, 12)
    return dt.date(year, month + 1, min(day.day, calendar.monthrange(year, month + 1)[1]))


def billing_window(as_of: dt.date) -> tuple[dt.date, dt.date]:
    """First and last day read by a run: from the month that lies 90 days before this month's start, to `as_of`."""
    return month_start(month_start(as_of) - dt.timedelta(days=90)), as_of


def merge_horizon(as_of: dt.date) -> dt.date:
    """First month that an incremental run rewrites: three months back, whole months only."""
    return month_start(add_months(as_of, -3))


def months_between(first: dt.date, last: dt.date) -> list[dt.date]:
    """The first days of the calendar months from `first` to `last`."""
    out = [month_start(first)]
    while out[-1] < month_start(last):
        out.append(add_months(out[-1], 1))
    return out


def instant(day: dt.date) -> Column:
    """Midnight of the day, whatever the session's time zone."""
    return F.lit(day).cast("timestamp_ntz")


def on_days(column: str, first: dt.date, last: dt.date) -> Column:
    """`column` falls on one of the days, both included; a plain range, so Parquet statistics can skip row groups."""
    return (F.col(column) >= instant(first)) & (F.col(column) < instant(last + dt.timedelta(days=1)))


def feed_window(feed: DataFrame, as_of: dt.date) -> DataFrame:
    """One feed's movements whose event day lies in the billing window, with the pipeline's own column names added."""
    return feed.filter(on_days("eventtimestamp", *billing_window(as_of))).withColumns({
        "mm_id": F.col("id"), "amount": F.col("total_amount"), "local_created_at": F.col("utc_created_at"),
    })


def movement_union(sources: dict[str, DataFrame], as_of: dt.date) -> DataFrame:
    """The four feeds as one set of movements.

    The creation time is bounded by two midnights, so movements created on the last day after 00:00 are left out,
    although the event window includes that day.
    """
    first, last = billing_window(as_of)
    columns = [
        "mm_id", F.coalesce("client_id_edit", "client_id").alias("client_id"), "eventtype", "eventtimestamp",
        "flow", "transaction_type", "origination_system", "source_account_type", "destination_bank", "origin_bank",
        "country", "status", "amount", "updated_at", "local_created_at",
    ]
    parts = [
        feed_window(sources[name], as_of)
        .filter(F.col("local_created_at").between(instant(first), instant(last)))
        .select(*columns)
        for name in FEEDS
    ]
    return reduce(DataFrame.unionByName, parts).withColumn(
        "event_month", F.trunc("eventtimestamp", "MM")
    )


def client_pull(feed: DataFrame, client_id: str, first: dt.date, last: dt.date) -> DataFrame:
    """All columns of one client's movements updated on the given days."""
    return feed.filter((F.col("client_id") == F.lit(client_id)) & on_days("updated_at", first, last))
