"""The whole pipeline: from source tables to the reconciliation, writing every table of a run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..functions.storage import remove, run_folder, stored
from ..operators import allocation, line_revenue, line_rules, matching, rating, summaries
from ..operators.invoice_rules import per_client, rule_lines
from ..operators.ordered import join_same
from ..sources.feeds import instant, merge_horizon, month_start, months_between, movement_union
from .changes import GROUP, changed_groups, fingerprints, in_doubt
from .upsert import MONTH, existing_table, only_unique, publish_view, rewrite_months, write_table

LINES = {
    "fee": "fee_lines",
    "discount": "discount_lines",
    "true_up": "true_up_lines",
}


def run_pipeline(
    sources: dict[str, DataFrame], as_of: dt.date, out: str, *, exact_cents: bool = False,
    on_duplicate: str = "error", chunks: int | None = None, views: bool = False,
    names: dict[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Run everything as of a day and write it below the folder `out`; returns the tables by name.

    A run replaces whole months, from three months before `as_of` on, in all tables by month: what these months no
    longer produce goes, older months stay as they were stored. Of these months, those whose rule rows are as the run
    before left them are not written again, and in the others only customers with other rule rows are rated again (see
    `changes`). A table that is not there yet gets all months that the run reads. Intermediate tables lie in a folder below `out` that the run removes. With `views` each result is also a
    temporary view, in `global_temp` for other sessions too. Invoices of older months are summed up by the first run, and
    again when their customers have left, come or changed their names. `names` gives tables (and views) other names than the keys of the result.
    """
    spark = next(iter(sources.values())).sparkSession
    with run_folder(spark, out):
        return _run(sources, as_of, out, exact_cents, on_duplicate, chunks, views, names or {})


def _named_otherwise(older: DataFrame, invoices: DataFrame, customers: DataFrame) -> bool:
    """Whether customers of the older invoices have left, come or changed their names since the rows of `older` were summed up."""
    stored_names = older.select("customer_id", "legal_name").distinct()
    names = customers.select(F.col("id").alias("customer_id"), "legal_name").distinct()
    known = stored_names.filter("customer_id is not null")
    if not join_same(known, names, ["customer_id", "legal_name"], "left_anti").isEmpty():
        return True
    if stored_names.filter("customer_id is null").isEmpty():
        return False
    # rows of unknown customers: one of them may be known by now
    come = invoices.select("customer_id").distinct().join(names.select("customer_id"), "customer_id", "left_semi")
    return not come.join(known, "customer_id", "left_anti").isEmpty()


def _run(
    sources: dict[str, DataFrame], as_of: dt.date, out: str, exact_cents: bool, on_duplicate: str, chunks: int | None,
    views: bool, names: dict[str, str],
) -> dict[str, DataFrame]:
    tables: dict[str, DataFrame] = {}
    horizon = merge_horizon(as_of)
    spark = next(iter(sources.values())).sparkSession

    def label(name: str) -> str:
        return names.get(name, name)

    def path(name: str) -> str:
        return f"{out}/{label(name)}"

    def keep(name: str, df: DataFrame) -> DataFrame:
        tables[name] = df
        return publish_view(df, label(name)) if views else df

    def table(name: str, df: DataFrame) -> DataFrame:
        return keep(name, write_table(df, path(name)))

    def recent(df: DataFrame) -> DataFrame:
        return df.filter(F.col(MONTH) >= F.lit(horizon))

    def month_last(df: DataFrame) -> DataFrame:
        """As Spark reads tables by month."""
        return df.select(*[c for c in df.columns if c != MONTH], MONTH)

    lines = table("invoice_lines", rule_lines(sources, as_of))
    keep("invoice_rules", per_client(lines))
    matches = matching.match_rules(movement_union(sources, as_of), matching.compile_rules(lines, clients=False))

    marks_path = path("rule_marks")
    old_rules, old_marks = existing_table(spark, path("rules")), existing_table(spark, marks_path)
    whole = old_rules is None or old_marks is None
    if whole:
        # matched once; duplicates are looked for before anything is replaced
        fresh = only_unique(line_rules.all_rules(lines, stored(matches)), matching.MERGE_KEY, on_duplicate)
        marks, months = stored(fingerprints(recent(fresh), exact_cents, on_duplicate)), months_between(horizon, as_of)
        remove(spark, marks_path)
    else:
        marks = stored(fingerprints(recent(line_rules.all_rules(lines, matches)), exact_cents, on_duplicate))
        old_marks = old_marks.filter(F.col(MONTH).between(F.lit(horizon), F.lit(month_start(as_of))))
        changed = stored(changed_groups(old_marks, marks))
        months = sorted(r[0] for r in changed.select(MONTH).distinct().collect())  # one row per calendar month

    def cut(df: DataFrame) -> DataFrame:
        return recent(df) if whole else df.filter(F.col(MONTH).isin(months))

    if not whole and months:
        matches = stored(cut(matches))
        fresh = only_unique(cut(line_rules.all_rules(lines, matches)), matching.MERGE_KEY, on_duplicate)
        # a run that dies from here on leaves customer-months that the next one prices again
        rewrite_months(in_doubt(cut(old_marks), changed), marks_path, months)

    def by_month(name: str, make, *inputs: DataFrame, again: list[dt.date] | None = None, since: dt.date = horizon) -> DataFrame:
        """The table of make(*inputs), written for the months to replace (or those given, from `since` on), or for all if it is new."""
        old = existing_table(spark, path(name))
        if old is None:
            return keep(name, rewrite_months(month_last(make(*inputs)), path(name), []))
        if again is not None:
            rows = make(*map(recent, inputs)).filter(F.col(MONTH) >= F.lit(since))
            return keep(name, rewrite_months(month_last(rows), path(name), again))
        if not months:
            return keep(name, month_last(old))
        return keep(name, rewrite_months(month_last(cut(make(*map(cut, inputs)))), path(name), months))

    def rate(rules: DataFrame) -> DataFrame:
        """The rated rows: those of customer-months that did not change as they are stored."""
        old = None if whole else existing_table(spark, path("rated_usage"))
        if old is None:
            return rating.rate_transactions(rules, chunks)
        rated = rating.rate_transactions(join_same(rules, changed, GROUP, "left_semi"), chunks)
        return join_same(cut(old), changed, GROUP, "left_anti").unionByName(rated)

    rules = by_month("rules", lambda: fresh)
    rated = by_month("rated_usage", rate, rules)
    line_rows = table("line_rules", line_revenue.line_rule_rows(rules))
    base = {
        kind: by_month(name, lambda r, kind=kind: line_revenue.fixed_line_revenue(r, kind, exact_cents), line_rows)
        for kind, name in LINES.items()
    }
    fee_totals = table("fee_totals", line_revenue.platform_fee_totals(base["fee"]))
    table("general_discounts", line_revenue.general_discounts(base["discount"]))
    specific = table("specific_discounts", line_revenue.specific_discounts(base["discount"]))
    shares = by_month("month_shares", allocation.month_shares, rated)
    fee_counts = allocation.fee_share_counts(shares)

    marts = [
        by_month("usage_revenue", allocation.allocate, rated, fee_totals, shares),
        table("fee_revenue", line_revenue.platform_fee_mart(base["fee"], fee_counts, specific)),
        table("discount_revenue", line_revenue.discount_mart(base["discount"], fee_counts)),
        table("true_up_revenue", line_revenue.true_up_mart(base["true_up"])),
    ]
    calculated = keep("revenue", allocation.revenue_calculated(*marts))
    # it completes the months of a group between its first and last one, so it looks at all recent months at once
    recent_months = months_between(horizon, as_of)
    summary = by_month("calculated_summary", summaries.calculated_summary, calculated, again=recent_months)
    invoices, summed = sources["invoices"], existing_table(spark, path("invoiced_summary"))
    invoiced_months = recent_months
    if summed is not None:
        older = invoices.filter((F.col("status") != "VOIDED") & (F.col("billing_period_start") < instant(horizon)))
        if _named_otherwise(summed.filter(F.col(MONTH) < F.lit(horizon)), older, sources["customers"]):
            invoiced_months = sorted(r[0] for r in summed.select(MONTH).distinct().collect() if r[0])  # one row per calendar month
        else:  # older invoices are summed up already
            invoices = invoices.filter(F.col("billing_period_start") >= instant(horizon))
    invoiced = by_month(
        "invoiced_summary", lambda: summaries.invoiced_summary({**sources, "invoices": invoices}), again=invoiced_months,
        since=invoiced_months[0])
    table("reconciliation", summaries.reconciliation(summary, invoiced))
    if whole or months:
        rewrite_months(cut(marks), marks_path, [] if whole else months)
    return tables
