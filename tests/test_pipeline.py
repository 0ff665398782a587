"""The whole run, its repetition, and the shape of its plans."""

import datetime as dt
import pathlib
import re

import pytest
from pyspark.sql import functions as F

from checks import queries
from meterbook.functions.storage import stored
from meterbook.operators import allocation, rating
from meterbook.operators.rating import rate_transactions
from meterbook.plans.pipeline import run_pipeline
from meterbook.sources.feeds import movement_union
from checks.sample import AS_OF, sample_sources


@pytest.fixture(scope="module")
def sources(spark, small):
    return {name: stored(df) for name, df in sample_sources(spark, small).items()}


@pytest.fixture(scope="module")
def first_run(spark, sources, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    tables = run_pipeline(sources, AS_OF, out)
    return out, tables, {name: df.count() for name, df in tables.items()}


def test_tables_equal_the_queries(spark, small, first_run):
    s = queries.stages(spark, small)
    tables = first_run[1]
    assert tables["revenue"].exceptAll(s.calculated).isEmpty()
    assert s.calculated.exceptAll(tables["revenue"]).isEmpty()
    assert first_run[2]["reconciliation"] == queries.queries()["reconciliation"](spark, small).count() > 0


def test_second_run_changes_nothing(sources, first_run):
    out, before, counts = first_run
    again = run_pipeline(sources, AS_OF, out, views=True)
    assert {name: df.count() for name, df in again.items()} == counts
    spark = again["rated_usage"].sparkSession
    assert spark.table("revenue").count() == spark.newSession().table("global_temp.revenue").count() == counts["revenue"]


def no_rating(rules, chunks=None):
    raise AssertionError("nothing is to be rated")


def test_unchanged_sources_are_not_rated_again(sources, first_run, monkeypatch):
    out, _, counts = first_run
    written = {f: f.stat().st_mtime_ns for name in ("rules", "rated_usage", "month_shares", "usage_revenue") for f in pathlib.Path(out, name).rglob("*.parquet")}
    monkeypatch.setattr(rating, "rate_transactions", no_rating)
    again = run_pipeline(sources, AS_OF, out)
    assert {name: df.count() for name, df in again.items()} == counts
    assert written == {f: f.stat().st_mtime_ns for name in ("rules", "rated_usage", "month_shares", "usage_revenue") for f in pathlib.Path(out, name).rglob("*.parquet")}


BY_MONTH = ["rules", "rated_usage", "month_shares", "usage_revenue", "fee_lines", "discount_lines", "true_up_lines", "calculated_summary", "invoiced_summary", "reconciliation"]


def equal(one, other, names=BY_MONTH):
    for name in names:
        assert one[name].columns == other[name].columns, name
        assert one[name].exceptAll(other[name]).isEmpty() and other[name].exceptAll(one[name]).isEmpty(), name


def test_only_changed_customers_are_rated_again_also_after_a_run_that_died(spark, sources, first_run, tmp_path, monkeypatch):
    whole = {name: spark.read.parquet(f"{first_run[0]}/{name}") for name in BY_MONTH}  # later runs have replaced files of the first
    movement = whole["rated_usage"].filter("mm_id is not null").groupBy("mm_id").agg(F.min("sequence_customer_id").alias("who"), F.min("transaction_month").alias("month")).orderBy("mm_id").first()
    other = {name: df.withColumn("total_amount", F.when(F.col("id") == movement.mm_id, F.col("total_amount") + 1).otherwise(F.col("total_amount")).cast(df.schema["total_amount"].dataType))
             if "total_amount" in df.columns else df for name, df in sources.items()}
    out, rate, rated = str(tmp_path / "out"), rating.rate_transactions, []
    run_pipeline(sources, AS_OF, out)

    def counted(rules, chunks=None):
        rated.append({tuple(r) for r in rules.select("transaction_month", "sequence_customer_id").distinct().collect()})
        return rate(rules, chunks)

    def broken(*_):
        raise RuntimeError("an executor too many was lost")

    monkeypatch.setattr(rating, "rate_transactions", counted)
    with monkeypatch.context() as m:
        m.setattr(allocation, "month_shares", broken)
        with pytest.raises(RuntimeError):
            run_pipeline(other, AS_OF, out)
    groups = whole["rules"].select("transaction_month", "sequence_customer_id").distinct().count()
    assert (movement.month, movement.who) in rated[0] and len(rated[0]) < groups / 4
    # the sources are as before the run that died: what it wrote must go
    equal(run_pipeline(sources, AS_OF, out), whole)
    assert rated[1] == rated[0]
    equal(run_pipeline(other, AS_OF, out), run_pipeline(other, AS_OF, str(tmp_path / "fresh")))
    assert rated[2] == rated[0]


def test_old_months_stay(sources, first_run):
    out, _, counts = first_run
    later = run_pipeline(sources, dt.date(1998, 5, 20), out)
    assert later["month_shares"].count() == counts["month_shares"]
    assert later["calculated_summary"].count() == counts["calculated_summary"]
    stored_months = {r[0] for r in later["rules"].select("transaction_month").distinct().collect()}
    assert dt.date(1998, 1, 1) in stored_months
    january = later["rated_usage"].filter(F.col("transaction_month") == dt.date(1998, 1, 1))
    assert not january.isEmpty() and january.filter("price_minimum_revenue is not null").count() > 0


def test_older_invoices_are_not_summed_up_again(sources, tmp_path):
    out, as_of, horizon = str(tmp_path), dt.date(1998, 5, 20), dt.datetime(1998, 2, 1)
    before = run_pipeline(sources, as_of, out)["invoiced_summary"].collect()
    voided = dict(sources)
    voided["invoices"] = sources["invoices"].withColumn("status", F.when(F.col("customer_id") == "seq_1", "VOIDED").otherwise(F.col("status")))
    after = run_pipeline(voided, as_of, out)["invoiced_summary"].collect()
    kept = [r for r in before if r.customer_id != "seq_1" or r.transaction_month < horizon.date()]
    assert sorted(map(str, after)) == sorted(map(str, kept)) and len(kept) < len(before)
    assert any(r.customer_id == "seq_1" for r in after)


def test_many_chunks_change_nothing_and_no_folder_stays(sources, first_run, tmp_path):
    names = {"rules": "all_the_rules"}
    tables = run_pipeline(sources, AS_OF, str(tmp_path), chunks=60, names=names)
    assert (tmp_path / "all_the_rules").is_dir() and not list(tmp_path.glob("_meterbook-run-*"))
    assert {name: df.count() for name, df in tables.items()} == first_run[2]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rating_windows_share_one_shuffle_and_small_tables_are_sent(spark, first_run):
    text = plan(rate_transactions(spark.read.parquet(f"{first_run[0]}/rules")))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1 and text.count("Sort [") == 2
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text


def test_what_is_no_longer_charged_goes(spark, sources, tmp_path):
    out = str(tmp_path)
    before = run_pipeline(sources, AS_OF, out)
    gone = before["rated_usage"].groupBy("sequence_customer_id").count().orderBy(F.desc("count")).first()[0]
    march = dt.date(1998, 3, 1)
    fewer = dict(sources)
    for feed in ("payout_transactions", "payin_transactions", "dac_transactions", "balance_recharges"):
        fewer[feed] = sources[feed].filter(~F.trunc("utc_created_at", "MM").eqNullSafe(F.lit(march)) & (F.crc32(F.encode("id", "UTF-8")) % 3 != 0))
    fewer["customers"] = sources["customers"].filter(F.col("id") != gone)
    again = run_pipeline(fewer, AS_OF, out)
    fresh = run_pipeline(fewer, AS_OF, f"{out}-fresh")
    equal(again, fresh)  # every month of the sample is recent, so a second run must equal a first one on the same sources
    assert again["rated_usage"].filter((F.col("transaction_month") == march) & F.col("mm_id").isNotNull()).isEmpty()
    assert not before["rated_usage"].sparkSession.read.parquet(f"{out}/rules").filter(F.col("transaction_month") == march).isEmpty()


def test_feed_filters_reach_the_scan(sources):
    text = plan(movement_union(sources, AS_OF))
    assert text.count("PushedFilters: [IsNotNull(eventtimestamp)") == 4
    assert "transfer_method" not in text


def test_no_query_multiplies_tables(spark, small):
    for name, query in queries.queries().items():
        text = plan(query(spark, small))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
        assert "Python" not in text, name


def test_older_invoices_follow_their_customers(sources, tmp_path):
    out, as_of, horizon = str(tmp_path / "out"), dt.date(1998, 5, 20), dt.date(1998, 2, 1)
    run_pipeline(sources, as_of, out)
    name = F.when(F.col("id") == "seq_1", "Another name").otherwise(F.col("legal_name"))
    other = {**sources, "customers": sources["customers"].filter("id <> 'seq_2'").withColumn("legal_name", name)}
    renamed = run_pipeline(other, as_of, out)["invoiced_summary"]
    old = renamed.filter(F.col("transaction_month") < F.lit(horizon))
    assert {r.legal_name for r in old.filter("customer_id = 'seq_1'").collect()} == {"Another name"}
    assert old.filter("customer_id = 'seq_2'").isEmpty() and not old.filter("customer_id is null").isEmpty()
    back = run_pipeline(sources, as_of, out)
    equal(back, run_pipeline(sources, as_of, str(tmp_path / "fresh")), ["invoiced_summary", "reconciliation"])
