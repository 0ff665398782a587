"""Merging by key, in memory and into a table."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from meterbook.functions import storage
from meterbook.plans.upsert import rewrite_months, upsert, upsert_table

SCHEMA = "id string, name string, transaction_month date, value int"
KEYS = ["id", "name", "transaction_month"]
MAY, JUNE = dt.date(2025, 5, 1), dt.date(2025, 6, 1)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def content(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_null_keys_are_equal(spark):
    old = frame(spark, (None, "fee", MAY, 1), ("a", "x", MAY, 1))
    assert content(upsert(old, frame(spark, (None, "fee", MAY, 2)), KEYS)) == content(frame(spark, (None, "fee", MAY, 2), ("a", "x", MAY, 1)))


def test_duplicates(spark):
    old, twice = frame(spark), frame(spark, ("a", "x", MAY, 2), ("a", "x", MAY, 1))
    with pytest.raises(ValueError):
        upsert(old, twice, KEYS)
    assert content(upsert(old, twice, KEYS, on_duplicate="first")) == [("a", "x", MAY, 1)]
    assert upsert(old, twice, KEYS, on_duplicate="keep").count() == 2
    incomplete = frame(spark, (None, "fee", MAY, 1), (None, "fee", MAY, 1))
    assert upsert(old, incomplete, KEYS).count() == 2


def test_table_is_idempotent_and_keeps_other_months(spark, tmp_path):
    path = f"{tmp_path}/t"
    first = frame(spark, (None, "fee", MAY, 1), ("a", "x", JUNE, 1), ("old", "x", MAY, 7))
    assert content(upsert_table(first, path, KEYS)) == content(first)
    assert content(upsert_table(first, path, KEYS)) == content(first)
    changed = upsert_table(frame(spark, ("a", "x", JUNE, 5), ("b", "x", JUNE, 1)), path, KEYS)
    assert content(changed) == content(frame(spark, (None, "fee", MAY, 1), ("old", "x", MAY, 7), ("a", "x", JUNE, 5), ("b", "x", JUNE, 1)))


def test_unknown_month_and_no_rows(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = frame(spark, ("a", "x", None, 1))
    upsert_table(rows, path, KEYS)
    assert content(upsert_table(rows, path, KEYS)) == content(rows)
    assert content(upsert_table(frame(spark), path, KEYS)) == content(rows)


def test_months_without_rows_are_cleared_after_the_others_are_written(spark, tmp_path):
    path, july = f"{tmp_path}/t", dt.date(2025, 7, 1)
    rewrite_months(frame(spark, ("a", "x", MAY, 1), ("b", "x", JUNE, 1), ("c", "x", july, 1)), path, [])
    again = rewrite_months(frame(spark, ("b", "x", JUNE, 2)), path, [JUNE, july])
    assert content(again) == content(frame(spark, ("a", "x", MAY, 1), ("b", "x", JUNE, 2)))
    assert content(rewrite_months(frame(spark), path, [MAY, JUNE])) == []


def test_a_write_that_fails_leaves_the_old_months(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = [("a", "x", MAY, 1), ("b", "x", JUNE, 1)]
    rewrite_months(frame(spark, *rows), path, [])
    broken = frame(spark, ("a", "x", MAY, 2), ("b", "x", JUNE, 3)).repartition(2).withColumn(
        "value", F.when(F.col("value") == 3, F.raise_error(F.lit("broken")).cast("int")).otherwise(F.col("value")))
    with pytest.raises(Exception, match="broken"):
        rewrite_months(broken, path, [MAY, JUNE])
    assert content(spark.read.schema(SCHEMA).parquet(path).select("id", "name", "transaction_month", "value")) == content(frame(spark, *rows))


def test_runs_in_several_threads_keep_their_own_folders(spark, tmp_path):
    seen, meet = {}, threading.Barrier(2)

    def run(name):
        with storage.run_folder(spark, f"{tmp_path}/{name}"):
            meet.wait()
            df = storage.stored(frame(spark, (name, "x", MAY, 1)))
            meet.wait()
            seen[name] = df.inputFiles()[0], content(df)

    threads = [threading.Thread(target=run, args=(name,)) for name in ("one", "two")]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert all(f"/{name}/_meterbook-run-" in where and rows == [(name, "x", MAY, 1)] for name, (where, rows) in seen.items()) and len(seen) == 2
    assert not any(list((tmp_path / name).glob("_meterbook-run-*")) for name in seen if (tmp_path / name).is_dir())


def test_keys_are_merged_not_broadcast(spark):
    old, new = frame(spark, ("a", "x", MAY, 1), ("b", "x", MAY, 1), (None, "x", MAY, 1)), frame(spark, ("a", "x", MAY, 2), ("a", "x", MAY, 2), (None, "x", MAY, 3))
    found = upsert(old, new, KEYS, on_duplicate="keep")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan and "HashAggregate" not in plan
    assert content(found) == content(frame(spark, ("a", "x", MAY, 2), ("a", "x", MAY, 2), ("b", "x", MAY, 1), (None, "x", MAY, 3)))


def test_rows_dealt_by_their_key_are_not_dealt_again(spark):
    rows = spark.createDataFrame([(f"m{n}", n, MAY) for n in range(40)] + [(None, 7, MAY)], "mm_id string, amount long, transaction_month date")
    rows = rows.repartition(4, "mm_id", "amount").distinct()
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the plan with its reused exchanges
    try:
        found = upsert(rows, rows.filter("amount > 5"), ["mm_id", "amount"], on_duplicate="keep")
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    whole = plan.split("Union")[1].split("coalesce(mm_id")[0]  # up to the join of incomplete keys
    assert "SortMergeJoin" in whole and "ENSURE_REQUIREMENTS" not in whole and "REPARTITION_BY_NUM" in whole
    assert sorted(r.amount for r in found.collect()) == sorted([*range(40), 7])
