"""Poisson replication against its SQL and by its statistics."""

import math
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from checks import compare
from meterbook.llm import mixing, queries


def test_query_equals_sql(spark, small):
    rows = queries.op5_poisson_mixing(spark, small)
    result = compare.tables(small).execute(queries.oracle_sql()["op5_poisson_mixing"])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(rows.columns)
    assert compare.rows(names, result.fetchall()) == compare.rows(rows.columns, [tuple(r) for r in rows.collect()])


def test_counts_follow_the_distribution(spark):
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit("abcd").alias("text"), F.when(F.col("id") % 4 == 0, "small").otherwise("large").alias("source"), F.lit(1).alias("rate"))
    out = mixing.replicate(docs.drop("rate"), weights={"small": 0.5, "large": 0.5}).groupBy("source", "doc_id", "rate").count().collect()
    for source, n in (("small", 10_000), ("large", 30_000)):
        rate = 20_000 / n
        counts = Counter(r["count"] for r in out if r.source == source)
        assert all(abs(r.rate - rate) < 1e-9 for r in out if r.source == source)
        for k in (1, 2, 3):
            want = n * math.exp(-rate) * rate**k / math.factorial(k)
            assert abs(counts[k] - want) < 5 * math.sqrt(want)
    assert set(mixing.mixed(docs).columns) == set(docs.columns)


def test_one_exchange_gives_the_global_order(spark, small):
    out = queries.op5_poisson_mixing(spark, small)
    keys = [r.order_key for r in out.collect()]
    parts = out.select(F.spark_partition_id().alias("p")).distinct().count()
    assert keys == sorted(keys) and parts == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert "rangepartitioning" not in out._jdf.queryExecution().executedPlan().toString()


def test_null_source_null_text_and_empty(spark):
    docs = spark.createDataFrame([(1, None, None), (2, "abc", None), (None, "x" * 1000, "b"), (4, "", "c")], "doc_id long, text string, source string")
    kept = mixing.mixed(docs).collect()
    assert {r.doc_id for r in kept} <= {1, 2, None, 4} and sum(r.doc_id == 4 for r in kept) == 1
    assert mixing.mixed(docs.limit(0)).count() == 0 and mixing.mixed(docs.filter("doc_id = 4")).columns == docs.columns


def test_small_sources_reach_their_weight(spark):
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit("abcd").alias("text"), F.when(F.col("id") < 40, "small").otherwise("large").alias("source"))
    out = mixing.replicate(docs, weights={"small": 0.2, "large": 0.8}).groupBy("source", "doc_id", "rate").count().collect()
    small = [r["count"] for r in out if r.source == "small"]
    assert len(small) == 40 and {round(r.rate, 6) for r in out if r.source == "small"} == {200.0}
    assert abs(sum(small) - 8000) < 5 * math.sqrt(8000)
    assert 100 < sum((x - 200) ** 2 for x in small) / 40 < 360


def test_documents_of_a_source_without_characters_are_kept_once(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "").alias("text"), F.lit("bare").alias("source"))
    docs = docs.union(spark.createDataFrame([(1000, "abc", "other")], docs.schema))
    kept = Counter(r.doc_id for r in mixing.mixed(docs).collect())
    assert all(kept[i] == 1 for i in range(500))


def test_sql_with_rates_of_hundreds(spark, tmp_path):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < 2, "a").otherwise(F.repeat(F.lit("abc def "), 40)).alias("text"),
        F.when(F.col("id") < 2, "small").when(F.col("id") < 10, None).otherwise("large").alias("source"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op5_poisson_mixing(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    result = con.execute(queries.oracle_sql()["op5_poisson_mixing"])
    names = [d[0] for d in result.description]
    got = rows.collect()
    assert compare.rows(names, result.fetchall()) == compare.rows(rows.columns, [tuple(r) for r in got]) and max(r.rate for r in got) > 100


def test_clashing_columns_come_back(spark):
    names = ["of", "below", "_rate", "_draws", "_u", "_count", "_own_rate", "copy", "rate", "order_key", "chars", "_mix_of", "_mix_count", "__mix_own_copy", "given", "weight"]
    docs = spark.createDataFrame([(i, "word " * i, "ab"[i % 2]) for i in range(40)], "doc_id long, text string, source string").withColumns({n: F.lit(n) for n in names})
    out = mixing.mixed(docs)
    assert out.columns == docs.columns and all(r[n] == n for r in out.collect() for n in names)
    plain = Counter(r.doc_id for r in mixing.mixed(docs.select("doc_id", "text", "source")).collect())
    assert Counter(r.doc_id for r in out.collect()) == plain
