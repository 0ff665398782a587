"""Histogram sort: the byte law, gapless slots, groups of equal texts."""

import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from meterbook.llm import shards
from meterbook.llm.queries import op7_histogram_shards


def sizes(rows):
    out = Counter()
    for r in rows:
        out[r.shard] += r.size
    return [out[i] for i in range(shards.SHARDS)]


def gapless(rows):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    return all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_query(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = op7_histogram_shards(spark, small).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts) and gapless(rows)
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 8, zlib.crc32(data), "bytes", None)
    assert max(sizes(rows)) - min(sizes(rows)) <= 2 * max(r.size for r in rows)


def test_hot_group_is_split_and_small_groups_are_not(spark, monkeypatch):
    monkeypatch.setattr(shards, "ROWS_PER_RANGE", 20)
    docs = spark.range(0, 4000, numPartitions=7).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("copy" * 20)).otherwise(F.concat(F.lit("text "), (F.col("id") / 2).cast("int").cast("string"), F.lit("x" * 70))).alias("text"))
    rows = shards.shard_rows(docs, tolerance=0.02).collect()
    per = sizes(rows)
    assert len(rows) == 4000 and gapless(rows) and max(per) - min(per) <= 0.05 * sum(per) / len(per)
    of = defaultdict(set)
    for r in rows:
        of[r.key].add(r.shard)
    assert sum(len(x) > 1 for x in of.values()) == 1


def test_repeated_null_and_empty(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (None, None), (None, "b"), (2, "")], "doc_id long, text string")
    rows = shards.shard_rows(docs).collect()
    assert len(rows) == 5 and gapless(rows)
    assert shards.shard_rows(docs.limit(0)).count() == 0
    assert len(shards.shard_rows(spark.createDataFrame([(1, "a")] * 50, "doc_id long, text string")).collect()) == 50


def test_written_shards(spark, tmp_path):
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"), F.lit(1).alias("n_chars"))
    shards.write_shards(docs, f"{tmp_path}/out", 4)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == 100 and back.select("shard").distinct().count() == 4
