"""Operators on tables whose other columns have the names that operators use inside, and whose ids are text."""

from pyspark.sql import functions as F

from meterbook.llm import licenses, mixing, shards, simhash, templates
from meterbook.llm.shared import fresh, table


def test_scan_keeps_every_column(spark):
    names = ["_low", "_gate", "_base", "_found", "_lic_low", "license", "_own_license"]
    docs = spark.createDataFrame([("MIT License", *names), (None, *names)], ["text", *names])
    out = licenses.scan_licenses(docs)
    rows = sorted(out.collect(), key=lambda r: r.text or "")
    assert set(out.columns) == {*docs.columns, "own_license"}
    assert all(r[c] == c for r in rows for c in names if c != "license") and all(r.own_license == "license" for r in rows)
    assert [r.license.score > 0 for r in rows] == [False, True]


def test_fresh_names():
    class Docs:
        columns = ["_A_x", "__a_y"]

    assert fresh(Docs, "_a_") == "___a_" and fresh(Docs, "_b_") == "_b_"


def test_text_ids(spark, small):
    docs = table(spark, small, "documents").withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    placed = shards.shard_rows(docs).collect()
    assert {r.doc_id for r in placed} == ids and len(placed) == len(ids)
    slots = sorted((r.shard, r.slot) for r in placed)
    assert all(slot == sum(s == shard for s, _ in slots[:i]) for i, (shard, slot) in enumerate(slots))
    kept = {r.doc_id for r in simhash.one_of_each(docs).select("doc_id").collect()}
    assert kept == {r.component_id for r in simhash.component_ids(docs).collect()}
    assert {r.doc_id for r in mixing.mixed(docs).select("doc_id").collect()} < ids
    assert {r.doc_id for r in templates.clean_documents(docs, table(spark, small, "benchmark")).select("doc_id").collect()} < ids


def test_one_text_with_text_ids_is_cut(spark):
    docs = spark.range(3000).select(F.concat(F.lit("d"), "id").alias("doc_id"), F.lit("the same words").alias("text"))
    sizes = [r["sum(size)"] for r in shards.shard_rows(docs).groupBy("shard").sum("size").collect()]
    assert len(sizes) == shards.SHARDS and max(sizes) < 1.1 * min(sizes)
