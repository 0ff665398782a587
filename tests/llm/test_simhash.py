"""SimHash components against comparing all pairs."""

import random

import brute
import pytest
from pyspark.sql import functions as F

from meterbook.llm import simhash
from meterbook.llm.queries import op6_simhash_anchors


def expected(texts):
    fps = {i: brute.fingerprint(t) for i, t in texts.items()}
    ids = sorted(fps)
    pairs = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if (fps[a] ^ fps[b]).bit_count() <= 4]
    return fps, brute.components(ids, pairs)


def test_query_equals_all_pairs(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    fps, parts = expected(texts)
    rows = op6_simhash_anchors(spark, small).collect()
    assert {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in rows} == {i: (fps[i], parts[i]) for i in texts} and len(rows) == len(texts)


@pytest.mark.parametrize("most", [4, 5])
def test_links_join_exactly_what_is_near(spark, most):
    random.seed(5)
    values = set()
    for _ in range(40):
        x = random.getrandbits(64)
        values.add(x)
        for _ in range(12):
            y = x
            for b in random.sample(range(64), random.choice([1, 2, 3, 4, 5, 6])):
                y ^= 1 << b
            values.add(y)
    signed = {v - (1 << 64) if v >> 63 else v: v for v in values}
    found = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), most).collect()
    got = brute.components(signed, [(r.a, r.b) for r in found])
    keys = sorted(signed)
    want = brute.components(signed, [(a, b) for i, a in enumerate(keys) for b in keys[i + 1:] if (signed[a] ^ signed[b]).bit_count() <= most])
    assert got == want and all((signed[r.a] ^ signed[r.b]).bit_count() <= most for r in found)


def test_anchors_are_a_perfect_covering():
    table = simhash._replicas()
    assert len(table) == 32 and all(len(x) == 156 for x in table)


def test_null_empty_ties_and_repeats(spark):
    rows = [(5, None), (3, ""), (9, " \n"), (2, "One two"), (1, "one  TWO"), (1, "one  TWO"), (None, "x y z"), (7, "z" * 50_000), (8, "é w " * 9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = sorted(((r.doc_id, r.component_id) for r in simhash.component_ids(docs).collect()), key=str)
    assert out == sorted([(5, 3), (3, 3), (9, 3), (2, 1), (1, 1), (1, 1), (None, None), (7, 7), (8, 8)], key=str)
    assert simhash.component_ids(docs.limit(0)).count() == 0
    kept = simhash.one_of_each(docs.withColumn("fp", F.lit("own"))).collect()
    assert sorted((r.doc_id for r in kept), key=str) == sorted([3, 1, None, 7, 8], key=str) and all(r.fp == "own" for r in kept)
    assert simhash.one_of_each(docs.limit(0)).count() == 0
