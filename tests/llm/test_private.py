"""Personal data: the fixed forms against a plain search, and what contexts discover."""

import random

import brute

from pyspark.sql import functions as F

from meterbook.llm import private
from meterbook.llm.queries import op1_private_data

TEXTS = [
    None, "", "a@b.c", "a@b a@c.d x@y.z_q@w.e", "..a@b.c.d.-@e.f.", "é@b.c 𝒳a@b.com 1.2.3.4", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.3.255 0000255.1.1.1",
    "4111 1111 1111 1111 and 4111-1111-1111-1112", "4111111111111111 4 4111 1111 1111 1111", "+1 (476) 555-5473. +49 30 1234567- +1 2", "+1+1 23456789012",
    "x\x01y@z.com \x01 9.9.9.9", "1 " * 5000, "a" * 50_000, "9" * 50_000, "a.b@c.d " * 2000, "+1" + " (" * 3000, "​1.1.1.1", "a@b.c,d@e.f;mailto:g@h.i",
]


def test_fixed_forms_equal_a_plain_search(spark):
    random.seed(3)
    texts = TEXTS + ["".join(random.choice("1234 .-+@ab()é\n") for _ in range(400)) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in private.extract_private(docs).collect()}
    for i, text in enumerate(texts):
        got = ",".join(f"{private.KINDS[s['rank']]}:{s.start}:{s.end}" for s in rows[i].base)
        assert got == brute.private_base(text)[2], text[:80]


def test_contexts_discover_unseen_identifiers(spark):
    texts = [f"Please dial hotline +1 (476) 555-{1000 + i} today" for i in range(12)] + ["You may dial hotline 555-0199, or not", "see room 555-0123 there"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in private.extract_private(docs).collect()}
    assert [(texts[12][s.start:s.end], private.KINDS[s["rank"]]) for s in rows[12].added] == [("555-0199", "phone")]
    assert not rows[13].added and all(not rows[i].added for i in range(12))


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a@b.c"), (1, "a@b.c"), (1, "d@e.ff 1.1.1.1"), (None, "a@b.c"), (None, None)], "doc_id long, text string")
    rows = private.extract_private(docs).collect()
    assert sorted((r.doc_id or 0, len(r.base)) for r in rows) == [(0, 0), (0, 1), (1, 1), (1, 1), (1, 2)]
    assert private.extract_private(docs.limit(0)).count() == 0


def test_query_equals_brute_force(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = op1_private_data(spark, small).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        counts, digest, joined = brute.private_base(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts and r.base_sha256 == digest
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))


def test_discovered_identifiers_induce_patterns(spark):
    texts = [f"Please dial hotline +1 (476) 555-{1000 + i} today" for i in range(60)]
    texts += [f"You may dial hotline 555-02{k:02d} now" for k in range(20)] + [f"It is my extension 555-02{k:02d}" for k in range(20)]
    texts += ["It was his extension 555-0999", "It was his room 555-0998"]  # no seed ever stands behind "extension"
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in private.extract_private(docs).collect()}
    assert [texts[100][s.start:s.end] for s in rows[100].added] == ["555-0999"] and not rows[101].added


def test_long_words_and_long_neighbours(spark):
    word, near = "User" + "x" * 70 + "1", "n" * 200
    texts = [word, word.upper(), f"{near} {word} {near} tail"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("found", private.occurrences(F.col("text")))
    found = {r.doc_id: r.found for r in docs.collect()}
    assert len({f[0].instance for f in found.values()}) == 1
    assert set(found[2][0].patterns) == {f"before {near}", f"after {near}"}
