"""Host rules against plain counting."""

import brute

from meterbook.llm import hosts
from meterbook.llm.queries import op3_host_rules

TEXTS = [
    None, "", " \n\t", "a b c", "x\ny\nx\n\n\nx \nx", "# * $ % & | < >", "w " * 100, " ".join(map(str, range(30))) + "\n" + " ".join(map(str, range(30))),
    "one word é𝒳 \x1cz", " ".join(f"a{i % 9}" for i in range(40)), " ".join(f"b{i}" for i in range(60)) + " b1 b2 b3 b4 b5 b6 b7 b8", "z" * 100_000,
]


def test_counts_equal_plain_counting(spark):
    docs = spark.createDataFrame([(i, t, "h", "k") for i, t in enumerate(TEXTS)], "doc_id long, text string, source string, kept string")
    rows = {r.doc_id: r for r in hosts.judge_hosts(docs).collect()}
    for i, text in enumerate(TEXTS):
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.quality_counts(text), i
        assert not (r.kept and r.base_failed)


def test_host_verdict_shrinks_small_hosts(spark):
    good, bad = " ".join(f"w{i}" for i in range(30)), "too short"
    rows = [(i, good, "fine") for i in range(200)] + [(1000 + i, bad if i else good, "junk") for i in range(60)] + [(2000, bad, "new"), (2001, good, "new"), (3000, good, None)]
    out = {r.doc_id: r for r in hosts.judge_hosts(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert out[0].kept and out[2001].kept and out[3000].kept
    assert not out[1000].kept and not out[1000].host_good and not out[1000].base_failed
    assert 0.0 < out[2000].host_rate < 0.5 < out[1000].host_rate and len(out) == len(rows)


def test_query_equals_brute_force(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = op3_host_rules(spark, small).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.quality_counts(texts[r.doc_id])


def test_empty_table(spark):
    assert hosts.judge_hosts(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0
