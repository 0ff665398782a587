"""Phrase mining against a plain version."""

import random
import re
from collections import Counter

import brute
import duckdb
import pytest
from pyspark.sql import functions as F

from meterbook.llm import phrases
from meterbook.llm.queries import PHRASES_SQL, op13_phrase_mining


def expected(rows, longest=3, least=10, most=2000):
    """rows: (lang, text)"""
    counts, words = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(brute.ASCII_LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(w[i:i + k])] += 1
    out = set()
    for lang, f in counts.items():
        often = {p: a for p, a in f.items() if a >= least and len(p) > 1}
        gone = set()
        for p, a in often.items():
            for k in range(2, len(p)):
                gone |= {p[i:i + k] for i in range(len(p) - k + 1) if 100 * a >= 50 * f[p[i:i + k]]}
        scored = []
        for p, a in often.items():
            if p not in gone:
                score, cut = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:cut]], f[p[cut:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:most], 1):
            out.add((lang, rank, p.decode(), -a, left, right, words[lang], -score))
    return out


def rows(df):
    got = [tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()]
    assert len(got) == len(set(got))
    return set(got)


def docs_of(spark, pairs):
    return spark.createDataFrame(pairs, "lang string, text string").repartition(3)


def test_query_equals_plain(spark, small):
    pairs = [(r.lang, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    want = expected(pairs)
    assert rows(op13_phrase_mining(spark, small)) == want and len(want) > 100
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    found = con.execute(PHRASES_SQL)
    names = [d[0] for d in found.description]
    assert {tuple(r[names.index(c)] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in found.fetchall()} == want


@pytest.fixture(scope="module")
def pairs():
    random.seed(8)
    made = [(random.choice(["en", "de", None, "und"]), "".join(
        random.choice(["a", "B", "c", "dd", "É", " x", "e\x00"]) + random.choice([" ", " ", "  ", "\t", ", ", ".\n", " ! ", ""]) for _ in range(random.randrange(60)))) for _ in range(120)]
    return [*made, ("en", None), ("en", ""), ("en", "..,, \n"), ("long", "w1 w2 w3 w4 " * 3000), *[("copies", "one two three. one two")] * 30]


@pytest.mark.parametrize("options", [{}, {"longest": 2}, {"longest": 4}, {"most": 3}, {"least": 2}])
def test_equals_plain_on_made_texts(spark, pairs, options):
    assert rows(phrases.collocations(docs_of(spark, pairs), **options)) == expected(pairs, **options)


def test_shuffled_joins_give_the_same(spark, pairs):
    assert rows(phrases.collocations(docs_of(spark, pairs), broadcast_rows=0)) == expected(pairs)


@pytest.mark.parametrize("broadcast_rows", [1, 3, 8])
@pytest.mark.parametrize("longest", [3, 4])
def test_more_frequent_phrases_than_are_broadcast(spark, pairs, longest, broadcast_rows):
    found = phrases.collocations(docs_of(spark, pairs), longest=longest, broadcast_rows=broadcast_rows)
    assert rows(found) == expected(pairs, longest=longest)


def test_occurrences_are_never_shuffled_by_phrase(spark, pairs, monkeypatch):
    plans, numbered = [], phrases._numbered

    def planned(rows, frequent, keys, buckets, most, number=None):
        relation = numbered(rows, frequent, keys, buckets, most, number)
        kept = rows.join(F.broadcast(frequent), keys) if number is None else phrases._likely(rows.withColumn("id", number), frequent, most)
        plans.append((number is not None, kept._jdf.queryExecution().optimizedPlan().toString()))
        return relation

    monkeypatch.setattr(phrases, "_numbered", planned)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # only what the code itself asks for
    try:
        assert rows(phrases.collocations(docs_of(spark, pairs), broadcast_rows=8)) == expected(pairs)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [large for large, _ in plans] == [True, True]
    words, pairs_of_words = (plan for _, plan in plans)
    assert words.count("Join") == words.count("strategy=broadcast") == 2 and words.count("RepartitionByExpression") == 1
    assert pairs_of_words.count("Join") == 2 and pairs_of_words.count("strategy=broadcast") == 1  # the other one is of the table's buckets


def test_few_other_rows_pass_and_all_frequent_ones_do(spark):
    ids = spark.range(100_000).select(F.xxhash64("id").alias("id"), (F.col("id") < 5_000).alias("often"))
    passed = phrases._likely(ids, ids.filter("often").select("id"), 1_000)
    found = {r["often"]: r["count"] for r in passed.groupBy("often").count().collect()}
    assert found[True] == 5_000 and found[False] < 0.1 * 95_000  # 64,000 bits


def test_words_whose_hashes_collide_get_other_ones(spark, monkeypatch):
    words = spark.createDataFrame([("en", "a"), ("en", "b"), ("en", "c")], "lang string, phrase string")
    plain, seeds = F.xxhash64, []

    def colliding(seed, *columns):
        seeds.append(seed)
        return F.lit(7).cast("long") if len(seeds) == 1 else plain(seed, *columns)

    monkeypatch.setattr(phrases.F, "xxhash64", colliding)
    hashes = [r[0] for r in words.select(phrases._word_hash(words)).collect()]
    assert len(set(hashes)) == 3 and all(h < 0 for h in hashes) and len(seeds) == 3


def test_common_words_are_the_most_frequent_within_the_limit(spark):
    words = spark.createDataFrame([("a", 9), ("b", 7), ("c", 5), ("d", 5), ("e", 3)], "phrase string, n long")
    common = lambda most: "".join(sorted(r.phrase for r in phrases._common(words, most).collect()))
    assert [common(most) for most in (0, 1, 2, 3, 4, 9)] == ["", "a", "ab", "ab", "abcd", "abcde"]


def test_products_beyond_64_bits(spark):
    big = 4_000_000_000_000
    found = phrases.strengths(spark.createDataFrame(
        [("x", "a", 1, big), ("x", "b", 1, big), ("x", "a b", 2, big - 1)], "lang string, phrase string, size int, n long")).collect()
    assert [(r.score, r.l, r.r) for r in found] == [(1000000 * (big - 1) ** 2 // (big * big), big, big)]


def test_joins_use_the_buckets(spark, pairs):
    with phrases._by_piece(spark):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            occurrences = phrases.occurrences(docs_of(spark, pairs), 4).withColumn("id", F.xxhash64("phrase"))
            words = occurrences.select("lang", "phrase", "id").distinct()
            relation = phrases._numbered(occurrences.drop("id"), words, ["lang", "phrase"], 4, 10_000)
            plan = phrases._adjacent(relation)._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan
    assert plan.count("Sort [") == 1  # the side that is moved by one place; the other one is read in its order
    assert [spark.conf.get(name) for name in phrases._SETTINGS] == ["true", "false"]


def test_empty_table_and_clashing_columns(spark):
    assert phrases.collocations(docs_of(spark, [("en", "a")]).limit(0)).collect() == []
    extra = docs_of(spark, [("en", "x y. " * 20)]).withColumns({n: F.lit(1) for n in ("piece", "at", "id", "phrase", "n", "rank", "first", "second", "words", "cut")})
    assert rows(phrases.collocations(extra)) == expected([("en", "x y. " * 20)])


def test_words_come_in_the_order_that_tables_are_sorted_by(spark):
    docs = docs_of(spark, [("en", f"a b, c{n % 7} d; e f g") for n in range(300)])
    words = phrases.occurrences(docs, 5)
    plan = words._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Sort [piece") > plan.index("Generate posexplode")
    placed = words.withColumn("part", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id()).collect()
    by_part = {}
    for r in sorted(placed, key=lambda r: r.row):
        by_part.setdefault(r.part, []).append((r.piece, r.at))
    assert len(by_part) > 1 and all(v == sorted(v) for v in by_part.values())


def test_texts_are_dealt_whole_and_breaks_part_their_words(spark):
    made = [("en", "Ab  c\t d,e .. ÉTÉ Ünter\n\x0b!?f"), ("en", "\t, ,"), ("en", None), ("de", " a  b ")]
    words = phrases.occurrences(docs_of(spark, made), 3)
    plan = words._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate posexplode") < plan.index("RepartitionByExpression") and plan.count("Generate") == 1  # no row per piece is shuffled
    runs = {}
    for r in sorted(words.collect(), key=lambda r: (r.piece, r.at)):
        of_text = runs.setdefault((r.lang, r.piece), [])
        if of_text and of_text[-1][0] + 1 == r.at:
            of_text[-1] = (r.at, [*of_text[-1][1], r.phrase])
        else:
            of_text.append((r.at, [r.phrase]))
    assert sorted((lang, [run for _, run in found]) for (lang, _), found in runs.items()) == [
        ("de", [["a", "b"]]), ("en", [["ab", "c", "d"], ["e"], ["ÉtÉ", "Ünter"], ["f"]])]
    assert {(r.lang, r.phrase): r.n for r in phrases.count_words(docs_of(spark, made)).collect()} == {
        ("de", "a"): 1, ("de", "b"): 1, **{("en", w): 1 for w in ("ab", "c", "d", "e", "ÉtÉ", "Ünter", "f")}}
