"""The line model: forward-backward against enumeration, held-out accuracy, odd texts."""

import itertools

import numpy as np
from pyspark.sql import functions as F

from meterbook.llm import line_crf
from meterbook.llm.queries import op4_line_quality


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    emission, chain = rng.normal(size=(3, 5)), rng.normal(size=(2, 2))
    lengths = [5, 3, 1]
    mask = np.arange(5)[None, :] < np.array(lengths)[:, None]
    good, pairs, total = line_crf.marginals(emission * mask, mask, chain)
    want_pairs = np.zeros((2, 2))
    for d, n in enumerate(lengths):
        weight, on, links = 0.0, np.zeros(n), np.zeros((2, 2))
        for labels in itertools.product((0, 1), repeat=n):
            w = np.exp(sum(emission[d, t] * labels[t] for t in range(n)) + sum(chain[a, b] for a, b in zip(labels, labels[1:])))
            weight, on = weight + w, on + w * np.array(labels)
            for a, b in zip(labels, labels[1:]):
                links[a, b] += w
        assert np.allclose(good[d, :n], on / weight) and np.isclose(total[d], np.log(weight))
        want_pairs += links / weight
    assert np.allclose(pairs, want_pairs) and not good[1, 3:].any()


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = op4_line_quality(spark, folder).join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 40 and sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)


def test_odd_texts_ties_and_missing_labels(spark):
    good = "Plain words make a line of text that reads well.\nAnother one follows it here."
    bad = "@@## $$$ %%% &&& ||| <<< ###\n!!! !!! !!! *** ### $$$"
    docs = spark.createDataFrame(
        [(i, good if i % 2 else bad, "s") for i in range(60)] + [(100, None, "s"), (101, "", "s"), (102, "\n \n", "s"), (103, "x" * 200_000, "s"), (104, "a\n" * 30_000, "s"), (None, good, "s"), (1, good, "s")],
        "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(3, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    scores = {r.doc_id: r.score for r in line_crf.judge(docs, labels).collect()}
    assert all((scores[i] >= 0.5) == bool(i % 2) for i in range(60)) and all(0 <= s <= 1 for s in scores.values())
    kept = line_crf.good_documents(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.filter("doc_id < 60").collect()} == set(range(1, 60, 2))
    assert kept.filter("doc_id = 1").count() == 2 and kept.filter(F.col("score") != "s").isEmpty()
    none = line_crf.judge(docs, labels.filter("quality = 1"))
    assert none.agg(F.count_distinct("score")).first()[0] == 1
    assert line_crf.judge(docs.limit(0), labels).count() == 0 and line_crf.judge(docs, labels.limit(0)).count() == docs.count()
