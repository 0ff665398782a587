"""Training samples: distinct labelled texts up to the bound, nothing held out."""

import zlib

from meterbook.llm.samples import FOLDS, HELD_OUT, training_sample


def sample(spark, texts, most=1000, marks=None):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, (marks or {}).get(i, i % 2)) for i in range(len(texts))], "doc_id long, toxic int")
    return training_sample(docs, labels, "toxic", most).collect()


def free(n):
    return [i for i in range(n) if zlib.crc32(str(i).encode()) % FOLDS != HELD_OUT]


def test_texts_that_share_a_word_stay(spark):
    rows = sample(spark, [f"they are w{i} v{i} u{i}" for i in range(200)])
    assert sorted(r.doc_id for r in rows) == free(200) and {r.label for r in rows} == {0, 1}
    assert all(r.text == f"they are w{r.doc_id} v{r.doc_id} u{r.doc_id}" and r.label == r.doc_id % 2 for r in rows)


def test_equal_texts_of_one_label_are_one_and_the_bound_counts_distinct_texts(spark):
    texts = ["Same  text\n" if i % 3 else f"own text {i}" for i in range(150)] + [" same text"] * 10 + [None]
    rows = sample(spark, texts)
    own = [i for i in free(150) if i % 3 == 0]
    assert len(rows) == len(own) + 2 and {r.doc_id for r in rows} >= set(own)
    assert sorted(r.label for r in rows if "own" not in r.text) == [0, 1]
    assert len(sample(spark, texts, len(own))) == len(own)
