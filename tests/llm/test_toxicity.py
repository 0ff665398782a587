"""Toxicity: the automaton against edit distances, context, held-out accuracy."""

import random

from meterbook.llm import toxicity
from meterbook.llm.queries import op8_toxicity


def edits(a, b):
    """Least number of letters added, left out, changed, or swapped with their neighbours."""
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(rows[-1][j] + 1, row[j - 1] + 1, rows[-1][j - 1] + (x != y)))
            if i > 1 and j > 1 and x == b[j - 2] and y == a[i - 2]:
                row[j] = min(row[j], rows[-2][j - 2] + 1)
        rows.append(row)
    return rows[-1][-1]


def test_automaton_equals_edit_distance():
    random.seed(4)
    words = {"".join(random.choice("abc") for _ in range(random.randint(3, 8))): random.random() for _ in range(40)}
    lexicon = toxicity.Lexicon(words, {})
    for _ in range(1500):
        word = "".join(random.choice("abc") for _ in range(random.randint(2, 9)))
        near = [(edits(word, t), -w) for t, w in words.items() if edits(word, t) == 0 or edits(word, t) == 1 and len(t) >= toxicity.LEAST_FUZZY]
        weight, found = lexicon.trie.best(word)
        assert (found, -weight) == min(near, default=(2, -0.0))
        assert not near or min(near)[0] == 0 or lexicon.trie.near(word)


def test_misspelled_stems_and_quotation():
    lexicon = toxicity.Lexicon({"scoundrel": 1.0, "fool": 0.8}, {"vilif": 0.9})
    assert lexicon.look("scoundrel") == (1.0, 0) and lexicon.look("scoundrle") == (1.0, 1) and lexicon.look("scondrel") == (1.0, 1)
    assert lexicon.look("sc0undrel") == (1.0, 0) and lexicon.look("sc0undrels") == (1.0, 1) and lexicon.look("vilification") == (0.9, 2) and lexicon.look("foul") is None
    plain = toxicity.features("You are a scoundrel and more", lexicon)
    quoted = toxicity.features('They said "scoundrel" once and more', lexicon)
    assert plain[0] > quoted[0] > 0 and toxicity.features("Nothing here", lexicon) == [0.0] * toxicity.FEATURES == toxicity.features("", lexicon)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = op8_toxicity(spark, folder).join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 40 and sum(r.predicted == r.toxic for r in rows) >= 0.95 * len(rows)


def test_odd_texts_and_missing_labels(spark):
    docs = spark.createDataFrame(
        [(i, "what a scoundrel that is" if i % 3 == 0 else f"a fine day number {i} that is", "s") for i in range(90)]
        + [(100, None, "s"), (101, "", "s"), (102, "z" * 200_000, "s"), (103, "what a scoundrle that is, scoundrell", "s"), (None, "scoundrel", "s"), (3, "what a scoundrel that is", "s")],
        "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(90)] + [(5, 1, None)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels)
    rows = toxicity.score_toxicity(docs, model).collect()
    assert len(rows) == 96 and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0
    none = toxicity.score_toxicity(docs, toxicity.train(docs, labels.limit(0))).collect()
    assert len({r.score for r in none}) == 1


def test_swapped_letters_are_found_wherever_they_are():
    lexicon = toxicity.Lexicon({"scoundrel": 1.0, "worthless": 0.9, "villains": 0.8}, {"despic": 0.7})
    for word, weight in (("scoundrel", 1.0), ("villains", 0.8), ("despic", 0.7)):
        for i in range(len(word) - 1):
            if word[i] != word[i + 1]:
                assert lexicon.look(word[:i] + word[i + 1] + word[i] + word[i + 2:]) == (weight, 1), (word, i)
    assert lexicon.look("wrothless") == (0.9, 1) and lexicon.look("dsepicable") == (0.7, 1) and lexicon.look("csodunrel") is None


def test_stems_are_found_misspelled_and_disguised():
    lexicon = toxicity.Lexicon({"scoundrel": 1.0, "vilifying": 0.7}, {"vilif": 0.9, "fool": 0.8})
    assert lexicon.look("v1lification") == (0.9, 2) and lexicon.look("vilofication") == (0.9, 1) and lexicon.look("f00lish") == (0.8, 2)
    assert lexicon.look("vilfication") == (0.9, 1) and lexicon.look("villification") == (0.9, 1) and lexicon.look("vilifyinq") == (0.9, 2)
    assert lexicon.look("vilifying") == (0.7, 0) and lexicon.look("foliage") is None and lexicon.look("village") is None


def test_stem_automaton_equals_edit_distance_of_beginnings():
    random.seed(6)
    stems = {"".join(random.choice("abcd") for _ in range(random.randint(4, 6))): random.random() for _ in range(25)}
    lexicon = toxicity.Lexicon({}, stems)
    for _ in range(1500):
        word = "".join(random.choice("abcd") for _ in range(random.randint(3, 9)))
        least = [(min(edits(word[:n], t) for n in range(len(word) + 1)), -w, t) for t, w in stems.items()]
        near = [(e, w) for e, w, t in least if e == 0 or e == 1 and len(t) >= toxicity.LEAST_FUZZY]
        weight, found = lexicon.trie.best_stem(word)
        assert (found, -weight) == min(near, default=(2, -0.0))
        assert not near or lexicon.trie.near_stem(word)
