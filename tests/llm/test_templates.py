"""Decontamination against a plain search for whole passages, and re-parameterised copies."""

import re

from meterbook.llm import templates
from meterbook.llm.queries import op9_template_decontamination

ITEM = "A train leaves the old station at 9 and travels with Alice for 120 km until it reaches the other town after 3 hours of rain"


def pairs(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc_id, r.item_id) for r in templates.contaminated(docs, bench).collect()}


def test_query_finds_whole_passages(spark, small):
    words = lambda t: " " + " ".join(re.findall(r"[^\W_]+", (t or "").lower())) + " "
    docs = {r.doc_id: words(r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    items = {r.item_id: words(r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()}
    whole = {(d, i) for d, t in docs.items() for i, p in items.items() if p in t}
    found = {(r.doc_id, r.item_id): r for r in op9_template_decontamination(spark, small).collect()}
    assert whole and whole <= set(found)
    for (d, i), r in found.items():  # what else is found shares half of the item's windows of eight words
        item, doc = items[i].split(), docs[d]
        shared = sum(" " + " ".join(item[k:k + 8]) + " " in doc for k in range(len(item) - 7))
        assert (d, i) in whole or shared >= 0.3 * (len(item) - 7)


def test_new_parameters_are_seen_and_inconsistent_ones_are_not(spark):
    other = ITEM.replace("9", "11").replace("Alice", "Bob").replace("120 km", "75 miles").replace("3", "4.5")
    twice = "If there are 5 red boxes and 5 blue boxes on a table then how many boxes stand on the whole table with 5 more"
    bad = twice.replace("5 red", "6 red").replace("5 blue", "7 blue")
    good = twice.replace("5", "12")
    found = pairs(spark, [ITEM, f"Some words before. {other} And some after", bad, good, "nothing of the kind", None, ""], [ITEM, twice, "too short item", None])
    assert found == {(0, 0), (1, 0), (3, 1)}


def test_short_items_repeats_and_empty_tables(spark):
    assert pairs(spark, ["we saw six small green frogs today", "six small green"], ["six small green frogs today"]) == {(0, 0)}
    docs = spark.createDataFrame([(1, ITEM, "x"), (1, ITEM, "x"), (None, ITEM, "y"), (2, "clean", "z")], "doc_id long, text string, hash string")
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert [r.doc_id for r in templates.clean_documents(docs, bench).collect()] == [2]
    assert templates.clean_documents(docs, bench).columns == docs.columns
    assert templates.clean_documents(docs, bench.limit(0)).count() == 4 and templates.clean_documents(docs.limit(0), bench).count() == 0


def test_each_occurrence_is_judged_by_itself(spark):
    other = ITEM.replace("9", "11").replace("Alice", "Bob").replace("120 km", "75 miles").replace("3", "4.5")
    longer = ITEM.replace("9", "7").replace("Alice", "Mary Ann")
    bad = "If there are 6 red boxes and 7 blue boxes on a table then how many boxes stand on the whole table with 8 more"
    twice = bad.replace("6", "5").replace("7", "5").replace("8", "5")
    refrain = "We add 3 to the sum of all the numbers and then we add 4 to the sum of all the numbers and stop there"
    texts = [f"{ITEM}. {other}.", f"{other}. Then more of it. {longer}. {ITEM}.", f"{bad}. {twice}", f"{bad}. {bad.replace('6', '9')}", refrain, refrain.replace("3", "5").replace("4", "6")]
    assert pairs(spark, texts, [ITEM, twice, refrain]) == {(0, 0), (1, 0), (2, 1), (4, 2), (5, 2)}


def test_items_of_few_literal_words_and_first_words_in_running_text(spark):
    items = ["What is 15% of 80 dollars?", "What is the capital city of France?", "Alice bought some very old green apples there"]
    texts = [f"Question: {items[0]}", "What is 16% of 80 dollars?", f"Question: {items[1]}", f'They asked, "{items[1]}"', "And so What is the capital city of Spain",
             f"Then, {items[2]}", "Bob bought some very old green apples there", "what is 15 of 80"]
    assert pairs(spark, texts, items) == {(0, 0), (2, 1), (3, 1), (4, 1), (5, 2), (6, 2)}
