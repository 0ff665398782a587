"""Phrase collocations by set-oriented mining over relations of occurrences.

Texts are cut into words that have places; what breaks a text into pieces takes up a place too, so words of two pieces are never neighbours. The relation of
occurrences (piece, place, phrase), where `piece` is the number of the text that the pieces lie in, is a table, bucketed by piece and sorted by piece and place. Phrases of
the next length come from merging it with itself: rows of one text at adjacent places join, so neighbouring phrases of k - 1 words that overlap make one of k words. The pairs are counted, pairs that are too rare go, and what is left, semi-joined and under a number of its own, is the relation that the next length starts from.
The tables' buckets serve the joins, so an occurrence is shuffled once, when its text is dealt. Phrases that occur often enough are joined by broadcast
while there are BROADCAST_ROWS of them at most, and numbered one after the other. Beyond that only the most frequent words are, any other word's number is its hash, checked to be its
own, and a longer phrase's is its two parts' numbers side by side. A set of 64 bits in each of BROADCAST_ROWS rows then lets all occurrences of frequent phrases and few others into
the relation. These others are too rare at any length, so the counts that follow drop what came of them. Occurrences are never shuffled by phrase, and each relation is removed when
the next one is there.

A phrase's strength is the least of floor(SCALE * a * a / (l * r)) over its cuts into a first part and a rest, with a, l and r the counts of phrase and parts; of equals the earliest cut
counts. Candidates that lie in a longer phrase at least half as frequent are left out.

Null and empty texts have no words; a null language is `und`. Repeated rows count again. An empty table gives no rows. Ties in strength and count go by the phrase's bytes. A piece may be of any
length: its places are rows. Of the table's columns only the named ones are read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.storage import remove
from .shared import scratch, stored

LONGEST, LEAST, MOST = 3, 10, 2000
SCALE = 1_000_000
INSIDE = 50  # percent of a candidate's count that a longer phrase around it needs to replace it
#: About a hundred megabytes in every executor at most.
BROADCAST_ROWS = 1_000_000
#: For a million different numbers in a file.
DICTIONARY_BYTES = 8_000_000
BREAKS, BLANKS = "[.,;:!?\\n-\\r][ .,;:!?\\n-\\r]*", "[ \\t]+"
#: Stands between two pieces; no word has it.
BREAK = "."
#: Joins by piece and place take tables as they are bucketed, by piece alone, and as they are sorted.
_SETTINGS = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.legacy.bucketedTableScan.outputOrdering": "true"}


def _lowered(word: Column) -> Column:
    """A-Z in lower case; where all is ASCII the plain function does that. Few other words have such letters."""
    mixed = F.when(word.rlike("[A-Z]"), F.translate(word, ascii_uppercase, ascii_lowercase)).otherwise(word)
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(mixed)


def _texts(docs: DataFrame, lang: str, text: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def _places(text: Column) -> Column:
    """A text's words and breaks in order; words of one piece have nothing between them. Beside breaks there may be empty ones.

    Letters stay as they are: few words are not all ASCII, but most texts have one that is not.
    """
    single = F.when(F.contains(text, F.lit("  ")) | F.contains(text, F.lit("\t")), F.regexp_replace(text, BLANKS, " ")).otherwise(text)
    return F.split(F.regexp_replace(single, BREAKS, f" {BREAK} "), " ")


def _is_word(word: str) -> Column:
    return ~F.col(word).isin("", BREAK)


def count_words(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, phrase, n): every word and how often it occurs."""
    words = _texts(docs, lang, text).select("lang", F.explode(_places(F.col("text"))).alias("word")).filter(_is_word("word"))
    return words.groupBy("lang", _lowered(F.col("word")).alias("phrase")).agg(F.count(F.lit(1)).alias("n"))


def occurrences(docs: DataFrame, buckets: int, lang: str = "lang", text: str = "text") -> DataFrame:
    """(piece, at, lang, phrase): the words of all texts, dealt and sorted by text."""
    # in order of texts, which the table is to be sorted by: far fewer rows to sort than words, and these then come in order
    dealt = _texts(docs, lang, text).withColumn("piece", F.monotonically_increasing_id()).repartition(buckets, "piece").sortWithinPartitions("piece")
    places = dealt.select("piece", "lang", F.posexplode(_places(F.col("text"))).alias("at", "word")).filter(_is_word("word"))
    return places.select("piece", "at", "lang", _lowered(F.col("word")).alias("phrase"))


def _small(frequent: DataFrame, most: int) -> bool:
    return frequent.limit(most + 1).count() <= most


def _word_hash(words: DataFrame) -> Column:
    """A negative hash of (lang, phrase) that no two of the words share."""
    seed = 0
    hashed = lambda seed: F.xxhash64(F.lit(seed), "lang", "phrase").bitwiseOR(F.lit(-1 << 63))
    while not words.groupBy(hashed(seed).alias("id")).count().filter("count > 1").isEmpty():
        seed += 1
    return hashed(seed)


def _common(words: DataFrame, most: int) -> DataFrame:
    """The most frequent of the words, `most` at most; words of one count are all in or out."""
    counts = words.groupBy("n").count()  # each count takes more words than the one before: few rows, however many words there are
    upto = counts.withColumn("upto", F.sum("count").over(Window.orderBy(F.desc("n"))))
    least = upto.filter(F.col("upto") <= most).agg(F.min("n")).first()[0]
    return words.filter(F.lit(False) if least is None else F.col("n") >= least)


def _likely(rows: DataFrame, frequent: DataFrame, slots: int) -> DataFrame:
    """The rows with an id of `frequent`, and few others: a bit for each of these ids, 64 in each of `slots` rows, goes to every task."""
    def placed(df: DataFrame) -> DataFrame:
        return df.withColumn("place", F.xxhash64("id")).withColumns({
            "slot": F.pmod("place", F.lit(slots)), "bit": F.expr("shiftleft(1L, int(shiftrightunsigned(place, 58)))")})

    marks = placed(frequent).groupBy("slot").agg(F.bit_or("bit").alias("bits"))
    return placed(rows).join(F.broadcast(marks), "slot").filter(F.col("bits").bitwiseAND(F.col("bit")) != 0)


def _numbered(rows: DataFrame, frequent: DataFrame, keys: list[str], buckets: int, most: int, number: Column | None = None) -> DataFrame:
    """The relation (piece, at, id) of the rows whose keys are frequent, as a table bucketed by piece and sorted by piece and place.

    Rows come dealt by piece; a broadcast join leaves them so. Where frequent keys are too many for that, `number` makes ids of keys, and some rows of other keys may stay.
    """
    kept = rows.join(F.broadcast(frequent), keys) if number is None else _likely(rows.withColumn("id", number), frequent, max(1, most))
    name = f"meterbook_occurrences_{uuid.uuid4().hex}"
    table = kept.select("piece", "at", "id").write.bucketBy(buckets, "piece").sortBy("piece", "at")
    # hashes take up little room only where they are written as places in a list of them
    table.option("parquet.dictionary.page.size", DICTIONARY_BYTES).option("path", scratch(rows.sparkSession)).saveAsTable(name)
    return rows.sparkSession.table(name)


def _removed(relation: DataFrame) -> None:
    """Delete a relation's files; what was made of it is stored."""
    for folder in {file.rpartition("/")[0] for file in relation.inputFiles()}:
        remove(relation.sparkSession, folder)


def _adjacent(relation: DataFrame) -> DataFrame:
    """(piece, at, first, second): occurrences and what stands at the next place of their piece."""
    second = relation.select("piece", (F.col("at") - 1).alias("at"), F.col("id").alias("second"))
    return relation.select("piece", "at", F.col("id").alias("first")).join(second, ["piece", "at"])


@contextmanager
def _by_piece(spark: SparkSession) -> Iterator[None]:
    """The session's settings for joins of the tables of occurrences, for the time of mining."""
    before = {name: spark.conf.get(name) for name in _SETTINGS}
    for name, value in _SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def frequent_phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, lang: str = "lang", text: str = "text", broadcast_rows: int = BROADCAST_ROWS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, n) of all phrases of up to `longest` words that occur `least` times, and (lang, n) of all words."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = stored(count_words(docs, lang, text))
    totals = stored(counts.groupBy("lang").agg(F.sum("n").alias("n")))
    last = stored(counts.filter(F.col("n") >= least).withColumn("id", F.monotonically_increasing_id()))
    sizes, rows, number = [last], occurrences(docs, buckets, lang, text), None
    if not _small(last, broadcast_rows):
        common = F.broadcast(_common(last, broadcast_rows // 2).select("lang", "phrase", F.col("id").alias("known")))
        number = F.coalesce("known", _word_hash(counts))
        last = stored(last.drop("id").join(common, ["lang", "phrase"], "left").select("lang", "phrase", "n", number.alias("id")))
        rows = rows.join(common, ["lang", "phrase"], "left")
    with _by_piece(spark):
        relation = _numbered(rows, last.select("lang", "phrase", "id"), ["lang", "phrase"], buckets, broadcast_rows, number)
        for size in range(2, longest + 1):
            pairs = _adjacent(relation)
            often = pairs.groupBy("first", "second").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
            often = stored(often.withColumn("id", F.monotonically_increasing_id()))
            number = None if _small(often, broadcast_rows) else F.struct("first", "second")
            often = often if number is None else often.withColumn("id", number)
            first = last.select("lang", F.col("phrase").alias("start"), F.col("id").alias("first"))
            second = last.select(F.substring_index("phrase", " ", -1).alias("end"), F.col("id").alias("second"))
            last = stored(often.join(first, "first").join(second, "second").select("lang", F.concat_ws(" ", "start", "end").alias("phrase"), "n", "id"))
            sizes.append(last)
            done = relation
            if size < longest:
                relation = _numbered(pairs, often.select("first", "second", "id"), ["first", "second"], buckets, broadcast_rows, number)
            _removed(done)
    return reduce(DataFrame.unionByName, [p.select("lang", "phrase", F.lit(k).alias("size"), "n") for k, p in enumerate(sizes, 1)]), totals


def _words(start, length) -> Column:
    return F.array_join(F.slice("words", start, length), " ")


def strengths(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, size, a, l, r, score) of all phrases of several words, by their weakest cut; exact, in decimals of 38 digits."""
    candidates = phrases.filter("size > 1").withColumnRenamed("n", "a")
    cuts = candidates.withColumn("words", F.split("phrase", " ")).withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumns({"start": _words(F.lit(1), F.col("cut")), "rest": _words(F.col("cut") + 1, F.col("size") - F.col("cut"))})
    part = lambda name, count: phrases.select("lang", F.col("phrase").alias(name), F.col("n").alias(count))
    scored = cuts.join(part("start", "l"), ["lang", "start"]).join(part("rest", "r"), ["lang", "rest"])
    exact = lambda c: F.col(c).cast("decimal(16,0)")
    scored = scored.withColumns({"up": exact("a") * exact("a") * F.lit(SCALE).cast("decimal(7,0)"), "down": exact("l") * exact("r")})
    cut = F.struct(F.expr("up div down").alias("score"), "cut", "l", "r")
    return scored.groupBy("lang", "phrase", "size", "a").agg(F.min(cut).alias("cut")).select("lang", "phrase", "size", "a", "cut.l", "cut.r", "cut.score")


def _longest_around(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, around): the count of the most frequent longer phrase that the words of a phrase lie in."""
    inner = phrases.filter("size > 2").withColumn("words", F.split("phrase", " "))
    inner = inner.withColumn("length", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    inner = inner.withColumn("start", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)))
    return inner.select("lang", _words(F.col("start"), F.col("length")).alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("around"))


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, most: int = MOST, lang: str = "lang", text: str = "text", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's strongest phrases; n counts its words."""
    phrases, totals = frequent_phrases(docs, longest, least, lang, text, broadcast_rows)
    scored = stored(strengths(phrases).join(_longest_around(phrases), ["lang", "phrase"], "left"))
    left = scored.filter(F.col("around").isNull() | (100 * F.col("around") < INSIDE * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = left.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
