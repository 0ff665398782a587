"""Benchmark decontamination by templates.

Numbers, names and units are replaced by typed placeholders; what is left of a question is its template, and a re-parameterised copy has the same one.
Windows of eight template words of the documents meet those of the benchmark in a hash join. Before it, a bit set of fixed size over the benchmark's windows
goes to every task and lets nearly only true candidates into the shuffle; the join decides. The values in the placeholders are then held against each
other per occurrence: a value of the benchmark must stand for one value wherever it occurs in it. Hits whose place in the document less that in the item is
the same, or nearly the same, are one occurrence, and all of the document's are one too; of several hits of an item's window the one with most hits at its
distance counts. A document is contaminated by an item if in any occurrence half of the item's windows, or a run's worth of them, are found and the values agree.

Numbers: tokens of digits, with separators. Units: a known unit right after a number, and signs for money and percent. Names: capitalised words that do not
begin a sentence; the first word of an item may stand anywhere in a document, so it is read both as it is and as a name. Windows with fewer than five literal
words say too little and are left out; an item that has no other is looked for by its very words. Items with fewer than eight words are one shorter
window; items under five words cannot be told from common phrases and match nothing.

Equal texts are judged once, by a 64-bit hash of the text, and so are values in placeholders told apart. Null and empty texts match nothing. Repeated rows give one result per id, text and item. Null ids are kept as null.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from .shared import portions, stored

WINDOW, LEAST = 8, 5
COVERAGE, RUN, AGREEMENT = 0.5, 20, 0.8
FILTER_BITS = 24  # two megabytes in every task, whatever the benchmark's size

TOKEN = re.compile(r"[.!?\n]|\d+(?:[.,:/]\d+)*|[^\W\d_]+(?:['’][^\W\d_]+)?|[%$€£¥°]")
#: Words that are units when they follow a number. A plain list.
UNITS = frozenset((
    "mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms ton tons lb lbs pound pounds oz ounce ounces ml l liter liters "
    "litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years mph kph hz khz mhz ghz w kw "
    "watt watts v volt volts amp amps j joule joules kj cal kcal pa kpa bar k c f degree degrees percent dollar dollars cent cents euro euros eur usd gbp").split())
MARKS, SIGNS = frozenset(".!?\n"), frozenset("%$€£¥°")
NUMBER, NAME, UNIT = 8, 16, 24  # codes of the placeholders; literal words have larger multiples of eight
CAPITAL, DIGIT, MEASURE, SIGN = 1, 2, 4, 3
TEMPLATE, FIRST, EXACT = 0, 64, 128  # added to the size that a hash begins with: another reading of the first word, and the very words
SHIFT = 4  # places that an occurrence may be off by where a name or number has more words; windows of other copies are at least five away
CACHE = 200_000
TOKENS = 20_000  # of short texts that are read together


class Codes(dict):
    """Token to a stable number whose low bits say what the token may be; 0 for the end of a sentence."""

    def __missing__(self, token: str) -> int:
        if len(self) > CACHE:
            self.clear()
        if token in MARKS:
            code = 0
        else:
            low = token.lower()
            code = (xxhash.xxh64_intdigest(low.encode(), 11) >> 4 << 3) + 64
            if token[0].isdigit():
                code |= DIGIT
            elif token in SIGNS:
                code |= SIGN
            else:
                code |= CAPITAL * token[0].isupper() | MEASURE * (low in UNITS)
        self[token] = code
        return code


def template(tokens: list[str], codes: Codes) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the words, with placeholders, the words, their codes without placeholders, which are capitalised, and their tokens' places."""
    code = np.fromiter(map(codes.__getitem__, tokens), np.uint64, len(tokens))
    mark, kind = code == 0, code & np.uint64(7)
    after_mark = np.concatenate(([True], mark[:-1])) if len(code) else mark
    number, sign = kind == DIGIT, kind == SIGN
    after_number = np.concatenate(([False], number[:-1])) if len(code) else number
    exact = code >> np.uint64(3) << np.uint64(3)
    plain, capital = exact.copy(), (kind & CAPITAL).astype(bool) & ~sign
    plain[capital & ~after_mark] = NAME
    plain[(kind & MEASURE).astype(bool) & after_number] = UNIT
    plain[number] = NUMBER
    plain[sign] = UNIT
    keep = np.flatnonzero(~mark)
    return plain[keep], [tokens[i] for i in keep] if len(keep) < len(tokens) else tokens, exact[keep], capital[keep], keep


def windows(code: np.ndarray, size: int, first: np.ndarray | None = None, sort: int = TEMPLATE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows of a size and which of them have enough literal words; first: other codes for their first words."""
    n = len(code) - size + 1
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    first = code if first is None else first
    value = np.full(n, size + sort, np.uint64)
    for k in range(size):
        value = (value ^ (code[k:k + n] if k else first[:n])) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(31)
    literal = np.concatenate(([0], np.cumsum(code > UNIT)))
    count = literal[size:] - literal[:-size] + (first[:n] > UNIT) - (code[:n] > UNIT).astype(int)
    return value, count >= min(LEAST, size)


def _slots(code: np.ndarray, words: list[str], at: int, size: int, first: np.ndarray | None = None) -> list[int]:
    """A number for the kind and the value of each placeholder; values are only told apart."""
    kind = [(code if first is None else first)[at], *code[at + 1:at + size]]
    return [xxhash.xxh64_intdigest(f"{c}:{words[i].lower()}".encode()) - (1 << 63) for i, c in enumerate(kind, at) if c <= UNIT]


SCHEMA = "place int, hash long, slots array<long>"


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codes = Codes()
    for batch in batches:
        rows = []
        for key, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
            code, words, exact, *_ = template(TOKEN.findall(text or ""), codes)
            if len(code) < LEAST:
                continue
            size = min(WINDOW, len(code))
            value, good = windows(code, size)
            number = lambda x: int(x.view(np.int64))
            if not good.any():
                value, _ = windows(exact, size, sort=EXACT)
                rows += [(key, i, number(v), [], size, len(value), True) for i, v in enumerate(value)]
                continue
            rows += [(key, int(i), number(value[i]), _slots(code, words, i, size), size, int(good.sum()), False) for i in np.flatnonzero(good)]
            # the first word as it is and as a name; the value of such a name is held against others only where nothing else can tell
            head, named = code[:size], np.full(1, NAME, np.uint64)
            for first, sorts in ((code[:1], (FIRST,)), (named, (TEMPLATE, FIRST))):
                slots = _slots(head, words, 0, size, first)
                slots = [None, *slots[1:]] if first is named and len(value) > 1 else slots
                for sort in sorts:
                    other, enough = windows(head, size, first, sort)
                    rows += [(key, 0, number(other[0]), slots, size, int(good.sum()), False)] if enough[0] and good[0] else []
        names = ["item", "place", "hash", "slots", "size", "windows", "by_words"]
        kinds = [batch.schema.field("item").type, pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.int32(), pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def benchmark_windows(benchmark: DataFrame, id: str = "item_id", text: str = "text") -> DataFrame:
    kind = benchmark.schema[id].dataType.simpleString()
    return benchmark.select(F.col(id).alias("item"), F.col(text).alias("text")).mapInArrow(_item_windows, f"item {kind}, {SCHEMA}, size int, windows int, by_words boolean")


def _bit_set(items: DataFrame) -> np.ndarray:
    """One bit per hash prefix of the benchmark's windows; at most 2^FILTER_BITS / 64 words come to the driver."""
    prefix = F.shiftrightunsigned("hash", 64 - FILTER_BITS)
    words = items.select(F.shiftright(prefix, 6).alias("word"), F.expr(f"shiftleft(1L, int(shiftrightunsigned(hash, {64 - FILTER_BITS}) & 63))").alias("bit"))
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for r in words.groupBy("word").agg(F.bit_or("bit").alias("bits")).collect():
        out[r["word"]] = r["bits"]
    return out.view(np.uint64)


def contaminated(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, text_key, item_id, found, windows, coverage, agreement) of the documents that hold an item or a re-parameterised copy of it."""
    items = stored(benchmark_windows(benchmark, item_id, item_text))
    spark = docs.sparkSession
    bits = spark.sparkContext.broadcast(_bit_set(items))
    sizes = sorted((r["size"], r["by_words"]) for r in items.select("size", "by_words").distinct().collect())

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, known = Codes(), bits.value

        def hits(tokens: list[str], ends: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[list[str]]]]:
            """Which text, place, hash and slots of the windows that may be the benchmark's; the texts' tokens stand in one list, a mark after each."""
            code, words, exact, capital, keep = template(tokens, codes)
            text = np.searchsorted(np.array(ends), keep, side="right")
            start = np.searchsorted(text, np.arange(len(ends)))
            other = np.where(code == NAME, exact, np.uint64(NAME))
            for size, by_words in sizes:
                n = len(code) - size + 1
                if n < 1:
                    continue
                inside = text[:n] == text[size - 1:]
                readings = [(*windows(exact, size, sort=EXACT), None)] if by_words else [
                    (*windows(code, size), code), (*windows(code, size, other, FIRST), other)]
                for hashes, good, first in readings:
                    good = inside if first is None else good & inside & capital[:n] if first is other else good & inside
                    prefix = hashes >> np.uint64(64 - FILTER_BITS)
                    hit = good & ((known[(prefix >> np.uint64(6)).astype(np.int64)] >> (prefix & np.uint64(63))) & np.uint64(1)).astype(bool)
                    at = np.flatnonzero(hit)
                    yield text[at], at - start[text[at]], hashes[at].view(np.int64), [[] if first is None else _slots(code, words, int(k), size, first) for k in at]

        for batch in portions(batches):
            texts = batch.column("text").to_pylist()
            tokens, ends, done = [], [], 0
            row, place, value, slots = [], [], [], []
            for i, text in enumerate(texts):
                tokens += TOKEN.findall(text or "")
                tokens.append("\n")
                ends.append(len(tokens))
                if len(tokens) >= TOKENS or i == len(texts) - 1:
                    for which, at, hashes, values in hits(tokens, ends):
                        row += (which + done).tolist()
                        place += at.tolist()
                        value += hashes.tolist()
                        slots += values
                    tokens, ends, done = [], [], i + 1
            take = pa.array(row, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("text_key").take(take), pa.array(place, pa.int32()), pa.array(value, pa.int64()), pa.array(slots, pa.list_(pa.int64()))],
                names=["text_key", "place", "hash", "slots"])

    text_key = F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_key")
    # windows of equal texts are the same rows: they become one before the first shuffle
    found = docs.select(text_key, F.col(text).alias("text")).mapInArrow(candidates, f"text_key long, {SCHEMA}").distinct()
    pairs = stored(found.join(items.withColumnsRenamed({"place": "item_place", "slots": "item_slots"}), "hash"))
    key = ["text_key", "item"]
    # two readings of one window: the one with fewer slots
    hits = pairs.withColumn("distance", F.col("place") - F.col("item_place")).groupBy(*key, "distance", "item_place").agg(
        F.max("windows").alias("windows"), F.max("size").alias("size"),
        F.min_by(F.arrays_zip("item_slots", "slots"), F.struct(F.size("slots"), "item_slots", "slots")).alias("values"))
    # occurrences: hits at one distance, chains of distances by small steps or by half of the item, and all hits of the document
    near = Window.partitionBy(*key).orderBy("distance")
    step = F.col("distance") - F.col("before")
    half = F.greatest(F.lit(SHIFT), F.floor((F.col("windows") + F.col("size")) / 2).cast("int"))
    chain = lambda most: F.sum(F.when(step > most, 1).otherwise(0)).over(near).cast("int")
    placed = (
        hits.withColumn("same", F.count(F.lit(1)).over(Window.partitionBy(*key, "distance")))
        .withColumn("before", F.lag("distance").over(near))
        .withColumn("of", F.array(F.col("distance"), chain(F.lit(SHIFT)), chain(half), F.lit(0))))
    one = (
        placed.select(*key, "item_place", "windows", "distance", "same", "values", F.posexplode("of").alias("kind", "part"))
        .groupBy(*key, "kind", "part", "item_place")
        .agg(F.max("windows").alias("windows"), F.min_by("values", F.struct(-F.col("same"), "distance")).alias("values")))
    found = one.groupBy(*key, "kind", "part").agg(
        F.count(F.lit(1)).cast("long").alias("found"), F.max("windows").alias("windows"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("values")))).alias("values"))
    held = F.filter("values", lambda v: v["item_slots"].isNotNull())
    # sorted by the benchmark's value: one that stands for a single value has other neighbours on both sides
    other = lambda a, i, v: ~F.get(a, i)["item_slots"].eqNullSafe(v["item_slots"])
    first = F.filter("held", lambda v, i: (i == 0) | other(F.col("held"), i - 1, v))
    single = F.filter("held", lambda v, i: ((i == 0) | other(F.col("held"), i - 1, v)) & other(F.col("held"), i + 1, v))
    agreement = F.when(F.size("held") > 0, F.size(single) / F.size(first)).otherwise(F.lit(1.0))
    best = F.max(F.struct("found", "agreement", "windows")).alias("best")
    verdicts = stored(
        found.filter((F.col("found") >= COVERAGE * F.col("windows")) | (F.col("found") >= RUN))
        .withColumn("held", held).withColumn("agreement", agreement).filter(F.col("agreement") >= AGREEMENT)
        .groupBy(*key).agg(best))
    return docs.select(F.col(id).alias("id"), text_key).join(verdicts, "text_key").select(
        F.col("id").alias(id), "text_key", F.col("item").alias(item_id), "best.found", "best.windows",
        (F.col("best.found") / F.col("best.windows")).alias("coverage"), "best.agreement").distinct()


def clean_documents(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs, with all columns, that hold no item of the benchmark."""
    bad = stored(contaminated(docs, benchmark, id, text).select(F.col(id).alias("_bad"), F.col("text_key").alias("_key")).distinct())
    same = docs[id].eqNullSafe(bad["_bad"]) & (F.xxhash64(F.coalesce(docs[text], F.lit(""))) == bad["_key"])
    return docs.join(bad, same, "left_anti")
