"""Near duplicates by SimHash, found by anchor-point covering.

A fingerprint has 64 bits. Two that differ in five bits or fewer differ in two or fewer within one of their halves. For 31 bits of a half the anchors are the
codewords of the perfect Hamming code (31, 26): every point lies within one bit (the covering radius) of exactly one anchor, its home. If x and y differ in at most
two bits there, the home of x is at most 1 + 2 = 3 bits from y. So every fingerprint is put at its home and replicated to the 156 anchors within three
bits of it, and fingerprints are compared per anchor: home against replicas. Of a pair, the one with the smaller home meets the other, so replicas go
only to anchors not below the own home, which halves them. The search is exact, and an anchor holds 2^-26 of the fingerprints on average at any size.

Equal fingerprints are one before the search, so copies cost nothing; large near groups at one anchor are a skewed join that adaptive execution splits.
Links leave a task only if they join parts the task has not joined yet. Components come from alternating stars over the links.

Null and empty texts have fingerprint zero and are linked like others. Repeated rows give repeated results.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .graph import components
from .shared import fresh, portions, stored

SHINGLE = 4
#: Bits in which linked fingerprints differ at most. Up to five leave two or fewer to one half, so the same anchors serve.
MOST_BITS = 4
SEED = 42
BLOCK = 1 << 15
#: Fingerprints whose links a task remembers; beyond that it starts afresh and may repeat a link, which changes nothing.
REMEMBERED = 500_000


def fingerprint(text: bytes, size: int) -> int:
    """The majority of the bits of all shingle hashes, as a signed number; repeated shingles count each time."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1])).tolist()
    stops = (ends - 1).tolist()
    size = min(size, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, stops[size - 1:], strict=False)), np.uint64, len(words) - size + 1)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), BLOCK):
        counts += np.unpackbits(hashes[i:i + BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits((2 * counts > len(hashes)).astype(np.uint8), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text_key, fp): one row per row of docs; text_key is a hash of the text."""
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            fps = [fingerprint(t or b"", size) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("text_key"), pa.array(fps, pa.int64())], names=["id", "text_key", "fp"])

    rows = docs.select(F.col(id).alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_key"), F.col(text).alias("text"))
    return rows.mapInArrow(mapped, f"id {docs.schema[id].dataType.simpleString()}, text_key long, fp long")


def _replicas() -> list[list[int]]:
    """For each syndrome s: the codewords w such that home xor w is within three bits of a point whose home is at bit s (0: the point itself)."""
    bit = lambda *at: sum(1 << (i - 1) for i in at)
    three = {frozenset((i, j, i ^ j)) for i, j in itertools.combinations(range(1, 32), 2)}
    four = {frozenset((i, j, k, i ^ j ^ k)) for i, j, k in itertools.combinations(range(1, 32), 3) if i ^ j ^ k not in (0, i, j, k)}
    words = [bit(*w) for w in three | four]
    return [[0, *sorted(w for w in words if (w ^ (bit(s) if s else 0)).bit_count() <= 3)] for s in range(32)]


def _syndrome(point: Column) -> Column:
    masks = [sum(1 << (i - 1) for i in range(1, 32) if i >> j & 1) for j in range(5)]
    bits = [F.shiftleft((F.bit_count(point.bitwiseAND(F.lit(m))) % 2).cast("int"), j) for j, m in enumerate(masks)]
    return bits[0] + bits[1] + bits[2] + bits[3] + bits[4]


def links(fps: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """(a, b): links that join all distinct fingerprints of `fp` within most_bits of each other; enough of them to keep every connection."""
    if most_bits > 5:
        raise ValueError("anchors within three bits of a half find all pairs up to five bits only")
    halves = fps.select("fp", F.explode(F.array(
        F.struct(F.lit(0).cast("long").alias("half"), F.col("fp").bitwiseAND(F.lit(0x7FFFFFFF)).alias("point")),
        F.struct(F.lit(1).cast("long").alias("half"), F.shiftrightunsigned("fp", 32).bitwiseAND(F.lit(0x7FFFFFFF)).alias("point")))).alias("h"))
    homed = halves.select("fp", "h.half", "h.point").withColumn("s", _syndrome(F.col("point")))
    flip = F.when(F.col("s") == 0, F.lit(0).cast("long")).otherwise(F.expr("shiftleft(1L, s - 1)"))
    homed = homed.withColumn("home", F.col("point").bitwiseXOR(flip))
    tag = F.shiftleft(F.col("half"), 31)
    table = F.from_json(F.lit(json.dumps(_replicas())), F.lit("array<array<bigint>>"))
    anchors = F.filter(F.transform(F.get(table, F.col("s")), lambda w: F.col("home").bitwiseXOR(w)), lambda a: a >= F.col("home"))
    homes = homed.select((tag + F.col("home")).alias("anchor"), F.col("fp").alias("a"))
    replicas = homed.select("fp", tag.alias("tag"), F.explode(anchors).alias("at")).select((F.col("tag") + F.col("at")).alias("anchor"), F.col("fp").alias("b"))
    near = (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= most_bits) & (F.col("a") != F.col("b"))
    met = replicas.join(homes, "anchor").filter(near).select("a", "b")
    return met.mapInArrow(_forest, "a long, b long")


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Without links between parts that remembered links of the same task join already."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    for batch in batches:
        if len(parent) > REMEMBERED:
            parent.clear()
        kept = []
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
                kept.append((a, b))
        yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in kept], pa.int64()) for i in (0, 1)], names=["a", "b"])


def near_groups(docs: DataFrame, size: int = SHINGLE, most_bits: int = MOST_BITS, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text_key, fp, root): root is the same number for all documents that links connect."""
    rows = stored(fingerprints(docs, size, id, text))
    # dealt by number, not by size: a task makes 156 replicas a half of each of its fingerprints; by another expression
    # than the one they are grouped by, or Spark leaves this out
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    joined = components(links(rows.select("fp").distinct().repartition(tasks, F.xxhash64("fp")), most_bits))
    return rows.join(joined, rows["fp"] == joined["a"], "left").select(
        rows["id"], "text_key", "fp", F.coalesce("root", rows["fp"]).alias("root"))


def component_ids(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fp, component_id): the smallest id in the document's component; null if the component has no id at all."""
    rows = stored(near_groups(docs, id=id, text=text))
    # stored, so that the join deals the rows anew and can split a hot component
    least = stored(rows.groupBy("root").agg(F.min("id").alias("component_id")))
    return rows.join(least, "root").select(F.col("id").alias(id), "fp", "component_id")


def one_of_each(docs: DataFrame, size: int = SHINGLE, most_bits: int = MOST_BITS, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs, with all columns whatever their names, that have the smallest (id, text_key) of their component; of repeated rows one stays."""
    rows = stored(near_groups(docs, size, most_bits, id, text))
    first = rows.groupBy("root").agg(F.min(F.struct("id", "text_key")).alias("first")).select("first.*")
    repeats = rows.groupBy("id", "text_key").agg(F.count(F.lit(1)).alias("copies"))
    own = fresh(docs, "_near_")
    first_id, key, copies = f"{own}id", f"{own}key", f"{own}copies"
    chosen = stored(first.join(repeats, first["id"].eqNullSafe(repeats["id"]) & (first["text_key"] == repeats["text_key"])).select(
        first["id"].alias(first_id), first["text_key"].alias(key), F.col("copies").alias(copies)))
    same = docs[id].eqNullSafe(F.col(first_id)) & (F.xxhash64(F.coalesce(docs[text], F.lit(""))) == F.col(key))

    def kept(which: Column) -> DataFrame:
        return docs.join(chosen.filter(which), same)

    once, more = kept(F.col(copies) == 1), kept(F.col(copies) > 1).dropDuplicates([first_id, key])
    return once.unionByName(more).drop(first_id, key, copies)
