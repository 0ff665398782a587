"""Sharding by histogram sort.

Rows have a key: the hash of their text, then their id. Splitters between the shards are found without sorting: each round counts the exact
bytes below a few candidate keys per splitter across all partitions, and the next round looks between the two candidates around
the wanted byte count, until a candidate is within the tolerance. Then the rows are exchanged once. Only counts per candidate come to the
driver: shards x probes numbers a round.

Rows with equal texts have one hash and stay in one shard, unless a group is so large that it would break the byte law: then the splitter
falls inside the group, between two ids (between their hashes, if ids are not whole numbers). Rows equal in text and id cannot be told apart and stay together. Null text has no bytes and a null
id sorts first. An empty table gives no rows.

Each shard is cut into ranges of keys for numbering: slots are row numbers in a range plus the exact rows of the ranges before it, so no task
sorts a whole shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from .shared import stored

SHARDS = 24
OVERHEAD = 8
TOLERANCE = 0.002
PROBES = 127
ROWS_PER_RANGE = 500_000

LOW, HIGH = -(1 << 63), (1 << 63) - 1


def _histogram(rows: DataFrame, column: str, cuts: list[int]) -> list[tuple[int, int]]:
    """(bytes, rows) strictly below each of the sorted cuts: counted per partition, summed over all."""
    edges = np.array(cuts, np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, number = np.zeros(len(edges) + 1, np.int64), np.zeros(len(edges) + 1, np.int64)
        for batch in batches:
            at = np.searchsorted(edges, batch.column(0).to_numpy(), side="right")
            np.add.at(size, at, batch.column(1).to_numpy())
            number += np.bincount(at, minlength=len(edges) + 1)
        full = np.flatnonzero(number)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (full, size[full], number[full])], names=["bucket", "size", "number"])

    summed = (rows.select(column, "size").mapInArrow(count, "bucket long, size long, number long")
              .groupBy("bucket").agg(F.sum("size").alias("size"), F.sum("number").alias("number")).collect())
    size, number = np.zeros(len(edges) + 1, np.int64), np.zeros(len(edges) + 1, np.int64)
    for r in summed:
        size[r["bucket"]], number[r["bucket"]] = r["size"], r["number"]
    return list(zip(np.cumsum(size)[:-1].tolist(), np.cumsum(number)[:-1].tolist(), strict=True))


def splitters(rows: DataFrame, column: str, targets: list[int], slack: int) -> list[tuple[int, int, int | None]]:
    """For each wanted number of bytes: the best key, the exact bytes below it, and, if no key is within the slack, the key whose own
    rows lie over the target."""
    spans: dict[int, tuple[int, int, int, int | None]] = {i: (LOW, 0, HIGH, None) for i in range(len(targets))}
    best: dict[int, tuple[int, int]] = {}
    over_target: dict[int, int] = {}
    while spans:
        cuts = sorted({low + (high - low) * k // (PROBES + 1) for low, _, high, _ in spans.values() for k in range(1, PROBES + 1)}
                      | {min(low + 1, high) for low, _, high, _ in spans.values()})
        below = dict(zip(cuts, (b for b, _ in _histogram(rows, column, cuts)), strict=True))
        after = {}
        for i, (low, low_bytes, high, high_bytes) in spans.items():
            inside = [(c, b) for c, b in below.items() if low < c <= high]
            known = [*inside, (low, low_bytes), *([best[i]] if i in best else [])]
            best[i] = min(known, key=lambda x: (abs(x[1] - targets[i]), x[0]))
            if abs(best[i][1] - targets[i]) <= slack:
                continue
            under = max([(low, low_bytes), *(x for x in inside if x[1] <= targets[i])])
            over = min([(high, high_bytes), *(x for x in inside if x[1] > targets[i])], key=lambda x: x[0])
            if over[0] - under[0] > 1:
                after[i] = (*under, *over)
            else:
                over_target[i] = under[0]
        spans = after
    return [(*best[i], over_target.get(i)) for i in range(len(targets))]


def shard_rows(docs: DataFrame, shards: int = SHARDS, id: str = "doc_id", text: str = "text", tolerance: float = TOLERANCE) -> DataFrame:
    """(id, key, size, text_crc32, shard, slot): one row per row of docs; sizes of shards differ by little, slots are gapless from 0."""
    body = F.coalesce(F.col(text), F.lit(""))
    # splits a group of equal texts; ids that are no whole numbers are split by their hash
    second = F.col(id).cast("long") if isinstance(docs.schema[id].dataType, T.IntegralType) else F.when(F.col(id).isNotNull(), F.xxhash64(id))
    rows = stored(docs.select(
        F.col(id).alias("id"), F.xxhash64(body).alias("key"), (F.octet_length(body) + F.lit(OVERHEAD)).cast("long").alias("size"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"), F.coalesce(second, F.lit(LOW)).alias("second")))
    total = rows.agg(F.sum("size")).first()[0] or 0
    targets = [total * i // shards for i in range(1, shards)]
    slack = int(tolerance * total / shards)
    first = splitters(rows, "key", targets, slack) if total else []
    cuts = [(key, LOW) for key, _, _ in first]
    for hot in sorted({h for _, _, h in first if h is not None}):  # a group of equal texts lies over these targets: split it by id
        start = _histogram(rows, "key", [hot])[0][0]
        over = [i for i, x in enumerate(first) if x[2] == hot]
        inside = splitters(rows.filter(F.col("key") == hot), "second", [targets[i] - start for i in over], slack)
        for i, (second, below, _) in zip(over, inside, strict=True):
            if abs(start + below - targets[i]) < abs(first[i][1] - targets[i]):
                cuts[i] = (hot, second)
    cuts.sort()
    count = rows.count()
    ranges = max(1, -(-count // (shards * ROWS_PER_RANGE)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edge, second = (np.array([c[i] for c in cuts], np.int64) for i in (0, 1))
        bounds = np.concatenate(([LOW], edge, [HIGH])).astype(np.float64)
        for batch in batches:
            key, other = batch.column("key").to_numpy(), batch.column("second").to_numpy()
            shard = np.searchsorted(edge, key, side="left")
            for i in range(len(cuts)):  # rows at an edge's own key go on while they are not below it
                shard += (shard == i) & (edge[i] == key) & (other >= second[i])
            width = np.maximum(bounds[shard + 1] - bounds[shard], 1.0)
            part = np.clip(((key - bounds[shard]) / width * ranges).astype(np.int64), 0, ranges - 1)
            columns = dict(zip(batch.schema.names, batch.columns, strict=True)) | {"shard": pa.array(shard.astype(np.int32)), "part": pa.array(part)}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    kind = docs.schema[id].dataType.simpleString()
    placed = rows.mapInArrow(place, f"id {kind}, key long, size long, text_crc32 long, second long, shard int, part long")
    sums = {(r["shard"], r["part"]): r["count"] for r in placed.groupBy("shard", "part").count().collect()}
    offsets, number = [], 0
    for i in range(shards):
        number = 0
        for j in range(ranges):
            offsets.append(number)
            number += sums.get((i, j), 0)
    before = F.get(F.array(*[F.lit(x).cast("long") for x in offsets]), (F.col("shard") * ranges + F.col("part")).cast("int"))
    order = Window.partitionBy("shard", "part").orderBy("key", "second")
    return placed.withColumn("slot", F.row_number().over(order) - 1 + before).select(
        F.col("id").alias(id), "key", "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, id: str = "doc_id", text: str = "text") -> None:
    """Write the documents themselves, one folder per shard, in slot order. Ids must be unique."""
    placed = shard_rows(docs, shards, id, text).select(F.col(id).alias("_id"), "shard", "slot")
    docs.join(placed, docs[id].eqNullSafe(placed["_id"])).drop("_id").repartitionByRange("shard", "slot").sortWithinPartitions(
        "shard", "slot").write.partitionBy("shard").parquet(path)
