"""Host-level quality rules: rule failures by domain, rates shrunk by an empirical beta prior, verdicts joined back.

Each document is counted and tested by rules of its own. Failures are summed by host (map-side partial sums, so a host with a third of
all documents is one row per task). A raw rate of a small host says little, so a beta prior is fitted to all hosts by moments and
every host gets the posterior mean (failures + a) / (documents + a + b). A host whose rate is over the limit has a bad verdict, which rejects its
documents; a document is also rejected by its own failures.

Null text has no words. A null host is a host of its own. Repeated rows count and are judged separately. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .shared import stored

SPACES = b" \t\n\v\f\r"
#: The symbols counted, and the limits of the base rules.
SYMBOLS = b"#*$%&|<>"
WINDOW, LEAST_WORDS, MOST_REPEATED = 8, 20, 30

SYMBOLS_PER_WORD = 0.1
DUPLICATE_LINES = 0.3
HOST_LIMIT = 0.5

COUNTS = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of eight which stands twice or more in the text. Windows are compared by 64-bit hashes."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    one = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    window = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        window *= np.uint64(0x9E3779B97F4A7C15)
        window += one[k:k + n]
        window ^= window >> np.uint64(29)
    ordered = np.sort(window)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(window, twice))
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(edges[:-1])))


def text_counts(text: bytes, code_points: int) -> tuple[int, ...]:
    words = text.split()
    seen: set[bytes] = set()
    lines = duplicates = 0
    for line in text.split(b"\n"):
        if line.strip(SPACES):
            lines += 1
            if line in seen:
                duplicates += 1
            else:
                seen.add(line)
    spaces = len(text) - len(text.translate(None, SPACES))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    return len(words), code_points - spaces, symbols, lines, duplicates, repeated_words(words)


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split(" ")[0] for c in COUNTS.split(", ")]
    for batch in batches:
        text = batch.column("text")
        lengths = pc.fill_null(pc.utf8_length(text), 0).to_pylist()
        rows = [text_counts(t or b"", n) for t, n in zip(text.cast(pa.binary()).to_pylist(), lengths, strict=True)]
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("host"), *(pa.array(c, pa.int64()) for c in columns)], names=["id", "host", *names])


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """(a, b) by moments over the raw rates of all hosts, each weighted by its documents; one row comes to the driver."""
    rate = F.col("failures") / F.col("documents")
    m = hosts.agg(F.sum("failures").alias("f"), F.sum("documents").alias("n"), F.count(F.lit(1)).alias("hosts"),
                  F.sum(F.col("documents") * rate * rate).alias("squares")).first()
    if not m["n"]:
        return 1.0, 1.0
    mean = (m["f"] + 0.5) / (m["n"] + 1)
    spread = max(m["squares"] / m["n"] - (m["f"] / m["n"]) ** 2, 0.0)
    noise = mean * (1 - mean) * m["hosts"] / m["n"]
    between = max(spread - noise, mean * (1 - mean) / 1000)
    weight = min(max(mean * (1 - mean) / between - 1, 2.0), 1000.0)
    return mean * weight, (1 - mean) * weight


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def judge_hosts(docs: DataFrame, id: str = "doc_id", text: str = "text", host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """(id, host, the counts, base_failed, own_failed, host_rate, host_good, kept): one row per row of docs."""
    counted = stored(docs.select(F.col(id).alias("id"), F.col(host).cast("string").alias("host"), F.col(text).alias("text"))
                     .mapInArrow(_count_batches, f"id {docs.schema[id].dataType.simpleString()}, host string, {COUNTS}"))
    own = (F.col("n_symbols") > SYMBOLS_PER_WORD * F.col("n_words")) | (F.col("n_dup_lines") > DUPLICATE_LINES * F.col("n_lines"))
    tested = counted.withColumn("base_failed", base_failed()).withColumn("own_failed", own)
    hosts = stored(tested.groupBy("host").agg(
        F.count(F.lit(1)).alias("documents"), F.count(F.when(F.col("base_failed") | F.col("own_failed"), 1)).alias("failures")))
    a, b = beta_prior(hosts)
    verdicts = hosts.select(F.col("host").alias("of"), ((F.col("failures") + a) / (F.col("documents") + (a + b))).alias("host_rate"))
    return (
        tested.join(verdicts, F.col("host").eqNullSafe(F.col("of")), "left").drop("of")
        .withColumn("host_good", F.col("host_rate") <= limit)
        .withColumn("kept", ~F.col("base_failed") & ~F.col("own_failed") & F.col("host_good"))
        .withColumnsRenamed({"id": id, "host": host})
    )
