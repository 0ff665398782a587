"""Helpers that several corpus operators share: input columns, stored tables, and scans over arrays inside a row."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Elements per block of an array scan: work per array is n * BLOCK / 2 instead of n * n / 2.
BLOCK = 128

#: Rows that Python code of a task turns into objects at once.
PORTION = 1_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A fresh path in the cluster's shared folder. Only a local session without that setting gets a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="meterbook-llm-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(folder)
    return f"{folder}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write rows to a table of their own in the shared folder and go on from there; this cuts the lineage."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(docs: DataFrame, prefix: str) -> str:
    """The prefix, with more underscores if need be, so that no column of docs begins with it."""
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = "_" + prefix
    return prefix


def portions(batches: Iterator[pa.RecordBatch], rows: int = PORTION) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that a task holds Python objects of few texts at a time."""
    for batch in batches:
        for at in range(0, max(1, batch.num_rows), rows):
            yield batch.slice(at, rows)


def let(value: Column, body) -> Column:
    """body(value), with value computed once per row although body uses it many times."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(values: Column, zero: Column, merge) -> Column:
    """Inclusive scan of an array by an associative merge, in blocks, so that long arrays stay cheap."""
    def blocks(array: Column) -> Column:
        count = F.ceil(F.size(array) / F.lit(BLOCK)).cast("int")
        cut = F.transform(F.sequence(F.lit(1), count), lambda i: F.slice(array, (i - 1) * BLOCK + 1, BLOCK))
        return F.when(F.size(array) > 0, cut)

    def joined(cut: Column) -> Column:
        sums = F.transform(cut, lambda block: F.aggregate(block, zero, merge))
        before = let(sums, lambda s: F.transform(s, lambda _, i: F.aggregate(F.slice(s, 1, i), zero, merge)))
        inner = lambda block, start: F.transform(
            block, lambda _, j: F.aggregate(F.slice(block, 1, j + 1), start, merge))
        return F.flatten(F.zip_with(cut, before, inner))

    scanned = let(values, lambda array: let(blocks(array), joined))
    return F.coalesce(scanned, F.array().cast(f"array<{'bigint'}>"))


def spans(text: Column, pattern: Column | str) -> Column:
    """array<struct<start, end, hit>> of all matches of a regular expression, in code points from 0, end exclusive; null if none.

    The matches are set between marks and the text is split there, so every second part is a match and the lengths add
    up to the positions: one pass of the expression, also for texts with very many matches. The pattern must not match
    the empty string. Marks that the text has itself count as another control character.
    """
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    marked = F.regexp_replace(F.replace(text, F.lit("\x01"), F.lit("\x02")), pattern, F.lit("\x01$0\x01"))

    def placed(parts: Column) -> Column:
        def numbered(ends: Column) -> Column:
            return F.transform(F.sequence(F.lit(1), F.size(parts) - 2, F.lit(2)), lambda i: F.struct(
                (F.get(ends, i) - F.length(F.get(parts, i))).alias("start"), F.get(ends, i).alias("end"),
                F.get(parts, i).alias("hit")))

        lengths = F.transform(parts, lambda s: F.length(s).cast("bigint"))
        return let(running(lengths, F.lit(0).cast("bigint"), lambda a, x: a + x), numbered)

    return let(F.split(marked, "\x01", -1), lambda parts: F.when(F.size(parts) > 1, placed(parts)))


def count_parts(text: Column, between: str) -> Column:
    """Number of non-empty parts of a text that runs of a character class set apart."""
    def full(parts: Column) -> Column:
        ends = F.when(F.element_at(parts, 1) == "", 1).otherwise(0) + F.when(F.element_at(parts, -1) == "", 1).otherwise(0)
        return F.when(F.size(parts) == 1, 1 - F.least(ends, F.lit(1))).otherwise(F.size(parts) - ends).cast("bigint")

    return let(F.split(text, f"{between}++", -1), full)
