"""Bounded training samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .shared import stored

#: Documents whose crc32(id as text) leaves this remainder are held out of all training.
FOLDS, HELD_OUT = 5, 0


def fold(id: str = "doc_id"):
    return F.crc32(F.col(id).cast("string").cast("binary")) % FOLDS


def training_sample(docs: DataFrame, labels: DataFrame, label: str, most: int, id: str = "doc_id") -> DataFrame:
    """(id, text, label) of at most `most` labelled texts that are not held out: those with the smallest hashes of their ids.

    Texts that are equal but for case and white space, and have the same label, are one, under the smallest id; nothing else is collapsed.
    """
    labelled = (
        labels.filter(F.col(label).isNotNull() & F.col(id).isNotNull() & (fold(id) != HELD_OUT))
        .groupBy(id).agg(F.max(label).alias("label"))
    )
    same = F.xxhash64(F.trim(F.regexp_replace(F.lower("text"), r"\s+", " ")))
    rows = docs.select(id, "text").filter("text is not null").withColumn("same", same)
    # only ids and hashes are grouped before the limit, so the bound counts distinct texts
    chosen = (
        rows.select(id, "same").join(labelled, id).groupBy("same", "label").agg(F.min(id).alias(id))
        .orderBy(F.xxhash64(F.col(id), F.lit(7)), id, "same", "label").limit(most)
    )
    # at most `most` rows of three numbers: small enough to send to every task
    return stored(rows.join(F.broadcast(chosen), [id, "same"]).dropDuplicates(["same", "label"]).select(id, "text", "label"))
