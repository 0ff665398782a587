"""From raw documents to packed training rows, each stage by one corpus operator.

STAGES are applied in order; each gets what its predecessor wrote. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterbook.llm import line_crf, mixing, packing, simhash, templates
from meterbook.llm.shared import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model, trained on `labels`, does not reject."""
    return line_crf.good_documents(docs, table(spark, sf_dir, "labels")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, by the operator's own shingles and bits."""
    return simhash.one_of_each(docs).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of `benchmark`, re-parameterised or not."""
    return templates.clean_documents(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by their sources' rates, in a global random order."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed rows of token ids."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing sources", mix),
    ("token packing", pack),
]

#: The quality model and the tokenizer cannot be written in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what the stages before it keep is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
