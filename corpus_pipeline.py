"""The corpus pipeline: quality rules, toxicity, near duplicates, personal data, packing.

Every stage takes the documents that the stage before it kept and returns a DataFrame,
which is written as Parquet in the shared folder and read again. All but the last return
the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stray.llm import icws, packing, pii, quality, toxicity
from stray.llm.common import materialise, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without lines too frequent on their host."""
    return quality.quality_stage(docs)


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxic grades; the labels name the outcomes to learn from."""
    return toxicity.toxicity_stage(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return icws.near_dup_stage(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and terms that reveal it replaced."""
    return pii.pii_stage(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.pack_documents(docs)


STAGES = [("quality", quality_rules), ("toxicity", toxic_documents), ("near_duplicates", near_duplicates),
          ("personal_data", personal_data), ("packing", packed_sequences)]

#: Learned grades, samples and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
