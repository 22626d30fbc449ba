"""Registered queries of this package and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stray.llm import (dialogue, fracsketch, hosts, icws, lexicon, licenses, line_store, lm, packing, pii, quality,
                       spelling, toxicity)
from stray.llm.common import table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-frequency quality verdict of every document."""
    return quality.quality_query(table(spark, sf_dir, "documents"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Own or inherited licence of every document."""
    return licenses.license_query(table(spark, sf_dir, "documents"))


def op3_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL rules and host reputation of every page."""
    return hosts.url_filter(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordinal toxicity grades of every document."""
    return toxicity.toxicity_query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces, packed into sequences."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op6_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model score of every document."""
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and revealing terms of every document."""
    return pii.pii_query(table(spark, sf_dir, "documents"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fracsketch.fingerprints(table(spark, sf_dir, "documents"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate group of every document."""
    return icws.near_duplicates(table(spark, sf_dir, "documents"))


def op10_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, and back."""
    return lexicon.encode_documents(table(spark, sf_dir, "documents"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants of every frequent word."""
    return spelling.spelling_query(table(spark, sf_dir, "documents"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that a later document repeats."""
    return line_store.line_dedup_query(table(spark, sf_dir, "documents"))


def op13_dialogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repair of every damaged conversation."""
    return dialogue.dialogue_query(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_quality, op2_licenses, op3_hosts, op4_toxicity, op5_packing, op6_lm, op7_pii,
                                   op8_fingerprints, op9_near_duplicates, op10_lexicon, op11_spelling, op12_line_dedup,
                                   op13_dialogue)}
ORACLE = {"op1_quality": quality.QUALITY_SQL, "op2_licenses": licenses.LICENSE_SQL, "op3_hosts": hosts.HOSTS_SQL,
          "op12_line_dedup": line_store.LINE_DEDUP_SQL}
