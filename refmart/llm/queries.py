"""The registered queries of the training-data operators and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (op1_training_order, op2_quality, op3_sentencepiece, op4_suffix_dedup, op5_pii, op6_warc, op7_decontaminate,
               op8_simhash, op9_licenses, op10_lm_score, op11_divergence,
               op12_runs, op13_url_filter)
from .oracle import ORACLE

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_training_order_shards(spark, sf_dir):
    return op1_training_order.training_order_query(table(spark, sf_dir, "documents"))


@query
def op2_quality_rules(spark, sf_dir):
    return op2_quality.quality_query(table(spark, sf_dir, "documents"))


@query
def op3_sentencepiece_sampling(spark, sf_dir):
    return op3_sentencepiece.summary(table(spark, sf_dir, "documents"))


@query
def op4_suffix_array_dedup(spark, sf_dir):
    return op4_suffix_dedup.dedup_query(table(spark, sf_dir, "documents"))


@query
def op5_personal_data(spark, sf_dir):
    return op5_pii.pii_query(table(spark, sf_dir, "documents"))


@query
def op6_warc_revisits(spark, sf_dir):
    return op6_warc.warc_query(table(spark, sf_dir, "pages"))


@query
def op7_benchmark_decontamination(spark, sf_dir):
    return op7_decontaminate.decontamination_query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op8_simhash_near_dedup(spark, sf_dir):
    return op8_simhash.simhash_query(table(spark, sf_dir, "documents"))


@query
def op9_license_scan(spark, sf_dir):
    return op9_licenses.scan(table(spark, sf_dir, "documents"))


@query
def op10_lm_scoring(spark, sf_dir):
    return op10_lm_score.lm_query(table(spark, sf_dir, "documents"))


@query
def op11_source_divergence(spark, sf_dir):
    return op11_divergence.divergence_query(table(spark, sf_dir, "documents"))


@query
def op12_periodic_runs(spark, sf_dir):
    return op12_runs.runs_query(table(spark, sf_dir, "documents"))


@query
def op13_url_filter_verdicts(spark, sf_dir):
    return op13_url_filter.filter_query(table(spark, sf_dir, "pages"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
