"""The corpus pipeline over ``documents``: each stage works on all rows that the one
before it kept, and calls one operator of ``refmart.llm``.

1. quality rules: rows that the rule ledger's policy rejects go;
2. SimHash near-dedup: one row of each component stays (the smallest doc_id);
3. benchmark decontamination: rows with a benchmark window go;
4. PII: spans of personal data are replaced by their kind, ``n_chars`` follows;
5. SentencePiece: sampled piece ids, and whether they decode to the text.

All but the last return the columns of their input. Stages 4 and 5 are no SQL, so
``ORACLE_SQL`` is None; tests/llm holds the run against a brute-force version.

Defined results: null, empty and blank texts have too few words and go in stage 1; of
rows that are repeated, or near copies, one stays (the smallest doc_id, then the
smallest text hash; a null doc_id ranks last); texts of any length go through whole;
nulls in other columns and columns of any name are carried along; an empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refmart.llm import op2_quality, op3_sentencepiece, op5_pii, op7_decontaminate, op8_simhash
from refmart.llm.common import written

ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op2_quality.apply_policy(docs, "v2")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op8_simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op7_decontaminate.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), "documents")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = op5_pii.redact(docs, op5_pii.train(docs))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = op3_sentencepiece.round_trip(docs.select("doc_id", "text"), ids="piece_ids")
    return rows.select("doc_id", "piece_ids", (F.octet_length("piece_ids") / 2).cast("long").alias("n_pieces"),
                       "lossless")


STAGES = [("quality rules", quality), ("SimHash near-dedup", near_dedup),
          ("benchmark decontamination", decontaminate), ("PII", personal_data),
          ("SentencePiece encoding and decoding", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage is written as Parquet in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES, 1):
        docs = written(stage(spark, docs, sf_dir), f"stage{n}")
    return docs
