"""Column helpers and the shared-folder helper of the training-data operators."""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refmart.session import ensure_checkpoint_dir

# The two word classes of the query contracts.
SPACE_WORD = r"[^\x20\x09-\x0D]+"
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ALNUM_WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BLANKS = "\t\n\x0b\x0c\r"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the cluster's shared folder (``spark.checkpoint.dir``)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read again, so a
    lost executor costs one stage and two readers share one computation."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. All-ASCII texts take ``lower``'s byte path; in others
    ``translate`` leaves letters outside ASCII alone."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def space_words(text: Column) -> Column:
    """Maximal runs of ``SPACE_WORD`` characters; no words for a null."""
    flat = F.coalesce(text, F.lit(""))
    for ch in BLANKS:
        flat = F.replace(flat, F.lit(ch), F.lit(" "))
    return F.filter(F.split(flat, " "), lambda w: w != "")


def alnum_words(text: Column) -> Column:
    """Lower-cased (A-Z) maximal runs of ``ALNUM_WORD`` characters; none for a null."""
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(ALNUM_WORD), F.lit(0))


# ASCII other than letters and digits becomes a blank, A-Z becomes a-z.
_APART = "".join(c for c in map(chr, range(128)) if not c.isalnum())
_FLAT = (string.ascii_uppercase + _APART, string.ascii_lowercase + " " * len(_APART))


def split_alnum(text: Column) -> Column:
    """The words of ``alnum_words``, by one translation and a split instead of a regular expression."""
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), *_FLAT), " "), lambda w: w != "")


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only what the operators need, under their own names: ``k_id``, ``k_hash``
    (of the text: rows that repeat a doc_id with another text stay apart) and
    ``k_text``. Further columns of ``docs`` cannot clash with inner names."""
    return docs.select(F.col(id_col).alias("k_id"), F.xxhash64(F.col(text_col)).alias("k_hash"),
                       F.col(text_col).alias("k_text"))


def same_key(left: DataFrame, right: DataFrame) -> Column:
    """Null-safe equality of the ``keyed`` key (a null doc_id is a key like any other)."""
    return left["k_id"].eqNullSafe(right["k_id"]) & (left["k_hash"] == right["k_hash"])


def covered(starts: Column, width: Column | int) -> Column:
    """Number of positions that windows of ``width`` at the sorted ``starts`` cover."""
    w = F.lit(width).cast("long") if isinstance(width, int) else width
    first = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1 << 40).cast("long").alias("last"))
    return F.aggregate(starts, first, lambda a, x: F.struct(
        (a["n"] + F.least(w, x.cast("long") - a["last"])).alias("n"), x.cast("long").alias("last")))["n"]
