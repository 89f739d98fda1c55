"""Delimited-file sources (inventory SRC3, SRC4, SRC5, PRJ20-PRJ23, FLT12).

* ``read_wide`` / ``write_wide``: the pipe-delimited hand-off of the wide
  instrument layout (Parquet is the better hand-off; both are offered).
* ``read_lei_csv``: the entity golden-copy CSV (BOM, quoted, multi-line).
* ``read_quotes``: a folder of pipe files in several layouts. Header lines are
  read first (one line a file); then each distinct header is one CSV read of all
  its files, mapped by name onto the 26-column target. No cap on columns, no
  schema inference pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.clean import (QUOTE_COLUMNS, QUOTE_HEADER_MAP, blank_to_null, normalize_header, parse_ts,
                               product_type)
from ..operators.contract import to_layout
from .quoted_csv import BOM, read_quoted_csv

WIDE_COLUMNS = [
    "HeaderReportingMarketId", "HeaderReportingNCA", "HeaderReportingPeriodDate", "SourceFileName", "TechRcrdId",
    "ISIN", "FullName", "ShortName", "CFI", "CommodityDerivativeInd", "NotionalCurrency", "IssuerLEI",
    "TradingVenueMIC", "IssuerReqAdmission", "AdmissionApprvlDate", "ReqForAdmissionDate", "FirstTradingDate",
    "TerminationDate", "TotalIssuedNominalAmount", "TotalIssuedNominalAmountCcy", "MaturityDate",
    "NominalValuePerUnit", "NominalValuePerUnitCcy", "FixedRate", "FloatRefRateISIN", "FloatRefRateIndex",
    "FloatTermUnit", "FloatTermValue", "FloatBasisPointSpread", "DebtSeniority", "ExpiryDate", "PriceMultiplier",
    "UnderlyingISIN", "UnderlyingLEI", "UnderlyingIndexRef", "UnderlyingIndexTermUnit", "UnderlyingIndexTermValue",
    "OptionType", "OptionExerciseStyle", "DeliveryType", "StrikePrice", "StrikePriceCcy", "StrikeNoPriceCcy",
    "CmdtyBaseProduct", "CmdtySubProduct", "CmdtySubSubProduct", "CmdtyTransactionType", "CmdtyFinalPriceType",
    "ValidFromDate", "ValidToDate", "LatestRecordFlag",
]


def write_wide(df: DataFrame, path: str, delimiter: str = "|") -> None:
    """SRC3 writer: header row, empty field = NULL, UTF-8, no quoting of text."""
    (df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]).write.mode("overwrite")
     .option("sep", delimiter).option("header", True).option("quote", "\u0000").option("nullValue", "")
     .option("emptyValue", "").csv(path))


def read_wide(spark: SparkSession, path: str, columns: list[str] | None = None, delimiter: str = "|") -> DataFrame:
    """SRC3 reader: all-text wide layout with an explicit schema (no inference);
    empty field = NULL."""
    cols = columns or WIDE_COLUMNS
    schema = StructType([StructField(c, StringType()) for c in cols])
    df = (spark.read.schema(schema).option("sep", delimiter).option("header", True).option("quote", "\u0000")
          .option("nullValue", "").option("encoding", "UTF-8").csv(path))
    return df.select(*[F.nullif(F.col(c), F.lit("")).alias(c) for c in cols])


def read_lei_csv(spark: SparkSession, path: str) -> DataFrame:
    """SRC4: golden-copy CSV -- UTF-8 with BOM, quoted fields that may span
    lines, header row. Many tasks share a file (``quoted_csv``); dotted header
    names are kept as they are (PRJ1 maps them)."""
    return read_quoted_csv(spark, path)


def read_quotes(spark: SparkSession, path: str, delimiter: str = "|") -> DataFrame:
    """SRC5 + PRJ20-PRJ23: every quote file of a folder (csv/txt/tsv/psv) in any
    of the layouts -> the 26-column quote table (text), with the file name,
    product type (row value, else from the file name) and parsed snapshot time.
    The first line of a file is its header, in any column order; later lines are
    data, whatever they hold; rows are kept with or without an ISIN."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{csv,txt,tsv,psv}").load(path)
    return read_quote_files(spark, sorted(r[0] for r in files.select("path").collect()), delimiter)


def _first_line(spark: SparkSession, path: str) -> str:
    """The header of one file, read as far as its first line end."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    data = where.getFileSystem(spark._jsc.hadoopConfiguration()).open(where)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(data, "UTF-8"))
    try:
        return reader.readLine() or ""
    finally:
        reader.close()


def read_quote_files(spark: SparkSession, paths: list[str], delimiter: str = "|") -> DataFrame:
    """SRC5 over given files: one pruned CSV read per distinct header line, united by
    column name. Of two headers with one target the last wins; unknown ones are dropped."""
    layouts: dict[str, list[str]] = {}
    for p in paths:
        layouts.setdefault(_first_line(spark, p), []).append(p)
    layouts = {line: files for line, files in layouts.items() if line.replace(BOM, "").strip()}
    if not layouts:
        return spark.createDataFrame([], ", ".join(f"{c} STRING" for c in QUOTE_COLUMNS))
    # the headers are normalised by the same column functions as data (one row per layout)
    cells = [(n, i, h) for n, line in enumerate(layouts) for i, h in enumerate(line.replace(BOM, "").split(delimiter))]
    named = spark.createDataFrame(cells, "layout INT, at INT, cell STRING").select(
        "layout", "at", normalize_header(F.trim(F.replace("cell", F.lit('"'), F.lit("")))).alias("h")).collect()
    targets: dict[int, dict[str, int]] = {}
    for r in sorted(named, key=lambda r: r["at"]):
        if r["h"] in QUOTE_HEADER_MAP:
            targets.setdefault(r["layout"], {})[QUOTE_HEADER_MAP[r["h"]]] = r["at"]
    parts = []
    for n, (line, files) in enumerate(layouts.items()):
        schema = StructType([StructField(f"c{i}", StringType()) for i in range(len(line.split(delimiter)))])
        raw = (spark.read.schema(schema).option("sep", delimiter).option("header", True).option("enforceSchema", True)
               .option("encoding", "UTF-8").option("mode", "PERMISSIVE").csv(files))
        at = targets.get(n, {})
        parts.append(raw.select(F.col("_metadata.file_name").alias("__name"), *[
            (F.col(f"c{at[c]}") if c in at else F.lit(None).cast("string")).alias(c) for c in QUOTE_COLUMNS
            if c != "file_name"]))
    return _quote_rows(reduce(DataFrame.unionByName, parts))


def _quote_rows(got: DataFrame) -> DataFrame:
    """Typed and cleaned quote rows from by-name text columns and ``__name``."""
    done = {
        "file_name": F.col("__name"),
        "produit_type": product_type(F.col("produit_type"), F.col("__name")),
        "date_extraction": F.date_format(parse_ts(F.col("date_extraction")), "yyyy-MM-dd HH:mm:ss"),
    }
    return to_layout(got.select(*[(done[c] if c in done else blank_to_null(F.col(c))).alias(c)
                                  for c in QUOTE_COLUMNS]), QUOTE_COLUMNS)
