"""Registered queries for column functions (PRJ), predicates (FLT), file
manifests (SRC8-SRC10), set operations and the scalar aggregates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import clean as C
from ..functions import predicates as P
from ..operators.measures import is_empty, max_date, row_delta, share_of_total
from ..sources.files import file_date, incremental_plan, latest_partition, union_files
from . import fixtures as fx
from . import warehouse as wh
from . import q_reports  # noqa: F401  (registers the shared SQL stages first)
from .catalog import register
from .fixtures import add_cte, sql_with

PY_WS_SQL = "'" + C.PY_WHITESPACE + "'"
WS_CLASS = C.WHITESPACE_CLASS


def _docs(spark, d):
    return fx.table(spark, d, "documents")


# ----------------------------------------------------------------- PRJ on the wide feed
@register("prj2_blank_to_null", sql_with(["wide"], """SELECT TechRcrdId, nullif(trim(CmdtyBaseProduct), '') AS base,
  nullif(trim(IssuerReqAdmission), '') AS req, nullif(trim(CommodityDerivativeInd), '') AS cdi FROM wide"""))
def prj2_blank_to_null(spark, d):
    """PRJ2: trim, blank -> NULL."""
    w = fx.wide(spark, d)
    return w.select("TechRcrdId", C.blank_to_null("CmdtyBaseProduct").alias("base"),
                    C.blank_to_null("IssuerReqAdmission").alias("req"),
                    C.blank_to_null("CommodityDerivativeInd").alias("cdi"))


@register("prj3_blank_to_null_keep", sql_with(["wide"], """SELECT TechRcrdId,
  nullif(CommodityDerivativeInd, '') AS cdi, nullif(IssuerReqAdmission, '') AS req FROM wide"""))
def prj3_blank_to_null_keep(spark, d):
    """PRJ3: blank -> NULL without trimming (leading blanks survive)."""
    w = fx.wide(spark, d)
    return w.select("TechRcrdId", C.blank_to_null("CommodityDerivativeInd", trim=False).alias("cdi"),
                    C.blank_to_null("IssuerReqAdmission", trim=False).alias("req"))


@register("prj9_record_id", sql_with(["wide"], """SELECT TechRcrdId, md5(SourceFileName || '|' || ISIN || '|' ||
  TradingVenueMIC || '|' || CAST(row_number() OVER (PARTITION BY SourceFileName, ISIN, TradingVenueMIC
  ORDER BY TechRcrdId) AS VARCHAR)) AS record_id FROM wide"""))
def prj9_record_id(spark, d):
    """PRJ9 (Q-3): md5(file|isin|venue|ordinal), ordinal counted within (file, isin,
    venue) in record order -- reproducible in parallel."""
    w = fx.wide(spark, d)
    n = F.row_number().over(Window.partitionBy("SourceFileName", "ISIN", "TradingVenueMIC").orderBy("TechRcrdId"))
    return w.select("TechRcrdId", C.record_id("SourceFileName", "ISIN", "TradingVenueMIC", n).alias("record_id"))


@register("prj10_first_text", sql_with(["wide"], """SELECT TechRcrdId, coalesce(nullif(trim(CmdtyBaseProduct), ''),
  nullif(trim(CmdtyTransactionType), ''), nullif(trim(ShortName), '')) AS first_text FROM wide"""))
def prj10_first_text(spark, d):
    """PRJ10: first non-blank alternative."""
    w = fx.wide(spark, d)
    return w.select("TechRcrdId", C.first_text("CmdtyBaseProduct", "CmdtyTransactionType", "ShortName")
                    .alias("first_text"))


@register("prj11_amount_ccy", sql_with(["wide"], """SELECT TechRcrdId, nullif(trim(TotalIssuedNominalAmount), '') AS amount,
  nullif(trim(TotalIssuedNominalAmountCcy), '') AS ccy FROM wide"""))
def prj11_amount_ccy(spark, d):
    """PRJ11: amount + currency attribute split from an amount struct."""
    w = fx.wide(spark, d).withColumn("amt", F.struct(F.col("TotalIssuedNominalAmount").alias("_VALUE"),
                                                     F.col("TotalIssuedNominalAmountCcy").alias("_Ccy")))
    v, c = C.amount_ccy("amt")
    return w.select("TechRcrdId", v.alias("amount"), c.alias("ccy"))


_SQL_BOOL = """CASE WHEN lower(trim({x})) IN ('1','true','t','y','yes') THEN TRUE
  WHEN lower(trim({x})) IN ('0','false','f','n','no') THEN FALSE END"""


@register("prj12_parse_bool", sql_with(["wide"], f"""SELECT TechRcrdId, {_SQL_BOOL.format(x='CommodityDerivativeInd')} AS cdi,
  {_SQL_BOOL.format(x='IssuerReqAdmission')} AS req FROM wide"""))
def prj12_parse_bool(spark, d):
    """PRJ12: boolean tokens (' Yes' -> true, '0' -> false, 'n/a' -> NULL)."""
    w = fx.wide(spark, d)
    return w.select("TechRcrdId", C.parse_bool("CommodityDerivativeInd").alias("cdi"),
                    C.parse_bool("IssuerReqAdmission").alias("req"))


_DEC = r"'^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)\s*$'"


def _sql_dec(x):
    r = f"replace({x}, ',', '.')"
    return f"CAST(CASE WHEN regexp_matches({r}, {_DEC}) THEN TRY_CAST(trim({r}) AS DECIMAL(38,10)) END AS DOUBLE)"


def _sql_int(x):
    return f"CASE WHEN regexp_matches({x}, '^\\s*[+-]?[0-9]+\\s*$') THEN TRY_CAST(trim({x}) AS INTEGER) END"


def _sql_date(x):
    return (f"CASE WHEN regexp_matches(substr({x}, 1, 10), '^\\s*[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}\\s*$') "
            f"THEN TRY_CAST(trim(substr({x}, 1, 10)) AS DATE) END")


add_cte("props", [], """SELECT event_id, props, regexp_extract(props, '([0-9]+)', 1) AS k,
  replace(CAST(value AS VARCHAR), '.', ',') AS v FROM events""")


@register("prj13_parse_decimal", sql_with(["props"], f"""SELECT event_id, {_sql_dec('props')} AS from_props,
  {_sql_dec('k')} AS from_k, {_sql_dec('v')} AS from_value FROM props"""))
def prj13_parse_decimal(spark, d):
    """PRJ13: comma decimals parsed, malformed text -> NULL (events: JSON text, a
    number inside it, and the value written with a decimal comma)."""
    e = fx.table(spark, d, "events").select(
        "event_id", "props", F.regexp_extract("props", "([0-9]+)", 1).alias("k"),
        F.replace(F.col("value").cast("string"), F.lit("."), F.lit(",")).alias("v"))
    return e.select("event_id", *[C.parse_decimal(c).cast("double").alias(n)
                                  for c, n in [("props", "from_props"), ("k", "from_k"), ("v", "from_value")]])


@register("prj14_parse_date", sql_with(["wide"], f"""SELECT TechRcrdId, {_sql_date('ReqForAdmissionDate')} AS req_date,
  {_sql_date('FixedRate')} AS bad_date, {_sql_date('TerminationDate')} AS term_date FROM wide"""))
def prj14_parse_date(spark, d):
    """PRJ14: first-10-character dates (ISO date-times included), bad text -> NULL."""
    w = fx.wide(spark, d)
    return w.select("TechRcrdId", C.parse_date("ReqForAdmissionDate").alias("req_date"),
                    C.parse_date("FixedRate").alias("bad_date"), C.parse_date("TerminationDate").alias("term_date"))


@register("prj15_parse_int", sql_with(["props"], f"""SELECT event_id, {_sql_int('k')} AS k_int,
  {_sql_int('props')} AS bad_int FROM props"""))
def prj15_parse_int(spark, d):
    """PRJ15: integer parse with a digit guard."""
    e = fx.table(spark, d, "events").select("event_id", "props",
                                            F.regexp_extract("props", "([0-9]+)", 1).alias("k"))
    return e.select("event_id", C.parse_int("k").alias("k_int"), C.parse_int("props").alias("bad_int"))


@register("prj16_cut", sql_with(["wide"], """SELECT TechRcrdId, substr(FullName, 1, 5) AS name5,
  substr(IssuerLEI, 1, 12) AS lei12 FROM wide"""))
def prj16_cut(spark, d):
    """PRJ16: width cut."""
    w = fx.wide(spark, d)
    return w.select("TechRcrdId", C.cut("FullName", 5).alias("name5"), C.cut("IssuerLEI", 12).alias("lei12"))


@register("prj17_coalesce_date", sql_with(["wide"], f"""SELECT TechRcrdId,
  coalesce({_sql_date('TerminationDate')}, DATE '1900-01-01') AS term_pk FROM wide"""))
def prj17_coalesce_date(spark, d):
    """PRJ17: 1900-01-01 sentinel for a nullable key date."""
    w = fx.wide(spark, d)
    return w.select("TechRcrdId", C.coalesce_date(C.parse_date("TerminationDate")).alias("term_pk"))


@register("prj25_split_code", sql_with(["wide"], """SELECT CFI, upper(substr(CFI, 1, 1)) AS cat, upper(substr(CFI, 2, 1)) AS grp,
  CASE WHEN length(rtrim(CFI)) >= 3 THEN upper(substr(CFI, 3, 1)) END AS a1,
  CASE WHEN length(rtrim(CFI)) >= 4 THEN upper(substr(CFI, 4, 1)) END AS a2,
  CASE WHEN length(rtrim(CFI)) >= 5 THEN upper(substr(CFI, 5, 1)) END AS a3,
  CASE WHEN length(rtrim(CFI)) >= 6 THEN upper(substr(CFI, 6, 1)) END AS a4,
  CASE WHEN CFI IS NOT NULL AND substr(CFI, 1, 1) = 'D' THEN 'DEBT' ELSE 'DERIVATIVE' END AS InstrumentCategory
FROM (SELECT DISTINCT CFI FROM wide)"""))
def prj25_split_code(spark, d):
    """PRJ25 + PRJ27: fixed-position code split and the two-way category."""
    c = fx.wide(spark, d).select("CFI").distinct()
    parts = C.split_code("CFI")
    return c.select("CFI", *[v.alias(k) for k, v in parts.items()],
                    C.instrument_category("CFI").alias("InstrumentCategory"))


# ----------------------------------------------------------------- PRJ on text
@register("prj7_sanitize", f"""SELECT doc_id, trim(replace(regexp_replace(coalesce(text, ''), '[\\r\\n\\t]+', ' ', 'g'),
  '|', ' '), {PY_WS_SQL}) AS clean FROM documents""")
def prj7_sanitize(spark, d):
    """PRJ7: CR/LF/TAB runs -> space, delimiter -> space, trim (whole texts)."""
    return _docs(spark, d).select("doc_id", C.sanitize("text").alias("clean"))


@register("prj8_clean_cell", f"""SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '{WS_CLASS}+', ' ', 'g')) AS clean
FROM documents""")
def prj8_clean_cell(spark, d):
    """PRJ8: NBSP -> space, whitespace runs collapsed, trimmed (whole texts)."""
    return _docs(spark, d).select("doc_id", C.clean_cell("text").alias("clean"))


_ISIN_SQL = "(^|[^\\p{L}\\p{N}_])([A-Z]{2}[A-Z0-9]{10})([^\\p{L}\\p{N}_]|$)"


@register("prj18_extract_isin", f"""SELECT doc_id, nullif(regexp_extract(coalesce(text, ''), '{_ISIN_SQL}', 2), '') AS isin
FROM documents""")
def prj18_extract_isin(spark, d):
    """PRJ18: first whole-word ISIN-shaped token of each document."""
    return _docs(spark, d).select("doc_id", C.extract_isin("text").alias("isin"))


@register("flt12_require_isin", f"""SELECT doc_id, isin FROM (SELECT doc_id,
  nullif(regexp_extract(coalesce(text, ''), '{_ISIN_SQL}', 2), '') AS isin FROM documents)
WHERE isin IS NOT NULL AND trim(isin) <> ''""")
def flt12_require_isin(spark, d):
    """FLT12: rows without an identifier are dropped."""
    return P.require_isin(_docs(spark, d).select("doc_id", C.extract_isin("text").alias("isin")), "isin")


@register("prj20_normalize_headers", """SELECT doc_id, regexp_replace(translate(replace(lower(replace(
  strip_accents(trim(text)), chr(65279), '')), '+', 'plus_'), '/ -.', '___'), '_{2,}', '_', 'g') AS norm FROM documents""")
def prj20_normalize_headers(spark, d):
    """PRJ20 on data: accent/BOM strip, lower, symbol rewrites (whole texts)."""
    return _docs(spark, d).select("doc_id", C.normalize_header("text").alias("norm"))


@register("prj26_between", """SELECT doc_id, regexp_extract(coalesce(text, ''), '\\(([^)]*)\\)', 1) AS inner_text,
  regexp_extract(coalesce(html, ''), '<title>([^<]*)</title>', 1) AS title FROM documents
  LEFT JOIN pages ON pages.page_id = documents.doc_id""")
def prj26_between(spark, d):
    """PRJ26: text between delimiters (documents) and the page title (pages)."""
    docs = _docs(spark, d)
    pages = fx.table(spark, d, "pages").select(F.col("page_id").alias("doc_id"), "html")
    return docs.join(pages, "doc_id", "left").select("doc_id", C.between("text").alias("inner_text"),
                                                      C.between("html", "<title>", "</title>").alias("title"))


@register("prj21_product_type", """SELECT doc_id, coalesce(nullif(trim(CASE WHEN lang <> 'en' THEN lang END), ''),
  CASE WHEN instr(lower(coalesce(text, '')), 'turbo') > 0 THEN 'turbo'
       WHEN instr(lower(coalesce(text, '')), 'warrant') > 0 THEN 'warrant'
       WHEN instr(lower(coalesce(text, '')), 'leverage') > 0 AND instr(lower(coalesce(text, '')), 'autre') > 0 THEN 'autre_leverage'
       WHEN instr(lower(coalesce(text, '')), 'autre') > 0 AND instr(lower(coalesce(text, '')), 'levier') > 0 THEN 'autre_leverage'
       WHEN instr(lower(coalesce(text, '')), 'leverage') > 0 THEN 'leverage'
       WHEN instr(lower(coalesce(text, '')), 'action') > 0 THEN 'ACTION' ELSE 'unknown' END) AS produit_type
FROM documents""")
def prj21_product_type(spark, d):
    """PRJ21: the row's type (here: non-English language code), else guessed from
    the name-like text by the ordered rules."""
    docs = _docs(spark, d)
    return docs.select("doc_id", C.product_type(F.when(F.col("lang") != "en", F.col("lang")), "text")
                       .alias("produit_type"))


@register("prj22_parse_ts", """SELECT event_id, strftime(coalesce(try_strptime(s, '%Y-%m-%d %H:%M:%S'),
  try_strptime(s, '%Y-%m-%dT%H:%M:%S'), try_strptime(s, '%Y-%m-%d %H:%M'), try_strptime(s, '%Y-%m-%dT%H:%M'),
  try_strptime(s, '%Y-%m-%d')), '%Y-%m-%d %H:%M:%S') AS parsed,
  strftime(coalesce(try_strptime(props, '%Y-%m-%d %H:%M:%S'), try_strptime(props, '%Y-%m-%d')), '%Y-%m-%d %H:%M:%S') AS bad
FROM (SELECT event_id, props, CASE event_id % 3 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
  WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M') ELSE strftime(ts, '%Y-%m-%d') END AS s FROM events)""")
def prj22_parse_ts(spark, d):
    """PRJ22: snapshot timestamps in the accepted ISO shapes; others -> NULL."""
    e = fx.table(spark, d, "events")
    s = F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")) \
        .when(F.col("event_id") % 3 == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm")) \
        .otherwise(F.date_format("ts", "yyyy-MM-dd"))
    fmt = "yyyy-MM-dd HH:mm:ss"
    return e.select("event_id", F.date_format(C.parse_ts(s), fmt).alias("parsed"),
                    F.date_format(C.parse_ts("props"), fmt).alias("bad"))


# ----------------------------------------------------------------- PRJ30 / FLT
@register("prj30_selected_or_default", sql_with(["register"], """SELECT Region,
  coalesce(CASE WHEN count(DISTINCT Country) = 1 THEN max(Country) END, 'EU') AS selected FROM register GROUP BY Region"""))
def prj30_selected_or_default(spark, d):
    """PRJ30: the single selected country per region, else a default."""
    reg = fx.venue_register(spark, d)
    return reg.groupBy("Region").agg(C.selected_or_default("Country", "EU").alias("selected"))


@register("flt1_current_only", sql_with(["wide"], "SELECT TechRcrdId, ISIN FROM wide WHERE LatestRecordFlag"))
def flt1_current_only(spark, d):
    """FLT1: current-record flag."""
    return P.current_only(fx.wide(spark, d)).select("TechRcrdId", "ISIN")


@register("flt4_matches_like", sql_with(["wide"], """SELECT DISTINCT ISIN, FullName FROM wide
  WHERE FullName LIKE '%r_ng%' OR CFI LIKE 'D_X%'"""))
def flt4_matches_like(spark, d):
    """FLT4: LIKE with % and _ wildcards."""
    w = fx.wide(spark, d)
    return w.filter(P.matches_like("FullName", "%r_ng%") | P.matches_like("CFI", "D_X%")) \
        .select("ISIN", "FullName").distinct()


@register("flt5_min_length", """SELECT doc_id FROM documents WHERE length(rtrim(lang)) >= 2 AND length(rtrim(text)) >= 2000""")
def flt5_min_length(spark, d):
    """FLT5: LEN(x) >= n (trailing blanks ignored)."""
    docs = _docs(spark, d)
    return docs.filter(P.min_length("lang", 2) & P.min_length("text", 2000)).select("doc_id")


@register("flt13_drop_blank_rows", """SELECT conv_id, turn FROM conversations
  WHERE coalesce(trim(role) <> '', FALSE) OR coalesce(trim(text) <> '', FALSE)""")
def flt13_drop_blank_rows(spark, d):
    """FLT13: drop rows whose cells are all blank."""
    c = fx.table(spark, d, "conversations")
    return P.drop_blank_rows(c.select("conv_id", "turn", "role", "text"), ["role", "text"]).select("conv_id", "turn")


# ----------------------------------------------------------------- SRC8-SRC10 on the orders manifest
add_cte("manifest", [], """SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS day,
  CASE o_orderstatus WHEN 'F' THEN 'full' WHEN 'O' THEN 'delta' ELSE 'lei' END AS kind,
  CASE o_orderstatus WHEN 'F' THEN 'FULINS_C_' || strftime(o_orderdate, '%Y%m%d') || '_01of01.zip'
       WHEN 'O' THEN 'DLTINS_' || strftime(o_orderdate, '%Y%m%d') || '_01of01.zip'
       ELSE strftime(o_orderdate, '%Y%m%d') || '-0800-lei2-golden-copy.csv.zip' END AS file_name
FROM orders""")


def manifest(spark, d):
    o = fx.table(spark, d, "orders")
    st = F.col("o_orderstatus")
    ymd = F.date_format("o_orderdate", "yyyyMMdd")
    return o.select(
        "o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("day"),
        F.when(st == "F", "full").when(st == "O", "delta").otherwise("lei").alias("kind"),
        F.when(st == "F", F.concat(F.lit("FULINS_C_"), ymd, F.lit("_01of01.zip")))
        .when(st == "O", F.concat(F.lit("DLTINS_"), ymd, F.lit("_01of01.zip")))
        .otherwise(F.concat(ymd, F.lit("-0800-lei2-golden-copy.csv.zip"))).alias("file_name"))


@register("src9_file_date", sql_with(["manifest"], """SELECT o_orderkey, file_name,
  CAST(try_strptime(nullif(regexp_extract(file_name, '^FULINS_[A-Z]_([0-9]{8})_', 1), ''), '%Y%m%d') AS DATE) AS full_date,
  CAST(try_strptime(nullif(regexp_extract(file_name, '^DLTINS_([0-9]{8})_', 1), ''), '%Y%m%d') AS DATE) AS delta_date,
  strftime(try_strptime(nullif(regexp_extract(file_name, '^([0-9]{8}-[0-9]{4})-', 1), ''), '%Y%m%d-%H%M'), '%Y-%m-%d %H:%M:%S') AS lei_ts
FROM manifest"""))
def src9_file_date(spark, d):
    """SRC9: dates embedded in the three feeds' file names."""
    m = manifest(spark, d)
    return m.select("o_orderkey", "file_name", file_date(F.col("file_name"), "full").alias("full_date"),
                    file_date(F.col("file_name"), "delta").alias("delta_date"),
                    F.date_format(file_date(F.col("file_name"), "lei"), "yyyy-MM-dd HH:mm:ss").alias("lei_ts"))


@register("src8_latest_partition", sql_with(["manifest"], """SELECT o_orderkey, kind, day FROM manifest m
  WHERE day = (SELECT max(day) FROM manifest x WHERE x.kind = m.kind)"""))
def src8_latest_partition(spark, d):
    """SRC8: files of the latest date, per feed kind."""
    return latest_partition(manifest(spark, d), "day", ["kind"]).select("o_orderkey", "kind", "day")


_LOADED_BEFORE = "2000-01-01"


@register("src10_incremental_plan", sql_with(["manifest"], f"""
WITH a AS (SELECT max(CASE WHEN kind = 'full' THEN day END) AS latest_full,
                  max(CASE WHEN kind = 'delta' THEN day END) AS latest_delta FROM manifest),
l AS (SELECT max(CASE WHEN kind = 'full' THEN day END) AS last_full,
             max(CASE WHEN kind = 'delta' THEN day END) AS last_delta FROM manifest WHERE day < DATE '{_LOADED_BEFORE}')
SELECT l.last_full, l.last_delta, a.latest_full, a.latest_delta,
  CASE WHEN a.latest_full IS NOT NULL AND (l.last_full IS NULL OR l.last_full < a.latest_full) THEN a.latest_full END AS full_to_get,
  CASE WHEN a.latest_delta IS NOT NULL AND (coalesce(l.last_delta, l.last_full) IS NULL
       OR a.latest_delta > coalesce(l.last_delta, l.last_full)) THEN a.latest_delta END AS delta_day,
  coalesce(l.last_delta, l.last_full) AS reference_date
FROM a, l"""))
def src10_incremental_plan(spark, d):
    """SRC10: what to load next, given what was loaded (everything published
    before 2000-01-01 counts as loaded)."""
    m = manifest(spark, d)
    return incremental_plan(m, m.filter(F.col("day") < F.lit(_LOADED_BEFORE).cast("date")))


# ----------------------------------------------------------------- AGG / SET / JOI11 / JOI12
@register("agg1_max_date", """SELECT max(CAST(o_orderdate AS DATE)) AS max_full_date FROM orders WHERE o_orderstatus = 'F'""")
def agg1_max_date(spark, d):
    """AGG1: scalar MAX(date) with a filter (NULL would mean 'skip')."""
    o = fx.table(spark, d, "orders").withColumn("day", F.to_date("o_orderdate"))
    return spark.range(1).select(max_date(o, "day", F.col("o_orderstatus") == "F").alias("max_full_date"))


@register("agg2_row_delta", sql_with(["cdc_state", "delta_d"], """SELECT
  (SELECT count(*) FROM cdc_state) AS rows_before,
  (SELECT count(*) FROM cdc_state) + (SELECT count(*) FROM delta_d d WHERE d.ActionType IN ('NEW', 'MOD')
     AND NOT EXISTS (SELECT 1 FROM cdc_state s WHERE s.ISIN = d.ISIN AND s.TradingVenueMIC = d.TradingVenueMIC
     AND s.ValidFromDate = d.VF)) AS rows_after,
  (SELECT count(*) FROM delta_d d WHERE d.ActionType IN ('NEW', 'MOD')
     AND NOT EXISTS (SELECT 1 FROM cdc_state s WHERE s.ISIN = d.ISIN AND s.TradingVenueMIC = d.TradingVenueMIC
     AND s.ValidFromDate = d.VF)) AS rows_delta"""))
def agg2_row_delta(spark, d):
    """AGG2: row counts before / after the delta apply."""
    from ..operators.cdc import apply_delta
    state = fx.cdc_state(spark, d)
    return row_delta(state, apply_delta(state, fx.delta(spark, d)))


@register("agg16_is_empty", sql_with(["wide", "delta"], """SELECT ((SELECT count(*) FROM wide) + (SELECT count(*) FROM delta)) = 0
  AS staging_empty, ((SELECT count(*) FROM wide WHERE ISIN IS NULL) + (SELECT count(*) FROM delta WHERE ISIN IS NULL)) = 0 AS keyed"""))
def agg16_is_empty(spark, d):
    """AGG16: emptiness guard over the full and the delta wide table; and over their
    rows without a key (a guard that answers true)."""
    w, dl = fx.wide(spark, d), fx.delta(spark, d)
    return spark.range(1).select(is_empty(w, dl).alias("staging_empty"),
                                 is_empty(w.filter("ISIN IS NULL"), dl.filter("ISIN IS NULL")).alias("keyed"))


@register("set1_union_files", sql_with(["wide"], """SELECT SourceFileName, count(*) AS rows FROM wide GROUP BY SourceFileName"""))
def set1_union_files(spark, d):
    """SET1: the history and the new files appended (UNION ALL), rows per file."""
    w = fx.wide(spark, d)
    cut = F.lit(fx.HISTORY_CUTOFF).cast("date")
    u = union_files([w.filter(F.col("ValidFromDate") < cut), w.filter(F.col("ValidFromDate") >= cut)])
    return u.groupBy("SourceFileName").agg(F.count(F.lit(1)).alias("rows"))


@register("set3_distinct_values", sql_with(["typed"], """SELECT DISTINCT IssuerLEI FROM typed WHERE IssuerLEI IS NOT NULL"""))
def set3_distinct_values(spark, d):
    """SET3 / AGG3: distinct non-NULL values."""
    from ..operators.measures import distinct_keys
    return distinct_keys(wh.staging(spark, d)["listing"], "IssuerLEI")


@register("joi11_append_common", sql_with(["delta"], """SELECT ISIN, TradingVenueMIC, IssuerLEI, FullName, ValidFromDate FROM delta"""))
def joi11_append_common(spark, d):
    """JOI11: project a delta onto the columns it shares with the state table."""
    from ..operators.joins import append_common
    return append_common(fx.cdc_state(spark, d).columns, fx.delta(spark, d),
                         exclude=("ValidToDate", "LatestRecordFlag"))


@register("joi12_star_view", sql_with(["star"], """SELECT ISIN, TradingVenueMIC, VenueMIC, MarketName, City, VenueCountry,
  VenueRegion, IssuerCountry, IssuerRegion, CfiCode, Category FROM star"""))
def joi12_star_view(spark, d):
    """JOI10 / JOI12: the fact along its dimension paths (blank members kept)."""
    columns = ["ISIN", "TradingVenueMIC", "VenueMIC", "MarketName", "City", "VenueCountry", "VenueRegion",
               "IssuerCountry", "IssuerRegion", "CfiCode", "Category"]
    return wh.star_view(spark, d, *columns).select(columns)


_LSK = "count(DISTINCT InstrumentListingSK) + max(CASE WHEN InstrumentListingSK IS NULL THEN 1 ELSE 0 END)"


@register("agg9_share_of_total", sql_with(["star"], """SELECT VenueMIC, listings,
  round(CAST(listings AS DOUBLE) / nullif((SELECT count(DISTINCT InstrumentListingSK) + max(CASE WHEN InstrumentListingSK IS NULL THEN 1 ELSE 0 END) FROM star), 0), 6) AS share
FROM (SELECT VenueMIC, count(DISTINCT InstrumentListingSK) + max(CASE WHEN InstrumentListingSK IS NULL THEN 1 ELSE 0 END) AS listings
      FROM star GROUP BY VenueMIC)"""))
def agg9_share_of_total(spark, d):
    """AGG9: every venue's share of all listings (grouping removed for the total)."""
    s = share_of_total(wh.star(spark, d, "VenueMIC", "InstrumentListingSK"), ["VenueMIC"], "InstrumentListingSK")
    return s.select("VenueMIC", "listings", F.round("share", 6).alias("share"))


@register("agg9_total_without_code", sql_with(["star"], f"""SELECT g.VenueMIC, g.CfiCode, g.listings, t.listings_all_codes FROM
  (SELECT VenueMIC, CfiCode, {_LSK} AS listings FROM star GROUP BY VenueMIC, CfiCode) g JOIN
  (SELECT VenueMIC, {_LSK} AS listings_all_codes FROM star GROUP BY VenueMIC) t ON g.VenueMIC IS NOT DISTINCT FROM t.VenueMIC"""))
def agg9_total_without_code(spark, d):
    """AGG9: listings per venue and classification code, with the code's filter removed for the total."""
    from ..operators.measures import total_without
    return total_without(wh.star(spark, d, "VenueMIC", "CfiCode", "InstrumentListingSK"), ["VenueMIC", "CfiCode"], ["CfiCode"], "InstrumentListingSK",
                         "listings_all_codes")


@register("agg10_agg_by_issuer", sql_with(["star"], """SELECT IssuerSK, count(DISTINCT InstrumentSK)
  + max(CASE WHEN InstrumentSK IS NULL THEN 1 ELSE 0 END) AS InstrumentsCnt FROM star GROUP BY IssuerSK"""))
def agg10_agg_by_issuer(spark, d):
    """AGG10: issuer -> distinct instruments pre-aggregate."""
    from ..operators.measures import agg_by_group
    return agg_by_group(wh.star(spark, d, "IssuerSK", "InstrumentSK"), "IssuerSK", "InstrumentSK", "InstrumentsCnt")


@register("agg8_total_nominal", sql_with(["enrich_tgt", "u_merged", "star"], f"""
SELECT round(CAST(t AS DOUBLE), 2) AS total_nominal, round(CAST(t AS DOUBLE) / nullif(n, 0), 6) AS nominal_per_listing
FROM (SELECT sum(u.TotalIssuedNominalAmount) AS t FROM enrich_tgt d LEFT JOIN u_merged u
      ON u.ISIN = d.ISIN AND u.ValidFromDate = d.ValidFromDate), (SELECT {_LSK} AS n FROM star)"""))
def agg8_total_nominal(spark, d):
    """AGG8 + AGG6: total nominal over the enriched instrument dimension (all versions,
    not sliced by the fact) and nominal per listing of the fact (blank on zero)."""
    from ..operators.measures import distinct_count, ratio
    dim = wh.enriched(wh.dimensions(spark, d, "instrument")["instrument"].select("ISIN", "ValidFromDate", "InstrumentSK"),
                      wh.enrichment(wh.staged(spark, d)))
    n = wh.star(spark, d, "InstrumentListingSK").select(distinct_count("InstrumentListingSK")).scalar()
    k = dim.agg(F.try_sum("TotalIssuedNominalAmount").alias("t")).withColumn("n", n)
    return k.select(F.round(F.col("t").cast("double"), 2).alias("total_nominal"),
                    F.round(ratio(F.col("t"), F.col("n")), 6).alias("nominal_per_listing"))


# ----------------------------------------------------------------- SRC7 (rows-only: no SQL twin)
QUOTE_PAGE_HEADERS = ["ISIN", "Produit", "Ss-Jacent", "Barrière", "Achat", "Vente", "Levier", "Maturité", "Var.",
                      "Émetteurs", "DATE_EXTRACTION", "ProduitType"]


@register("src7_html_best_table")
def src7_html_best_table(spark, d):
    """SRC7 + PRJ18/PRJ19/FLT13: rows of each page's best-matching quote table
    (every page is parsed; the driver's pages carry no <table>, so the result
    is empty -- the golden page test checks the values)."""
    from ..sources.html import html_best_table
    return html_best_table(fx.table(spark, d, "pages"), QUOTE_PAGE_HEADERS)


_QUOTE_PAGE_SQL = """SELECT l_orderkey AS page_id, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_extendedprice) AS INTEGER) AS row_no,
  'XS' || lpad(CAST(l_partkey AS VARCHAR), 10, '0') AS "ISIN", 'Turbo ' || CAST(l_suppkey AS VARCHAR) AS h_produit,
  l_returnflag AS h_ssjacent, '' AS h_barriere, printf('%.2f', l_quantity) AS h_achat, printf('%.2f', l_extendedprice) AS h_vente,
  CAST(l_linenumber AS VARCHAR) AS h_levier, l_linestatus AS h_var FROM lineitem"""


@register("src7_html_quote_pages", _QUOTE_PAGE_SQL)
def src7_html_quote_pages(spark, d):
    """SRC7 + PRJ18/PRJ19: one quote page per order (its lines as table rows, behind a
    menu table; every other row leaves its end tags out), read back by header name:
    the same name, a synonym, a part of the name."""
    from ..sources.html import html_best_table
    li = fx.table(spark, d, "lineitem")
    cells = [F.concat(F.lit("XS"), F.lpad(F.col("l_partkey").cast("string"), 10, "0")),
             F.concat(F.lit("<b>Turbo</b> "), F.col("l_suppkey").cast("string")), F.col("l_returnflag"),
             F.format_string("%.2f", "l_quantity"), F.format_string("%.2f", "l_extendedprice"),
             F.col("l_linenumber").cast("string"), F.col("l_linestatus")]
    closed = F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), c, F.lit("</td>")) for c in cells], F.lit("</tr>"))
    opened = F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), c) for c in cells])
    row = F.when(F.col("l_linenumber") % 2 == 0, opened).otherwise(closed)
    rows = li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_extendedprice", row.alias("h")))).alias("r"))
    head = "".join(f"<th>{h}</th>" for h in ("ISIN", "Nom", "Underlying", "Cours achat", "Vente", "Levier max", "Var."))
    pages = rows.select(
        F.col("l_orderkey").alias("page_id"), F.lit("u").alias("url"),
        F.concat(F.lit("<html><p>" + "x" * 200 + "<table><tr><td>menu<td>home</table><table><thead><tr>" + head + "</tr></thead>"),
                 F.array_join(F.transform("r", lambda x: x["h"]), ""), F.lit("</table></html>")).alias("html"))
    return html_best_table(pages, QUOTE_PAGE_HEADERS).select(
        "page_id", "row_no", "ISIN", "h_produit", "h_ssjacent", "h_barriere", "h_achat", "h_vente", "h_levier", "h_var")


# ----------------------------------------------------------------- SRC3 / SRC4 round trips
_PSV_COLS = ["TechRcrdId", "ISIN", "FullName", "CFI", "TradingVenueMIC", "TerminationDate", "FixedRate",
             "CmdtyBaseProduct", "CmdtyTransactionType", "ValidFromDate", "LatestRecordFlag"]


@register("src3_wide_roundtrip", sql_with(["wide"], "SELECT " + ", ".join(
    f"nullif(CAST({c} AS VARCHAR), '') AS {c}" for c in _PSV_COLS) + " FROM wide"))
def src3_wide_roundtrip(spark, d):
    """SRC3: the wide feed written as a pipe file (header, empty = NULL) and read
    back with the explicit all-text schema."""
    from ..sources.text import read_wide, write_wide
    path = fx.scratch_path(spark, "wide_psv")
    write_wide(fx.wide(spark, d).select(*_PSV_COLS), path)
    return read_wide(spark, path, columns=_PSV_COLS)


# Source headers of the golden copy (dotted, as published) -> target columns.
LEI_MAPPING = [("LEI", "LEI"), ("Entity.LegalName", "LegalName"),
               ("Entity.LegalAddress.FirstAddressLine", "LegalAddress_FirstAddressLine"),
               ("Entity.LegalAddress.City", "LegalAddress_City"),
               ("Entity.LegalAddress.Country", "LegalAddress_Country"),
               ("Entity.EntityCategory", "EntityCategory"), ("Entity.EntityStatus", "EntityStatus"),
               ("Registration.InitialRegistrationDate", "InitialRegistrationDate"),
               ("Registration.LastUpdateDate", "LastUpdateDate")]


def _lei_target():
    from pyspark.sql.types import DateType, StringType, StructField, StructType, TimestampNTZType
    return StructType([
        StructField("LEI", StringType(), False),
        StructField("LegalName", StringType(), True, {"width": 12}),
        StructField("LegalAddress_FirstAddressLine", StringType(), True),
        StructField("LegalAddress_City", StringType(), True),
        StructField("LegalAddress_Country", StringType(), True),
        StructField("EntityCategory", StringType(), True),
        StructField("EntityStatus", StringType(), True),
        StructField("InitialRegistrationDate", DateType(), True),
        StructField("LastUpdateDate", TimestampNTZType(), True),
        StructField("RegistrationStatus", StringType(), True),
    ])


@register("src4_golden_copy_load", sql_with(["golden"], """SELECT LEI, substr(LegalName, 1, 12) AS LegalName,
  LegalAddress_FirstAddressLine, LegalAddress_City, LegalAddress_Country, EntityCategory, EntityStatus,
  InitialRegistrationDate, date_trunc('second', LastUpdateDate) AS LastUpdateDate,
  CAST(NULL AS VARCHAR) AS RegistrationStatus FROM golden"""))
def src4_golden_copy_load(spark, d):
    """SRC4 + PRJ1 + PRJ2 + PRJ4 + PRJ5: the golden copy written as CSV with its
    dotted source headers, read back, mapped (fail-fast), blank -> NULL,
    contract-checked against the target and cast (width cut, dates,
    second-precision timestamps; a missing nullable target column is NULL)."""
    from ..functions.clean import blank_to_null_all
    from ..operators.contract import cast_to, enforce_contract, project_mapping
    from ..sources.text import read_lei_csv
    g = fx.golden(spark, d).select(*[F.col(t).cast("string").alias(s) for s, t in LEI_MAPPING])
    path = fx.scratch_path(spark, "lei_csv")
    g.write.option("header", True).option("escape", '"').csv(path)
    raw = read_lei_csv(spark, path)
    target = _lei_target()
    return cast_to(enforce_contract(blank_to_null_all(project_mapping(raw, LEI_MAPPING)), target), target)


# ----------------------------------------------------------------- SRC5 quote files
def _quote_frames(spark, d):
    """Events rendered as quote files in two layouts (views/clicks as turbos,
    the rest as shares); a quarter of the rows leave the product type blank."""
    e = fx.table(spark, d, "events")
    isin = F.concat(F.lit("FR"), F.lpad(F.col("event_id").cast("string"), 10, "0"))
    num = F.format_string("%.2f", F.col("value"))
    fr = F.replace(num, F.lit("."), F.lit(","))
    ts = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    ptype = lambda t: F.when(F.col("event_id") % 4 == 0, F.lit("")).otherwise(F.lit(t))
    url = F.concat(F.lit("https://quotes.example/"), F.col("event_type"))
    turbo = e.filter(F.col("event_type").isin("view", "click")).select(
        isin.alias("ISIN"), F.concat(F.lit("P"), F.col("user_id").cast("string")).alias("Produit"),
        F.col("event_type").alias("Ss-Jacent"), num.alias("Barrière"), fr.alias("Achat"), fr.alias("Vente"),
        (F.col("user_id") % 20).cast("string").alias("Levier"), F.date_format("ts", "yyyy-MM-dd").alias("Maturité"),
        F.concat(fr, F.lit("%")).alias("Var."), F.concat(F.lit("E"), (F.col("user_id") % 7).cast("string")).alias("Émetteurs"),
        ts.alias("DATE_EXTRACTION"), ptype("turbo").alias("ProduitType"), url.alias("SOURCE_URL"))
    action = e.filter(~F.col("event_type").isin("view", "click")).select(
        isin.alias("ISIN"), F.upper(F.col("event_type")).alias("Libellé"), fr.alias("Dernier"),
        F.concat(fr, F.lit("%")).alias("Var."), fr.alias("Ouv"), fr.alias("+Haut"), fr.alias("+Bas"),
        F.lit("0,0%").alias("Var/1Janv"), F.col("user_id").cast("string").alias("Vol."),
        ts.alias("DATE_EXTRACTION"), ptype("ACTION").alias("ProduitType"), url.alias("SOURCE_URL"))
    return turbo, action


_Q_OUT = [c for c in C.QUOTE_COLUMNS if c != "file_name"]
_FR = "replace(printf('%.2f', value), '.', ',')"
_TS = "strftime(ts, '%Y-%m-%d %H:%M:%S')"
_ISIN = "'FR' || lpad(CAST(event_id AS VARCHAR), 10, '0')"
_PT = "CASE WHEN event_id % 4 = 0 THEN 'unknown' ELSE '{t}' END"
_URL = "'https://quotes.example/' || event_type"
_SRC5_SQL = f"""
SELECT {_ISIN} AS isin, CAST(NULL AS VARCHAR) AS libelle, 'P' || CAST(user_id AS VARCHAR) AS produit, {_PT.format(t='turbo')} AS produit_type,
  {_URL} AS source_url, {_TS} AS date_extraction, CAST(NULL AS VARCHAR) AS dernier, {_FR} || '%' AS variation, CAST(NULL AS VARCHAR) AS ouverture,
  CAST(NULL AS VARCHAR) AS plus_haut, CAST(NULL AS VARCHAR) AS plus_bas, CAST(NULL AS VARCHAR) AS var_1janv, CAST(NULL AS VARCHAR) AS volume, {_FR} AS achat, {_FR} AS vente,
  CAST(NULL AS VARCHAR) AS sous_jacent, event_type AS ss_jacent, CAST(NULL AS VARCHAR) AS borne_basse, CAST(NULL AS VARCHAR) AS borne_haute, printf('%.2f', value) AS barriere,
  CAST(user_id % 20 AS VARCHAR) AS levier, CAST(NULL AS VARCHAR) AS prix_exercice, strftime(ts, '%Y-%m-%d') AS maturite, CAST(NULL AS VARCHAR) AS delta,
  'E' || CAST(user_id % 7 AS VARCHAR) AS emetteurs
FROM events WHERE event_type IN ('view', 'click')
UNION ALL
SELECT {_ISIN}, upper(event_type), NULL, {_PT.format(t='ACTION')}, {_URL}, {_TS}, {_FR}, {_FR} || '%', {_FR},
  {_FR}, {_FR}, '0,0%', CAST(user_id AS VARCHAR), NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
FROM events WHERE event_type NOT IN ('view', 'click')"""


@register("src5_read_quotes", _SRC5_SQL)
def src5_read_quotes(spark, d):
    """SRC5 + PRJ20 + PRJ21 + PRJ22 + PRJ23: quote files of two layouts in one
    folder -> the quote table in one scan (file name excluded from the check:
    it is the writer's part-file name)."""
    from ..sources.text import read_quotes
    path = fx.scratch_path(spark, "quotes")
    for frame in _quote_frames(spark, d):
        frame.write.mode("append").option("sep", "|").option("header", True).csv(path)
    return read_quotes(spark, path).select(*_Q_OUT)


# ----------------------------------------------------------------- SRC1 full-file XML
_XML_OUT = ["ISIN", "FullName", "ShortName", "CFI", "NotionalCurrency", "IssuerLEI", "TradingVenueMIC",
            "AdmissionApprvlDate", "FirstTradingDate", "TerminationDate", "TotalIssuedNominalAmount",
            "TotalIssuedNominalAmountCcy", "MaturityDate", "FixedRate", "DebtSeniority", "ExpiryDate",
            "PriceMultiplier", "OptionType", "DeliveryType", "StrikePrice", "StrikePriceCcy"]


def wide_as_records(w):
    """The wide feed as nested full-file records (element names of the published
    schema; currencies as the ``Ccy`` attribute)."""
    b = lambda c: C.blank_to_null(c, trim=False)
    amt = lambda v, c: F.struct(b(v).alias("_VALUE"), b(c).alias("_Ccy"))
    return w.select(
        F.struct(b("ISIN").alias("Id"), b("FullName").alias("FullNm"), b("ShortName").alias("ShrtNm"),
                 b("CFI").alias("ClssfctnTp"), b("NotionalCurrency").alias("NtnlCcy")).alias("FinInstrmGnlAttrbts"),
        b("IssuerLEI").alias("Issr"),
        F.struct(b("TradingVenueMIC").alias("Id"), b("AdmissionApprvlDate").alias("AdmssnApprvlDtByIssr"),
                 b("FirstTradingDate").alias("FrstTradDt"), b("TerminationDate").alias("TermntnDt"))
        .alias("TradgVnRltdAttrbts"),
        F.struct(amt("TotalIssuedNominalAmount", "TotalIssuedNominalAmountCcy").alias("TtlIssdNmnlAmt"),
                 b("MaturityDate").alias("MtrtyDt"), F.struct(b("FixedRate").alias("Fxd")).alias("IntrstRate"),
                 b("DebtSeniority").alias("DebtSnrty")).alias("DebtInstrmAttrbts"),
        F.struct(b("ExpiryDate").alias("XpryDt"), b("PriceMultiplier").alias("PricMltplr"),
                 b("OptionType").alias("OptnTp"),
                 F.struct(F.struct(F.struct(amt("StrikePrice", "StrikePriceCcy").alias("Amt")).alias("MntryVal"))
                          .alias("Pric")).alias("StrkPric"), b("DeliveryType").alias("DlvryTp")).alias("DerivInstrmAttrbts"))


RECORDS_PER_FILE = 50_000       # of a compressed file, which one task reads


def write_records(records, path, root, tag):
    """XML files as published: compressed (records are mostly tags), of a bounded number of records each;
    a record to a line, as blanks between its tags only cost time, and compressed fast."""
    records.write.format("xml").option("rootTag", root).option("rowTag", tag).option("indent", "").option("compression", "gzip") \
        .option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", RECORDS_PER_FILE).save(path)


@register("src1_read_full_xml", sql_with(["wide"], "SELECT " + ", ".join(
    f"nullif({c}, '') AS {c}" for c in _XML_OUT) + " FROM wide"))
def src1_read_full_xml(spark, d):
    """SRC1 + PRJ11: the wide feed written as full-file XML records and read back
    by schema path (whole table, in compressed files of a bounded number of records)."""
    from ..sources.xml import read_full_xml
    path = fx.scratch_path(spark, "fulins_xml")
    write_records(wide_as_records(fx.wide(spark, d)), path, "FinInstrmRptgRefDataRpt", "RefData")
    return read_full_xml(spark, path).select(*_XML_OUT)


# ----------------------------------------------------------------- SRC2 delta XML
def delta_as_records(dl):
    """The delta feed as ``FinInstrm`` elements wrapping one New/Modified/
    Terminated/Cancelled record each (the schema's choice)."""
    b = lambda c: C.blank_to_null(c, trim=False)
    rec = F.struct(
        F.struct(b("ISIN").alias("Id"), b("FullName").alias("FullNm")).alias("FinInstrmGnlAttrbts"),
        b("IssuerLEI").alias("Issr"),
        F.struct(b("TradingVenueMIC").alias("Id"), b("TerminationDate").alias("TermntnDt")).alias("TradgVnRltdAttrbts"),
        F.struct(F.struct(b("HeaderReportingPeriodDate").alias("FrDt")).alias("PblctnPrd")).alias("TechAttrbts"))
    from ..sources.xml import DELTA_KINDS
    return dl.select(*[F.when(F.col("ActionType") == code, rec).alias(kind) for kind, code in DELTA_KINDS])


@register("src2_read_delta_xml", sql_with(["delta"], """SELECT ActionType, ISIN, TradingVenueMIC, IssuerLEI, FullName,
  TerminationDate, HeaderReportingPeriodDate AS PublicationFromDate FROM delta"""))
def src2_read_delta_xml(spark, d):
    """SRC2: the delta feed written as delta-file XML and read back -- the action
    comes from the record wrapper."""
    from ..sources.xml import read_delta_xml
    path = fx.scratch_path(spark, "dltins_xml")
    write_records(delta_as_records(fx.delta(spark, d)), path, "FinInstrmRptgRefDataDltaRpt", "FinInstrm")
    return read_delta_xml(spark, path).select("ActionType", "ISIN", "TradingVenueMIC", "IssuerLEI", "FullName",
                                              "TerminationDate", "PublicationFromDate")
