"""HTML quote pages -> rows of the best-matching table (inventory SRC7, PRJ18,
PRJ19, FLT13).

Python only takes the tags apart (an Arrow UDF: per page its tables' headers and
rows). Which table fits, which cell belongs to which column, cleaning and the ISIN
fallback are column expressions over them.
"""

from __future__ import annotations

import re
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clean import clean_cell, extract_isin, strip_accents

# --------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# --------------------------------------------------------------------------
SYNONYMS = {
    "produit": ["libelle", "nom", "designation", "instrument"],
    "ssjacent": ["sousjacent", "underlying", "actifsousjacent"],
    "barriere": ["knockout", "barrier", "seuil"],
    "achat": ["buy", "coursachat", "prixachat"],
    "vente": ["sell", "coursvente", "prixvente"],
    "levier": ["lever", "leverage", "gearing"],
    "maturite": ["maturity", "echeance", "expiry"],
    "var": ["variation", "change", "evolution", "var"],
    "emetteurs": ["emetteur", "issuer", "editeur"],
}
NOT_SCORED = {"ISIN", "DATE_EXTRACTION", "PRODUITTYPE", "SOURCE_URL"}
MIN_HTML_LENGTH = 200
# --------------------------------------------------------------------------


class TableRows(HTMLParser):
    """(table, row, in head, [(tag, text)]) of every table row of a page. A row or
    cell ends at its end tag or, where that is left out, at the next row, cell,
    section or table end. Each table keeps its own open row, so tables may nest."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple[int, int, bool, list[tuple[str, str]]]] = []
        self._open: list[dict] = []
        self._tables = 0
        self.feed(html)
        self.close()
        while self._open:
            self._end_table()

    def _end_cell(self, t):
        if t["cell"] is not None:
            tag, parts = t["cell"]
            t["row"].append((tag, " ".join(parts)))
            t["cell"] = None

    def _end_row(self, t):
        self._end_cell(t)
        if t["row"] is not None:
            self.rows.append((t["no"], t["n"], t["head"], t["row"]))
            t["n"] += 1
            t["row"] = None

    def _end_table(self):
        self._end_row(self._open[-1])
        self._open.pop()

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self._open.append({"no": self._tables, "n": 0, "head": False, "row": None, "cell": None})
            self._tables += 1
        elif self._open:
            t = self._open[-1]
            if tag in ("thead", "tbody", "tfoot"):
                self._end_row(t)
                t["head"] = tag == "thead"
            elif tag == "tr":
                self._end_row(t)
                t["row"] = []
            elif tag in ("td", "th"):
                self._end_cell(t)
                if t["row"] is None:
                    t["row"] = []
                t["cell"] = (tag, [])

    def handle_endtag(self, tag):
        if not self._open:
            return
        t = self._open[-1]
        if tag in ("td", "th"):
            self._end_cell(t)
        elif tag == "tr":
            self._end_row(t)
        elif tag == "thead":
            self._end_row(t)
            t["head"] = False
        elif tag == "table":
            self._end_table()

    def handle_data(self, data):
        if self._open and self._open[-1]["cell"] is not None:
            self._open[-1]["cell"][1].append(data)


# Tags that a page's pieces are told apart by; any other one only parts the text around it.
_ROW_TAGS = {t: t for t in ("table", "/table", "thead", "/thead", "tbody", "tfoot", "tr", "/tr", "td", "th", "/td", "/th")}
# Elements whose content the parser reads as text, not as tags.
_RAW = {"script", "style"}
_RAW_TEXT = {"title", "textarea", "iframe", "noembed", "noframes", "xmp", "plaintext", "noscript"}
_TAG = re.compile(r"""/?([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\n\r\f]+[a-zA-Z_:-][a-zA-Z0-9_:.-]*"""
                  r"""(?:=(?:"[^"<>]*"|'[^'<>]*'|[^<>"'`= \t\n\r\f/]+))?)*[ \t\n\r\f]*/?)""")
_DOCTYPE = re.compile(r"!doctype( [^<>\[\]-]*)?", re.I)


def _kind(tag: str) -> str | None:
    """What a piece between ``<`` and ``>`` is: one of the row tags, a raw element's name, "" for a tag
    that only parts the text; None where only the parser knows."""
    m = _TAG.fullmatch(tag)
    if m is None:
        return "" if _DOCTYPE.fullmatch(tag) else None
    name = m[1].lower()
    if tag[0] == "/":
        if m[2].strip(" \t\n\r\f"):
            return None                            # an end tag with attributes
        return _ROW_TAGS.get("/" + name, "")
    if name in _RAW or name in _RAW_TEXT or name in _ROW_TAGS:
        return None if m[2].endswith("/") else name
    return ""


class NotPlain(Exception):
    """The page holds something that ``plain_rows`` leaves to ``TableRows``."""


def plain_rows(html: str, kinds: dict[str, str | None]) -> list[tuple[int, int, bool, list[tuple[str, str]]]]:
    """``TableRows(html).rows`` for pages of ordinary tags, cut at ``<`` instead of parsed character by
    character; raises ``NotPlain`` for the others (broken tags, declarations, raw text within a cell).
    ``kinds`` keeps what a tag's text was found to be, from page to page."""
    rows: list[tuple[int, int, bool, list[tuple[str, str]]]] = []
    outer: list[tuple] = []               # the open tables around the one that no, n, head, row, cell and parts are of
    tables, no, n, head = 0, -1, 0, False
    row = cell = parts = None
    pieces = iter(html.split("<"))
    next(pieces)
    for piece in pieces:
        tag, end, text = piece.partition(">")
        kind = kinds.get(tag)
        if kind is None:
            if tag[:3] == "!--":
                after = piece.find("-->", 5)
                if after < 0 or "--!" in piece or piece[3] in ">-":
                    raise NotPlain
                text, end, kind = piece[after + 3:], ">", ""
            else:
                kind = _kind(tag)
                if kind is None:
                    raise NotPlain
                if len(kinds) < 10000:
                    kinds[tag] = kind
        if kind and (no >= 0 or kind not in _ROW_TAGS or kind == "table"):
            if kind == "td" or kind == "th":
                if cell is not None:
                    row.append((cell, " ".join(parts)))
                elif row is None:
                    row = []
                cell, parts = kind, []
            elif kind == "/td" or kind == "/th":
                if cell is not None:
                    row.append((cell, " ".join(parts)))
                    cell = None
            elif kind == "table":
                outer.append((no, n, head, row, cell, parts))
                no, n, head, row, cell = tables, 0, False, None, None
                tables += 1
            elif kind not in _ROW_TAGS:
                if cell is not None or not end:
                    raise NotPlain
                for piece in pieces:
                    tag, end, text = piece.partition(">")
                    if tag.lower() == "/" + kind and end:
                        break
                    if kind in _RAW_TEXT or tag[:len(kind) + 1].lower() == "/" + kind:
                        raise NotPlain
                else:
                    raise NotPlain
            else:
                if cell is not None:
                    row.append((cell, " ".join(parts)))
                    cell = None
                if row is not None:
                    rows.append((no, n, head, row))
                    n += 1
                    row = None
                if kind == "tr":
                    row = []
                elif kind == "/table":
                    no, n, head, row, cell, parts = outer.pop()
                elif kind != "/tr":
                    head = kind == "thead"
        if text:
            if cell is not None:
                parts.append(unescape(text) if "&" in text else text)
        elif not end:
            raise NotPlain
    while no >= 0:
        if cell is not None:
            row.append((cell, " ".join(parts)))
        if row is not None:
            rows.append((no, n, head, row))
        no, n, head, row, cell, parts = outer.pop()
    return rows


def rows_of(html: str, kinds: dict[str, str | None]) -> list[tuple[int, int, bool, list[tuple[str, str]]]]:
    """The rows of ``TableRows``, by the shorter way where the page allows it."""
    try:
        return plain_rows(html, kinds)
    except NotPlain:
        return TableRows(html).rows


def page_tables(html_col: Column) -> Column:
    """Per page its tables that have rows, in their order: the header's cells (those of the first row of its
    head, else of its first row) and the ``td`` cells of each row after the first that has any. The texts are
    cleaned as by ``clean_cell``: ``split`` parts them at the same white space."""
    @F.arrow_udf("array<struct<head: array<string>, rows: array<array<string>>>>")
    def tables(pages: pa.Array) -> pa.Array:
        kinds: dict[str, str | None] = {}
        heads, head_ends, cells, cell_ends, row_ends, table_ends = [], [0], [], [0], [0], [0]
        for html in pages.to_pylist():
            found: dict[int, list] = {}
            for no, n, in_head, row in rows_of(html or "", kinds):
                t = found.get(no)
                if t is None:
                    t = found[no] = [row, in_head, []]
                elif in_head and not t[1]:
                    t[0], t[1] = row, True
                if n > 0:
                    data = [" ".join(text.split()) for tag, text in row if tag == "td"]
                    if data:
                        t[2].append(data)
            for no in sorted(found):
                head, _, data = found[no]
                heads += [" ".join(text.split()) for _, text in head]
                head_ends.append(len(heads))
                for row in data:
                    cells += row
                    cell_ends.append(len(cells))
                row_ends.append(len(cell_ends) - 1)
            table_ends.append(len(row_ends) - 1)

        def lists(ends: list[int], values: pa.Array) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
        rows = lists(row_ends, lists(cell_ends, pa.array(cells, pa.string())))
        return lists(table_ends, pa.StructArray.from_arrays([lists(head_ends, pa.array(heads, pa.string())), rows], ["head", "rows"]))

    return tables(html_col)


def plain_name(c: Column) -> Column:
    """A header reduced to its letters and digits: lower case, without accents."""
    return F.regexp_replace(F.lower(strip_accents(F.trim(c))), "[^a-z0-9]+", "")


def column_of(names: Column, wanted: str) -> Column:
    """PRJ19: the place (from 0) in ``names``, an array of plain names, of the column that
    serves ``wanted`` (a plain name): the same name, else its first synonym there, else the
    first name that contains it or is contained in it; null if there is none."""
    exact = [F.array_position(names, n) for n in [wanted, *SYNONYMS.get(wanted, [])]]
    part = F.array_position(F.transform(names, lambda n: (n != "") & (
        F.contains(n, F.lit(wanted)) | F.contains(F.lit(wanted), n))), True)
    return (F.coalesce(*[F.nullif(p, F.lit(0)) for p in [*exact, part]]) - 1).cast("int")


def html_best_table(pages: DataFrame, expected: list[str], html_col: str = "html",
                    keys: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """SRC7: one output row per data row of each page's best table, with one
    text column per expected header (named by a plain form of the header),
    ``row_no``, ``row_text`` and the page's ISIN fallback. The best table is the
    first of those whose header (the first row of its head, else its first row) has
    most expected names, at least one. Blank rows are dropped (FLT13); ISIN = first
    ISIN-shaped token of the row, else of the page."""
    spark = pages.sparkSession
    fields = [h for h in expected if h and h.upper() not in NOT_SCORED]
    # the expected names in their plain form, by the same expression as the headers
    plain = [r[0] for r in spark.createDataFrame([(i, h) for i, h in enumerate(fields)], "i INT, h STRING")
             .select(plain_name(F.col("h")).alias("p"), "i").orderBy("i").collect()]
    wanted = F.array(*[F.lit(p) for p in sorted(set(plain))]).cast("array<string>")
    # a page is one row until its best table is known, and the columns are found once per page
    page = F.col(html_col)
    tables = pages.where(F.length(page) >= MIN_HTML_LENGTH) \
        .select(*keys, extract_isin(page).alias("page_isin"), page_tables(page).alias("tables"))
    tables = tables.withColumn("names", F.transform("tables", lambda t: F.transform(
        t["head"], plain_name)))
    tables = tables.withColumn("best", F.array_min(F.transform("names", lambda n, i: F.struct(
        (-F.size(F.array_intersect(n, wanted))).alias("score"), i.alias("i")))))
    # no rows instead of a filter, which would find the names twice
    tables = tables.select(*keys, "page_isin", F.get("names", F.col("best.i")).alias("names"), F.when(
        F.col("best.score") < 0, F.get("tables", F.col("best.i"))["rows"]).alias("rows"))
    data = tables.select(*keys, "page_isin", F.array(*[column_of(F.col("names"), p) for p in plain])
                         .cast("array<int>").alias("places"), F.posexplode("rows").alias("row_no", "cells"))
    # pages of equal keys are numbered on, as one
    data = data.withColumn("row_no", F.row_number().over(Window.partitionBy(*keys).orderBy("row_no")))
    data = data.where(F.exists("cells", lambda x: x != ""))
    data = data.withColumn("row_text", F.array_join("cells", " "))
    out = [F.coalesce(F.get("cells", F.get("places", F.lit(i))), F.lit("")).alias(f"h_{p or i}") for i, p in enumerate(plain)]
    return data.select(*keys, "row_no", "row_text", "page_isin", *out,
                       extract_isin(clean_cell("row_text"), F.col("page_isin")).alias("ISIN"))
