"""Golden-file tests for the sources, contracts and sinks (rows-only / R items)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StringType, StructField, StructType, TimestampType

from conftest import DATA

MAPPING = [("LEI", "LEI"), ("Entity.LegalName", "LegalName"),
           ("Entity.LegalAddress.FirstAddressLine", "LegalAddress_FirstAddressLine"),
           ("Entity.LegalAddress.Country", "LegalAddress_Country"), ("Entity.EntityStatus", "EntityStatus"),
           ("Registration.InitialRegistrationDate", "InitialRegistrationDate"),
           ("Registration.LastUpdateDate", "LastUpdateDate")]


def test_full_xml(spark):
    from refmart.sources.xml import read_full_xml
    rows = {r.ISIN: r for r in read_full_xml(spark, os.path.join(DATA, "xml_full")).collect()}
    assert len(rows) == 6  # the record without ISIN is dropped
    bond = rows["XS1234567890"]
    assert (bond.TotalIssuedNominalAmount, bond.TotalIssuedNominalAmountCcy, bond.FixedRate) == ("500000000", "EUR", "2.5")
    assert rows["XS0987654321"].FloatRefRateIndex == "EURI" and rows["XS0987654321"].FloatTermValue == "3"
    opt = rows["DE000C1234X5"]
    assert (opt.StrikePrice, opt.StrikePriceCcy, opt.UnderlyingISIN, opt.OptionExerciseStyle) == ("100", "EUR", "FR0000120271", "EURO")
    cmd = rows["GB00C0MMOD17"]
    assert (cmd.CmdtyBaseProduct, cmd.CmdtySubProduct, cmd.CmdtySubSubProduct) == ("NRGY", "OILP", "BRNT")
    assert all(r.HeaderReportingPeriodDate == "2024-01-05" and r.HeaderReportingNCA == "FR" for r in rows.values())


def test_full_xml_compat_blanks_unmatched_paths(spark):
    from refmart.sources.xml import read_full_xml
    r = read_full_xml(spark, os.path.join(DATA, "xml_full"), compat=True).filter("ISIN = 'XS1234567890'").first()
    assert r.FixedRate is None and r.TotalIssuedNominalAmount == "500000000"


def test_delta_xml_actions(spark):
    from refmart.sources.xml import read_delta_xml
    d = read_delta_xml(spark, os.path.join(DATA, "xml_delta"))
    got = sorted((r.ActionType, r.ISIN) for r in d.collect())
    assert got == [("CANC", "DE000F9876Y1"), ("MOD", "FR0000120271"), ("NEW", "FR0000999999"),
                   ("TERM", "XS0987654321"), ("TERM", "XS1234567890")]  # no-venue record dropped


def test_delta_xml_applies_to_full(spark):
    from refmart.operators.cdc import apply_delta
    from refmart.sources.xml import read_delta_xml, read_full_xml
    full = read_full_xml(spark, os.path.join(DATA, "xml_full")) \
        .withColumn("ValidFromDate", F.to_date(F.col("HeaderReportingPeriodDate"))) \
        .withColumn("ValidToDate", F.lit(None).cast("date")).withColumn("LatestRecordFlag", F.lit(True))
    delta = read_delta_xml(spark, os.path.join(DATA, "xml_delta")).withColumn("ValidFromDate", F.lit(None).cast("string"))
    out = {(r.ISIN, r.ValidFromDate.isoformat()): r for r in apply_delta(full, delta).collect()}
    assert out[("FR0000120271", "2024-01-05")].ValidToDate == dt.date(2024, 1, 5)   # MOD: VF - 1
    assert out[("FR0000120271", "2024-01-06")].LatestRecordFlag is True             # MOD inserted
    assert out[("XS1234567890", "2024-01-05")].ValidToDate == dt.date(2024, 1, 10)  # TERM with date
    assert out[("XS0987654321", "2024-01-05")].ValidToDate == dt.date(2024, 1, 6)   # TERM without date
    assert out[("DE000F9876Y1", "2024-01-05")].ValidToDate == dt.date(2024, 1, 6)   # CANC
    assert ("FR0000999999", "2024-01-06") in out                                     # NEW inserted
    assert ("XS1234567890", "2024-01-06") not in out                                 # TERM inserts nothing


RECORD = ("<RefData><FinInstrmGnlAttrbts><Id>{i:012d}</Id><FullNm>a &amp; b\n&lt;{i}&gt; é中</FullNm></FinInstrmGnlAttrbts>"
          "<TradgVnRltdAttrbts><Id>XPAR</Id></TradgVnRltdAttrbts></RefData>")
HEADER = "<RptHdr><RptgNtty><NtlCmptntAuthrty>{c}</NtlCmptntAuthrty></RptgNtty><RptgPrd><Dt>2024-01-0{d}</Dt></RptgPrd></RptHdr>"


def _document(path, n, header, close=True):
    with open(path, "w", encoding="utf-8") as out:
        out.write(f'<?xml version="1.0"?>\n<Doc xmlns="urn:x"><Pyld>{header}')
        out.writelines(RECORD.format(i=i) + ("\n  " if i % 3 else "") for i in range(n))
        out.write("</Pyld></Doc>\n" if close else "")


def test_one_xml_document_is_read_by_many_tasks(spark, tmp):
    from refmart.sources.xml import RECORD_SCHEMA, read_full_xml, records
    os.makedirs(f"{tmp}/a b")
    _document(f"{tmp}/a b/one.xml", 2000, HEADER.format(c="FR", d=5))
    _document(f"{tmp}/two.xml", 3, HEADER.format(c="DE", d=6))
    _document(f"{tmp}/none.xml", 0, HEADER.format(c="IT", d=7))
    _document(f"{tmp}/bare.xml", 2, "")
    paths = [f"{tmp}/a b", f"{tmp}/two.xml", f"{tmp}/none.xml", f"{tmp}/bare.xml"]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    got = []
    try:
        for size in ("7000", "50011", before):      # splits fall anywhere within records
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got.append(sorted((r.SourceFileName, r.ISIN, r.FullName, r.HeaderReportingNCA, str(r.ValidFromDate))
                              for r in read_full_xml(spark, paths).collect()))
            parts = records(spark, f"{tmp}/a b", "RefData", RECORD_SCHEMA).rdd.getNumPartitions()
            assert parts > 5 or size != "50011"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = [("one.xml", i, "FR", "2024-01-05") for i in range(2000)] + [("two.xml", i, "DE", "2024-01-06") for i in range(3)] + [
        ("bare.xml", i, None, "None") for i in range(2)]
    want = sorted((f, f"{i:012d}", f"a & b\n<{i}> é中", c, d) for f, i, c, d in want)
    assert got == [want] * 3


@pytest.mark.parametrize("bad", ["cut", "unclosed", "nested", "spaced"])
def test_malformed_xml_records_fail_the_read(spark, tmp, bad):
    from refmart.sources.xml import read_full_xml
    body = {"cut": RECORD.format(i=1) + RECORD.format(i=2)[:60], "unclosed": "<RefData><Issr>x</RefData>",
            "nested": "<RefData><Issr>x" + RECORD.format(i=1), "spaced": "<RefData><Issr>x</Issr></RefData >" + RECORD.format(i=1)}
    with open(f"{tmp}/x.xml", "w") as out:
        out.write("<Doc><RptHdr></RptHdr>" + RECORD.format(i=0) + body[bad] + ("" if bad == "cut" else "</Doc>"))
    with pytest.raises(Exception, match="RefData|MALFORMED"):
        read_full_xml(spark, f"{tmp}/x.xml").collect()


def test_lei_csv_mapping_contract_cast(spark):
    from refmart.operators.contract import ContractError, cast_to, enforce_contract, project_mapping
    from refmart.functions.clean import blank_to_null_all
    from refmart.sources.text import read_lei_csv
    raw = read_lei_csv(spark, os.path.join(DATA, "lei"))
    assert raw.columns[0] == "LEI"
    df = blank_to_null_all(project_mapping(raw, MAPPING))
    target = StructType([
        StructField("LEI", StringType(), False),
        StructField("LegalName", StringType(), True, {"width": 8}),
        StructField("LegalAddress_FirstAddressLine", StringType(), True),
        StructField("LegalAddress_Country", StringType(), True),
        StructField("EntityStatus", StringType(), True),
        StructField("InitialRegistrationDate", TimestampType(), True),
        StructField("LastUpdateDate", TimestampType(), True),
        StructField("Quantifier", DecimalType(20, 6), True),
    ])
    out = {r.LEI: r for r in cast_to(enforce_contract(df, target), target).collect()}
    assert out["5299000ABCDEFGHIJK34"].LegalName == 'Beta "Ho'             # quoted quote, cut to width
    assert out["5299000ABCDEFGHIJK34"].LegalAddress_FirstAddressLine == "Line one\nLine two"
    assert out["5299000ABCDEFGHIJK34"].InitialRegistrationDate is None     # bad date -> NULL
    assert out["213800ABCDEFGHIJKL56"].LegalName is None                   # blank -> NULL
    assert out["969500ABCDEFGHIJKL12"].Quantifier is None                  # missing nullable column
    with pytest.raises(ContractError):
        project_mapping(read_lei_csv(spark, os.path.join(DATA, "lei_missing.csv")), MAPPING)
    with pytest.raises(ContractError):
        enforce_contract(df.withColumn("Unknown", F.lit(1)), target)


def test_quoted_csv_is_read_by_many_tasks(spark, tmp):
    import csv as pycsv
    import random
    from refmart.sources.quoted_csv import _lines, read_quoted_csv
    rng = random.Random(6)
    cells = ["", "x", "é中", 'say ""hi""'.replace('""', '"'), "a,b", "two\nlines", "\n\n", '"', "long " * 60, "\n" * 40, "end\n"]
    rows = [[str(i), *(rng.choice(cells) for _ in range(3))] for i in range(700)] + [["700", "y" * 9000 + "\n" * 900, "", "z"]]
    rng.shuffle(rows)
    os.makedirs(f"{tmp}/in")
    for n, part in enumerate((rows[:690], rows[690:])):
        with open(f"{tmp}/in/f{n}.csv", "w", encoding="utf-8", newline="") as out:
            out.write("\ufeff" * (n == 0))
            w = pycsv.writer(out, lineterminator="\r\n" if n else "\n", quoting=pycsv.QUOTE_ALL if n else pycsv.QUOTE_MINIMAL)
            w.writerow(["a.id", "b", "c d", "e"])
            w.writerows(part)
            out.write("\n")
    want = sorted(tuple(x or None for x in r) for r in rows)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("997", "4096", "60000", before):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = read_quoted_csv(spark, f"{tmp}/in")
            assert got.columns == ["a.id", "b", "c d", "e"]
            assert sorted(map(tuple, got.collect()), key=lambda r: tuple(x or "" for x in r)) == sorted(
                want, key=lambda r: tuple(x or "" for x in r))
            assert _lines(spark, f"{tmp}/in").rdd.getNumPartitions() > 2 or size == before
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_quoted_csv_odd_files(spark, tmp):
    from refmart.sources.quoted_csv import read_quoted_csv
    with open(f"{tmp}/a.csv", "w") as out:
        out.write('"x\ny",,x,x\n1,2\n\n1,2,3,4,5\n"open\nend')
    got = read_quoted_csv(spark, f"{tmp}/a.csv")
    assert got.columns == ["x\ny", "_c1", "x2", "x3"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(
        [("1", "2", None, None), ("1", "2", "3", "4"), ("open\nend", None, None, None)], key=str)
    open(f"{tmp}/empty.csv", "w").close()
    assert read_quoted_csv(spark, f"{tmp}/empty.csv").count() == 0


def test_quotes_layouts(spark):
    from refmart.functions.clean import QUOTE_COLUMNS
    from refmart.sources.text import read_quotes
    q = read_quotes(spark, os.path.join(DATA, "quotes"))
    assert q.columns == QUOTE_COLUMNS
    rows = {r.isin: r for r in q.collect()}
    assert set(rows) == {"FR0013355888", "FR0013355889", "FR0000120271", "DE000VU0AAA1", None}   # kept without an ISIN
    t = rows["FR0013355888"]
    assert (t.produit, t.ss_jacent, t.barriere, t.levier, t.maturite, t.variation, t.emetteurs) == \
        ("Turbo Call CAC", "CAC 40", "6500", "12,5", "Open End", "+2,1%", "BNP")
    assert t.produit_type == "turbo" and t.date_extraction == "2024-01-05 10:00:00"
    assert rows["FR0013355889"].produit_type == "turbo"          # blank type -> from the file name
    a = rows["FR0000120271"]
    assert (a.libelle, a.plus_haut, a.var_1janv, a.volume, a.produit_type) == \
        ("TOTALENERGIES", "60,50", "+3,2%", "1 234 567", "ACTION")
    assert a.date_extraction == "2024-01-05 17:35:00"
    b = rows["DE000VU0AAA1"]
    assert (b.sous_jacent, b.borne_basse, b.borne_haute, b.produit_type, b.date_extraction) == \
        ("DAX", "15000", "17000", "autre_leverage", None)


def test_html_best_table(spark):
    from refmart.sources.html import column_of, html_best_table, plain_name
    html = open(os.path.join(DATA, "html", "pages.html"), encoding="utf-8").read()
    pages = spark.createDataFrame([(1, "https://example.com/turbos", html)], "page_id BIGINT, url STRING, html STRING")
    expected = ["ISIN", "Produit", "Ss-Jacent", "Barrière", "Achat", "Vente", "Levier", "Maturité", "Var.",
                "Émetteurs", "DATE_EXTRACTION", "ProduitType"]
    rows = sorted(html_best_table(pages, expected).collect(), key=lambda r: r.row_no)
    assert len(rows) == 2  # blank row dropped
    assert rows[0].ISIN == "FR0013355888" and rows[1].ISIN == "FR0000000001"   # page fallback
    assert (rows[0].h_produit, rows[0].h_ssjacent, rows[0].h_barriere, rows[0].h_levier, rows[0].h_maturite,
            rows[0].h_var, rows[0].h_emetteurs) == ("Turbo Call FR0013355888", "CAC 40", "6 500", "12,5",
                                                    "Open End", "+2,1%", "BNP")
    names = spark.range(1).select(F.transform(F.array(F.lit("Nom"), F.lit("Underlying"), F.lit("Dernière Échéance")), plain_name).alias("n"))
    assert tuple(names.select(*[column_of(F.col("n"), w) for w in ("produit", "ssjacent", "maturite", "levier")]).first()) \
        == (0, 1, None, None)


def test_html_omitted_end_tags_and_nested_tables(spark):
    from refmart.sources.html import html_best_table
    pad = "<p>" + "x" * 200 + "</p>"
    html = pad + ("<table><tr><th>Produit<th>Achat<tr><td>P1<td>1,0<tr><td>P2 <table><tr><td>inner</table> more<td>2,0"
                  "</table><table><tr><td>Produit<td>other</table>")
    pages = spark.createDataFrame([(1, "u", html), (2, "u", None), (3, "u", "")], "page_id BIGINT, url STRING, html STRING")
    rows = html_best_table(pages, ["ISIN", "Produit", "Achat"]).orderBy("row_no").collect()
    assert [(r.page_id, r.row_no, r.h_produit, r.h_achat) for r in rows] == [(1, 1, "P1", "1,0"), (1, 2, "P2 more", "2,0")]


def test_html_rows_are_cut_as_the_parser_reads_them():
    """SRC7: pages of ordinary tags give the parser's rows without it; the others are left to it."""
    import random
    from refmart.sources.html import NotPlain, TableRows, plain_rows, rows_of
    usual = ["<table>", "</table>", "<thead>", "</thead>", "<tbody>", "<tr>", "</tr>", "<td>", "<th>", "</td>", "</th>",
             '<TD class="a b">', "<b>", "</b>", "<br/>", "a", " b  c", "&amp;", "x & y", "&nbsp", "\n", "<!-- c -->",
             "<a href='u?x=1&y=2'>", "</a>"]
    odd = ["<!-- <td> -->", "<script>if(a<b)'<td>'</script>", "<style>td{}</style>", "<title>t</title>", "<", "< td>", "</ td>", "<td x='1>2'>",
           "<!-->", "<!DOCTYPE html>", "<?x ?>", "<td/>", "<svg:td>", "</td x>", "<td\nid=1>", "<![CDATA[x]]>", "</script>", "<textarea>"]
    rnd, kinds, plain = random.Random(5), {}, 0
    for i in range(6000):
        tags = usual if i % 2 else usual + odd
        page = "<table><tr><td>" * (i % 3) + "".join(rnd.choice(tags) for _ in range(rnd.randint(0, 30)))
        want = TableRows(page).rows
        assert rows_of(page, kinds) == want, page
        try:
            plain += plain_rows(page, kinds) == want
        except NotPlain:
            assert not i % 2, page
    assert plain > 3000


def test_html_pages_are_parsed_without_a_shuffle(spark):
    """SRC7: the best table is found in the page's row; pages with equal keys and null keys keep all their rows."""
    from refmart.sources.html import html_best_table
    page = "<p>" + "x" * 200 + "<table><tr><td>menu</table><table><tr><th>Produit<th>Achat<tr><td>P&nbsp; 1<td>1<tr><td><td><tr><td>P2<td>2</table>"
    pages = spark.createDataFrame([(1, "u", page), (1, "u", page), (None, None, page), (2, "u", "y" * 300)], "page_id BIGINT, url STRING, html STRING")
    df = html_best_table(pages, ["ISIN", "Produit", "Achat"])
    assert sorted((r.page_id or 0, r.row_no, r.h_produit, r.h_achat) for r in df.collect()) == [
        (0, 1, "P 1", "1"), (0, 3, "P2", "2"), (1, 1, "P 1", "1"), (1, 2, "P 1", "1"), (1, 5, "P2", "2"), (1, 6, "P2", "2")]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1 and "MapInPandas" not in plan


def test_quotes_header_rules(spark, tmp):
    import os
    from refmart.sources.text import read_quotes
    os.makedirs(tmp + "/q")
    wide = "|".join([f"X{i}" for i in range(70)] + ["ISIN", "Dernier"])
    for name, lines in {"a.csv": ["Libellé|ISIN|Dernier", "L1|FR0000000001|1", "ISIN|Libellé|x", "L2||3"],
                        "b.psv": ["ISIN|PRIX_EX|Prix exercice", "FR0000000002|7|8"],
                        "c.txt": [wide, "|".join(["v"] * 70 + ["FR0000000003", "9"])]}.items():
        open(f"{tmp}/q/{name}", "w", encoding="utf-8").write("\n".join(lines) + "\n")
    rows = {(r.file_name, r.isin, r.libelle, r.dernier, r.prix_exercice) for r in read_quotes(spark, tmp + "/q").collect()}
    assert rows == {("a.csv", "FR0000000001", "L1", "1", None), ("a.csv", "Libellé", "ISIN", "x", None),
                    ("a.csv", None, "L2", "3", None), ("b.psv", "FR0000000002", None, None, "8"),
                    ("c.txt", "FR0000000003", None, "9", None)}


def test_html_pages_without_tables(spark):
    from refmart.sources.html import html_best_table
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    assert html_best_table(pages, ["ISIN", "Produit", "Achat"]).count() == 0


def test_wide_roundtrip(spark, tmp):
    from refmart.plans import fixtures as fx
    from refmart.sources.text import WIDE_COLUMNS, read_wide, write_wide
    w = fx.wide(spark, "/root/testdata/sf0.001").select(*WIDE_COLUMNS[:20])
    write_wide(w, tmp + "/wide")
    back = read_wide(spark, tmp + "/wide", columns=WIDE_COLUMNS[:20])
    assert back.count() == w.count()
    assert back.filter("TerminationDate = ''").count() == 0
    assert back.filter("TerminationDate IS NULL").count() == w.filter("TerminationDate IS NULL").count()


def test_sinks(spark, tmp):
    from refmart.sources.sinks import append_batch, overwrite_partition, read_current, write_full_refresh
    a = spark.createDataFrame([(1, "f1"), (2, "f2")], "x INT, file_name STRING")
    write_full_refresh(a, tmp + "/t", "v1")
    write_full_refresh(a.filter("x = 1"), tmp + "/t", "v2")
    assert read_current(spark, tmp + "/t").count() == 1
    append_batch(a, tmp + "/app")
    append_batch(a, tmp + "/app")       # retried load: nothing duplicated
    append_batch(spark.createDataFrame([(3, "007"), (4, "f2")], "x INT, file_name STRING"), tmp + "/app")
    append_batch(spark.createDataFrame([(3, "007")], "x INT, file_name STRING"), tmp + "/app")
    assert sorted(r.x for r in spark.read.parquet(tmp + "/app").collect()) == [1, 2, 3]
    f = spark.createDataFrame([(dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 2), 2)], "SnapshotDate DATE, v INT")
    overwrite_partition(f, tmp + "/fact")
    overwrite_partition(f.filter("v = 2").withColumn("v", F.lit(3)), tmp + "/fact")
    got = sorted((r.SnapshotDate.isoformat(), r.v) for r in spark.read.parquet(tmp + "/fact").collect())
    assert got == [("2024-01-01", 1), ("2024-01-02", 3)]
