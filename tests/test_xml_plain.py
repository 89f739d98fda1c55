"""XML records that one regular expression cuts: the rows must be those of the parser."""

import gzip
import tempfile

import pytest
from pyspark.sql import functions as F

SCHEMA = "G STRUCT<Id: STRING, Nm: STRING>, I STRING, D STRUCT<T: STRUCT<_VALUE: STRING, _Ccy: STRING>, R: STRUCT<X: STRING>, B: ARRAY<STRING>>"
PLAIN = ["<G><Id>a</Id><Nm>b c</Nm></G><I>1</I><D><T Ccy=\"EUR\">5</T><R><X>9</X></R></D>", "<I>éŁ\U0001F600\xa0</I>", "<G></G>", "",
         "<G>\n  <Nm>x  y</Nm>\r\n\t</G>\n ", "<D><T>5</T></D>", "<D><R></R></D>", "<G/>", "<D><T Ccy=\"EUR\"/></D>",
         "<D><T Ccy=\"EUR\"></T><R/></D>", "<D><T/></D>", "<D><T></T></D>", "<G><Id>_\x85_</Id></G>"]
ODD = ["<I> a </I>", "<I>a </I>", "<I></I>", "<I/>", "<I>a&amp;b &lt;c</I>", "<I>a<!-- c -->b</I>", "<I><![CDATA[<x>]]></I>", "<I>a\tb</I>", "<I>a>b</I>",
       "<I>2</I><G><Id>order</Id></G>", "<I>1</I><I>2</I>", "<Z>unknown</Z><I>1</I>", "<G><Id>a</Id>text</G>", "<D><T Ccy=' x '>5</T></D>",
       "<D><T Ccy=\"EUR\"> </T></D>", "<D><T Ccy=\"\">5</T></D>", "<D><T Ccy=\" x\"> 5</T></D>", "<D><T Ccy=\"a>b\">5</T></D>", "<D><T Other=\"q\">5</T></D>",
       "<D><B>1</B><B>2</B></D>", "<p:I>prefixed</p:I>", "<I a=\"1\">attribute</I>", "<I><N>nested</N></I>", "<G><Id>a</Id><Id>b</Id></G>"]


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="refmart-xml-", dir="/tmp")


def _by_parser(spark, bodies):
    rows = spark.createDataFrame([(f"<Rec>{b}</Rec>",) for b in bodies], "x string")
    return rows.select(F.from_xml("x", SCHEMA, {"ignoreNamespace": "true", "mode": "FAILFAST"}).alias("r")).select("r.*")


def test_plain_and_other_records_give_what_the_parser_gives(spark, folder):
    from refmart.sources.xml import records
    bodies = PLAIN + ODD
    with open(f"{folder}/a.xml", "w", newline="") as f:
        f.write("<?xml version=\"1.0\"?>\n<Root xmlns:p=\"urn:p\">" + "\n".join(f"<Rec>{b}</Rec>" for b in ["<I>first</I>", *bodies]) + "</Root>")
    got = records(spark, folder, "Rec", SCHEMA)
    want = _by_parser(spark, ["<I>first</I>", *bodies])
    assert [f.dataType for f in got.drop("SourceFileName", "SourceFilePath").schema] == [f.dataType for f in want.schema]
    assert sorted(map(repr, got.drop("SourceFileName", "SourceFilePath").collect())) == sorted(map(repr, want.collect()))


def test_plain_records_do_not_need_the_parser(spark):
    from pyspark.sql.types import StructType
    from refmart.sources.xml import CUT, _plain
    pattern, width, build = _plain("Rec", StructType.fromDDL(SCHEMA))
    df = spark.createDataFrame([(f"\n<Rec>{b}",) for b in PLAIN + ODD], "value string").coalesce(1)
    assert [r[0] for r in df.select(F.col("value").rlike(pattern)).collect()] == [True] * len(PLAIN) + [False] * len(ODD)
    cells = F.split(F.regexp_replace("value", pattern, "".join(f"{CUT}${i + 1}" for i in range(width))), CUT)
    got = df.where(F.col("value").rlike(pattern)).select(cells.alias("c")).select(build(F.col("c")).alias("r")).select("r.*").collect()
    assert got == _by_parser(spark, PLAIN).collect()


@pytest.mark.parametrize("body", ["<I>a</G>", "<G><Id>a</G>", "<I>a</I></G>", "<I>a]]>b</I>", "<I>a\x02b</I>", "<I>\x01</I>", "\x01" * 6, "<I>a&b</I>", "<I a=1>x</I>"])
def test_broken_records_fail_the_read(spark, folder, body):
    from refmart.sources.xml import records
    with open(f"{folder}/a.xml", "w") as f:
        f.write(f"<Root><Rec><I>1</I></Rec><Rec>{body}</Rec></Root>")
    with pytest.raises(Exception, match="MALFORMED_RECORD|Malformed"):
        records(spark, folder, "Rec", SCHEMA).collect()


def test_records_are_not_shuffled_to_meet_their_header(spark, folder):
    from refmart.sources.xml import read_full_xml
    with gzip.open(f"{folder}/a.xml.gz", "wt") as f:
        f.write("<R><RptHdr><RptgNtty><NtlCmptntAuthrty>FR</NtlCmptntAuthrty></RptgNtty></RptHdr>" + "".join(
            f"<RefData><FinInstrmGnlAttrbts><Id>X{i}</Id></FinInstrmGnlAttrbts></RefData>" for i in range(3)) + "</R>")
    df = read_full_xml(spark, folder).select("ISIN", "HeaderReportingNCA")
    assert "Exchange hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, df.collect())) == [("X0", "FR"), ("X1", "FR"), ("X2", "FR")]


def test_the_feed_is_written_as_plain_records(spark, folder):
    """SRC1: what the query writes is cut, but for the first record of each file; blank values stay blank."""
    from pyspark.sql.types import StructType
    from refmart.plans.q_core import wide_as_records, write_records
    from refmart.sources.xml import RECORD_SCHEMA, _plain, read_full_xml
    columns = ["ISIN", "FullName", "ShortName", "CFI", "NotionalCurrency", "IssuerLEI", "TradingVenueMIC", "AdmissionApprvlDate", "FirstTradingDate",
               "TerminationDate", "TotalIssuedNominalAmount", "TotalIssuedNominalAmountCcy", "MaturityDate", "FixedRate", "DebtSeniority", "ExpiryDate",
               "PriceMultiplier", "OptionType", "DeliveryType", "StrikePrice", "StrikePriceCcy"]
    rows = [[f"{c}{i}" if (i + k) % 5 or k in (0, 10, 11, 19, 20) else [None, ""][i % 2] for k, c in enumerate(columns)] for i in range(40)]
    rows[7][1] = "a & b <c>"
    rows[8][11] = None
    write_records(wide_as_records(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns)).coalesce(1)), folder + "/x", "Root", "RefData")
    pattern, _, _ = _plain("RefData", StructType.fromDDL(RECORD_SCHEMA))
    pieces = spark.read.option("lineSep", "</RefData>").text(folder + "/x").where("value like '%<RefData>%'")
    assert pieces.count() == 40 and pieces.where(F.col("value").rlike(pattern)).count() == 38     # not the first, nor the one with references
    got = {r.ISIN: tuple(r) for r in read_full_xml(spark, folder + "/x").select(*columns).collect()}
    assert got == {r[0]: tuple(v or None for v in r) for r in rows}
