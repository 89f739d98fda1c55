"""URL filters against a plain version: rules, resolved links, aliases, odd rows."""

from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import pandas as pd
import pytest

from refmart.llm import op13_url_filter as op13
from refmart.llm.oracle import ORACLE

CLASHES = ("u_id", "u_host", "u_rule", "root", "rule", "verdict", "host", "path", "a", "b", "link", "kind")
DDL = "page_id long, url string, html string, " + ", ".join(f"{c} string" for c in CLASHES)

ROWS = [
    (1, "http://a.org/x", '<link rel="canonical" href="https://b.net/fr/y?utm_source=q">'),
    (2, "https://b.net/fr/y/#z", None),
    (3, "http://c.org/", "<META http-equiv='Refresh' content=\"0; URL='/x'\">"),
    (4, "http://c.org/x", "<link href=//a.org/x rel=canonical>"),
    (5, "http://k.com/q", '<link rel="canonical" href="http://a.org/x">'),
    (6, None, None), (7, "foo", '<link rel=canonical href="http://a.org/x">'), (8, "http://WWW.Example.com/en/1", ""),
    (9, "http://m.example.com/en/1", '<!-- <link rel=canonical href="http://free.org/"> -->'), (10, "http://free.org", ""),
    (None, "http://a.org/x#t", None), (1, "http://a.org/x", ""), (11, "http://example.com", ""),
    (12, "http://xexample.com/en/", ""), (13, "http://a.org:80/x?gclid=1", None), (14, "http://a.org/x?p=1", None),
    (15, "http://d.org/dir/page?q#f", '<link rel="alternate canonical" href="other&amp;x">'),
    (16, "http://d.org/dir/other&x", '<link rel=canonical href="?page=2">'), (17, "http://d.org/dir/other&x/?page=2", None),
    (18, "http://e.org/mail", '<link rel=canonical href="mailto:x@y.net">'),
    (19, "http://example.com/en/" + "y" * 100_000, "<p>canonical</p>" * 5000), (20, "", ""), (21, "http://", ""),
    (22, "://net/es/", ""), (23, "http://x/http://y.net/es/", "")]
EXPECTED = {     # page_id: (host, rule, verdict, via)
    1: ("a.org", None, "block", 2), 2: ("b.net", "net/fr/", "block", None), 3: ("c.org", None, "block", 2),
    4: ("c.org", None, "block", 2), 5: ("k.com", "com/", "allow", None), 6: ("", None, "allow", None),
    7: ("", None, "allow", None), 8: ("www.example.com", "www.example.com/en/", "allow", None),
    9: ("m.example.com", "example.com/en/", "block", None), 10: ("free.org", None, "allow", None),
    None: ("a.org", None, "block", 2), 11: ("example.com", None, "allow", None),
    12: ("xexample.com", "com/", "allow", None), 13: ("a.org:80", None, "block", 2), 14: ("a.org", None, "allow", None),
    15: ("d.org", None, "allow", None), 16: ("d.org", None, "allow", None), 17: ("d.org", None, "allow", None),
    18: ("e.org", None, "allow", None), 19: ("example.com", "example.com/en/", "block", None),
    20: ("", None, "allow", None), 21: ("", None, "allow", None), 22: ("net", "net/es/", "block", None),
    23: ("x", None, "allow", None)}


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, *["x"] * len(CLASHES)) for r in ROWS], DDL).repartition(3)


def test_verdicts(pages):
    got = op13.filter_query(pages).select("page_id", "host", "rule", "verdict", "via").collect()
    assert Counter(tuple(r) for r in got) == Counter((r[0], *EXPECTED[r[0]]) for r in ROWS)


def test_matches_sql(pages):
    frame = pd.DataFrame(ROWS, columns=["page_id", "url", "html"]).astype({"page_id": "Int64"})  # noqa: F841
    with duckdb.connect() as db:
        db.register("pages", frame)
        want = db.execute(ORACLE["op13_url_filter_verdicts"]).fetchall()
    got = op13.filter_query(pages).select("page_id", "host", "path", "rule", "verdict", "via").collect()
    assert Counter(map(tuple, got)) == Counter(want)


def test_empty(spark):
    out = op13.filter_query(spark.createDataFrame([], DDL))
    assert out.columns == ["page_id", "host", "path", "rule", "verdict", "via"] and not out.collect()


def test_rules_as_a_table_longest_then_longer_host_then_allow(spark):
    rules = spark.createDataFrame([("block", "B.org", "/x"), ("allow", "a.b.org", "/"), ("block", "a.b.org", "/"),
                                   ("block", "org", "/xyz1")], "verdict string, host string, path string")
    pages = spark.createDataFrame([(1, "h://a.b.org/x", None), (2, "h://q.b.org/x", None), (3, "h://b.org/y", None),
                                   (4, "h://a.b.org/xyz1", None)], "page_id long, url string, html string")
    none = spark.createDataFrame([], "src string, dst string")
    got = {r.page_id: (r.rule, r.verdict) for r in op13.decide(pages, none, rules).collect()}
    assert got == {1: ("a.b.org/", "allow"), 2: ("b.org/x", "block"), 3: (None, "allow"), 4: ("a.b.org/", "allow")}


def test_random_graph_against_plain_components(spark):
    rng = random.Random(3)
    urls = [f"http://h{i % 7}.{rng.choice(['org', 'net', 'com'])}/{rng.choice(['en', 'fr'])}/{i}" for i in range(300)]
    edges = [(rng.choice(urls), rng.choice(urls)) for _ in range(170)] + [(u, urls[0]) for u in urls[200:260]]
    root = {u: u for u in urls}

    def find(u):
        while root[u] != u:
            u = root[u]
        return u
    for a, b in edges:
        root[find(a)] = find(b)

    def own(u):
        host, path = re.match(r"http://([^/]*)(.*)", u).groups()
        return "allow" if host.endswith(".com") else "block" if host.endswith(".net") and path.startswith("/fr/") else None
    bad = {find(u) for u in urls if own(u) == "block"}
    want = {i: own(u) or ("block" if find(u) in bad else "allow") for i, u in enumerate(urls)}
    p = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = op13.decide(p, spark.createDataFrame(edges, "src string, dst string"))
    assert {r.page_id: r.verdict for r in got.collect()} == want


def test_runs_no_python(pages):
    plan = op13.filter_query(pages)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|MapInArrow", plan)
