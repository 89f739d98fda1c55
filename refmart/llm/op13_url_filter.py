"""URL filters with redirect equivalence (native DataFrame functions only).

A rule (verdict, host, path) fits urls of its host and of all subdomains whose path
starts with the rule's path; the longest rule (host and path together) decides. Urls
that no rule fits inherit a block from their aliases: urls are nodes under a canonical
key, redirects (``meta refresh``) and canonical links are edges, and connected
components of the edges are found by alternating star steps over written tables. A
component with a blocked url blocks all its urls that no rule fits.

Explicit allows take precedence: a url that an allow rule fits is never blocked by an
alias. It does not lift the block of the component's other urls either.

Rules are matched per distinct host, not per page: a host's suffixes (no more labels
than the longest rule has) are joined to the rules, and the pages then meet one row per
host, which AQE broadcasts when small and splits when the host holds a third of them.

Defined results: a null url, or one without ``://``, has empty host and path, no rule
fits it, it has no aliases and is allowed; a null html has no edges; repeated rows each
get their own (equal) result; a null page_id is kept; urls and html of any length are
read whole; equally long rules: the longer host first, then allow before block; an empty
table gives an empty result; further columns of the input are ignored, whatever their
names. A link that is no absolute url after resolving, or that leads to itself, is no edge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, written
from .components import components

# The rules of the query's contract (verdict, host, path).
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
TRACKING = r"(?i)(^|&)(utm_[a-z]+|gclid|fbclid)(=[^&]*)?"     # query parameters that name no other page

TAG = r"(?is)<(?:link|meta)\b[^>]*>"
HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>"


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def url_key(url: Column) -> Column:
    """What two urls of one page share: host and path without scheme, default port, fragment,
    tracking parameters and closing slash. Null for a null url or one without ``://``."""
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    query = F.regexp_replace(F.regexp_replace(query, TRACKING, ""), "^&", "")
    key = F.concat(F.regexp_replace(host_of(url), r":(80|443)$", ""), F.regexp_replace(path_of(url), r"/+$", ""), F.lit("/"),
                   F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))
    return F.when(url.contains("://"), key)


def rules_table(spark: SparkSession, rules=RULES) -> DataFrame:
    """(r_verdict, r_host, r_path) of a list of rules or a DataFrame (verdict, host, path)."""
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(list(rules), "verdict string, host string, path string")
    return rules.select(F.col("verdict").alias("r_verdict"), ascii_lower(F.col("host")).alias("r_host"),
                        F.col("path").alias("r_path"))


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(r_for, r_list): for every host (column ``h``) that a rule's host fits, these rules, the
    first to be tried first."""
    most = rules.agg(F.max(F.size(F.split("r_host", r"\.")))).first()[0] or 1
    labels = F.slice(F.reverse(F.split("h", r"\.")), 1, most)
    suffix = hosts.select("h", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda n: F.array_join(F.reverse(F.slice(labels, F.lit(1), n)), "."))).alias("r_host"))
    order = F.struct((-(F.char_length("r_host") + F.char_length("r_path"))).alias("size"),
                     (-F.char_length("r_host")).alias("host_size"), "r_verdict", "r_host", "r_path")
    return suffix.join(rules, "r_host").groupBy(F.col("h").alias("r_for")).agg(
        F.sort_array(F.collect_set(order)).alias("r_list"))


def ruled(pages: DataFrame, rules, url_col: str = "url") -> DataFrame:
    """``pages`` with u_host, u_path and u_rule (struct rule, verdict; null where none fits)."""
    r = rules_table(pages.sparkSession, rules)
    p = pages.withColumn("u_host", host_of(F.col(url_col))).withColumn("u_path", path_of(F.col(url_col)))
    per_host = host_rules(p.select(F.col("u_host").alias("h")).where("h <> ''").distinct(), r)
    fitting = F.get(F.filter("r_list", lambda x: F.startswith(F.col("u_path"), x["r_path"])), F.lit(0))
    out = p.join(per_host, F.col("u_host") == F.col("r_for"), "left").withColumn("fit", fitting)
    return out.withColumn("u_rule", F.when(F.col("fit").isNotNull(), F.struct(
        F.concat("fit.r_host", "fit.r_path").alias("rule"), F.col("fit.r_verdict").alias("verdict")))).drop(
        "r_for", "r_list", "fit")


def _attribute(tag: Column, name: str) -> Column:
    """The value of a tag's attribute ('' without one)."""
    value = rf"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    return F.trim(F.concat(*[F.regexp_extract(tag, value, n) for n in (1, 2, 3)]))


def resolved(link: Column, url: Column) -> Column:
    """``link`` of the page at ``url`` as an absolute url."""
    base = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*", 0)
    page = F.regexp_extract(url, r"(?s)^.*?://[^?#]*", 0)
    folder = F.when(page == base, F.concat(base, F.lit("/"))).otherwise(F.regexp_extract(page, r"(?s)^.*/", 0))
    return (F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
            .when(link.startswith("//"), F.concat(F.regexp_extract(url, r"(?s)^.*?:(?=//)", 0), link))
            .when(link.startswith("/"), F.concat(base, link))
            .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:") | (link == ""), F.lit(None))
            .when(link.startswith("?") | link.startswith("#"), F.concat(page, link))
            .otherwise(F.concat(folder, link)))


def page_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(kind, src, dst): the redirects and canonical links that stand in the pages, as urls."""
    url = F.col("e_url")
    some = pages.select(F.col(url_col).alias("e_url"), F.col(html_col).alias("e_html")).where(
        url.contains("://") & F.col("e_html").rlike("(?i)canonical|refresh"))
    tags = F.regexp_extract_all(F.regexp_replace("e_html", HIDDEN, ""), F.lit(TAG), F.lit(0))
    fields = F.transform(tags, lambda t: F.struct(
        F.lower(_attribute(t, "rel")).alias("rel"), F.lower(_attribute(t, "http-equiv")).alias("equiv"),
        _attribute(t, "href").alias("href"), _attribute(t, "content").alias("content")))
    t = some.select("e_url", F.inline(fields))
    canonical, refresh = F.col("rel").rlike(r"(^|\s)canonical(\s|$)"), F.col("equiv") == "refresh"
    target = F.regexp_extract("content", r"""(?is)^[0-9.\s]*[;,]\s*(?:url\s*=\s*)?['"]?([^'"]*)""", 1)
    # one row each, so that what follows names the link instead of repeating its expression
    t = t.where(canonical | refresh).select("e_url", F.inline(F.array(F.struct(
        F.when(canonical, "canonical").otherwise("redirect").alias("kind"),
        F.replace(F.when(canonical, F.col("href")).otherwise(F.trim(target)), F.lit("&amp;"), F.lit("&")).alias("link")))))
    return t.select("kind", F.col("e_url").alias("src"), resolved(F.col("link"), url).alias("dst")).where(
        "dst IS NOT NULL")


def decide(pages: DataFrame, edges: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: id, host, path, rule, verdict, via (the smallest id of a blocked page in
    the component, where an alias blocks the page). ``edges``: (src, dst) urls."""
    p = ruled(pages.select(F.col(id_col).alias("u_id"), F.col(url_col).alias("u_url")), rules, "u_url")
    p = p.withColumn("u_key", url_key(F.col("u_url"))).drop("u_url")
    links = edges.select(url_key(F.col("src")).alias("a"), url_key(F.col("dst")).alias("b")).where(
        F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    comp = components(links).select(F.col("a").alias("c_key"), F.col("b").alias("c_root"))
    p = p.join(comp, F.col("u_key") == F.col("c_key"), "left").withColumn("root", F.coalesce("c_root", "u_key"))
    p = written(p.drop("c_key", "c_root", "u_key"), "ruled_pages")
    blocks = p.where("u_rule.verdict = 'block' AND root IS NOT NULL").groupBy(F.col("root").alias("b_root")).agg(
        F.min("u_id").alias("b_via"), F.lit(True).alias("b_hit"))
    open_, closed = p.where("u_rule IS NULL"), p.where("u_rule IS NOT NULL")
    open_ = open_.join(blocks, F.col("root") == F.col("b_root"), "left").select(
        "u_id", "u_host", "u_path", F.lit(None).cast("string").alias("rule"),
        F.when(F.col("b_hit"), "block").otherwise("allow").alias("verdict"), F.col("b_via").alias("via"))
    closed = closed.select("u_id", "u_host", "u_path", "u_rule.rule", "u_rule.verdict",
                           F.lit(None).cast(pages.schema[id_col].dataType).alias("via"))
    return closed.unionByName(open_).withColumnsRenamed({"u_id": id_col, "u_host": "host", "u_path": "path"})


def filter_query(pages: DataFrame) -> DataFrame:
    """The op13 query: every page's url under the contract's rules, aliases from the pages' own html."""
    return decide(pages, page_edges(pages))
