"""URL rules whose block decisions reach every alias of a page: redirects and canonical links join pages into classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm.graph import components, written
from ledgerlark.operators.blocks import beside

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def placed(df: DataFrame, url: str, host: str = "host", path: str = "path", name: str = "name") -> DataFrame:
    """``df`` with a url's ``host``, ``path`` and page ``name`` in steps, so that none is worked out twice.

    host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; path: then up to ``?``, ``#``
    or the end; both empty without ``://``. The name under which urls are one page is host, path (``/`` if empty)
    and query, null without host: scheme and fragment don't tell pages apart.
    """
    text, query = F.col(url), F.col("__query")
    df = df.withColumn("__rest", F.when(F.locate("://", text) > 0, F.substring(text, F.locate("://", text) + 3, F.length(text))))
    parts = {
        host: F.coalesce(F.translate(F.regexp_extract("__rest", r"^[^/?#]*+", 0), UPPER, LOWER), F.lit("")),
        path: F.coalesce(F.regexp_extract("__rest", r"^[^/?#]*+([^?#]*+)", 1), F.lit("")),
        "__query": F.coalesce(F.regexp_extract("__rest", r"^[^?#]*+(\?[^#]*+)", 1), F.lit("")),
    }
    df = df.withColumns(parts)
    full = F.concat(F.col(host), F.when(F.col(path) == "", F.lit("/")).otherwise(F.col(path)), query)
    return df.withColumn(name, F.when(F.col(host) != "", full)).drop("__rest", "__query")


def attribute(tag: Column, name: str) -> Column:
    """An attribute of an HTML tag, quoted or not; empty if absent."""
    groups = F.regexp_extract_all(tag, F.lit(rf"""(?is)[\s"']{name}\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++)"""), F.lit(1))
    return F.coalesce(F.btrim(F.get(groups, F.lit(0)), F.lit("\"' \t\r\n\f")), F.lit(""))


def resolved(link: Column, host: Column, path: Column) -> Column:
    """An absolute url of ``link`` found on a page of ``host`` and ``path``: absolute, ``//host``, ``/path``, ``?query`` or relative.

    Fragments and other schemes (mailto:, javascript:) name no page: null.
    """
    folder = F.regexp_extract(path, r"^(?s)(.*/)", 1)
    return (
        F.when(F.rlike(link, F.lit(r"^[A-Za-z][A-Za-z0-9+.-]*+://")), link)
        .when(F.rlike(link, F.lit(r"^[A-Za-z][A-Za-z0-9+.-]*+:|^#|^$")), F.lit(None))
        .when(link.startswith("//"), F.concat(F.lit("http:"), link))
        .when(link.startswith("/"), F.concat(F.lit("http://"), host, link))
        .when(link.startswith("?"), F.concat(F.lit("http://"), host, path, link))
        .when(folder == "", F.concat(F.lit("http://"), host, F.lit("/"), link))
        .otherwise(F.concat(F.lit("http://"), host, folder, link))
    )


def aliases(spark: SparkSession, pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b): the names of a page and of what its canonical link or refresh redirect names, where they differ.

    Comments and scripts don't count, and of a page all tags do, wherever they stand. Pages without host, links to
    the page itself and links without host give nothing. The patterns are possessive, so a page costs its length.
    """
    plain = F.regexp_replace(html, r"(?is)<!--(?:[^-]++|-(?!->))*+-->|<script\b(?:[^<]++|<(?!/script))*+</script", " ")
    tags = F.regexp_extract_all(plain, F.lit(r"""(?is)<(?:link|meta)\b(?:[^<>"']++|"[^"<]*+"|'[^'<]*+'|["'])*+>"""), F.lit(0))
    found = pages.where(F.rlike(F.col(html), F.lit(r"(?i)<(?:link|meta)\b[^<]*(?:canonical|refresh)"))).select(
        F.col(url).alias("url"), F.explode(tags).alias("tag")
    )
    is_link = F.rlike("tag", F.lit(r"(?i)^<link"))
    found = found.withColumns(
        {
            "rel": F.when(is_link, F.lower(attribute(F.col("tag"), "rel"))),
            "href": F.when(is_link, attribute(F.col("tag"), "href")),
            "on": F.when(~is_link, F.lower(attribute(F.col("tag"), "http-equiv"))),
            "content": F.when(~is_link, attribute(F.col("tag"), "content")),
        }
    )
    target = F.regexp_extract("content", r"""(?is)^[^;,]*+[;,]\s*+(?:url\s*+=\s*+)?["']?([^"']*+)""", 1)
    canonical = F.array_contains(F.split("rel", r"\s+"), "canonical")
    link = F.when(canonical, F.col("href")).when(F.col("on") == "refresh", F.btrim(target))
    linked = found.withColumn("link", F.replace(link, F.lit("&amp;"), F.lit("&")))
    linked = written(spark, linked.select("url", "link"), "links").where("link != ''")
    # Written between the steps: a filter on their ends would repeat all of them in one expression.
    linked = placed(linked, "url", name="a")
    linked = linked.select("a", resolved(F.col("link"), F.col("host"), F.col("path")).alias("to"))
    linked = written(spark, linked, "targets")
    return placed(linked, "to", "to_host", "to_path", "b").where("a != b").select("a", "b")


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def decided(spark: SparkSession, places: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict) of the distinct ``places`` (host, path) that a rule fits.

    A rule fits its host and all subdomains where the path starts with the rule's; the one with most
    characters wins, of equally long ones the one with the longer host, then block. Rules meet hosts by an equi-join on the host's suffixes
    and, per rule host, on the path's beginning of each length that its rules have. Only suffixes with as many
    labels as some rule's host are formed.
    """
    rules = written(spark, rules.select("host", "path", "verdict").dropna().distinct(), "rules")
    count = rules.count()
    lengths = rules.select(F.col("host").alias("suffix"), F.length("path").alias("n")).distinct()
    labels = F.split("host", r"\.")
    deepest = rules.agg(F.max(F.size(labels))).first()[0] or 0
    last = F.least(F.lit(deepest), F.size(labels))
    suffixes = F.transform(F.sequence(F.lit(1), last), lambda k: F.array_join(F.slice(labels, -k, k), "."))
    if not count:
        return places.select("host", "path", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict")).limit(0)
    wide = places.where("host != ''").distinct().select("host", "path", F.explode(suffixes).alias("suffix"))
    wide = beside(wide, lengths, ["suffix"], "inner", count).where(F.length("path") >= F.col("n"))
    wide = wide.withColumn("head", F.substring(F.col("path"), F.lit(1), F.col("n")))
    fitting = rules.select(F.col("host").alias("suffix"), F.col("path").alias("head"), "verdict")
    met = beside(wide, fitting, ["suffix", "head"], "inner", count)
    rule = F.concat("suffix", "head")
    best = F.max(F.struct(F.length(rule).alias("n"), F.length("suffix").alias("m"), F.col("verdict") == "block", rule.alias("rule"), "verdict"))
    return met.groupBy("host", "path").agg(best.alias("best")).select("host", "path", "best.rule", "best.verdict")


def judge(
    spark: SparkSession,
    pages: DataFrame,
    rules: DataFrame,
    redirects: DataFrame | None = None,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """page_id, host, path, rule, verdict, component for every row of ``pages``.

    ``rules`` (host, path, verdict: allow or block) decide the pages they fit, the longest first. Pages are
    nodes named by host, path and query; canonical links and refresh redirects in ``html`` and the rows of
    ``redirects`` (from_url, to_url), if given, are edges. A page without fitting rule goes by its component:
    allowed if a member is explicitly allowed, else blocked if a member, a page or only a target, is blocked,
    else allowed. So a block reaches all aliases, and an explicit allow, its own or an alias's, comes first.
    ``component`` is the component's smallest page name, null for pages without aliases. In a component a page with
    an empty path counts with the path ``/``, which is the same page.

    Repeated rows each get a row; equal urls fare alike. A null url, or one without ``://``, has an empty host and path,
    no rule and no aliases, and is allowed. Null or empty ``html`` has no links. Other columns are ignored, an
    empty table gives no rows, and rules holding nulls don't count.
    """
    named = placed(pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url")), "url")
    edges = aliases(spark, pages, url, html)
    if redirects is not None:
        ends = placed(redirects.select("from_url", "to_url"), "from_url", "host", "path", "a")
        edges = edges.union(placed(ends, "to_url", "host", "path", "b").where("a != b").select("a", "b"))
    joined = components(spark, edges)
    # A component's smallest node has no row of its own.
    nodes = written(spark, joined.union(joined.select("component", "component").distinct()), "aliases")
    members = placed(nodes.withColumn("link", F.concat(F.lit("http://"), F.col("node"))), "link")
    spots = named.select("host", "path").union(members.select("host", "path"))
    verdicts = written(spark, decided(spark, spots, rules), "verdicts")
    ruled = members.join(verdicts, ["host", "path"]).groupBy("component")
    said = ruled.agg(F.max((F.col("verdict") == "allow").cast("int")).alias("allowed"))
    said = said.select("component", F.when(F.col("allowed") == 1, "allow").otherwise("block").alias("spread"))
    spread = nodes.join(said, "component", "left").select(F.col("node").alias("name"), "component", "spread")
    judged = named.join(spread, "name", "left").join(verdicts, ["host", "path"], "left")
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", "spread", F.lit("allow")).alias("verdict"), "component"
    )


