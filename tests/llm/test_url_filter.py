"""op11 against brute force: rules by host and path, classes over canonical links and redirects, odd rows."""

from ledgerlark.llm import url_filter

PAGES = [
    (1, "http://a.com/x", '<link rel="canonical" href="http://bad.net/y">'),
    (2, "https://a.com/x#f", ""),
    (3, "http://b.org/fr/1", '<meta http-equiv=refresh content="0; url=//a.com/x">'),
    (4, "http://c.com/q", "<LINK href=/r rel=canonical />"),
    (5, "http://c.com/r", "<meta content=\"3;URL='http://d.example.com/de/1'\" http-equiv=\"Refresh\">"),
    (6, None, None),
    (7, "nourl", "<link rel=canonical href='http://bad.net/'>"),
    (8, "http://e.com/", "<!-- <link rel=canonical href='http://bad.net/'> --><script>'<link rel=canonical href=http://bad.net/>'</script>"),
    (9, "http://X.NET", ""),
    (10, "HTTP://Foo.Example.NET/en/a?b#c", None),
    (11, "a://b://c/d", "<link rel='alternate' href='http://bad.net/'>"),
    (12, "http://f.com/dir/page", "<link rel='x canonical' href='other?a=1&amp;b=2'>"),
    (13, "http://f.com/dir/other?a=1&b=2", "<link rel=canonical href='http://g.net/'>" * 2),
    (14, "http://example.com.evil/de/", ""),
    (15, "http://h.com/" + "p" * 50_000, "<link " * 20_000 + "<link rel=canonical href='mailto:x@y'>"),
    (None, "http://a.com/x", "x" * 100_000),
    (16, "http://example.com/de", ""),
    (16, "http://example.com/de", ""),
]


def verdicts(spark, pages, rules=url_filter.RULES, **more):
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    extra = df.selectExpr("*", "'z' AS host", "1 AS name", "2 AS component")
    found = url_filter.judge(spark, extra, url_filter.rule_table(spark, rules), **more).collect()
    return sorted(((r.page_id is None, r.page_id or 0, r.host, r.path, r.rule, r.verdict) for r in found), key=str)


def test_rules_and_aliases(spark):
    got = {(p, v[2], v[3]): (v[4], v[5]) for v in verdicts(spark, PAGES) for p in [None if v[0] else v[1]]}
    # a.com/x is an alias of bad.net/y (blocked) and of b.org/fr/1 (allowed): the allow comes first.
    assert got[1, "a.com", "/x"] == got[2, "a.com", "/x"] == got[None, "a.com", "/x"] == (None, "allow")
    assert got[3, "b.org", "/fr/1"] == ("org/fr/", "allow")
    assert got[4, "c.com", "/q"] == got[5, "c.com", "/r"] == (None, "block")
    assert got[6, "", ""] == got[7, "", ""] == (None, "allow")
    assert got[8, "e.com", "/"] == got[9, "x.net", ""] == (None, "allow")
    assert got[10, "foo.example.net", "/en/a"] == ("example.net/en/", "allow")
    assert got[11, "b:", "//c/d"] == (None, "allow")
    assert got[12, "f.com", "/dir/page"] == got[13, "f.com", "/dir/other"] == (None, "block")
    assert got[14, "example.com.evil", "/de/"] == got[16, "example.com", "/de"] == (None, "allow")
    assert got[15, "h.com", "/" + "p" * 50_000] == (None, "allow")
    assert len(verdicts(spark, PAGES)) == len(PAGES)


def test_hub_and_redirect_table(spark):
    """Three hundred pages redirect to one that is blocked only through a chain; brute-force classes agree."""
    pages = [(i, f"http://s{i}.com/p{i % 7}", "") for i in range(300)]
    hops = [(f"http://s{i}.com/p{i % 7}", "http://hub.com/") for i in range(0, 300, 2)]
    hops += [("http://hub.com", "https://next.com/#x"), ("http://next.com/", "http://z.net/"), (None, "http://z.net/"), ("http://s1.com/p1", None)]
    redirects = spark.createDataFrame(hops, "from_url string, to_url string")
    got = verdicts(spark, pages, redirects=redirects)
    assert {v[1] for v in got if v[5] == "block"} == set(range(0, 300, 2))
    assert all(v[4] is None for v in got)


def test_empty(spark):
    assert verdicts(spark, []) == []
    assert [v[4:] for v in verdicts(spark, [(1, "http://a.net/", "")], rules=[("x", "/", None)])] == [(None, "allow")]
