from frames import SF, read
from pyspark.sql import functions as F

from fareline.llm import urls
from fareline.llm.oracle import LLM_ORACLE_SQL
from fareline.llm.queries import LLM_QUERIES, URL_RULES


def pages(spark, *rows):
    """Pages of (url, html), with columns whose names the operator uses itself."""
    frame = spark.createDataFrame([(i, url, html) for i, (url, html) in enumerate(rows)],
                                  "page_id long, url string, html string")
    return frame.selectExpr("*", "'x' AS host", "'x' AS verdict", "'x' AS node", "'x' AS Url_", "1 AS component")


def verdicts(df, rules=URL_RULES, redirects=None):
    return [r.verdict for r in sorted(urls.judge(df, rules, redirects).collect(), key=lambda r: r.page_id)]


def canonical(target):
    return f'<html><head><LINK href="{target}" rel="canonical"></head></html>'


def refresh(target):
    return f"<meta http-equiv='Refresh' content='0; URL={target}'>"


def test_host_and_path(spark):
    rows = ["http://A.Example.NET/x?q#f", "https://b.org", "https://b.org?x/y", "https://b.org#x", "no scheme/x", None, "",
            "://h/p", "a://b://c/d", "http://Ünï.NET/É", "http://user@h:80/p", "http:///p"]
    df = spark.createDataFrame([(r,) for r in rows], "url string")
    found = [tuple(r) for r in df.select(urls.host_of(F.col("url")), urls.path_of(F.col("url"))).collect()]
    assert found == [
        ("a.example.net", "/x"), ("b.org", ""), ("b.org", ""), ("b.org", ""), ("", ""), ("", ""), ("", ""), ("h", "/p"),
        ("b:", "//c/d"), ("Ünï.net".replace("Ü", "Ü"), "/É"), ("user@h:80", "/p"), ("", "/p")]


def test_rules(spark):
    cases = {"http://net/": "net/", "http://x.net/a": "net/", "http://x.net": None, "http://inet/": None,
             "http://example.net/en/1": "example.net/en/", "http://a.example.net/en": "net/", "http://example.com/de/": "example.com/de/",
             "http://example.com/de": None, "http://b.org/fr/x": "org/fr/", "http://b.org/de/x": None}
    found = urls.judge(pages(spark, *((u, None) for u in cases)), URL_RULES).collect()
    assert {list(cases)[r.page_id]: r.rule for r in found} == cases
    tie = (urls.Rule("block", "ab.c", "/"), urls.Rule("allow", "b.c", "/a"), urls.Rule("block", "b.c", "/x"))
    assert verdicts(pages(spark, ("http://ab.c/", None), ("http://b.c/x", None), ("http://b.c/a", None)), tie) == [
        "block", "block", "allow"]


def test_targets_are_resolved_like_a_browser_does(spark):
    """A page is blocked if what its link means is a blocked page, however it is written."""
    rules = (urls.Rule("block", "x.com", "/z"), urls.Rule("block", "x.com", "/p?v=2"), urls.Rule("block", "y.com", "/a/b"))
    blocked = [("http://x.com/a/b", "../z"), ("http://x.com/a/b/c", "../../z"), ("http://x.com/a", "./z"), ("http://x.com/a", "../../../z"),
               ("http://x.com/k/", "http://y.com/q/../a/./b"), ("http://x.com", "z")]
    allowed = [("http://x.com/a/b", "z"), ("http://x.com/a/b", "./../a/z"), ("http://x.com/a", "#z"), ("http://x.com/a", "mailto:z@x.com"),
               ("http://x.com/a", "?z")]
    df = pages(spark, *((u, canonical(t)) for u, t in blocked + allowed))
    assert verdicts(df, rules) == ["block"] * len(blocked) + ["allow"] * len(allowed)
    # a query alone stays on the page's path, and is another page than the path without it
    alias = pages(spark, ("http://w.com/p?a=1", canonical("?v=2")), ("http://w.com/p?v=2", canonical("http://x.com/z")),
                  ("http://w.com/p", None))
    assert verdicts(alias, rules) == ["block", "block", "allow"]
    based = pages(spark, ("http://w.com/p", '<base href="http://x.com/q/"><link rel=canonical href="../z">'),
                  ("http://x.com/q/r/s", '<BASE href="../"><link rel=canonical href="../z">'),
                  ("http://w.com/p", '<base target=_top><link rel=canonical href="z">'))
    assert verdicts(based, rules) == ["block", "block", "allow"]


def test_paths_without_dots(spark):
    cases = {"/a/b/c/./../../g": "/a/g", "/..": "/", "/../../x": "/x", "/a/.": "/a/", "/a/b/..": "/a/", "/a/...": "/a/...", "": "",
             "/a//../b": "/a/b", "/.": "/", "/a/./b/": "/a/b/"}
    df = spark.createDataFrame([(c,) for c in cases], "p string")
    assert [r[0] for r in df.select(urls.without_dots(F.col("p"))).collect()] == list(cases.values())


def test_blocks_follow_links_and_allows_do_not_spread(spark):
    df = pages(
        spark,
        ("http://one.com/a", canonical("http://two.com/b")),        # blocked through two.com and three.net
        ("https://two.com/b#part", refresh("http://three.net/c")),  # blocked through three.net
        ("http://four.org/fr/", canonical("http://three.net/c")),   # explicit allow
        ("http://five.com/", canonical("http://four.org/fr/")),     # same component: blocked
        ("http://six.com/x/y", canonical("../z")),                  # no component with a block
        ("http://seven.com/x/y", canonical("/other?a=1&amp;b=2")),
        ("http://seven.com/other?a=1&b=2", refresh("//eight.net/de/")),
        ("http://nine.com/", None),
        (None, canonical("http://three.net/c")),
        ("nothing", ""),
    )
    assert verdicts(df) == ["block", "block", "allow", "block", "allow", "block", "block", "allow", "allow", "allow"]


def test_given_redirects(spark):
    df = pages(spark, ("http://one.com/", ""), ("http://two.com/", ""))
    redirects = spark.createDataFrame([("http://one.com/", "http://x.net/"), (None, "http://two.com/"), ("http://two.com/", None)],
                                      "source string, target string")
    assert verdicts(df, redirects=redirects) == ["block", "allow"]
    assert verdicts(df) == ["allow", "allow"]


def test_repeated_rows_and_empty_table(spark):
    df = pages(spark, ("http://x.net/", None))
    assert verdicts(df.unionByName(df)) == ["block", "block"]
    assert verdicts(df.filter("false")) == []


def test_query_reads_all_pages_without_python(spark):
    result = LLM_QUERIES["op9_url_filter"](spark, SF)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert result.count() == read(spark, SF, "pages").count()
    assert "op9_url_filter" in LLM_ORACLE_SQL
