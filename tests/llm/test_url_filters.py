from pyspark.sql import functions as F

from genrec.llm import url_filters as q
from genrec.llm.graph import components

SCHEMA = "page_id long, url string, html string"


def verdicts(spark, rows):
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in q.judge(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_hosts_paths_and_longest_rules(spark):
    rows = [(1, "http://A.Example.ORG/es/x?y#z", ""), (2, "https://example.org/en/12", ""), (3, "https://example.org/en/2", ""),
            (4, "x://b.com/fr/#/de/", ""), (5, "x://b.com/de/a://c.org/", ""), (6, "x://b.com", ""), (7, "//b.org/", ""), (8, None, None),
            (9, "x://org/", ""), (10, "x://borg/", ""), (11, "x://É.ORG:80/p?q/r", ""), (12, "x://b.org?x=/", ""), (13, "://c.org/", "")]
    got = verdicts(spark, rows)
    assert got == {
        1: ("a.example.org", "/es/x", "example.org/es/", "block"), 2: ("example.org", "/en/12", "example.org/en/1", "block"),
        3: ("example.org", "/en/2", "org/", "allow"), 4: ("b.com", "/fr/", "com/fr/", "allow"),
        5: ("b.com", "/de/a://c.org/", "com/de/", "block"), 6: ("b.com", "", None, "allow"), 7: ("", "", None, "allow"),
        8: ("", "", None, "allow"), 9: ("org", "/", "org/", "allow"), 10: ("borg", "/", None, "allow"),
        11: ("É.org:80", "/p", None, "allow"), 12: ("b.org", "", None, "allow"), 13: ("c.org", "/", "org/", "allow")}


def test_blocks_reach_aliases_and_allows_win(spark):
    link = '<link href="{}" rel="canonical">'.format
    rows = [(1, "http://a.net/x", link("https://b.com/de/9")), (2, "https://www.b.com/de/9.html#t", ""),
            (3, "http://m.A.net/x/", '<META http-equiv="refresh" content="0; URL=http://z.net/q?utm_source=1&a=2">'),
            (4, "https://z.net/q?a=2", None), (5, "https://z.net/q?a=3", None),
            (6, "http://c.net/1", link("https://b.com/de/7")), (7, "http://c.net/1/", link("http://d.org/")),
            (8, "https://b.com/de/7", ""), (1, "http://a.net/x", "")]
    got = {k: v[3] for k, v in verdicts(spark, rows).items()}
    # 1, 3, 4: aliases of a blocked address; 6, 7: an explicitly allowed alias; 8: its own rule
    assert got == {1: "block", 2: "block", 3: "block", 4: "block", 5: "allow", 6: "allow", 7: "allow", 8: "block"}


def test_targets_are_resolved(spark):
    rows = [("/de/9", "https://a.com/x/y?z#t", "https://a.com/de/9"), ("//b.com/de/9", "https://a.com", "https://b.com/de/9"),
            ("next.html", "x://a.com/d/e?f=/g/", "x://a.com/d/next.html"), ("next", "x://a.com", "x://a.com/next"),
            ("../n?q=http://c.d/", "x://a.com/d/e/f", "x://a.com/d/n?q=http://c.d/"), ("./", "x://a.com/d/e", "x://a.com/d/"),
            ("../../..", "x://a.com/d/e", "x://a.com/"), ("/a/./b/..", "x://a.com/", "x://a.com/a/"), ("?p=2", "x://a.com/d?e#f", "x://a.com/d?p=2"),
            ("#t", "x://a.com/d?e#f", "x://a.com/d?e#t"), ("http://b.org", "x://a.com/d", "http://b.org"), ("mailto:x@y.z", "x://a.com/d", None),
            ("/de", "nowhere", None)]
    df = spark.createDataFrame(rows, "target string, base string, want string")
    for r in df.select("*", q.resolved(F.col("target"), F.col("base")).alias("got")).collect():
        assert r.got == r.want, r
    refs = spark.createDataFrame([("/a?b=1&amp;c=2&#38;d&#x2F;&bogus;&#x1F600;é&", "/a?b=1&c=2&d/&bogus;😀é&"), ("&amp;amp;", "&amp;"), ("", "")], "v string, want string")
    assert all(r.got == r.want for r in refs.select("*", q.decoded(F.col("v")).alias("got")).collect())


def test_relative_and_repeated_links_alias(spark):
    link = '<link rel="canonical" href="{}">'.format
    rows = [(1, "http://a.net/x/1", link("//b.com/de/9")), (2, "http://b.com/q/2", link("../de/9")), (3, "http://b.com/q", link("/de/9")),
            (4, "http://c.net/1", '<base href="https://b.com/de/"><meta http-equiv=refresh content="0; url=9.html">'),
            (5, "http://d.net/1", link("http://d.net/2") + link("http://b.com/de/9")), (6, "http://d.net/2", ""),
            (7, "http://e.net/1", link("/p?a=1&amp;b=2")), (8, "http://e.net/p?a=1&b=2", link("//b.com/de/9")), (9, "http://f.net/", link("mailto:x@y"))]
    got = {k: v[3] for k, v in verdicts(spark, rows).items()}
    assert got == {k: "block" for k in range(1, 9)} | {9: "allow"}


def test_stage_and_edges(spark):
    df = spark.createDataFrame([(1, "x://b.com/de/", ""), (2, None, None), (3, "x://b.com/fr/", "")], SCHEMA).selectExpr(
        "*", "url as host", "1 as url_judged")
    assert q.allowed(df).columns == df.columns
    assert sorted(r.page_id for r in q.allowed(df).collect()) == [2, 3]
    assert q.judge(df.limit(0)).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 40)] + [(100 + i, 200) for i in range(50)] + [(7, 7), (None, 3), (300, 301), (301, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {100 + i: 100 for i in range(50)} | {200: 100, 300: 300, 301: 300}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
