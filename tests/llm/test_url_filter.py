from __future__ import annotations

from tillflow.llm import url_filter

PAGES = "page_id bigint, url string, html string"


def judged(spark, rows, **options):
    found = url_filter.judge(spark.createDataFrame(rows, PAGES), **options)
    return {r["page_id"]: r for r in found.collect()}


def link(target):
    return f'<html><head><LINK href="{target}" data-x rel="canonical"></head></html>'


def test_longest_rule_and_parts(spark):
    urls = [
        "http://A.Example.NET/en/1?x#y", "https://example.net/de/", "http://net", "http://notexample.com/de/1", "http://example.com/de/#a",
        "http://x.org/fr/1", "http://org/en", "no scheme", None, "http://example.com?x=/de/", "ftp://a.b.example.com/de/x", "://net/", "http://x.net/a\nb",
    ]
    found = judged(spark, [(i, u, None) for i, u in enumerate(urls)])
    assert [(found[i]["host"], found[i]["path"], found[i]["rule"], found[i]["verdict"]) for i in range(len(urls))] == [
        ("a.example.net", "/en/1", "example.net/en/", "allow"),
        ("example.net", "/de/", "net/", "block"),
        ("net", "", None, "allow"),
        ("notexample.com", "/de/1", None, "allow"),
        ("example.com", "/de/", "example.com/de/", "block"),
        ("x.org", "/fr/1", "org/fr/", "allow"),
        ("org", "/en", None, "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("example.com", "", None, "allow"),
        ("a.b.example.com", "/de/x", "example.com/de/", "block"),
        ("net", "/", "net/", "block"),
        ("x.net", "/a\nb", "net/", "block"),
    ]


def test_aliases_share_decisions_and_allow_comes_first(spark):
    rows = [
        (1, "http://a.com/1", link("https://b.com/1")),
        (2, "http://b.com/1#top", '<meta http-equiv="refresh" content="0; url=http://c.com/x?q=1&amp;r=2">'),
        (3, "https://c.com/x?q=1&r=2", link("//bad.net/p")),
        (4, "http://d.com/1", link("http://bad.net/p")),
        (5, "http://e.com/1", link("http://also.net/p")),
        (6, "http://f.com/1", link("http://also.net/p")),
        (7, "http://f.com/1", link("http://x.org/fr/2")),
        (8, "http://g.com/1", None),
        (9, "http://x.org/fr/3", link("http://bad.net/p")),
    ]
    found = judged(spark, rows[:6] + rows[7:8])
    assert [found[i]["verdict"] for i in (1, 2, 3, 4, 5, 6, 8)] == ["block"] * 6 + ["allow"]
    assert {found[i]["rule"] for i in found} == {None}
    found = judged(spark, rows)
    assert [found[i]["verdict"] for i in range(1, 10)] == ["allow"] * 9
    assert found[9]["rule"] == "org/fr/" and found[9]["alias"] is None and found[1]["alias"] == "allow"


def test_relative_targets_and_given_redirects(spark):
    rows = [(1, "http://a.com/x/y?z", link("other")), (2, "http://a.com/x/other", None), (3, "http://z.com/", None)]
    redirects = spark.createDataFrame([("http://a.com/x/other", "http://z.com"), ("http://z.com", "http://q.net/")], "source string, target string")
    found = judged(spark, rows, redirects=redirects)
    assert [found[i]["verdict"] for i in (1, 2, 3)] == ["block"] * 3


def test_no_rows_repeats_and_extra_columns(spark):
    assert judged(spark, []) == {}
    pages = spark.createDataFrame([(1, "http://a.net/", None, "x")] * 3 + [(None, None, None, None)], PAGES + ", rule string")
    assert sorted(str(r["rule"]) for r in url_filter.judge(pages).collect()) == ["None", "net/", "net/", "net/"]


def test_registered_query_follows_long_chains_and_hot_targets(spark, tmp_path):
    from tillflow.llm.queries import op6_url_filter

    blocked = next(h + p for h, p, v in url_filter.RULES if v == "block")
    chain = [(i, f"http://c{i}.example/", link(f"http://c{i + 1}.example/" if i < 40 else f"http://{blocked}")) for i in range(41)]
    hot = [(100 + i, f"http://h{i}.example/", link("http://hot.example/")) for i in range(300)]
    end = [(500, "http://hot.example/", link(f"http://{blocked}x")), (501, "http://alone.example/", "")]
    spark.createDataFrame([*chain, *hot, *end], PAGES).write.parquet(str(tmp_path / "pages.parquet"))
    found = op6_url_filter(spark, str(tmp_path)).collect()
    assert {r["page_id"]: r["verdict"] for r in found} == {i: "allow" if i == 501 else "block" for i, _, _ in [*chain, *hot, *end]}
