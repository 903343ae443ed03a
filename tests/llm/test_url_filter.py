"""URL rules and vocabulary."""

from pitpanel.llm.url_filter import judge_urls


def test_rules_terms_and_edges(spark):
    cases = {
        "http://a.example.org/es/1": ("a.example.org", "/es/1", "example.org/es/", "block"),
        "HTTP://A.Example.ORG/en/12?x": ("a.example.org", "/en/12", "example.org/en/1", "block"),
        "x://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
        "x://example.org": ("example.org", "", None, "allow"),
        "x://b.com/fr/porn": ("b.com", "/fr/porn", "com/fr/", "allow"),
        "x://b.com/DE/": ("b.com", "/DE/", None, "allow"),
        "x://b.net/porn": ("b.net", "/porn", None, "block"),
        "x://b.net/popcorn/essex": ("b.net", "/popcorn/essex", None, "allow"),
        "x://b.net/sex": ("b.net", "/sex", None, "allow"),
        "x://b.net/sex/sex-sex": ("b.net", "/sex/sex-sex", None, "allow"),
        "x://b.net/SEX?a=casino": ("b.net", "/SEX", None, "block"),
        "x://b.net#xxx": ("b.net", "", None, "block"),
        "no scheme porn": ("", "", None, "block"),
        "": ("", "", None, "allow"),
        "a\nb://c.org/\nq": ("c.org", "/\nq", "org/", "allow"),
        "x://y.com://z.org/": ("y.com:", "//z.org/", None, "allow"),
    }
    urls = list(cases)
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(None, None, None), (0, urls[0], None)], "page_id long, url string, host string")
    rows = judge_urls(df).collect()
    assert len(rows) == len(urls) + 2
    for r in rows:
        if r.page_id is None:
            assert (r.host, r.path, r.rule, r.verdict) == ("", "", None, "allow")
        else:
            assert (r.host, r.path, r.rule, r.verdict) == cases[urls[r.page_id]], urls[r.page_id]
    assert judge_urls(df.limit(0)).count() == 0
