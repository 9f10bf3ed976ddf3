import fnmatch

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemart.llm import urls


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.text("ab*./", max_size=12), min_size=1, max_size=30),
    st.lists(st.text("ab./é", max_size=14), min_size=1, max_size=8),
)
def test_automaton_matches_globs(globs, texts):
    found = urls.matching(urls.compile_globs(globs), [t.encode() for t in texts])
    for t, row in zip(texts, found):
        for g, hit in zip(globs, row):
            assert hit == fnmatch.fnmatchcase(t, g), (t, g)


def test_verdicts(spark):
    rows = [
        (1, "https://www.example.com/en/a?x=1#y"), (2, "http://EXAMPLE.com/en/"), (3, "http://a.b.example.com/en"),
        (4, "http://m.shop.net/fr/1"), (5, "http://shop.net/en/"), (6, None), (7, "no scheme"), (8, ""), (8, ""),
        (9, "x://notexample.com/en/"), (10, "http://com?q/"), (None, "http://net/es/" + "z" * 70_000), (12, "a://b://net/es/"),
        (13, "http://www.example.com\n/en/"),
    ]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, host string")
    got = urls.judge_pages(pages, urls.RULES).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: (r["host"], r["path"][:10], r["rule"], r["verdict"]) for r in got}
    assert by[1] == ("www.example.com", "/en/a", "www.example.com/en/", "allow")
    assert by[2] == ("example.com", "/en/", "example.com/en/", "block")
    assert by[3] == ("a.b.example.com", "/en", "com/", "allow")
    assert by[4][2:] == ("net/fr/", "block")
    assert by[5][2:] == (None, "allow")
    for i in (6, 7, 8):
        assert by[i] == ("", "", None, "allow")
    assert by[9][2:] == ("com/", "allow")
    assert by[10] == ("com", "", None, "allow")
    assert by[None][2:] == ("net/es/", "block")
    assert by[12][:2] == ("b:", "//net/es/")


def test_hosts_end_where_the_path_begins(spark):
    """Hosts in a path, as in archive and redirect URLs, are not the page's host."""
    rules = (*urls.RULES, urls.Rule(urls.BLOCK, "shop.org"), urls.Rule(urls.BLOCK, "ads*.org/x"))
    rows = [
        (1, "http://web.archive.org/web/2020/http://www.example.com/en/x"), (2, "http://foo.org/a.net/es/b"),
        (3, "http://a.org/b.com/c"), (4, "http://m.net/a.net/es/"), (5, "http://b.net/es/a.com/"),
        (6, "http://shop.org"), (7, "http://m.shop.org/a"), (8, "http://shop.organic/a"), (9, "http://b.org/m.shop.org"),
        (10, "http://m.ads1.org/xy"), (11, "http://ads.net/a.org/x"),
    ]
    got = urls.judge_pages(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()
    found = {r["page_id"]: r["rule"] for r in got}
    fits = {5: "net/es/", 6: "shop.org", 7: "shop.org", 10: "ads*.org/x"}
    assert found == {i: fits.get(i) for i, _ in rows}


def test_empty(spark):
    assert urls.judge_pages(spark.createDataFrame([], "page_id long, url string"), urls.RULES).collect() == []


@pytest.mark.parametrize("n", [1, 40])
def test_many_words(n):
    globs = [f"*{'ab' * i}*" for i in range(1, n + 1)]
    found = urls.matching(urls.compile_globs(globs), [b"ab" * 20, b""])
    assert found[0].tolist() == [i <= 20 for i in range(1, n + 1)]
    assert not found[1].any()
