import pytest

from pulsegrid.llm import url_filter as u
from pulsegrid.llm.queries import URL_RULES


@pytest.mark.parametrize(
    "url, host, path",
    [
        (None, "", ""),
        ("no scheme", "", ""),
        ("http://A.Example.COM/P/a?x=/y", "a.example.com", "/P/a"),
        ("http://É.com#/x", "É.com", ""),
        ("http://a?b://c/d", "a", ""),
        ("://h/p", "h", "/p"),
        ("http://", "", ""),
        ("http:///p", "", "/p"),
    ],
)
def test_host_and_path(url, host, path):
    assert u.host_and_path(url) == (host, path)


@pytest.mark.parametrize(
    "host, path, found",
    [
        ("a.com", "/x", ("com/", "allow")),
        ("example.com", "/en/1", ("example.com/en/", "block")),
        ("blog.example.com", "/en/1", ("example.com/en/", "block")),
        ("www.example.com", "/en/1", ("www.example.com/en/", "allow")),
        ("a.www.example.com", "/en/1", ("www.example.com/en/", "allow")),
        ("badexample.com", "/en/1", ("com/", "allow")),
        ("example.com", "", None),
        ("x.net", "/es/1", ("net/es/", "block")),
        ("x.net", "/de/1", None),
        ("net", "/fr/", ("net/fr/", "block")),
        ("", "/fr/", None),
    ],
)
def test_the_longest_rule_of_the_host_or_a_domain_above_wins(host, path, found):
    assert u.Rules(URL_RULES).find(host, path) == found


def test_the_model_judges_urls_it_has_not_seen():
    model = u.fit()
    say = lambda url: model.score(u.features(*u.host_and_path(url), u.Settings())) >= 0.5
    blocked = ["http://m.spam-farm.example.org/fr/831", "https://x.casino-win.example.net/de/5", "http://free-bets.example.org/es/99"]
    blocked += ["http://cheap-pills.example.org/en/3.html", "https://blog.adult-x.example.net/en/44", "http://ads-track.example.org/de/2"]
    allowed = ["http://blog.ththan.example.net/en/369", "https://www.thering.example.org/fr/12/", "http://school.example.org/timetable"]
    assert all(map(say, blocked)) and not any(map(say, allowed))


def test_rows_of_all_kinds(spark):
    rows = [(1, "http://x.net/fr/1"), (1, "http://x.net/fr/1"), (2, None), (None, "http://a.com/"), (3, "http://spam-farm.example.net/de/1")]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'z' as host", "'y' as verdict")
    found = sorted((r.page_id or 0, r.rule or "", r.verdict) for r in u.judge(pages, URL_RULES).collect())
    assert found == [(0, "com/", "allow"), (1, "net/fr/", "block"), (1, "net/fr/", "block"), (2, "", "allow"), (3, "", "block")]
    assert u.judge(pages.limit(0), URL_RULES).collect() == []
