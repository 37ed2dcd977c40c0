import duckdb
import pytest

from starpipe.llm.oracles import url_filters
from starpipe.llm.url_filter import RULES, Vocabulary, judge_urls

URLS = [
    None, "", "no scheme", "://", "http://", "HTTP://A.Example.NET/EN/x", "http://a.example.net/en/x",
    "http://example.net/en", "http://badexample.net/", "http://net/", "http://xnet/", "ftp://x.example.com/de/?q#f",
    "http://x.example.com/de", "http://w.org/fr/1", "http://org/fr/", "http://w.org?fr/", "http://w.org#/fr/",
    "http://a.com/casino", "http://casinos.com/", "http://a.com/casino-x", "http://a.com/free?x=bets",
    "http://a.com/free/free", "http://a.com/freebets", "http://é.com/FREE/İwin", "a://b://net/x",
    "http://É.Example.Net/en/", "http://u@a.net:80/", "http://line\nbreak.net/free\nwin",
]


def test_agrees_with_sql(make):
    rows = [(i, url, "clash") for i, url in enumerate(URLS)] + [(3, "http://net/", "x"), (None, "http://net/", None)]
    got = judge_urls(make(rows, "page_id long, url string, host string"), carry=["page_id"]).toPandas()
    pages = make(rows, "page_id long, url string, host string").toPandas()
    db = duckdb.connect()
    db.register("pages", pages)
    want = db.sql(url_filters()).df()
    columns = sorted(got.columns)

    def plain(frame):
        frame = frame[columns].astype(object)
        return sorted(map(str, frame.where(frame.notna(), None).values.tolist()))

    assert plain(got) == plain(want)


def test_longest_rule_wins(make):
    rows = [(1, "http://x.example.net/en/a"), (2, "http://x.example.net/de/a"), (3, "http://example.com/de/")]
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in judge_urls(make(rows, "page_id long, url string")).collect()}
    assert got == {1: ("example.net/en/", "allow"), 2: ("net/", "block"), 3: ("example.com/de/", "block")}
    assert all(rule in RULES for rule, _ in got.values())


def test_terms_stand_alone_and_count_once():
    words = Vocabulary({"bad": 2, "soft": 1, "so": 1})
    assert words.weight("x-BAD.y") == 2
    assert words.weight("badly soft_soft") == 1
    assert words.weight("soft so") == 2
    assert words.weight(None) == words.weight("") == 0
    assert Vocabulary({}).weight("bad") == 0


@pytest.mark.parametrize("rules", [{}, {"net/": "block"}])
def test_empty_tables_and_rules(make, rules):
    empty = make([], "page_id long, url string, rule string, extra int")
    result = judge_urls(empty, rules=rules)
    assert result.count() == 0
    assert result.columns == ["page_id", "url", "extra", "host", "path", "rule", "term_weight", "verdict"]
