import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rollcall.llm.queries import URL_GLOBS, URL_RULES
from rollcall.llm.url_filter import Automaton, Glob, Rule, judge_urls

URLS = [
    None, "", "no scheme.org/", "http://", "http://a.org", "http://a.org/", "HTTP://A.Org/x?y#z", "x://org/",
    "http://EXAMPLE.org/es/1", "http://www.example.org/es", "http://example.org/en/12", "http://xexample.org/en/1",
    "http://a.com/fr/?q=/de/", "http://a.com/de/x", "http://a.com?/de/x", "http://a.com#/de/", "http://com/de/",
    "http://a.net/b.org/x", "http://free-bets.example.net", "http://b.ads-track.net/x", "http://a.net/login?x",
    "http://É.com/fr/é", "http://a.com/\n/fr/", "http://a://b.org/x", "http://a.net/" + "y" * 20000 + ".exe",
]


def plain(glob):
    out = ""
    for token in re.findall(r"\*\*|\*|\?|[^*?]+", glob):
        out += {"**": "(?s:.)*", "*": "[^/]*", "?": "[^/]"}.get(token) or re.escape(token)
    return re.compile(out)


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.text("ab/*?", min_size=1, max_size=12), min_size=1, max_size=20),
    st.lists(st.text("ab/cé", max_size=12), min_size=1, max_size=8),
)
def test_automaton_is_globbing(globs, strings):
    found = Automaton(globs).match(strings)
    for i, s in enumerate(strings):
        for j, g in enumerate(globs):
            assert bool(found[i, j]) == bool(plain(g).fullmatch(s)), (g, s)


def test_rules_over_many_words():
    globs = [f"*.host{i}.org/**" for i in range(300)]
    found = Automaton(globs).match([".host7.org/", ".a.host299.org/x/y", ".nohost.org/"])
    assert found[0].nonzero()[0].tolist() == [7] and found[1].nonzero()[0].tolist() == [299]
    assert not found[2].any()


def brute(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1], m[2]) if m else ("", "")
    host = re.sub("[A-Z]+", lambda x: x[0].lower(), host)
    best = None
    for r in URL_RULES:
        site, slash, rest = r.rule.partition("/")
        fits = (host == site or host.endswith("." + site)) and path.startswith(slash + rest)
        if fits and (best is None or len(r.rule) > len(best.rule)):
            best = r
    return host, path, best


def test_pages(spark):
    rows = [(i, u, "clash") for i, u in enumerate(URLS)] + [(0, None, "clash"), (4, URLS[4], None)]
    found = judge_urls(spark.createDataFrame(rows, "page_id int, url string, verdict string"), URL_RULES, URL_GLOBS)
    got = found.collect()
    assert len(got) == len(rows)
    globs = sorted(URL_GLOBS, key=lambda g: -len(g.pattern))
    for r in got:
        host, path, best = brute(r.url)
        other = next((g for g in globs if plain(g.pattern).fullmatch(f".{host}{path}")), None)
        assert (r.host, r.path, r.rule) == (host, path, best.rule if best else None)
        assert r.verdict == (best.verdict if best else other.verdict if other else "allow")


def test_longest_rule_and_ties(spark):
    urls = spark.createDataFrame([("http://a.b/c/d",)], "url string")
    told = judge_urls(urls, [Rule("allow", "b/c/"), Rule("block", "b/c/"), Rule("allow", "b/")])
    assert told.first().verdict == "block"
    told = judge_urls(urls, [Rule("allow", "b/*/")], [Glob("block", "**/d")])
    assert (told.first().rule, told.first().verdict) == (None, "block")  # a rule's star is a star


@pytest.mark.parametrize("rules", [(), URL_RULES])
def test_no_pages(spark, rules):
    none = spark.createDataFrame([], "page_id int, url string")
    assert judge_urls(none, rules).count() == 0
    assert judge_urls(spark.createDataFrame([(1, "x")], none.schema), ()).first().verdict == "allow"
