import time

import pytest

from haulmetrics.llm import url_filter
from haulmetrics.llm.queries import URL_RULES


def brute(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    for c in "?#":
        path = path.split(c, 1)[0]
    fits = [r for r in rules if (host == r[1] or host.endswith("." + r[1]))
            and path.startswith(r[2])]
    best = max(fits, key=lambda r: (len(r[1]), len(r[2]), r[0]), default=None)
    return host, path, best and best[1] + best[2], best[0] if best else default


URLS = [None, "", "no scheme", "http://", "http://example.org", "http://EXAMPLE.org/es/x",
        "https://a.b.example.org/en/17?x=/es/", "http://example.org/en/2", "http://notexample.org/es/",
        "http://x.com/fr", "http://x.com/fr/", "http://x.com/de/#a", "http://com/de/",
        "http://x.com:80/de/", "http://u@x.com/de/1", "http://x.com//de/", "ftp://a?b/c",
        "http://a.org#/x", "http://ÄÖ.org/es", "x\nhttp://y.org/\nz", "http://.org/", "http://org./"]
EXTRA = [("block", "com", "/de/"), ("allow", "com", "/de/x/y"), ("block", "x.com", "/de/x/"),
         ("allow", "x.com", "/de/x/"), ("block", "org", "")]


@pytest.mark.parametrize("rules", [URL_RULES, URL_RULES + EXTRA, []])
def test_both_ways_match_brute_force(prepared, rules):
    urls = URLS + ["http://x.com/de/x/y/z", "http://y.x.com/de/x"] + URLS[:3]
    pages = prepared.createDataFrame([(i % 9, u, "other") for i, u in enumerate(urls)],
                                     "page_id long, url string, host string").repartition(3)
    expected = sorted([(i % 9, *brute(u, rules)) for i, u in enumerate(urls)], key=str)
    table = prepared.createDataFrame(rules, "verdict string, host string, path string")
    for found in (url_filter.judge(pages, rules), url_filter.judge_by_join(pages, table)):
        assert sorted(map(tuple, found.collect()), key=str) == expected


def test_empty_table(prepared):
    pages = prepared.createDataFrame([], "page_id long, url string")
    assert url_filter.judge(pages, URL_RULES).collect() == []


def test_rules_beyond_the_bound_are_refused(monkeypatch):
    monkeypatch.setattr(url_filter, "MAX_BROADCAST_BYTES", 20)
    with pytest.raises(ValueError):
        url_filter.UrlTrie([url_filter.Rule("block", "a.example", "/x")])


def test_long_paths_take_linear_time():
    trie = url_filter.UrlTrie(url_filter.Rule(*r) for r in URL_RULES + EXTRA)
    start = time.perf_counter()
    assert trie.match("example.org", "/en/1" + "x" * 1_000_000).path == "/en/1"
    assert trie.match("a.com", "/x" * 500_000) is None
    assert time.perf_counter() - start < 5
