from __future__ import annotations

import re

import pytest

from playmart.llm import urls

RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/")]


def parted(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host) :]).group()


URLS = [None, "", "nohost", "://", "http://", "HTTP://WWW.Example.COM/en/x?a=/b#c", "http://a.example.com/en", "http://b.com",
        "http://b.com/", "x://y://z.com/p", "http://com/en/?q", "https://k.net/es/#top", "https://k.net/ES/", "http://É.com/q\nr",
        "http://notexample.com/en/", "http://www.www.example.com/en/1", "http://h#f://x.com/"]


def test_hosts_paths_and_longest_rules(spark):
    pages = spark.createDataFrame([(i, u, None, "clash") for i, u in enumerate(URLS)], "page_id long, url string, html string, host string")
    got = {r.page_id: r for r in urls.judge_pages(pages, RULES).collect()}
    for i, u in enumerate(URLS):
        host, path = parted(u)
        fits = [(len(rule), rule, verdict) for verdict, rule in RULES
                for h, p in [(rule.split("/")[0], rule[rule.index("/") :])]
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (got[i].host, got[i].path) == (host, path)
        assert got[i].rule == (max(fits)[1] if fits else None)
        if fits:
            assert got[i].verdict == max(fits)[2]


def plain_rank(nodes, edges, seed, damping, rounds):
    score = dict(seed)
    for _ in range(rounds):
        new = {n: (1 - damping) * seed[n] for n in nodes}
        for n in nodes:
            out = {d: w for (s, d), w in edges.items() if s == n} or {n: 1}
            for d, w in out.items():
                new[d] += damping * score[n] * w / sum(out.values())
        score = new
    return score


def test_scores_equal_plain_iteration(spark):
    edges = {("a", "b"): 3, ("a", "c"): 1, ("b", "a"): 1, ("c", "c"): 2, ("d", "a"): 5, ("e", "d"): 1}
    nodes = sorted({x for e in edges for x in e} | {"f"})
    trusted = {n: 1.0 if n == "a" else 0.25 * (n == "f") for n in nodes}
    blocked = {n: 0.5 * (n == "b") for n in nodes}
    seeds = spark.createDataFrame([(n, trusted[n], blocked[n]) for n in nodes], "host string, trusted double, blocked double")
    table = spark.createDataFrame([(s, d, n) for (s, d), n in edges.items()], "src string, dst string, n long")
    got = {r.host: r for r in urls.propagate(seeds, table, rounds=7, still=-1).rows.collect()}
    forth = plain_rank(nodes, edges, trusted, urls.DAMPING, 7)
    back = plain_rank(nodes, {(d, s): n for (s, d), n in edges.items()}, blocked, urls.DAMPING, 7)
    for n in nodes:
        assert got[n].trust == pytest.approx(forth[n]) and got[n].distrust == pytest.approx(back[n])


def test_links_are_read_from_pages(spark):
    html = """<a href="http://B.org/1">x</a><A HREF='//c.org/y'><a href=/own><a href="#x"><a href="mailto:a@b"><a href=""><a href="q?x=http://d">"""
    pages = spark.createDataFrame([(1, "http://a.com/", html), (2, "http://a.com/2", html), (3, None, html), (4, "http://e.com", None)], "page_id long, url string, html string")
    got = {(r.src, r.dst): r.n for r in urls.host_links(pages).collect()}
    assert got == {("a.com", "b.org"): 2, ("a.com", "c.org"): 2, ("a.com", "a.com"): 4}


def test_a_host_that_links_to_a_blocked_one_is_suspect(spark):
    pages = spark.createDataFrame(
        [(1, "http://bad.net/es/", ""), (2, "http://fan.org/", '<a href="http://bad.net/es/">'), (3, "http://good.org/", '<a href="http://x.com/">'),
         (4, "http://x.com/", ""), (4, "http://x.com/", "")], "page_id long, url string, html string")
    got = urls.judge_pages(pages, RULES).collect()
    assert sorted((r.page_id, r.verdict) for r in got) == [(1, "block"), (2, "block"), (3, "allow"), (4, "allow"), (4, "allow")]


def test_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert urls.judge_pages(pages, RULES).count() == 0
    one = spark.createDataFrame([(1, "http://x.org/", "")], "page_id long, url string, html string")
    assert [(r.rule, r.verdict) for r in urls.judge_pages(one, []).collect()] == [(None, "allow")]


def test_scores_that_do_not_settle_raise(spark):
    seeds = spark.createDataFrame([("a", 1.0, 0.0), ("b", 0.0, 0.0)], "host string, trusted double, blocked double")
    links = spark.createDataFrame([("a", "b", 1), ("b", "a", 1)], "src string, dst string, n long")
    with pytest.raises(RuntimeError, match="settled"):
        urls.propagate(seeds, links, rounds=2)
    assert urls.propagate(seeds, links).rows.count() == 2
