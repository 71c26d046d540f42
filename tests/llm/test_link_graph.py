import numpy as np
import pytest

from wattlake.llm import link_graph
from wattlake.llm.queries import RULES, url_verdicts

PAGES = "page_id long, url string, html string"


def naive_host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    ends = [rest.find(c) for c in "/?#" if c in rest]
    host, tail = (rest[:min(ends)], rest[min(ends):]) if ends else (rest, "")
    ends = [tail.find(c) for c in "?#" if c in tail]
    path = tail[:min(ends)] if ends else tail
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def naive_rule(host, path):
    best = None
    for rule in RULES:
        if (host == rule.host or host.endswith("." + rule.host)) and path.startswith(rule.path):
            if best is None or len(rule.text) > len(best.text):
                best = rule
    return best


URLS = [
    None, "", "no scheme", "http://", "http://A.Net", "http://a.net/", "http://net/x", "http://planet/x", "https://www.Example.NET/en/a?b#c",
    "http://example.net/english", "http://example.net?/en/", "http://x.example.com/de/1", "http://example.com/DE/1", "http://b.org/fr/",
    "http://b.org#/fr/", "ftp://u:p@h.ORG:80/fr/x", "x://y://z", "http://É.net/\n?", "http://a.b/c#d?e",
]


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(URLS)], PAGES)
    for r in link_graph.judge_urls(pages, RULES).collect():
        host, path = naive_host_path(URLS[r.page_id])
        rule = naive_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule and rule.text), URLS[r.page_id]
        assert r.verdict == (rule.verdict if rule else "allow")


def _links(*hosts):
    return "".join(f"<a HREF = '//{h}/x'>y</a><a href=https://{h.upper()}?z>" for h in hosts)


def _naive_spread(edges, seeds, damping):
    hosts = sorted({h for e in edges for h in e[:2]} | set(seeds))
    out = np.zeros((len(hosts), len(hosts)))
    for a, b, n in edges:
        out[hosts.index(a), hosts.index(b)] += n
    sums = out.sum(axis=1, keepdims=True)
    step = damping * out / np.where(sums == 0, 1, sums)
    start = np.array([1.0 if h in seeds else 0.0 for h in hosts])
    return dict(zip(hosts, np.linalg.solve(np.eye(len(hosts)) - step.T, start), strict=True))


def test_trust_equals_the_solved_equations(spark):
    rng = np.random.default_rng(5)
    names = [f"h{i}.com" for i in range(12)]
    edges = [(names[a], names[b], int(rng.integers(1, 4))) for a in range(12) for b in range(12) if a != b and rng.random() < 0.2]
    seeds = spark.createDataFrame([(names[0], True, False), (names[1], False, True), (names[2], True, False)], "host string, trusted boolean, blocked boolean")
    found = link_graph.spread_trust(spark.createDataFrame(edges, "src string, dst string, n long"), seeds).collect()
    trust = _naive_spread(edges, {names[0], names[2]}, link_graph.DAMPING)
    distrust = _naive_spread([(b, a, n) for a, b, n in edges], {names[1]}, link_graph.DAMPING)
    got = {r.host: r for r in found}
    for h in names:
        for value, name in ((trust.get(h, 0), "trust"), (distrust.get(h, 0), "distrust")):
            assert (getattr(got[h], name) if h in got else 0) == pytest.approx(value, abs=1e-5)


def test_hosts_that_link_to_blocked_ones_are_blocked(spark):
    pages = [
        (1, "http://bad.net/a", None), (2, "http://farm.com/a", _links("bad.net")), (3, "http://second.com/a", _links("farm.com")),
        (4, "http://good.org/fr/a", _links("friend.com")), (5, "http://friend.com/", _links("lone.com")), (6, "http://lone.com/", ""),
        (7, "http://friend.com/", "<a href='/self'>"), (8, "http://new.com/", _links("new.com", "lone.com")),
        (9, "http://www.example.com/de/x", ""), (10, "http://www.example.com/x", ""), (11, "http://www.example.com/y", ""),
    ]
    got = {r.page_id: r for r in link_graph.judge_urls(spark.createDataFrame(pages, PAGES), RULES).collect()}
    assert {i for i, r in got.items() if r.verdict == "block"} == {1, 2, 3, 9}
    assert got[5].trust > 0 and got[6].trust > 0 and got[8].trust == 0
    assert got[2].distrust == pytest.approx(0.85) and got[3].distrust == pytest.approx(0.85**2)


def test_odd_rows_and_empty_table(spark):
    rows = [(None, "http://a.net/", None, 1), (1, None, "<a href='http://x.y/'>", 2), (1, None, "<a href='http://x.y/'>", 2)]
    got = link_graph.judge_urls(spark.createDataFrame(rows, PAGES + ", host int"), RULES).collect()
    assert sorted((r.page_id or 0, r.host, r.verdict) for r in got) == [(0, "a.net", "block"), (1, "", "allow"), (1, "", "allow")]
    assert link_graph.judge_urls(spark.createDataFrame([], PAGES), RULES).collect() == []


def test_query_judges_every_page(spark):
    folder = "/root/testdata/sf0.01"
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    found = url_verdicts(spark, folder).collect()
    assert len(found) == len(pages)
    for r in found:
        host, path = naive_host_path(pages[r.page_id])
        rule = naive_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule and rule.text)
        assert rule is None or r.verdict == rule.verdict
