from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymart.llm import urlgraph as U


@pytest.mark.parametrize(
    "url,host,path,rule,verdict",
    [
        ("http://A.Example.COM/en/1?x=/fr/", "a.example.com", "/en/1", "example.com/en/", "block"),
        ("https://www.example.com/en/#t", "www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("https://x.www.example.com/en/a", "x.www.example.com", "/en/a", "www.example.com/en/", "allow"),
        ("http://a.net/es/", "a.net", "/es/", "net/es/", "block"),
        ("http://a.net/ES/", "a.net", "/ES/", None, None),
        ("http://anet/es/", "anet", "/es/", None, None),
        ("x://y.com/a://b", "y.com", "/a://b", "com/", "allow"),
        ("http://y.com", "y.com", "", None, None),
        ("http://y.com?q", "y.com", "", None, None),
        ("y.com/a", "", "", None, None),
        (None, "", "", None, None),
        ("://ÄB.com/\n?", "Äb.com", "/\n", "com/", "allow"),
    ],
)
def test_rules(spark, url, host, path, rule, verdict):
    frame = spark.createDataFrame([(1, url, None)], "page_id long, url string, html string")
    r = U.judged_by_rules(frame).first()
    assert (r.host, r.path, r.rule, r.rule_verdict) == (host, path, rule, verdict)


def test_links(spark):
    html = """<a href="http://B.org/x">1</a><a href='//c.org?q'>2<a href=/local>3<img SRC=https://b.org>
    <a href="mailto:x@y.org">4<a data-href="http://no.org">5<a href = "rel#f">6"""
    rows = [(1, "http://a.org/", html), (2, "http://a.org/", None), (3, None, html)]
    judged = U.judged_by_rules(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = {(r.src, r.dst): r.links for r in U.host_links(judged).collect()}
    assert got == {("a.org", "b.org"): 2, ("a.org", "c.org"): 1, ("a.org", "a.org"): 2}


def test_propagation_against_plain_iteration(spark):
    random.seed(2)
    names = [f"h{i}" for i in range(9)]
    links = {(a, b): random.randint(1, 4) for a in range(7) for b in random.sample(range(9), 3)}
    seeds = np.asarray([(random.random() * (i % 3 == 0), random.random() * (i % 4 == 1)) for i in range(9)])
    frame = spark.createDataFrame([(n, *map(float, s)) for n, s in zip(names, seeds)], "host string, trust_seed double, distrust_seed double")
    edges = spark.createDataFrame([(names[a], names[b], n) for (a, b), n in links.items()], "src string, dst string, links long")
    got = {r.host: (r.trust, r.distrust) for r in U.propagate(frame, edges, rounds=200).collect()}

    def rank(seed, pairs):
        total = np.zeros(9)
        for (a, _), n in pairs.items():
            total[a] += n
        t = seed.copy()
        for _ in range(400):
            new = np.zeros(9)
            for (a, b), n in pairs.items():
                new[b] += t[a] * n / total[a]
            t = 0.15 * seed + 0.85 * (new + t[total == 0].sum() * seed / seed.sum())
        return t

    trust, distrust = rank(seeds[:, 0], links), rank(seeds[:, 1], {(b, a): n for (a, b), n in links.items()})
    assert np.allclose([got[n] for n in names], np.stack([trust, distrust], 1), atol=1e-6)


def test_distrust_reaches_hosts_that_link_to_blocked_ones(spark):
    bad = [(i, "http://bad.net/es/p", None) for i in range(3)]
    linker = [(10 + i, "http://farm.org/x", '<a href="http://bad.net/">') for i in range(2)]
    linked = [(20, "http://good.com/x", '<a href="http://friend.org/">'), (21, "http://friend.org/x", None), (22, None, None), (None, "http://bad.net/", None)]
    frame = spark.createDataFrame([(*r, "c") for r in bad + linker + linked], "page_id long, url string, html string, host string")
    got = {(r.page_id, r.verdict, r.rule) for r in U.filter_urls(frame, margin=0.3).collect()}
    assert got == {
        (0, "block", "net/es/"), (1, "block", "net/es/"), (2, "block", "net/es/"), (10, "block", None), (11, "block", None),
        (20, "allow", "com/"), (21, "allow", None), (22, "allow", None), (None, "block", None),
    }
    assert U.filter_urls(frame.limit(0)).collect() == []


def test_links_to_blocked_hosts_at_the_default_margin(spark):
    """Several linkers, and the blocked host's own links, neither clear a linker nor the blocked host."""
    inner = '<a href="/es/q">' * 99
    bad = [(i, "http://bad.net/es/p", inner) for i in range(3)] + [(3, "http://bad.net/other", inner)]
    full = [(4, "http://worse.net/fr/", inner)]
    farms = [(10 + i, f"http://farm{i}.org/x", '<a href="http://worse.net/"><a href="/y">') for i in range(5)]
    mixed = [(20, "http://mixed.org/x", '<a href="http://worse.net/">' + '<a href="http://plain.org/">' * 9)]
    plain = [(21, "http://plain.org/x", None), (22, "http://lone.org/x", '<a href="http://bad.net/">')]
    frame = spark.createDataFrame(bad + full + farms + mixed + plain, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in U.filter_urls(frame, rounds=4).collect()}
    assert got == {k: "allow" if k in (20, 21) else "block" for k in got}
    assert len(got) == 13


def test_every_page_is_judged(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = U.op1_url_filter(spark, sf_dir)
    assert rows.count() == pages.count()
    assert rows.where("rule is not null").where((F.col("rule").isin("com/", "www.example.com/en/")) != (F.col("verdict") == "allow")).count() == 0
