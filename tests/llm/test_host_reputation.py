from __future__ import annotations

from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from silverline.llm import host_reputation as H
from silverline.llm.queries import op7_host_reputation

SF = "/root/testdata/sf0.01"


def plain_reputation(outcomes):
    """{host: (n, good, mean, upper)} by the same formulas, step by step."""
    n, good = defaultdict(int), defaultdict(int)
    for h, g in outcomes:
        n[h] += g is not None
        good[h] += g or 0
    domain = lambda h: ".".join(h.split(":")[0].split(".")[-2:])
    suffix = lambda h: h.split(":")[0].split(".")[-1]

    def rolled(of):
        a, b = defaultdict(int), defaultdict(int)
        for h in n:
            a[of(h)] += n[h]
            b[of(h)] += good[h]
        return a, b

    def strength(groups):
        g = [(a, b, m) for a, b, m in groups if a > 0 and 0 < m < 1]
        total = sum(a for a, _, _ in g)
        if not g or total <= len(g):
            return H.SUFFIX_STRENGTH
        s = sum(a * (b / a - m) ** 2 / (m * (1 - m)) for a, b, m in g)
        return 1 / min(max((s - len(g)) / (total - len(g)), 1e-3), 0.5) - 1

    base = (sum(good.values()) + 1) / (sum(n.values()) + 2) if sum(n.values()) else 0.5
    sn, sg = rolled(suffix)
    ms = {s: (sg[s] + H.SUFFIX_STRENGTH * base) / (sn[s] + H.SUFFIX_STRENGTH) for s in sn}
    dn, dg = rolled(domain)
    k = strength([(dn[d], dg[d], ms[d.split(".")[-1]]) for d in dn])
    md = {d: (dg[d] + k * ms[d.split(".")[-1]]) / (dn[d] + k) for d in dn}
    k = strength([(n[h], good[h], md[domain(h)]) for h in n])
    out = {}
    for h in n:
        mean = (good[h] + k * md[domain(h)]) / (n[h] + k)
        out[h] = (n[h], good[h], mean, mean + H.BOUND_SIGMAS * (mean * (1 - mean) / (n[h] + k + 1)) ** 0.5)
    return out


def test_against_plain_formulas(spark):
    rows = [(f"h{i % 7}.d{i % 3}.{'org' if i % 2 else 'net:80'}", None if i % 5 == 0 else int(i * i % 7 > i % 7)) for i in range(300)]
    rows += [("", None), ("", 0), ("single", 1), ("bad.evil.org", 0)] + [("bad.evil.org", 0)] * 60
    got = {r["host"]: tuple(r)[1:] for r in H.host_reputation(spark.createDataFrame(rows, "host string, good int")).collect()}
    want = plain_reputation(rows)
    assert got.keys() == want.keys()
    for h in want:
        assert got[h] == pytest.approx(want[h])
    assert got["bad.evil.org"][3] < H.LEAST_GOOD < got["single"][3]


def named():
    return H.document_of(H.path_of(F.col("url")))


URLS = [("HTTP://WWW.Example.COM/en/1?x", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
        ("http://a.www.example.com/en/", "a.www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("http://m.example.com/en/x#y", "m.example.com", "/en/x", "example.com/en/", "block"),
        ("http://notexample.com/en/x", "notexample.com", "/en/x", "com/", "allow"),
        ("http://example.com", "example.com", "", None, "allow"),
        ("http://a.net/es/1", "a.net", "/es/1", "net/es/", "block"),
        ("http://a.net/fr/1", "a.net", "/fr/1", "net/fr/", "block"),
        ("http://a.net/ES/1", "a.net", "/ES/1", None, "allow"),
        ("http://x://y/z", "x:", "//y/z", None, "allow"),
        ("no scheme.com/en/", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"),
        ("a://b?c/d", "b", "", None, "allow"), ("a\nb://É.com/\n/x", "É.com", "/\n/x", "com/", "allow")]


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u[0], "clash") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    labels = spark.createDataFrame([(0, 1), (0, 1), (1, None), (None, 0), (99, 0)], "doc_id long, quality int") \
        .withColumn("path", F.lit("clash"))
    got = {r["page_id"]: tuple(r)[1:] for r in H.judge_pages(pages, labels, named()).collect()}
    assert got == {i: u[1:] for i, u in enumerate(URLS)}
    assert H.judge_pages(pages.limit(0), labels, named()).count() == 0
    assert H.judge_pages(pages.unionAll(pages), labels.limit(0), named()).count() == 2 * len(URLS)


def test_a_bad_host_is_blocked(spark):
    pages = spark.createDataFrame([(i, f"http://{'bad' if i % 2 else 'fine'}.site{i % 2}.org/{i}") for i in range(80)], "page_id long, url string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(60)], "doc_id long, quality int")
    got = {r["page_id"]: r["verdict"] for r in H.judge_pages(pages, labels, named()).collect()}
    assert got == {i: "block" if i % 2 else "allow" for i in range(80)}


def test_sql(spark):
    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = op7_host_reputation(spark, SF).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, con.execute(H.JUDGE_SQL).fetchall()))


def test_outcomes_come_by_the_document_a_page_carries(spark):
    ends = ("", "/", ".html", "?page=2", "#top", ".html?a/7")
    pages = spark.createDataFrame(
        [(1000 - i, f"http://{'bad' if i % 2 else 'fine'}.site{i % 2}.org/en/{i}{ends[i % 6]}") for i in range(120)]
        + [(2000, "http://fine.site0.org/en/x1"), (2001, "http://fine.site0.org/1/en")], "page_id long, url string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(120)] + [(1000 - i, i % 2) for i in range(120)], "doc_id long, quality int")
    got = {(r["host"], r["verdict"]) for r in H.judge_pages(pages, labels, named()).collect()}
    assert got == {("bad.site1.org", "block"), ("fine.site0.org", "allow")}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_tables_name_the_document_in_the_url(spark, sf):
    """The article of every page, its headline aside, is word for word the document its URL names."""
    from silverline.llm.page_diff import main_text

    pages, documents = (spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("pages", "documents"))
    texts = {r["doc_id"]: r["text"].split() for r in documents.select("doc_id", "text").collect()}
    named = pages.withColumn("doc_id", H.document_of(H.path_of(F.col("url")))).select("doc_id", "html").collect()
    assert named and all(" ".join(main_text(r["html"])[1][1:]).split() == texts[r["doc_id"]] for r in named)


def test_sql_takes_the_document_not_the_page(spark):
    """Where the labels of documents and of page ids differ, SQL and code follow the document."""
    pages = [(1000 - i, f"http://{'bad' if i % 2 else 'fine'}.site{i % 2}.org/en/{i}") for i in range(120)]
    labels = [(i, 1 - i % 2) for i in range(120)] + [(1000 - i, i % 2) for i in range(120)]
    con = duckdb.connect()
    for name, kinds, rows in (("pages", "page_id BIGINT, url VARCHAR", pages), ("labels", "doc_id BIGINT, quality INT", labels)):
        con.execute(f"CREATE TABLE {name} ({kinds})")
        con.executemany(f"INSERT INTO {name} VALUES (?, ?)", rows)
    got = H.judge_pages(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int"), named())
    got = sorted(map(str, map(tuple, got.collect())))
    assert got == sorted(map(str, con.execute(H.JUDGE_SQL).fetchall())) and sum("block" in r for r in got) == 60


def test_registered_domains():
    rules = H.public_suffixes()
    assert max(r.count(".") + 1 for r in rules) <= H.MOST_LABELS
    want = {"a.b.co.uk": ("b.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "uk": ("uk", "uk"), "x.y.example.com:80": ("example.com", "com"),
            "10.0.1.2:8080": ("10.0.1.2", H.IP_SUFFIX), "[::1]:80": ("[::1]", H.IP_SUFFIX), "": ("", ""), "single": ("single", "single"),
            "a.b.c.ck": ("b.c.ck", "c.ck"), "a.www.ck": ("www.ck", "ck"), "a.b.xn--55qx5d.cn": ("b.xn--55qx5d.cn", "xn--55qx5d.cn")}
    assert {h: H.registered(h, rules) for h in want} == want


def test_a_bad_domain_under_a_long_suffix(spark):
    """Many small hosts of one bad domain are blocked by it, and clean neighbours under co.uk are not."""
    rows = [(f"h{i}.bad.co.uk", 0) for i in range(80)] + [(f"h{i}.fine{i}.co.uk", 1) for i in range(400)]
    rows += [("h.bad.co.uk", None), ("h.fine1.co.uk", None)]
    got = {r["host"]: r["upper"] for r in H.host_reputation(spark.createDataFrame(rows, "host string, good int")).collect()}
    assert got["h3.bad.co.uk"] < H.LEAST_GOOD and got["h.bad.co.uk"] < H.LEAST_GOOD <= got["h.fine1.co.uk"]
