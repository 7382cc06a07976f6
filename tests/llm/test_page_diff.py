from __future__ import annotations

import html
import random
import re
from pathlib import Path

from pyspark.sql import functions as F

from silverline.llm import page_diff as P

PAGE = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style><script>var t="</p>";</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><div class="cookie-notice">We use cookies</div><nav><ul><li><a href="/">Menu</a></li></ul></nav>
<!-- <p>no</p> --><main><article class="post"><header><h1>Head &amp; line</h1><p>by someone</p></header>
<p>One<br>two &lt;b&gt;&nbsp;x</p><div class='share'><p>Share</p></div><p>three <b>bold</b> H<sub>2</sub>O
<ul><li>a<li>b</ul><blockquote>quote</blockquote><pre>x
  y</pre><table><tr><td>c<td>d</table><form><p>form</p></form><aside>aside</aside>
<section id="comments"><article class="comment"><p>reader</p></article></section></article></main>
<div id=sidebar><p>side</p></div><footer>&copy; foot</footer></body></html>"""


def test_marked_article():
    assert P.main_text(PAGE)[1] == ["Head & line", "One two <b> x", "three bold H2O", "a", "b", "quote", "x y", "c", "d"]


def test_odd_markup():
    assert P.main_text("") == ([], None) and P.main_text("plain &eacute; <") == (["plain é <"], None)
    assert P.main_text("<article><p>a<p>b</article><p>c")[1] == ["a", "b"]
    assert P.main_text("<article><nav>x<p>never closed")[1] is None
    assert P.main_text("<ARTICLE><P TITLE='a>b'>x</P></ARTICLE>")[1] == ["x"]
    assert P.main_text("<article>a<script>if (a<b) {'</p>'}</SCRIPT >b<style>x")[1] == ["ab"]
    assert P.main_text('<div class="content"><p>x</p><div class="ad">ad</div><div>y</div></div><p>z</p>')[1] == ["x", "y"]
    assert P.main_text("<article><p>1 < 2 & 3 > 2</p></article>")[1] == ["1 < 2 & 3 > 2"]


def test_longest_common_lines():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(9))] for _ in range(2))
        kept = sorted(P.common_lines(a, b))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        assert len(kept) == best[-1][-1]
        rest = iter(b)
        assert all(a[i] in rest for i in kept)


SILENT = "<body><p>Top line</p><div><p>{}</p><p>{}</p></div><p>Bottom &amp; line</p></body>"


def test_pages(spark):
    rows = [(1, "http://h.com/a/1", SILENT.format("one", "uno")), (2, "http://h.com/a/2", SILENT.format("two", "due")),
            (3, "http://h.com/b/zzz", SILENT.format("three", "tre")), (4, "http://alone.org/x", SILENT.format("four", "quattro")),
            (5, "http://h.com/a/1?page=2", PAGE), (6, None, None), (7, "http://h.com/a/3", ""), (None, "http://n.net/", "<article>x</article>"),
            (8, "http://copies.net/c/1", "<article><p>Same</p></article>"), (9, "http://copies.net/c/2", "<article><p>Same</p></article>"),
            (10, "http://long.net/", "<article><p>" + "word " * 200000 + "</p></article>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("host", F.lit("x"))
    got = {r["page_id"]: r for r in P.extract(pages).collect()}
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert got[1]["text"] == "one\n\nuno" and got[2]["text"] == "two\n\ndue"
    assert got[3]["text"] == "three\n\ntre"        # its nearest neighbours on the host are in other folders
    assert got[4]["text"] == "Top line\n\nfour\n\nquattro\n\nBottom & line"
    assert got[5]["text"].startswith("Head & line\n\nOne two") and got[6]["text"] == got[7]["text"] == "" and got[None]["text"] == "x"
    assert got[8]["text"] == got[9]["text"] == "Same" and got[10]["n_chars"] == 999_999
    assert P.extract(pages.limit(0)).count() == 0 and P.extract(pages.unionAll(pages)).count() == 2 * len(rows)


def test_pages_table(spark):
    """On pages whose article is one element of paragraphs, a plain pattern gives the same text."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r["page_id"]: r["text"] for r in P.extract(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)(</article>|$)", r["html"], re.S)[1].replace("<br>", " ")
        blocks = (re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", b))).strip() for b in re.split(r"</?(?:p|h1)>", article))
        assert got[r["page_id"]] == "\n\n".join(b for b in blocks if b)


def _texts(spark, rows, ranges=7):
    """page_id -> text, with the pages sorted into several ranges."""
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": str(ranges)}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        return {r["page_id"]: r["text"] for r in P.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_nearest_page_of_the_whole_host(spark):
    """Pages alone in their folder or by the start of their name have a partner; ranges cut a host anywhere."""
    pages = [(i, f"http://h.com/en/{i}", SILENT.format(f"word{i}", f"text{i}")) for i in range(1000, 1200)]
    pages += [(1, "http://h.com/en/about", SILENT.format("one", "uno")), (2, "http://h.com/zzz/y", SILENT.format("two", "due")),
              (3, "http://h.com/", SILENT.format("three", "tre")), (4, "http://alone.org/x", SILENT.format("four", "quattro"))]
    got = _texts(spark, pages)
    assert got[1] == "one\n\nuno" and got[2] == "two\n\ndue" and got[3] == "three\n\ntre"
    assert got[4] == "Top line\n\nfour\n\nquattro\n\nBottom & line"
    assert all(got[i] == f"word{i}\n\ntext{i}" for i in range(1000, 1200))


def test_copies_are_passed_over(spark):
    """Groups of exact and near copies over several ranges, and repeated rows, keep their article."""
    def page(lines):
        return "<body><p>Top line</p>" + "".join(f"<p>{x}</p>" for x in lines) + "<p>Bottom line</p></body>"

    lines = [f"A paragraph of some words, number {k}." for k in range(8)]
    near = lambda i: [*lines[:i % 8], f"A paragraph that was changed, {i}.", *lines[i % 8 + 1:]]
    rows = [(i, f"http://h.com/a/{i}", page(lines)) for i in range(100, 160)]
    rows += [(i, f"http://h.com/n/{i}", page(near(i))) for i in range(160, 220)]
    rows += [(1, "http://h.com/z", page(["one", "uno", "un"])), (2, "http://h.com/z", page(["one", "uno", "un"]))]
    rows += [(i, f"http://copies.org/{i}", page(lines)) for i in range(300, 340)]
    got = _texts(spark, rows)
    assert all(got[i] == "\n\n".join(lines) for i in range(100, 160))
    assert all(got[i] == "\n\n".join(near(i)) for i in range(160, 220))
    assert got[1] == got[2] == "one\n\nuno\n\nun"
    assert all(got[i] == "\n\n".join(["Top line", *lines, "Bottom line"]) for i in range(300, 340))


def test_thin_pages_are_differenced(spark):
    menu = "".join(f"<li>Menu entry {k}</li>" for k in range(24))
    rows = [(i, f"http://thin.com/{i}", f"<body><ul>{menu}</ul><p>Own paragraph {i} of this page.</p></body>") for i in range(6)]
    for ranges in (1, 7):
        assert _texts(spark, rows, ranges) == {i: f"Own paragraph {i} of this page." for i in range(6)}


def test_notices_of_every_article_go(spark):
    def page(i, host):
        return (i, f"http://{host}/{i}", f"<body><nav>Menu {i}</nav><article><p>Text {i} of it.</p><p>Follow us every day</p><p>{'Quoted' if i % 2 else 'Own'} line</p>"
                                         f"<p>More {i}</p></article><footer>Foot</footer></body>")

    got = _texts(spark, [*(page(i, "many.com") for i in range(8)), *(page(i, "few.com") for i in range(20, 23))])
    assert all(got[i] == f"Text {i} of it.\n\n{'Quoted' if i % 2 else 'Own'} line\n\nMore {i}" for i in range(8))
    assert all("Follow us every day" in got[i] for i in range(20, 23))          # too few pages to tell


def test_differencing_decides_blocks_of_the_table(spark):
    """Counts by an independent version: partners in path order among rows that differ, and sets of lines."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    kept = P.decide(P.read_blocks(pages)).collect()
    assert sum(r["by_difference"] for r in kept) > 0 and sum(r["by_markup"] for r in kept) > 0
    lines = {}
    for r in pages.collect():
        blocks = P.blocks_of(r["html"])
        best = max(k for _, k in blocks)
        lines[r["url"]] = ([b for b, _ in blocks], {b for b, k in blocks if k == best})
    place = {u: (re.match("[^:]*://([^/?#]*)", u)[1].lower(), re.match("[^:]*://[^/?#]*([^?#]*)", u)[1], u) for u in lines}
    order = sorted(lines, key=place.get)
    for r in kept:
        at = order.index(r["address"])
        beside = [order[i] for i in (at - 1, at + 1) if 0 <= i < len(order) and place[order[i]][0] == place[r["address"]][0]]
        own, article = lines[r["address"]]
        assert r["by_difference"] + r["by_markup"] == sum(b not in article for b in own)
        if any(len(lines[u][1] & article) > len(article) / 2 for u in beside):
            continue                                                               # copies: the partner is further off
        most = max((P._shared_prefix(place[u][1], place[r["address"]][1]) for u in beside), default=0)
        counts = {sum(i in P.common_lines(own, lines[u][0]) and b not in article for i, b in enumerate(own)) for u in beside
                  if P._shared_prefix(place[u][1], place[r["address"]][1]) == most} or {0}
        assert r["by_difference"] in counts


def _menu_page(menu, lines):
    return f"<body><nav>{menu}</nav>" + "".join(f"<p>{x}</p>" for x in lines) + "</body>"


def test_one_body_in_many_forms(spark):
    """Pages of one address and body, with other menus, fill several ranges: partners are beyond them, and each is paired."""
    lines = [f"A paragraph of some words, number {k}." for k in range(8)]
    rows = [(i, "http://one.org/m", _menu_page(f"Day {i}", lines)) for i in range(80)]
    rows += [(100, "http://one.org/a", _menu_page("Day", [*lines[:7], "The last is other."])),
             (101, "http://one.org/z", _menu_page("Day", ["The first is other.", *lines[1:]]))]
    rows += [(i, "http://two.org/m", _menu_page(f"Day {i}", lines)) for i in range(200, 240)]
    rows += [(300, "http://two.org/z", _menu_page("Day", ["Another page,", "with other lines."]))]
    for ranges in (1, 7, 31):
        got = _texts(spark, rows, ranges)
        assert all(got[i] == lines[7] for i in range(80))          # all are alike on the host: the next that is not equal
        assert got[100] == "The last is other." and got[101] == "The first is other."
        assert all(got[i] == "\n\n".join(lines) for i in range(200, 240)) and got[300] == "Another page,\n\nwith other lines."


def test_lost_blocks_are_shuffled_when_many(spark):
    rows = [(i, f"http://h.com/{i}", SILENT.format(f"one {i}", f"uno {i}")) for i in range(40)] + [(None, "http://h.com/7", SILENT.format("one 7", "uno 7"))]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = _texts(spark, rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == {**{i: f"one {i}\n\nuno {i}" for i in range(40)}, None: "one 7\n\nuno 7"}


def test_no_text_is_written_or_moved(spark):
    """Pages are told apart by files much smaller than their texts, and no text is dealt by a key where little is lost."""
    rng = random.Random(5)
    words = {i: [f"{rng.getrandbits(12_000):x}" for _ in range(6)] for i in range(200)}
    pages = spark.createDataFrame([(i, f"http://h{i % 9}.com/{i}", "<article>" + "".join(f"<p>{x}</p>" for x in w) + "</article>") for i, w in words.items()],
                                  "page_id long, url string, html string")
    root = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    size = lambda: sum(f.stat().st_size for f in root.rglob("*.parquet"))
    old, before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), size()
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4k")
        out = P.extract(pages)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "hashpartitioning" not in plan
    assert 0 < size() - before < sum(len(x) for w in words.values() for x in w) / 8
    assert {r["page_id"]: r["text"] for r in out.collect()} == {i: "\n\n".join(w) for i, w in words.items()}
