"""The node table against a parser that reads one page at a time, and the page operators on nested and broken markup."""

import html as references
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from figloom.operators import html as hp
from figloom.operators import pages

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s?"[^"]*"|=\s?'[^']*'|[^>])*)(?:>|\Z)""", re.S)


def brute(page):
    """Nodes of one page by a stack: pre, post, parent, tag, text, start, stop."""
    tokens, at, raw = [], 0, None
    while at < len(page):
        if raw:
            end = re.compile(rf"</{raw}[\s/>]", re.I).search(page, at)
            stop = end.start() if end else len(page)
            if stop > at and raw in ("title", "textarea"):
                tokens.append(("text", None, at, stop))
            at, raw = stop, None
            continue
        m = TOKEN.search(page, at)
        start = m.start() if m else len(page)
        if start > at:
            tokens.append(("text", None, at, start))
        if not m:
            break
        if m[2]:
            tag = m[2].lower()
            empty = not m[1] and (tag in hp.VOID or m[0].endswith("/>"))
            tokens.append(("close" if m[1] else "empty" if empty else "open", tag, start, m.end()))
            raw = tag if tag in hp.RAW and not m[1] and not empty else None
        at = m.end()
    nodes, open_ = [], []

    def end(depth, stop):
        for k in open_[depth:]:
            nodes[k]["post"], nodes[k]["stop"] = len(nodes) - 1, stop
        del open_[depth:]

    for kind, tag, start, stop in tokens:
        if kind == "close":
            for depth in range(len(open_) - 1, -1, -1):
                if nodes[open_[depth]]["tag"] == tag:
                    end(depth + 1, start)
                    end(depth, stop)
                    break
            continue
        if kind != "text":
            outermost = None
            for depth in range(len(open_) - 1, -1, -1):
                above = nodes[open_[depth]]["tag"]
                if tag in hp.ENDED_BY.get(above, ()):
                    outermost = depth
                elif above in hp.WALLS:
                    break
            if outermost is not None:
                end(outermost, start)
        text = references.unescape(page[start:stop]) if kind == "text" else None
        nodes.append({"pre": len(nodes), "post": len(nodes), "parent": open_[-1] if open_ else -1, "tag": tag, "text": text, "start": start, "stop": stop})
        if kind == "open":
            open_.append(len(nodes) - 1)
    end(0, len(page))
    return nodes


PIECES = ["<p>", "</p>", "<b>", "</b>", "<div class='a b'>", "</div>", "<li>", "</li>", "<ul>", "</ul>", "<td>", "<tr>", "</table>", "<table>", "<br>", "<img src=\"x>y\" alt='q'>", "<figure>", "</figure>", "text", " a &amp; b ", "<!-- <p> -->", "<script>if (a<b) '</p>'</script>", "<TITLE>one <b> two</title>", "<div/>", "</x>", "<!doctype html>", "5 < 6", "<h1>", "</h1>", "<p title=\"it's\">", "<option>", "<SPAN CLASS=x>", "</span>"]


@pytest.mark.parametrize("seed", range(4))
def test_nodes_are_those_of_a_stack(seed):
    rng = random.Random(seed)
    cases = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 30))) for _ in range(300)]
    for x in ("<p>a<div><p>b</div>c", "<ul><li>x<ul><li>y</ul><li>z</ul>", "<b><i></b></i>", "<a href='1'", "<!-- x", "<script>x", "<p><b>x<p>y</b>z"):
        cases.append(x)
    for page, nodes in zip(cases, hp.parse(pa.array(cases)).to_pylist(), strict=True):
        assert [{k: v for k, v in n.items() if k != "attrs"} for n in nodes] == brute(page), page


def test_batches_and_slices():
    cases = ["<p>é</p>", None, "", "<b>x", "<p>y</p>"]
    whole = hp.parse(pa.array(cases)).to_pylist()
    assert whole[1] == whole[2] == [] and [hp.parse(pa.array([c], pa.string())).to_pylist()[0] for c in cases] == whole
    assert hp.parse(pa.array(cases).slice(3, 2)).to_pylist() == whole[3:]
    assert hp.parse(pa.chunked_array([cases[:2], cases[2:]])).to_pylist() == whole
    assert hp.parse(pa.array([], pa.string())).to_pylist() == []


def test_long_pages_take_linear_time():
    deep = "<div>" * 40_000 + "x" + "</div>" * 40_000
    flat = "<p>y<li>" * 60_000
    quotes = '<a href="' + "x" * 300_000
    got = hp.parse(pa.array([deep, flat, quotes])).to_pylist()
    assert got[0][0]["post"] == 40_000 and got[0][40_000]["text"] == "x" and got[0][40_000]["parent"] == 39_999
    assert len(got[1]) == 180_000 and len(got[2]) == 1


def test_joins_by_interval(spark):
    p = spark.createDataFrame([(1, "<figure><p>a</p><figure><p>b</p></figure></figure><p>c</p>"), (2, None)], "page_id long, html string")
    n = hp.node_table(p, "page_id")
    pairs = hp.within(n.where("tag = 'p'"), n.where("tag = 'figure'"), "page_id")
    assert sorted((r["outer_pre"], r["pre"]) for r in pairs.collect()) == [(0, 1), (0, 4), (3, 4)]


@pytest.mark.parametrize("attrs,name,want", [(' href="a b"', "href", "a b"), (" HREF='x'", "href", "x"), (" href=y>", "href", "y"), (" data-href=z", "href", None), (' a="1"href="2"', "href", "2"), (" href = '?a&amp;b'", "href", "?a&b"), ("", "href", None), (None, "href", None)])
def test_attributes(spark, attrs, name, want):
    assert spark.createDataFrame([(attrs,)], "a string").select(hp.attribute(F.col("a"), name)).first()[0] == want


def test_nested_figures_and_divs(spark):
    html = "<figure id=o><div><figure><img src='//h/in_hi-res.png'><p>In</p></figure></div><p>Out<p>side</figure><figure><p></p></figure>"
    p = spark.createDataFrame([(1, html)], "page_id long, html string")
    blocks = pages.figure_blocks(p, "page_id")
    assert [r["pos"] for r in blocks.orderBy("pos").collect()] == [0, 1, 2]
    told = pages.captions(blocks).select("pos", "caption", pages.image_url(F.col("block")).alias("u")).orderBy("pos").collect()
    assert [tuple(r) for r in told] == [(0, "InOutside", "https://h/in.png"), (1, "In", "https://h/in.png")]
    rsc = '<div class="x image_table"><div><div>pad</div></div><a href="/image/article/1">i</a><span class="graphic_title">Fig <b>1</b></span></div>'
    block = pages.figure_blocks(spark.createDataFrame([(1, rsc)], "page_id long, html string"), "page_id", "rsc")
    assert block.first()["block"] == rsc and pages.captions(block, "rsc").first()["caption"] == "Fig 1"
    assert block.select(pages.image_url(F.col("block"), "https://r", "rsc")).first()[0] == "https://r/image/article/1"


def test_only_marked_figures_of_acs(spark):
    html = '<figure><a class="inline-fig internalNav">x</a><p>c</p></figure><figure><p>d</p></figure>'
    assert pages.figure_blocks(spark.createDataFrame([(1, html)], "page_id long, html string"), "page_id", "acs").count() == 1


def test_open_badge_of_the_document(spark):
    html = "<div><a href='/a'>x</a></div><span class='text-orange big'>Op<b>en</b></span>"
    assert [r["link"] for r in pages.open_links(spark.createDataFrame([(1, html)], "page_id long, html string")).collect()] == ["/a"]
