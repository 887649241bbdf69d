"""Main text of pages: markup by hand, votes of a host, and the given pages against a plain reading of their template."""

import html as library
import random
import re

import pytest
from pyspark.sql import functions as F

from mediatide.llm.host_paths import Page, host_paths, main_texts, op11_host_paths

SHAPE = "page_id long, url string, html string"


def own_text(html: str) -> str:
    page = Page(html)
    return page.text(page.best().path)


FRAME = """<!DOCTYPE html><html><head><title>A &amp; B</title><style>p{{}}</style><script>var a = "<p>not text</p>";</script></head>
<body class="single has-sidebar comments-open"><header><h1>Site</h1><nav><ul><li><a href="/">Home</a></ul></nav></header>
<div class="cookie-notice">We use cookies on this site.</div><div id="wrapper" class="content-sidebar"><div class="content">{}</div>
<div class="sidebar"><p>Words beside the text, of some length, in a sidebar.</p></div></div>
<section id="comments"><article class="comment-body"><p>First! I have read this and have much to say about it, at length.</p></article></section>
<footer><p>&copy; 2024 Somebody</p></footer></body></html>"""

CASES = [
    ("<p>One two.</p><p>Three&nbsp;four &lt;five&gt; &#8364;&#x41;.</p>", "One two. Three four <five> €A."),
    ("<p>bold<b>er</b> and <i>more\n\n so</i></p>tail", "bolder and more so tail"),
    ("<p><b>Not closed.<br><p>Next one.<ul><li>a<li>b</ul>", "Not closed. Next one. a b"),
    ("<p>Text one is here.</p><div class='ad-box'><p>Buy!</p></div><p>Text two.</p>", "Text one is here. Text two."),
    ("<p>Text one is here.</p><form><input name=q><p>Your mail</p><textarea>x</textarea></form>", "Text one is here."),
    ("<p>Text.<!-- <p>no</p> --> More &amp text; &unknown; &.</p>", "Text. More & text; &unknown; &."),
    ("<p>1 < 2 and 3 <4 <> 5</p>", "1 < 2 and 3 <4 <> 5"),
    ("<p title='a > b' data-x=\"</p>\">Quoted attributes.</p>", "Quoted attributes."),
    ("<div class=share-buttons>Tweet</div><p>Text.</p><div hidden>secret</div><div style='display: none'>s</div>", "Text."),
    ("<header><h2>Head line</h2><p class='meta'>by me</p></header><p>Text of the story, long enough.</p>", "Head line Text of the story, long enough."),
    ("<table><tr><td>a<td>b<tr><td>c</table><p>Text and more text.</p>", "a b c Text and more text."),
    ("<P CLASS='lead'>Upper <SPAN>case</SPAN></P><HR><P>End</P>", "Upper case End"),
    ("<p>one<svg><path d='x'/><text>no</text></svg>two</p>", "one two"),
]


@pytest.mark.parametrize(("inner", "wanted"), CASES)
def test_content_of_a_page(inner, wanted):
    assert own_text(FRAME.format(inner)) == wanted
    assert own_text(f"<body><nav><a href=x>Menu item</a></nav><article>{inner}</article></body>") == wanted


@pytest.mark.parametrize(
    ("html", "wanted"),
    [
        ("", ""), ("just text", "just text"), ("<", "<"), ("<p>cut <a href='x", "cut"), ("<title>never closed <p>x", ""), ("<!-- open", ""),
        ("<p>a</p></div></b></article><p>b", "a b"), ("</p></p>x", "x"), ("<main><form id=aspnet><p>All in a form.</p></form></main>", "All in a form."),
        ("<div>" * 20_000 + "deep" + "</div>" * 20_000, "deep"), ("<b><i>" * 5000 + "x" + "</i>" * 9000, "x"), ("<li>" * 20_000 + "y", "y"),
        ("<a href='" + "x" * 100_000, ""), ("a\x1c b　c", "a b c"),
    ],
)
def test_odd_markup(html, wanted):
    assert own_text(html) == wanted


def long_text(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(n))


def test_the_host_decides(spark):
    """Boxes of unknown name that hold more than a short story are found out by the host's other pages."""
    rng = random.Random(2)
    rows = []
    for i in range(40):
        story, box = long_text(rng, 4 if i % 8 == 0 else 80), long_text(rng, 25)
        rows.append((i, "https://A.example.org:8080/x", f"<body><div class='zz{i} qx'><p>{box}</div><div class='k-{i}'><p>{story}</div></body>", story, box))
    # Another host uses the same classes the other way round.
    for i in range(40, 50):
        story, box = long_text(rng, 90), long_text(rng, 5)
        rows.append((i, "http://user@b.example.org/", f"<body><div class='zz{i} qx'><p>{story}</div><div class='k-{i}'><p>{box}</div></body>", story, box))
    pages = spark.createDataFrame([r[:3] for r in rows], SHAPE).repartition(4)
    alone = {r[0]: own_text(r[2]) for r in rows}
    assert any(alone[r[0]] != r[3] for r in rows)
    assert {r["page_id"]: r["text"] for r in main_texts(pages).collect()} == {r[0]: r[3] for r in rows}
    winners = {r["host"]: r["paths"] for r in host_paths(pages).collect()}
    assert winners["a.example.org"][0]["spelled"] == "body>div.k-#" and winners["b.example.org"][0]["spelled"] == "body>div.qx.zz#"
    assert [p["votes"] for p in winners["a.example.org"]] == [35, 5]


def test_a_page_with_several_winning_containers(spark):
    pages = [(i, "http://h/x", f"<body><div class=s><p>part one of page {i}</div><ul><li><a href=x>l</a></ul><div class=s><p>part two, longer</div>") for i in range(3)]
    found = main_texts(spark.createDataFrame([*pages, (9, "http://h/y", "<body><div class=other><p>Another kind of page.</div>")], SHAPE), 30)
    texts = {r["page_id"]: r["text"] for r in found.collect()}
    assert texts[9] == "Another kind of page."
    assert texts[1] in ("part one of page 1 part two, longer", "part one of page 1 l part two, longer")


def test_given_pages(spark):
    """Every page of the table against its article, cut out by a pattern."""
    path = "/root/testdata/sf0.01"
    found = {r["page_id"]: r for r in op11_host_paths(spark, path).collect()}
    pages = spark.read.parquet(f"{path}/pages.parquet").collect()
    assert len(found) == len(pages)
    for r in pages:
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S).group(1)
        blocks = re.split(r"</?(?:p|h1|br)>", re.sub(r"</?b>", "", article))
        wanted = " ".join(" ".join(map(library.unescape, blocks)).split())
        assert (found[r["page_id"]]["text"], found[r["page_id"]]["url"]) == (wanted, r["url"])
        assert found[r["page_id"]]["n_chars"] == len(wanted)


def test_odd_rows(spark, folder):
    body = "<article><p>" + "word " * 200_000 + "</p></article>"
    rows = [(1, None, "<p>a</p>"), (2, "no host", "<p>b</p>"), (3, "http://h/", None), (4, "http://h/", ""), (None, None, None), (5, "http://h/", body), (5, "http://h/", body)]
    pages = spark.createDataFrame(rows, SHAPE)
    for name in ("host", "path", "paths", "votes", "text", "n_chars"):
        pages = pages.withColumn(name, F.lit("extra"))
    out = op11_host_paths(spark, folder(pages=pages))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    long = ("word " * 200_000).strip()
    got = sorted([(r["page_id"] or 0, r["url"], r["text"], r["n_chars"]) for r in out.collect()], key=repr)
    wanted = [(1, None, "a", 1), (2, "no host", "b", 1), (3, "http://h/", "", 0), (4, "http://h/", "", 0), (0, None, "", 0), *[(5, "http://h/", long, len(long))] * 2]
    assert got == sorted(wanted, key=repr)
    assert main_texts(spark.createDataFrame([], SHAPE)).collect() == []
