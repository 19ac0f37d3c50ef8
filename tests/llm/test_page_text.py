import html
import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import types as T

from webmart.llm import page_text
from webmart.llm.queries import op12_page_text

PAGES = T.StructType(
    [T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())]
)


def text(page):
    return page_text.main_text(page)[0]


class Article(HTMLParser):
    """The text of the given pages' article element, by a plain walk over them."""

    def __init__(self, page):
        super().__init__(convert_charrefs=False)
        self.inside, self.parts = False, [""]
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.inside = self.inside or tag == "article"
        self.handle_endtag("" if tag == "article" else tag)

    def handle_endtag(self, tag):
        self.inside = self.inside and tag != "article"
        if tag in ("p", "h1", "article"):
            self.parts.append("")
        elif tag == "br":
            self.parts[-1] += " "

    def handle_data(self, data):
        self.parts[-1] += data if self.inside else ""

    def handle_entityref(self, name):
        self.handle_data(f"&{name};")

    def result(self):
        return "\n\n".join(part for part in (" ".join(html.unescape(part).split()) for part in self.parts) if part)


def test_query_equals_a_plain_walk(spark, sf_dir):
    found = op12_page_text(spark, sf_dir)
    assert found.dtypes == [("page_id", "bigint"), ("url", "string"), ("text", "string"), ("n_chars", "bigint")]
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    wanted = [(row.page_id, row.url, Article(row.html or "").result()) for row in rows]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(((*row, len(row[2])) for row in wanted), key=repr)


ARTICLE = "<h1>Heading</h1><p>A first paragraph, with some words.</p><p>Short.</p><p>And a last one; it ends here.</p>"
TEXT = "Heading\n\nA first paragraph, with some words.\n\nShort.\n\nAnd a last one; it ends here."
PROSE = "This stretch of prose is long, has marks of punctuation, and is still no part of the article. " * 5


@pytest.mark.parametrize(
    "furniture",
    [
        "<nav><ul><li><a href=x>Home</a><li><a href=y>About us</a></ul></nav>",
        f"<header><p>{PROSE}</p></header>",
        f"<footer><p>{PROSE}</footer>",
        f"<aside><p>{PROSE}</p></aside>",
        f"<div class='sidebar left'><p>{PROSE}</p></div>",
        f"<div id=cookieNotice><p>{PROSE}</p></div>",
        f"<div class='ad'>{PROSE}</div>",
        f"<div role='alert'><p>{PROSE}</p></div>",
        f"<form><label>Name</label><input name=n><p>{PROSE}</p><button>Send</button></form>",
        f"<section id='comments'><article><p>{PROSE}</p></article></section>",
        f"<div class='post-comments'><div><p>{PROSE}</p></div></div>",
        f"<script>var a = '<p>{PROSE}</p>';</script><style>p {{ margin: 0 }}</style><!-- {PROSE} -->",
        f"<noscript><p>{PROSE}</p></noscript><select><option>{PROSE}</select><textarea>{PROSE}</textarea>",
    ],
)
@pytest.mark.parametrize("place", ["before", "after"])
@pytest.mark.parametrize("shell", ["<article>{}</article>", "<main>{}</main>", "<div class='content'>{}</div>", "{}"])
def test_furniture_is_left_out(furniture, place, shell):
    article = shell.format(ARTICLE)
    page = furniture + article if place == "before" else article + furniture
    assert text(f"<!DOCTYPE html><html><head><title>{PROSE}</title></head><body class='has-sidebar'>{page}</body></html>") == TEXT
    inside = furniture + ARTICLE if place == "before" else ARTICLE + furniture
    if not furniture.startswith("<header"):
        assert text(f"<body>{shell.format(inside)}") == TEXT


def test_unmarked_pages_are_judged_by_their_paths():
    links = "".join(f"<li><a href=/{i}>Link {i}</a></li>" for i in range(30))
    page = f"<div class=x1><ul>{links}</ul></div><div class=x2>{ARTICLE}<p>{PROSE}</p></div><div class=x3>Menu</div>"
    assert text(page) == f"{TEXT}\n\n{PROSE.strip()}"
    scored = page_text.main_text(page)[1]
    assert {name: path.kept for name, path in scored.items()} == {
        "/div.x1/ul/li": False,
        "/div.x2/h1": False,
        "/div.x2/p": True,
        "/div.x3": False,
    }
    assert scored["/div.x2/p"].nodes == 4 and scored["/div.x1/ul/li"].score == 0


def test_the_mark_of_an_article_decides():
    assert text(f"<div><p>{PROSE}</p></div><article><p>Hi.</p></article>") == "Hi."
    assert text("<article><p>Outer.</p><article><p>A reader's answer.</p></article></article>") == "Outer."
    assert text("<article><article><p>Inner.</p></article></article>") == "Inner."
    assert text(f"<main><article></article><p>{PROSE}</p></main><p>x</p>") == PROSE.strip()
    assert text("<article><header><h1>T</h1></header><p>A.</p><footer>F</footer></article>") == "T\n\nA."
    assert text("<div itemprop=articleBody><p>B.</p></div><p>C.</p>") == "B."


def test_blocks_and_white_space():
    assert text("<p>a\n\t b&nbsp;c<br>d<i>e</i>f <img src=x>g</p>tail") == "a b c def g\n\ntail"
    assert text("<p>one<p>two<ul><li>three<li>four</ul>five") == "one\n\ntwo\n\nthree\n\nfour\n\nfive"
    assert text("<table><tr><td>a<td>b<tr><th>c</table>") == "a\n\nb\n\nc"
    assert text("<p>a <button>press</button>b<svg><g>x</g></svg>c<script>d()</script>e</p>") == "a bce"
    assert text("<p>1 < 2 & 3 &lt;b&gt; &amp;amp; &#65;&#x42; &copy &unknown;</p>") == "1 < 2 & 3 <b> &amp; AB © &unknown;"
    assert text("<p class='a>b' title=\"<p>\">x</p><!-- <p>y</p> --><![CDATA[z]]><?php w ?>") == "x"
    assert text("<p>a</p><p  ") == "a"
    assert text("<p>a<!-- never ends") == "a"
    assert text("<nav>only</nav>") == text("") == text(None) == text(" \n ") == ""


@pytest.mark.parametrize(
    "page",
    ["<div>" * 100_000 + "x", "<p " * 100_000, '<a href="' * 50_000, "<!--" * 100_000, "</x>" * 100_000, "<li><ul>" * 50_000]
    + ["<svg>" * 50_000 + "</q>" * 50_000, "<script>" * 50_000, "<b>" * 200_000 + "x", "<table><tr><td>" * 30_000, "&" * 200_000]
    + ["".join(f"<p class=c{i}>a" for i in range(30_000))],
)
def test_malformed_pages_take_proportional_time(page):
    began = time.time()
    page_text.main_text(page)
    assert time.time() - began < 20


def test_odd_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>x</p>"), (None, None, None), (1, "u", f"<p>{PROSE * 500}</p>")]
    pages = spark.createDataFrame(rows * 2, PAGES)
    wanted = sorted(((a, b, (t := text(page)), len(t)) for a, b, page in rows * 2), key=repr)
    found = page_text.extract(pages.selectExpr("*", "1 AS text", "2 AS paths", "3 AS n_chars", "4 AS TEXT_"))
    assert found.columns == ["page_id", "url", "text", "n_chars", "paths"]
    assert sorted((tuple(row)[:4] for row in found.collect()), key=repr) == wanted
    assert page_text.extract(spark.createDataFrame([], PAGES)).collect() == []
