"""Main text against a plain reading of the given pages, and against pages of other make."""

import html
import re

import pytest

from corpusmill.llm import main_text, queries

LONG = (
    "This is the first paragraph of the story, and it has a number of words that are in the usual "
    "order, so that it is clear to all who read it what the page is for."
)
MORE = "<p>" + " ".join([LONG] * 2) + "</p>"


def plain(page):
    """The article of the given pages, whose furniture is all outside of it."""
    article = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    blocks = (re.sub(r"<[^>]*>", "", b.replace("<br>", " ")) for b in re.split(r"</?(?:p|h1)>", article))
    return "\n".join(t for t in (" ".join(html.unescape(b).split()) for b in blocks) if t)


def test_given_pages(spark):
    folder = "/root/testdata/sf0.001"
    got = {r.page_id: r for r in queries.queries()["op11_main_text"](spark, folder).collect()}
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    assert len(got) == len(pages)
    for page in pages:
        want = plain(page.html)
        assert (got[page.page_id].text, got[page.page_id].url) == (want, page.url)
        assert got[page.page_id].n_chars == len(want)


@pytest.mark.parametrize(
    "page, want",
    [
        ("", ""),
        ("   \n ", ""),
        ("<html><body><nav><a href=x>Home</a></nav></body></html>", ""),
        # No container: stop words decide, short blocks follow their neighbours.
        (
            f"<body><div><a href=a>One</a> <a href=b>Two</a></div><h1>Title</h1><p>{LONG}</p><p>Short one.</p>"
            f"<p>{LONG}</p><div>Contact</div><div><a href=c>Imprint of the house</a></div>",
            f"Title\n{LONG}\nShort one.\n{LONG}",
        ),
        # Furniture by class, id, role, style and element, inside and outside the article.
        (
            f'<body class="has-sidebar"><div id="cookie-notice"><p>{LONG}</p></div><header><p>{LONG}</p></header>'
            f'<main><article class="post"><header><h1>Big  title</h1></header><p>{LONG}</p>'
            f'<div class="ad-slot">{LONG}</div><form><p>{LONG}</p><input name=q><select><option>{LONG}</select></form>'
            f'<p>Next.</p><section id="comments"><article class="comment"><p>{LONG}</p></article></section></article></main>'
            f'<aside>{LONG}</aside><div class="sidebar">{LONG}</div><div style="display: none">{LONG}</div>'
            f'<div role="complementary">{LONG}</div><footer><p>{LONG}</p></footer></body>',
            f"Big title\n{LONG}\nNext.",
        ),
        # Marked-up text inside scripts, styles, comments; attributes that hold tags.
        (
            f'<script>var a = "<p>{LONG}</p>";</script><style>p > a {{}}</style><!-- <p>{LONG}</p> -->'
            f'<article><p title="a > b">{LONG}</p><script>"</article>"</script><noscript>no</noscript><p>End</article>',
            f"{LONG}\nEnd",
        ),
        # Character references, white space, breaks, inline tags, unclosed elements.
        (
            f"<article><h2>A &amp;amp; B&nbsp;&#67;&copy</h2><p>{LONG}<p>x<b>y</b>\n\t z<br>w<ul><li>one<li>two</ul>",
            f"A &amp; B C©\n{LONG}\nxy z w\none\ntwo",
        ),
        # Lists of links inside the article are no text, a link in a sentence is.
        (
            f'<article><p>{LONG} <a href="x">More</a> of it.</p><ul><li><a href=a>This and that</a></li></ul></article>',
            f"{LONG} More of it.",
        ),
        # A menu that is never closed, a form around the whole page, an end tag without a start.
        (f"<nav><ul><li><a href=x>One</a></ul><article></section><p>{LONG}</p></article>", LONG),
        (f"<form id=f><div><main>{MORE}</main></div></form>", f"{LONG} {LONG}"),
        # Text that is cut off, a lone less-than sign.
        (f"<article><p>{LONG} 1 < 2</p><p>cut <", f"{LONG} 1 < 2\ncut <"),
        (f"<article><p>{LONG}</p><p>cut <b hre", f"{LONG}\ncut"),
        # Furniture inside a line does not part it.
        (f'<article><p>{LONG} <span class="ad">Buy</span>Here.</p>', f"{LONG} Here."),
        # An article of short lines only.
        ("<nav><a href=x>x</a></nav><article><h1>T</h1><p>One.</p></article><footer>Imprint</footer>", "T\nOne."),
    ],
)
def test_pages_of_other_make(page, want):
    assert main_text.main_text(page) == want


def test_odd_tables(spark):
    page = f"<article><p>{LONG}</p></article>"
    rows = [(1, page, "a", 5), (1, page, "a", 5), (None, None, None, None), (2, "", "b", 1)]
    table = spark.createDataFrame(rows, "page_id bigint, html string, TEXT string, n_chars int")
    got = sorted(map(tuple, main_text.extract(table).collect()), key=str)
    assert got == sorted([(1, LONG, len(LONG)), (1, LONG, len(LONG)), (None, "", 0), (2, "", 0)], key=str)
    assert main_text.extract(table).columns == ["page_id", "text", "n_chars"]
    assert main_text.extract(table.limit(0)).collect() == []
    long = spark.createDataFrame([("<article>" + MORE * 20_000,)], "html string")
    assert main_text.extract(long).first().n_chars == 20_000 * (2 * len(LONG) + 2) - 1
    beyond = spark.createDataFrame([("<article><p>\U0001f600&#x1F600;</p>",)], "html string")
    assert main_text.extract(beyond).first().n_chars == 2
