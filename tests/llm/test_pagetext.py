import re
import time
from html import unescape

import pytest

from stratalake.llm.pagetext import main_text, page_texts
from stratalake.llm.queries import op11_page_text

PAGES = "page_id long, url string, html string"


def plain(html):
    """The given pages' layout read without a tree: what stands in the article, cut at its blocks."""
    inside = re.split("</article>", html.split("<article>", 1)[1])[0]
    blocks = (re.sub("<[^>]*>", "", b.replace("<br>", " ")) for b in re.split("</?(?:p|h1)>", inside))
    return "\n".join(t for t in (" ".join(unescape(b).split()) for b in blocks) if t)


def test_query_against_plain_version(spark):
    path = "/root/testdata/sf0.01"
    want = {r.page_id: (r.url, plain(r.html)) for r in spark.read.parquet(f"{path}/pages.parquet").collect()}
    got = op11_page_text(spark, path).collect()
    assert {r.page_id: (r.url, r.text) for r in got} == want and len(got) == len(want)
    assert all(r.n_chars == len(r.text) for r in got)


LONG = "A sentence of the article, long enough to count as one. " * 8
SECOND = "Another paragraph that says a little more about the same. " * 6
WANT = "\n".join(("Title & more", LONG.strip(), SECOND.strip(), "Short."))
BODY = f"<h1>Title &amp; more</h1><p>{LONG}</p><p>{SECOND}<p>Short."
LINKS = "".join(f'<li><a href="/{i}">Link {i}</a></li>' for i in range(12))


@pytest.mark.parametrize(
    "html",
    [
        f"<body><nav><ul>{LINKS}</ul></nav><article>{BODY}</article><footer>&copy; x</footer></body>",
        f"<header><h1>Site</h1></header><main><article><header>{BODY}</article></main>",
        f'<div id="page"><div class="site-header">Site</div><div class="content has-sidebar">{BODY}</div>'
        f'<div class="sidebar"><p>{SECOND}</p></div></div>',
        f'<article>{BODY}</p><section id="comments"><article class="comment"><p>{LONG}{LONG}</p></article></section></article>',
        f"<body><form><article>{BODY}</article></form></body>",
        f'<div class="cookie-notice"><p>{LONG}</p></div><div role="main">{BODY}</div><div role="contentinfo">x</div>',
        f"<main>{BODY}<script>if (a < b) document.write('<p>no</p>')</script><style>p{{}}</style><!-- <p>no --></main>",
        f'<ARTICLE>{BODY}<div class="ad">Buy</div><aside>See also</aside><ul>{LINKS}</ul></ARTICLE>',
        f"<table><tr><td><div class=menu>{LINKS}</div><td><div>{BODY}</div></table>",
        f"<article>{BODY}<p hidden>no</p><p style='display: none'>no</p><textarea>no</textarea><noscript>no</noscript></article>",
    ],
)
def test_layouts(html):
    assert main_text(html) == WANT


def test_article_without_names_by_density():
    sections = "".join(f"<div class=s><h2>Part {i}</h2><p>{LONG}</p><p>{SECOND}</p></div>" for i in range(3))
    html = f"<body><div>{'<a href=x>go</a> ' * 20}</div><div><h1>Head</h1>{sections}</div><div>x</div></body>"
    want = ["Head"] + [t for i in range(3) for t in (f"Part {i}", LONG.strip(), SECOND.strip())]
    assert main_text(html).split("\n") == want


def test_broken_markup():
    assert main_text("<p title=it's>one<p title='a > b'>two") == "one\ntwo"
    assert main_text('<div class="sidebar"><ul><li>x</div><h1>T</h1><p>y') == "T\ny"
    assert main_text("<article><p><b>bold<br><p>a\xa0 b\n\tc</article>") == "bold\na b c"
    assert main_text("1 < 2 &lt;b&gt; &amp;amp; &#x41;&eacute;") == "1 < 2 <b> &amp; Aé"
    assert main_text("<article><p>x <button>share</button> y</p></article>") == "x y"
    assert main_text("text <a") == "text" and main_text("text <!-- cut") == "text"


@pytest.mark.parametrize("unit", ["<div>", "<b><div><i>", "</p>", "<ul><li>", '<a "', "<td><p>", "&amp", "<h1><div></h2>"])
def test_time_grows_with_length(unit):
    def seconds(n):
        start = time.perf_counter()
        main_text(unit * n)
        return time.perf_counter() - start

    assert seconds(120_000) < 8 * seconds(30_000) + 0.5


def test_odd_rows(spark, clash):
    rows = [(1, "u", None), (1, "u", None), (None, None, ""), (2, "v", "<nav>x</nav>"), (3, None, "<p>" + "word " * 300_000)]
    out = page_texts(clash(spark.createDataFrame(rows, PAGES)))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted((r.page_id or 0, r.url, r.n_chars) for r in out.collect())
    assert got == [(0, None, 0), (1, "u", 0), (1, "u", 0), (2, "v", 0), (3, None, 5 * 300_000 - 1)]
    assert page_texts(spark.createDataFrame([], PAGES)).count() == 0
