import html
import random
import re

import numpy as np
import pytest

from punctum.llm import content, queries
from punctum.llm.common import table
from tests.llm.conftest import SF

NONE = content.Weights({}, {})
SCHEMA = "page_id long, url string, html string"


def marked(page):
    """The blocks of the one article element of a page of the test tables, by its few tags."""
    inside = page[page.index("<article>") + 9 : page.index("</article>")]
    blocks = re.split("</?(?:p|h1)>", inside.replace("<br>", " ").replace("<b>", ""))
    return "\n".join(filter(None, (" ".join(html.unescape(b).split()) for b in blocks)))


def main(page):
    return content.Page(page).text(NONE)[0]


@pytest.mark.parametrize("sf", [SF, SF.replace("0.001", "0.01")])
def test_query_equals_the_marked_articles(spark, sf):
    pages = {r.page_id: r for r in table(spark, sf, "pages").collect()}
    got = queries.op12_html_extraction(spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == marked(pages[r.page_id].html) and r.url == pages[r.page_id].url and r.n_chars == len(r.text)
        region = pages[r.page_id].html[r.region_start : r.region_end]
        assert region.split()[0].startswith(html.escape(r.text.split()[0], quote=False)[:3])


def test_without_any_labelled_page(spark):
    pages = table(spark, SF, "pages").selectExpr("page_id", "url", "replace(replace(html, '<article>', '<div id=c>'), '</article>', '</div>') AS html")
    want = {r.page_id: marked(r.html) for r in table(spark, SF, "pages").collect()}
    assert {r.page_id: r.text for r in content.extracted(pages).collect()} == want


PARTS = [
    "<nav><a href='/'>Home</a> <a href='/b'>Second page</a></nav>", "<header class='site-header'><h2>The site</h2><p>Its motto in words</p></header>",
    "<div id=sidebar><h3>Popular</h3><p>One two three four five</p></div>", "<aside>Read this instead of that</aside>", "<div class='cookie-notice'><p>We use cookies here.</p><button>Yes</button></div>",
    "<div class=\"ad-box\">Buy now, pay later, all of it</div>", "<form action=/s><label>Find</label><input name=q><textarea>words words</textarea></form>", "<script>var a = '<p>no words</p>';</script>",
    "<style>p > a { color: red }</style>", "<!-- <p>not shown to anybody</p> -->", "<section id='comments'><h3>Two comments</h3><div class=comment><p>I think so too, really.</p></div></section>",
    "<div role='navigation'>Here and there</div>", "<div role=alert>Something happened to the page</div>", "<ul class='breadcrumbs'><li>Up<li>Down</ul>", "<noscript>Turn it on</noscript>", "<footer>&copy; all of us</footer>"]


@pytest.mark.parametrize("seed", range(12))
@pytest.mark.parametrize("shell", ["article", "main", "div class='post-body'", "section"])
def test_parts_around_and_inside(seed, shell):
    draw = random.Random(seed)
    parts = lambda: "\n".join(draw.sample(PARTS, draw.randint(1, 6)))
    words = lambda: ' '.join(draw.choice(['sun', 'moon', '&amp;', 'sky', '&#233;t&eacute;', 'a<b>bold</b>er', 'rain\n\twind']) for _ in range(draw.randint(1, 9)))
    blocks = [words() for _ in range(draw.randint(1, 5))]
    middle = [f"<p>{b}" + draw.choice(["</p>", "", f"</p>{draw.choice(PARTS[:1] + PARTS[2:])}"]) for b in blocks]
    page = f"<!DOCTYPE html><html><head><title>Not this</title></head><body>{parts()}<{shell}><h1>Title</h1>{''.join(middle)}</{shell.split()[0]}>{parts()}</body></html>"
    plain = [" ".join(html.unescape(re.sub("</?b>", "", b)).split()) for b in blocks]
    assert main(page) == "\n".join(["Title", *plain])


def test_blocks_and_characters():
    assert main("<p>a\n\n b&nbsp;c<br>d</p>x<div>e<i>f</i>g</div><ul><li>h<li>i</ul><table><tr><td>j<td>k</table>") == "a b c d\nx\nefg\nh\ni\nj\nk"
    assert main("1 &lt; 2 &amp;&amp; 3 > 2 < 4 &notanentity; &#x1F600;") == "1 < 2 && 3 > 2 < 4 ¬anentity; \U0001f600"
    assert main("<p title='a > b' data-x=\"<p>\">one</p><![CDATA[two <p> &amp;]]>") == "one\ntwo <p> &amp;"
    assert main("<P>one<p CLASS=AD>two<p>three") == "one\nthree"
    assert main("<article><header><h1>Title</h1></header><p>text</p><footer>no</footer></article>") == "Title\ntext"
    assert main("<h1><a href=x>A linked title</a></h1><p>and <a href=y>a linked word</a></p>") == "A linked title\nand a linked word"
    assert main("<div class='has-sidebar no-comments'><p>kept</p></div>") == "kept"


def test_odd_pages(spark):
    long = "<p>" + "word " * 400_000
    deep = "<div>" * 50_000 + "deep" + "<b>" * 50_000
    broken = "<a \"" * 3_000 + "<p>x" + "<" * 20_000 + "</" * 20_000 + "<p '" * 3_000
    pages = [(1, "u", None), (2, "u", ""), (3, None, "<nav>only a menu</nav>"), (None, None, "<p>x"), (4, "u", long), (4, "u", long), (5, "u", deep), (6, "u", broken), (7, "u", "<p"), (8, "u", " \n ")]
    frame = spark.createDataFrame(pages, SCHEMA)
    got = sorted(((r.page_id or 0, r.url, r.text, r.n_chars) for r in content.extracted(frame).collect()), key=repr)
    assert [r[2] for r in got if r[0] in (1, 2, 3, 8)] == [""] * 4
    assert got[0] == (0, None, "x", 1)
    assert [r[3] for r in got if r[0] == 4] == [400_000 * 5 - 1] * 2
    assert [r[2] for r in got if r[0] == 5] == ["deep"]
    clashing = frame.selectExpr("*", "'t' AS text", "1 AS score", "2 AS draw", "3 AS kind", "4 AS n_chars")
    assert sorted(((r.page_id or 0, r.url, r.text, r.n_chars) for r in content.extracted(clashing).collect()), key=repr) == got
    assert content.extracted(frame.limit(0)).collect() == []


def test_best_run_against_all_runs():
    draw = np.random.default_rng(5)
    for _ in range(300):
        scores = draw.integers(-3, 3, draw.integers(0, 12)).astype(float)
        runs = [(scores[a:b].sum(), -b, -a, (a, b)) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)]
        start, end = content.best_run(scores)
        most = max((r[0] for r in runs), default=0)
        assert (start, end) == (0, 0) if most <= 0 else scores[start:end].sum() == most and end == min(-r[1] for r in runs if r[0] == most)
