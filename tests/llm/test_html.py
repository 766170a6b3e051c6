"""Main text of pages, by hand and against the pages' own articles."""

import html
import re

from clickloom.llm.common import table
from clickloom.llm.html_extraction import extract, main_text, op9_html_extraction

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="nav-open"><header><h1>Site</h1></header>
<nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice"><p>We use cookies</p></div><main><article class="post">
<header><h1>T&eacute;st &amp; more</h1></header><p>One   two<br>three</p><aside><p>side</p></aside><ul><li>a<li>b</ul><p>x &lt; y
<div class="ad"><p>buy</p></div><form><label>mail</label></form><span class="advert">now</span> tail <b>bold
<section id="comments"><article class="comment"><p>nice</p></article></section></article></main>
<div id="sidebar"><p>s</p></div><script>var t="</p>";</script><footer>f</footer></body></html>"""


def test_furniture_goes_and_the_article_stays():
    assert main_text(PAGE) == "Tést & more\nOne two three\na\nb\nx < y\ntail bold"


def test_pages_without_an_article_element():
    page = "<div><a href=x>Home</a></div><div>Some long text stands here.</div><div>more</div><div class=footer>c</div>"
    assert main_text(page) == "Some long text stands here.\nmore"
    links = "".join(f"<div><a href=/{k}>link {k}</a></div>" for k in range(30))
    assert main_text(f"{links}<div>First words.</div><div>{'long ' * 50}</div>{links}") == "First words.\n" + "long " * 49 + "long"


def test_furniture_does_not_part_pages_without_an_article_element():
    share = "<ul class=share><li>Mail<li>Post<li>Print<li>Save</ul>"
    page = f"<div class=nav><p>Home</p></div><h1>Title</h1>{share}<p>{'long ' * 100}</p><p>middle</p>{share}<p>Last words.</p><div class=footer>c</div>"
    assert main_text(page) == "Title\n" + "long " * 99 + "long\nmiddle\nLast words."


def test_linked_blocks_of_the_text_stay():
    page = "<ul><li><a href=/>Home</a></ul><h1><a href=/t>Title</a></h1><p>Some words stand here.</p><div><a href=/r>The report in full</a></div>" \
        "<p>More words stand here.</p><p><a href=/s>The source</a></p><div><a href=/n>Next</a></div>"
    assert main_text(page) == "Title\nSome words stand here.\nThe report in full\nMore words stand here.\nThe source"


def test_names_that_only_contain_a_listed_word_are_text():
    page = '<article><h2 id="sharing-your-data">Data</h2><section id="related-work"><p class="notice-period">One month</p></section>' \
        '<p data-id="share">See <a href="/page?id=comments">these <b title="a class=ad">words</b></a></p><p class="ad">buy</p>' \
        '<span class="share-button">Share</span><div class="cookie-note">We use</div><section id="related-posts"><p>More</p></section></article>'
    assert main_text(page) == "Data\nOne month\nSee these words"


def test_odd_pages(spark):
    assert [main_text(x) for x in (None, "", "plain text", "<p>x <b", "<script>never closed", "&amp &am", "<!-- open", "a < b > c")] == [
        "", "", "plain text", "x", "", "& &am", "", "a < b > c"]
    rows = [(1, "u", PAGE, "t"), (1, "u", PAGE, "t"), (None, None, None, "t"), (2, "v", "<p>" + "w " * 200_000, "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract(pages).collect()
    assert len(got) == 4 and {r.n_chars for r in got} == {len(main_text(PAGE)), 0, 399_999}
    assert extract(pages.limit(0)).collect() == []


def test_all_pages_of_the_table(spark, sf_dir):
    got = {r.page_id: r for r in op9_html_extraction(spark, sf_dir).collect()}
    pages = table(spark, sf_dir, "pages").collect()
    assert len(got) == len(pages)
    for page in pages:
        article = page.html.split("<article>")[1].split("</article>")[0]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article))
        assert got[page.page_id].text == "\n".join(b for b in blocks if b) and got[page.page_id].n_chars == len(got[page.page_id].text)


def test_letters_whose_lower_case_is_longer_move_nothing():
    for tag in ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg"):
        page = f"<article><p>{'İ' * 12}</p><{tag}>secret()</{tag.upper()}><p>end</p><{tag.upper()}>x</{tag}>tail</article>"
        assert main_text(page) == f"{'İ' * 12}\nend\ntail", tag
    assert main_text("<article><p>a</p><script>x</ſcript></script><p>b</p></article>") == "a\nb"
