"""Main text of pages with and without helpful markup."""

from time import process_time

import pytest

from plumbline.llm.html_text import blocks, extract, main_text

LONG = "Plain words make up this paragraph, which goes on for a good while so that nobody takes it for a menu entry at all. " * 2
LONG = LONG.strip()

CASES = {
    "article": (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body>"
        "<nav><ul><li><a href='/a'>A</a></li></ul></nav><!-- <p>no</p> --><div class='ad'>Buy now</div>"
        f"<article><h1>Head &amp; shoulders</h1><p><b>Bold.<br><p>{LONG}</p><p>Short.</p></article><footer>&copy; x</footer>",
        f"Head & shoulders\n\nBold.\n\n{LONG}\n\nShort.",
    ),
    "comments": (
        f"<main><article><header><h2>Title</h2></header><p>{LONG}</p><ul><li>one<li>two</ul></article>"
        f"<section id='comments'><h3>Comments</h3><article class='comment'><p>{LONG} indeed</p></article></section></main>"
        f"<aside><p>{LONG}</p></aside><form><label>Mail</label><input name=q><button>Go</button></form>",
        f"Title\n\n{LONG}\n\none\n\ntwo",
    ),
    "no hints": (
        f"<div><a href=a>Home</a> <a href=b>News</a></div><h1>Some title</h1><p>{LONG}</p><p>Short one.</p><p>{LONG}</p><div>Imprint</div>",
        f"Some title\n\n{LONG}\n\nShort one.\n\n{LONG}",
    ),
    "notices": (
        f"<div class='cookie-notice' role=dialog><p>{LONG}</p></div><div id='main-content'><p>Tiny.</p><p>{LONG}</p></div>"
        f"<div style='display: none'><p>{LONG}</p></div><div class='newsletter'>{LONG}</div>",
        f"Tiny.\n\n{LONG}",
    ),
    "white space": ("<article><p> a\n\t b&nbsp;&#32;c &lt;d&gt; </p>\n<p>\n</p><p>e<br>f</p></article>", "a b c <d>\n\ne f"),
    "broken": ("<article><p>one <a href='x>two</a><p title=\"a > b\">three < four</article", "one two\n\nthree < four"),
    "empty": ("", ""),
    "nothing": ("<nav><a href=x>x</a></nav><script>if (a < b) { '</div>' }", ""),
}


@pytest.mark.parametrize("name", CASES)
def test_main_text(name):
    page, expected = CASES[name]
    assert main_text(page)[0] == expected


WRAPPERS = [
    "<article class='post category-social'>{}</article>", "<article class='post has-post-thumbnail no-sidebar tag-ads'>{}</article>",
    "<div class='content has-sidebar'>{}</div>", "<div class='entry tag-legal'>{}</div>", "<div id=page class='with-sidebar'><article>{}</article></div>",
    "<div class='content-sidebar-wrap'>{}</div>", "<section title='a hidden gem'>{}</section>", "<article data-note='display:none' data-role=menu>{}</article>",
    "<div class='article-with-comments'>{}</div>", "<div class='section-legal'><article>{}</article></div>", "<div class='entryContent'>{}</div>",
    "<div id='post-42'>{}</div>", "<div class='left-column'><article>{}</article></div>", "<div class='page-content no-header'>{}</div>",
    "<div style='overflow: hidden ;'>{}</div>", "<article aria-hidden=false>{}</article>",
]


@pytest.mark.parametrize("wrapper", WRAPPERS)
def test_an_article_is_not_lost_by_one_word_of_its_attributes(wrapper):
    page = f"<nav><a href=a>Home</a></nav>{wrapper.format(f'<h1 title="what is hidden here">Title</h1><p>{LONG}</p>')}<footer>End</footer>"
    assert main_text(page)[0] == f"Title\n\n{LONG}"


ASIDES = [
    "class=comment", "class='post-comments'", "class='site-footer'", "id=cookie-notice", "class='widget box'", "class='main-nav'", "class='share-buttons'",
    "hidden", "style='color: red; display:none'", "style='visibility:hidden'", "aria-hidden='true'", "role=dialog", "class='Sidebar'", "class='nav_menu'",
    "class='ad-slot'", "id='advert-1'", "class='user-comment'", "class='comment-42'", "id='reader-comments'", "class='siteFooter'",
    "class='left-sidebar'", "class='comment-body'", "class='related-posts'", "class='footer-content'", "id='cookieConsent'",
]


@pytest.mark.parametrize("attribute", ASIDES)
def test_what_stands_aside_is_still_left_out(attribute):
    assert main_text(f"<article><p>{LONG}</p><div {attribute}><p>{LONG} aside</p></div></article>")[0] == LONG


def test_a_page_of_short_paragraphs_keeps_them():
    page = "<div><a href=a>Home</a></div><div><p>Short one.</p><p>Another short one here.</p></div><footer>End</footer>"
    assert main_text(page)[0] == "Short one.\n\nAnother short one here."
    assert main_text("<ul><li><a href=a>one</a><li><a href=b>two</a></ul>")[0] == ""


@pytest.mark.parametrize("page", ["<b>" * 100_000 + "</i>" * 100_000, "<div>" * 100_000 + "</p>" * 100_000, "<li><b>" * 50_000 + "</p></u>" * 50_000])
def test_unmatched_tags_take_linear_time(page):
    began = process_time()
    assert main_text(page + f"<p>{LONG}</p>")[0] == LONG
    assert process_time() - began < 3


def test_blocks_know_links_and_containers():
    found = blocks("<nav><a href=x>a b</a> c</nav><p>d <a>e</a></p><h2>f</h2>")
    assert [(b[0], b[1], round(b[2], 2), b[3], b[5]) for b in found] == [("a b c", 3, 0.67, 1, 0), ("d e", 2, 0.5, 0, 0), ("f", 1, 0.0, 0, 1)]


def test_rows(spark):
    rows = [(1, "u", CASES["article"][0], 5), (1, "u", CASES["article"][0], 5), (None, None, None, None), (2, "v", "<p>" + "very long words " * 50000, 1)]
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string, n_chars long")).collect()
    assert len(got) == 4
    texts = {r["page_id"]: r for r in got}
    assert texts[1]["text"] == CASES["article"][1] and texts[1]["n_chars"] == len(CASES["article"][1])
    assert texts[None]["text"] == "" and texts[None]["n_chars"] == 0
    assert texts[2]["n_chars"] == 16 * 50000 - 1
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
