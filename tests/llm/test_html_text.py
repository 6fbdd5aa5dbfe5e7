import re
from html import unescape

import pytest

from clickfeat.llm.html_text import main_lines, main_text

PAGES = [
    ("<nav><a>Home</a></nav><article><h1>Title</h1><p>One &amp; <b>two</b>three<p>four</article><footer>x</footer>",
     "Title One & twothree four"),
    ("<div class='ad'>buy</div><p>only text</p><div id=sidebar>more</div>", "only text"),
    ("<body class='has-sidebar'><div class='post with-ads'><p>kept</p></div></body>", "kept"),
    ("<header>site</header><article><header><h1>Head</h1></header><p>body</p><footer>tags</footer></article>", "Head body"),
    ("<article>main<aside>side</aside><div class='ad-slot'>ad</div> rest</article>", "main rest"),
    ("<article><p>text</p></article><section class=comments><article>reply</article></section>", "text"),
    ("<article class='post'><p>text</p></article><article class='comment'>reply</article>", "text"),
    ("<div class='cookie-notice'>We use</div><form><p>name</p><input></form><p>a<br>b</p>", "a b"),
    ("<script>var a='<p>no</p>';</script><style>p{}</style><!-- no --><p>yes</p><script>open", "yes"),
    ("<p>a&nbsp;&lt;b&gt; &#x41;&copy;</p>\n\n<p>  c \t\n d </p>", "a <b> A© c d"),
    ("<ul><li>one</li><li>two</li></ul><table><tr><td>3</td><td>4</td></tr></table>", "one two 3 4"),
    ("<div hidden>no</div><div style='display:none'>no</div><p>yes", "yes"),
    ("plain text only", "plain text only"), ("<nav>only menu</nav>", ""), ("", ""), (None, ""),
    ("<p title='a > b'>quoted</p><p class=it's>odd</p>", "quoted odd"),
    ("<article>" + "<p>word</p>" * 3000 + "</article>", " ".join(["word"] * 3000)),
]


BODY = "The whole article stands here, in a sentence of some length."
LOOSE = [
    (f"<article style='overflow:hidden'><p>{BODY}</article>", BODY),
    (f"<div class='overflow-hidden'><p aria-hidden=false data-id='nav'>{BODY}</p></div>", BODY),
    (f"<p aria-hidden=\"true\">no</p><p HIDDEN=''>no</p><p style='color:red;display : none'>no</p><p>{BODY}", BODY),
    (f"<html><head><title>t</title><meta charset=utf-8><body><p>{BODY}</p></body></html>", BODY),
    (f"<head><link rel=x><style>p{{}}</style><p>{BODY}</p>", BODY), (f"<head><title>t</title>{BODY}", BODY),
    (f"<svg-icon name=a></svg-icon><p>{BODY}</p>", BODY),
    (f"<svg/><math a='1' /><p>{BODY}</p><svg><text>no</text></svg>", BODY),
    (f"<article><p>See also</p></article><div><p>{BODY}</p></div>", f"See also {BODY}"),
]


@pytest.mark.parametrize("html, text", LOOSE)
def test_loose_markup_empties_no_article(html, text):
    assert " ".join(main_lines(html)) == text


PARAGRAPHS = [f"Paragraph {i} of the article says what there is to say about it, at some length." for i in range(8)]
MENU = "".join(f"<div class=x><a href='/{i}'>Item {i}</a></div>" for i in range(12))
WORDS = "".join(f"<div>Word {i}</div>" for i in range(12))


def test_window_sums_decide_without_a_marked_article():
    body = "<h2><a href=/t>Title</a></h2>" + "".join(f"<p>{p} <a href=/x>more</a></p>" for p in PARAGRAPHS)
    text = ["Title", *[f"{p} more" for p in PARAGRAPHS]]
    assert main_lines(f"<div>{MENU}</div><div>{body}</div><div>{MENU}</div>") == text
    # Short lines without links go too, but for those that share a window with the article.
    got = main_lines(f"<div>{WORDS}</div><div>{body}</div><div>{WORDS}</div>")
    assert got[1:-2] == text and len(got) == len(text) + 3
    by = "<h1>A</h1><p>by B</p><p>today</p>" + "".join(f"<p>{p}" for p in PARAGRAPHS)
    assert main_lines(f"{MENU}{by}") == ["A", "by B", "today", *PARAGRAPHS]
    # A link that is never closed, a page of links only and one long paragraph among short ones lose nothing.
    assert main_lines("<p><a href=/x>open" + "".join(f"<p>{p}" for p in PARAGRAPHS))[-8:] == PARAGRAPHS
    assert len(main_lines(MENU)) == 12
    short = [f"A rather short paragraph, number {i}, of the text." for i in range(6)]
    page = [*short, "long " * 2000 + "end.", *short]
    assert main_lines("".join(f"<p>{p}</p>" for p in page)) == page


@pytest.mark.parametrize("html, text", PAGES)
def test_pages(html, text):
    assert " ".join(main_lines(html)) == text


def test_pages_as_a_table(spark):
    rows = [(i, html, "u", 5) for i, (html, _) in enumerate(PAGES)] * 2
    pages = spark.createDataFrame(rows, "page_id bigint, html string, url string, _id bigint")
    got = main_text(pages)
    assert got.columns == [*pages.columns, "text"]
    assert all(r["text"] == PAGES[r["page_id"]][1] for r in got.collect())
    assert main_text(pages.limit(0)).collect() == []


def test_given_pages(small):
    for r in main_text(small("pages")).collect():
        inner = re.search("<article>(.*?)</article>", r["html"], re.S)[1]
        inner = re.sub("</?b>", "", inner)
        assert r["text"] == " ".join(unescape(re.sub("<[^>]*>", " ", inner)).split())
