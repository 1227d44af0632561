import time

import pytest

from yearloom.llm import catalog
from yearloom.llm.html_text import extract, main_text

GOOD = "This is the text of an article, and it has all of the words that a text has in it."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("plain text", "plain text"),
        ("<p>open", "open"),
        ("<!-- <p>no</p> --><p>a&amp;b &eacute;&#233;&nbsp;c</p>", "a&b éé c"),
        ("<script>var t='</p>';</script><style>p{}</style><p>x</p>", "x"),
        ("<script>never closed <p>x</p>", ""),
        ("<div>a<br>b  \n c</div><div>d</div>", "a b c\n\nd"),
        (f"<nav><a href=x>home</a></nav><p>{GOOD}</p><footer>foot</footer>", GOOD),
        (f"<div class='side-bar sidebar'><p>{GOOD}</p></div><p>{GOOD}</p>", GOOD),
        (f"<article><header><h1>Title</h1></header><p>{GOOD}</p></article>", f"Title\n\n{GOOD}"),
        (f"<header><h1>Site</h1></header><p>{GOOD}</p>", GOOD),
        (f"<article><p>{GOOD}<p>Short.</article><div id='comments'><p>{GOOD}</p></div>", f"{GOOD}\n\nShort."),
        (f"<p>{GOOD}</p><p><a href=1>{GOOD}</a></p>", GOOD),
        (f"<form><p>{GOOD}</p></form><p hidden>{GOOD}</p><p>{GOOD}</p>", GOOD),
        (f"<div class=ad>Buy it.</div><article><h1>T</h1><p>{GOOD}</p></article>", f"T\n\n{GOOD}"),
        (f"<p>{GOOD}</p><p>Near it.</p><footer>x</footer><div>far away</div>", f"{GOOD}\n\nNear it."),
        ("<p>a < b and 2 <3 c</p>", "a < b and 2 <3 c"),
    ],
)
def test_pages(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<script src=/js/>var leaked = 1;</script><p>{GOOD}</p>", GOOD),
        (f"<style media=all/>p{{}}</style><svg/><p>{GOOD}</p>", GOOD),
        (f"<script>a</scripts>b</script ><p>{GOOD}</p>", GOOD),
        (f"<body><form action=/><nav>{GOOD}</nav><div><p>{GOOD}</p></div></form></body>", GOOD),
        (f"<form><div><p>{GOOD}</p></div><div id=comments><p>A {GOOD}</p><p>B {GOOD}</p></div></form>", GOOD),
        (f"<div class='market-share'><p>{GOOD}</p></div>", GOOD),
        (f"<div class='social-policy' id=ad-free-reading><p>{GOOD}</p></div><div class=left-sidebar>{GOOD}</div>", GOOD),
        (f"<div class='content widget'><p>{GOOD}</p></div><div class=widget-2>Short.</div>", GOOD),
        (f"<div class=comments><div class=widget><p>{GOOD}</p></div></div>", GOOD),
        (f"<article><p>A short one.</p></article><div class=ad><p>{GOOD}</p></div>", "A short one."),
        (f"<article><p>{GOOD}</p><p>Photo © a friend.</p></article><p>© all rights</p>", f"{GOOD}\n\nPhoto © a friend."),
        (f"<p>{GOOD}</p><div class='post-comments'><p>A {GOOD}</p><p>B {GOOD}</p></div><form><p>{GOOD}</p></form>", GOOD),
        (f"<nav><p>{GOOD}</p></nav><footer><p>{GOOD}</p></footer>", ""),
        ("<p>don't <b x=\"1>one</b> it's</p>", "don't one it's"),
        ("<p>a <b c='>' d=\">\">e</b> f", "a e f"),
        ("<p>a <b c d", "a <b c d"),
        ("a <b <i>c</i>", "a <b c"),
    ],
)
def test_hard_pages(page, text):
    assert main_text(page) == text


def _seconds(page):
    start = time.perf_counter()
    main_text(page)
    return time.perf_counter() - start


@pytest.mark.parametrize(
    "part",
    ["<a ", "<a b=\"c ", "<a \"<b", "<!-", "<div></p>", "<div>", "</p>", "<p class=x>a", "<form>a", "<li>a<ul>", "<b '", "<a b='\">", "<x =\"<y ='"],
)
def test_time_grows_with_the_length(part):
    """Up to a megabyte of broken markup, or four where the page is one unclosed tag."""
    top = 2**22 if part in ("<a ", "<a b=\"c ") else 2**20
    short, long = part * (top // 4 // len(part)), part * (top // len(part))
    assert _seconds(long) < 8 * _seconds(short) + 1


def test_many_open_and_stray_elements():
    pages = ["<div>" * n + "</p>" * n + GOOD for n in (2**16, 2**18)]
    assert _seconds(pages[1]) < 8 * _seconds(pages[0]) + 1
    assert main_text(pages[0]) == GOOD


def test_deep_and_long_pages():
    assert main_text("<div>" * 5000 + GOOD + "</div>" * 5000) == GOOD
    assert main_text(f"<article>{'<p>' + GOOD + '</p>'}</article>" * 300).count("\n\n") == 299


def test_messy_rows(spark):
    rows = [(1, None, "u", "old"), (1, None, "u", "old"), (None, "", "u", "old"), (2, f"<p>{GOOD}", None, "old")]
    pages = spark.createDataFrame(rows, "page_id bigint, html string, url string, text string")
    result = extract(pages)
    assert sorted(r["text"] for r in result.collect()) == ["", "", "", GOOD]
    assert extract(pages.limit(0)).count() == 0
    assert result.columns == pages.columns
    clash = pages.selectExpr("*", "1 AS block", "'x' AS label", "2 AS section", "3 AS page", "4 AS n_chars")
    found = extract(clash)
    assert found.columns == clash.columns
    assert all((r["block"], r["label"], r["section"], r["page"]) == (1, "x", 2, 3) for r in found.collect())


def test_query_gives_the_articles(spark, folder):
    import re

    pages = dict(spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "html").collect())
    rows = catalog.op6_html_text(spark, folder).collect()
    assert len(rows) == len(pages)
    for row in rows:
        article = re.search(r"<article>(.*?)(?:</article>|<footer>)", pages[row["page_id"]], re.S)[1]
        assert row["n_chars"] == len(row["text"])
        # The words of the article, without markup, are the words of the text.
        bare = re.sub(r"<[^>]*>", " ", article)
        assert re.findall(r"[a-zA-Z]{3,}", row["text"]) == re.findall(r"[a-zA-Z]{3,}", re.sub(r"&(amp|quot|lt|gt|am);?", " ", bare))


@pytest.mark.parametrize(
    "wrapper",
    [
        "body class='single no-sidebar'", "body class='with_sidebar menu-open'", "main id=sidebar", "article class='post comments'",
        "div class='content has-sidebar'", "div class='post comments-open'", "div class='layout-no-sidebar'", "div data-id='social'",
        "div data-role=menu", "div title='id=\"sidebar\"'", "div class='a' data-hidden=1", "div aria-hidden='false' class=x",
    ],
)
def test_wrappers_keep_their_text(wrapper):
    assert main_text(f"<{wrapper}><p>{GOOD}</p></{wrapper.split()[0]}>") == GOOD


@pytest.mark.parametrize(
    "part",
    [
        "div class='x' hidden", "div hidden id=x", "div class='has-image sidebar'", "div CLASS = 'widget-with-image'",
        "div id=comments data-id=x", "div aria-hidden='true' class='x'", "section role='complementary'", "div class='menu menu-open'",
    ],
)
def test_parts_of_the_page_go(part):
    assert main_text(f"<{part}><p>{GOOD}</p></{part.split()[0]}><p>Own. {GOOD}</p>") == f"Own. {GOOD}"
