import random
import time

import numpy as np
import pytest

from quayside.llm.html_extract import WINDOW, extract, main_text, regions

ARTICLE = "<h1>A  title</h1><p>First&nbsp;text &amp; more &lt;p&gt;.<p><b>Second</b> <a href=x>linked</a>\ntext.</p><ul><li>one<li>two</ul>"
WANT = "A title\nFirst text & more <p>.\nSecond linked text.\none\ntwo"


@pytest.mark.parametrize(
    "before,after",
    [
        ("", ""),
        ("<nav><ul><li><a href=/>Home</a><li>Menu</ul></nav>", "<footer>&copy; site</footer>"),
        ('<header><h1>Site</h1></header><div class="ad">Buy <p>now</p></div>', '<aside class=x>Side<p>bar</p></aside>'),
        ("<script>var t='</p><article>x</article>';</script><style>p{}</style><!-- <p>no</p> -->", "<!-- open"),
        ('<div id="cookie-notice">We use cookies</div>', '<section class="comments"><article>Nice</article></section>'),
        ("<form><p>Name <input> <button>Go</button></form>", '<div class="related sidebar"><p>More</p></div>'),
    ],
)
@pytest.mark.parametrize("tag", ["article", "main"])
def test_article_alone_is_left(before, after, tag):
    page = f"<!DOCTYPE html><html><head><title>T</title></head><body>{before}<{tag}>{ARTICLE}</{tag}>{after}</body></html>"
    assert main_text(page) == WANT


def test_things_inside_the_article_go():
    page = f'<article>{ARTICLE}<div class="ad-slot"><p>Buy</p></div><p>Last.</p><form>x</form><div class=comments><p>I agree</p></div></article>'
    assert main_text(page) == WANT + "\nLast."


def test_pages_without_an_article_keep_the_bulk():
    text = "<p>" + "</p><p>".join("words of the main text, many of them, one after the other" for _ in range(6)) + "</p>"
    links = "".join(f"<li><a href=/{i}>Link number {i}</a>" for i in range(9))
    page = f"<body><ul>{links}</ul><div><div>{text}</div></div><ul>{links}</ul></body>"
    assert main_text(page).split("\n") == ["words of the main text, many of them, one after the other"] * 6


def test_edges(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p"), (4, "u", "plain & simple"), (1, "u", None), (None, "u", "<br>" * 5)]
    rows.append((6, "u", "<article>" + "<p>x &eacute;</p>" * 20_000 + "</article>"))
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, n_chars string")
    got = extract(pages).collect()
    assert sorted((str(r.page_id), r.n_chars) for r in got)[:2] == [("1", 0), ("1", 0)]
    by_id = {r.page_id: r for r in got}
    assert by_id[4].text == "plain & simple" and by_id[2].text == "" and by_id[None].text == ""
    assert by_id[6].text.count("x é") == 20_000 and by_id[6].n_chars == len(by_id[6].text)
    assert extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize(
    "page",
    [
        f"<body><div class='layout has-sidebar'><article>{ARTICLE}</article></div></body>",
        f"<body><div class='site no-comments'><main>{ARTICLE}</main></div></body>",
        f"<body><article class='post comments-open'>{ARTICLE}</article></body>",
        f"<body><div class='sidebar'><article>{ARTICLE}</article><div class='ad'>Buy</div></div></body>",
        f"<body><article><div id='widget'>{ARTICLE}</div><div class='comments'>Nice</div></article></body>",
        f"<body><div class='ad_box_1'>Buy</div><div id='page' class='with-header'>{ARTICLE}</div><div class='site-footer'>x</div></body>",
    ],
)
def test_names_do_not_empty_a_page(page):
    assert main_text(page) == WANT


def test_names_within_an_article_keep_its_sections():
    parts = ("<section id='related-work'><h2 id='related'>Related work</h2><p class='notice'>Others</p></section>"
             "<h2 id='search-methods'>Search</h2><p class='notice-period'>A month</p><div class='related'>More</div>")  # fmt: skip
    assert main_text(f"<article>{ARTICLE}{parts}</article>") == WANT + "\nRelated work\nOthers\nSearch\nA month"


LONG = "words of the main text, many of them, one after the other"


def test_short_regions_between_links_stay():
    links = "".join(f"<li><a href=/{i}>Link number {i}</a>" for i in range(5))
    page = f"<body><div>{f'<p>{LONG}</p>' * 6}</div><ul>{links}</ul><div><p>A short end.</p></div><ul>{links}</ul></body>"
    assert main_text(page).split("\n") == [LONG] * 6 + ["A short end."]


def test_a_teaser_does_not_stand_for_the_page():
    page = f"<body><div>{f'<p>{LONG}</p>' * 6}</div><article><p>Read on</p></article></body>"
    assert main_text(page).split("\n") == [LONG] * 6 + ["Read on"]


BAD = {
    "a": "<a ", "script": "<script ", "declaration": "<!", "div": "<div>", "less": "text 5 <b and ", "quote": "<a \"", "quotes": "<a '\"<b \"",
    "value": "<a x='", "named": "<div class=ad>x", "close": "<p></x>", "body": "<body>", "names": "<p " + "a = " * 10 + ">",
}


@pytest.mark.parametrize("kind", BAD)
def test_a_megabyte_of_odd_markup_ends_soon(kind):
    page = BAD[kind] * (1_000_000 // len(BAD[kind]))
    started = time.process_time()
    main_text(page)
    main_text(page + "\"'>")
    assert time.process_time() - started < 20


def test_a_tag_that_never_ends_is_text():
    assert main_text("<p>if a <b and c it goes on to the end of the line") == "if a <b and c it goes on to the end of the line"
    assert main_text('<p title="a > b">text of the paragraph</p>') == "text of the paragraph"
    assert main_text("<p title='it\"s'>one</p><p data-x=\"'\">two</p>") == "one\ntwo"


LONG = "Some article text here that is long enough to be kept."


@pytest.mark.parametrize(
    "attributes", ['data-title="The hidden cost of trade"', 'class="flex hidden md:flex"', 'data-style="display:none"', 'hidden="until-found"', 'hidden']
)
def test_only_attributes_hide_and_never_the_whole_page(attributes):
    assert main_text(f"<article {attributes}><p>{LONG}</p></article>") == LONG


@pytest.mark.parametrize(
    "part",
    [
        '<section class="user-comments"><p>Nice one</p></section>', '<div class="related-articles"><p>Other stories</p></div>',
        '<div id="cookieConsent"><p>We use cookies</p></div>', '<div class="ad-300x250">Buy now</div>', '<p class="ad">Buy this</p>',
        '<div hidden><p>not shown</p></div>', '<div style="color:red; display : none">not shown</div>', '<div aria-hidden="true">not shown</div>',
        '<div class="relatedStories"><p>Others</p></div>', '<div class="sponsored_box">Paid</div>',
    ],
)
def test_what_is_not_the_article_goes(part):
    for page in (f"<article><p>{LONG}</p>{part}<p>{LONG}</p></article>", f"<div><p>{LONG}</p></div>{part}<div><p>{LONG}</p></div>"):
        assert main_text(page) == f"{LONG}\n{LONG}"


@pytest.mark.parametrize("part", ['<p class="notice-period">{}</p>', '<h2 class="related">{}</h2>', '<p id="adoption">{}</p>', '<div class="subscribers-count">{}</div>'])
def test_names_that_only_resemble_stay(part):
    assert main_text(f"<article><p>{LONG}</p>{part.format('Kept as it is')}</article>") == f"{LONG}\nKept as it is"


def test_regions_equal_looking_at_every_line():
    r = random.Random(3)
    for _ in range(300):
        weights = [r.choice([0, 0, 0, 5, 40]) for _ in range(r.randint(0, 25))]
        # A line belongs to a region if some window from a line of text up to it holds text without an empty window between.
        filled = [any(weights[k : k + WINDOW]) for k in range(len(weights))]
        want, k = [], 0
        while k < len(weights):
            if not filled[k]:
                k += 1
                continue
            end = k
            while end < len(weights) and filled[end]:
                end += 1
            first = next(i for i in range(k, end) if weights[i] > 0)
            want.append((first, end))
            k = end
        assert regions(np.array(weights, dtype=np.int64)) == want
