import html as escapes
import re

import pytest

from modelvigil.llm import html_text

P = "<p>A sentence of the article, with enough words in it. And one more of them.</p>"
T = "A sentence of the article, with enough words in it. And one more of them."


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("   ", ""), ("no markup, but text.", "no markup, but text."),
    (f"<html><body><nav><ul><li><a href=/x>Menu</a></ul></nav><article><h1>Title</h1>{P}</article><footer>&copy; x.</footer>", f"Title\n{T}"),
    (f"<article>{P}<p>Tom &amp; Jerry&nbsp;&#233; \n\t now<br>then</p></article>", f"{T}\nTom & Jerry é now then"),
    (f"<script>var t='<p>no</p>';</script><style>p{{}}</style><!-- <p>no</p> --><article>{P}</article>", T),
    (f"<article>{P}<div class='ad'>Buy this now, it is cheap. Really, it is.</div>{P}</article>", f"{T}\n{T}"),
    (f"<article>{P}</article><div id='comments'><p>First! I disagree with all of it, frankly.</p></div>", T),
    (f"<article>{P}<section class=comments><p>First! I disagree with all of it.</p></section></article>", T),
    (f"<div class='cookie-notice'>We use cookies, as you know. Accept them.</div><main>{P}</main><aside>See also this one.</aside>", T),
    (f"<header><h1>Site</h1></header><div class=content>{P}{P}</div><form>Your mail, please. <input></form>", f"{T}\n{T}"),
    (f"<article>{P}<p hidden>Not seen, never.</p><p aria-hidden=true>Nor this.</p></article>", T),
    (f"<article><header><h2>Title</h2></header>{P}</article>", f"Title\n{T}"),
    ("<article><p>One<p>Two <b>bo</b>ld<p>Three</article>", "One\nTwo bold\nThree"),
    ("<article><ul><li>One, two.<li>Three.</ul><table><tr><td>a1.<td>b2.</table></article>", "One, two.\nThree.\na1.\nb2."),
    (f"<article>{P}<p>cut off in the mid", f"{T}\ncut off in the mid"), (f"<article>{P}<p title=\"open>x</p>", T + "\nx"),
    (f"<article>{P}<p>1 < 2 and a<b</p></article>", None), ("<nav>Only a menu.</nav>", ""),
    (f"<article>{P}<textarea>typed</textarea><select><option>a<option>b</select></article>", T),
])
def test_main_text(page, want):
    got = html_text.main_text(page)
    assert want is None and got.startswith(T) or got == want


def test_without_a_container_long_paths_win():
    page = "<body><div class=top>Home</div>" + "<div><p>" + "Long text, with marks. " * 20 + "</p></div>" * 1 + "<div><span>x</span></div>"
    assert html_text.main_text(page) == ("Long text, with marks. " * 20).strip()


LONG = "<p>" + "Some words of a sentence with a length like many others, up to its end. " * 70 + "</p>"
SHORT = (
    "<h2>Part</h2><table><tr><td>12 beads<td>8 seeds</table><ul><li>An entry of a list with hardly more than some words"
    "<li><a href=/x>Linked entry</a></ul><div><blockquote><p>It was said, by one.</p></blockquote></div><h3><a href=/y>Next part</a></h3>"
)
SHORT_TEXTS = ["Part", "12 beads", "8 seeds", "An entry of a list with hardly more than some words", "Linked entry", "It was said, by one.", "Next part"]


@pytest.mark.parametrize("before, after", [
    ("<article>", "</article>"), ("<body><div class=top>Home</div><div class=text>", "</div>"), ("<body>", ""),
    ("<div>", "</div><div class=end>All of it by us</div>"), ("<article><div><div>", "</div></div></article>"),
])
@pytest.mark.parametrize("long", [LONG, LONG.replace(", up", " up")[:1500] + "</p>", "<p>word</p>" + LONG])
def test_short_blocks_beside_long_paragraphs_stay(before, after, long):
    got = html_text.main_text(f"{before}{long * 3}{SHORT}{long}{after}").split("\n")
    assert [t for t in got if len(t) < 100 and t != "word"] == SHORT_TEXTS
    assert len([t for t in got if len(t) > 1000]) == 4


@pytest.mark.parametrize("page", [
    f"<body><div>{LONG}</div><div>{SHORT}</div></body>", f"<body>{SHORT}<div>{LONG}</div></body>",
    f"<body><div><div>{LONG}</div></div><div>{SHORT}</div><div class=top>Home</div><div>x</div></body>",
])
def test_short_blocks_in_an_element_of_their_own_stay(page):
    assert [t for t in html_text.main_text(page).split("\n") if len(t) < 1000] == SHORT_TEXTS


def test_menus_go_and_lists_with_links_stay():
    menu = "<ul><li><a href=/1>One page</a><li><a href=/2>Another page</a></ul><p class=tags><a href=/3>cats</a> <a href=/4>dogs</a></p>"
    assert html_text.main_text(f"<article>{P}{menu}{P}</article>") == f"{T}\n{T}"
    assert html_text.main_text(f"<article>{P}<ol><li><a href=/1>Beads</a><li>of glass or of seeds</ol></article>") == f"{T}\nBeads\nof glass or of seeds"


@pytest.mark.parametrize("wrapper", [
    "div class='layout has-sidebar'", "div class='content no-comments'", "div class='page header-fixed'", "div id=search",
    "article class='post category-search'", "div class='widget'", "div class='page header'", "main class=comments",
    "section role=search class='menu-open nav-closed'", "article class=widget",
])
@pytest.mark.parametrize("inner", ["{}", "<article>{}</article>", "<div class=widget><div class=text>{}</div></div>", "<div class='no-ad'><p class=notice-bar>{}</p></div>"])
def test_a_class_word_does_not_drop_the_article(wrapper, inner):
    page = f"<body><div class='nav'>A menu.</div><{wrapper}>{inner.format(P + P)}</{wrapper.split()[0]}><div class=footer>The end.</div>"
    assert html_text.main_text(page) == f"{T}\n{T}"


@pytest.mark.parametrize("word", ["comments", "sidebar", "cookie-notice", "sidebar-1", "x related y", "ad", "share_menu"])
def test_class_words_drop_what_is_not_the_article(word):
    box = f"<div class='{word}'><article><p>I see. And this, too.</p></article></div>"
    assert html_text.main_text(f"<div class=text>{P}{P}<article>{P}{P}</article>{box}</div>{box}").count(T) >= 2
    assert "I see" not in html_text.main_text(f"<div class=text>{P}{P}<article>{P}{P}</article>{box}</div>{box}")
    assert html_text.main_text(f"<article>{P}</article><div class='{word}'>{P * 9}</div>") == T


def test_long_and_odd_pages_end_quickly():
    assert html_text.main_text("<" * 100_000 + "a" * 200_000) is not None
    assert html_text.main_text("<div>" * 100_000 + "deep text." + "</b></div>" * 100_000) == "deep text."
    text = "word, " * 100_000
    assert html_text.main_text(f"<article><p>{text}</p></article>") == text.strip()


def by_markers(page):
    """The article of the synthetic pages, read off their fixed markers."""
    inner = re.search(r"<article>(.*?)(?:</article>|<footer>|\Z)", page, re.S)[1].replace("<br>", " ")
    parts = [escapes.unescape(re.sub(r"<[^>]*>", "", p)) for p in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(t for t in (" ".join(p.split()) for p in parts) if t)


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = html_text.op3_html_text(spark, folder).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, by_markers(pages[r.page_id].html), len(r.text))


def test_odd_rows(spark):
    df = spark.createDataFrame(
        [(None, None, None, 1), (1, "u", f"<article>{P}</article>", 2), (1, "u", f"<article>{P}</article>", 2), (2, None, "", 3)],
        "page_id long, url string, html string, text long",
    )
    got = sorted(map(tuple, html_text.extract(df).collect()), key=str)
    assert got == sorted([(None, None, "", 0), (1, "u", T, len(T)), (1, "u", T, len(T)), (2, None, "", 0)], key=str)
    assert html_text.extract(df.limit(0)).count() == 0


RIVER = "The river rose again in the night, and the people of the town moved what they could to the upper floors."


@pytest.mark.parametrize("page, blocks", [
    (f"<body><article><p>{RIVER}</p><!--><p>Two {RIVER}</p><!---><p>Three {RIVER}</p><!----><!-- > --!></article></body>", [RIVER, f"Two {RIVER}", f"Three {RIVER}"]),
    (f"<article><p title=it's>Hello {RIVER}</p><p title=a=b\"c>They don't {RIVER}</p></article>", [f"Hello {RIVER}", f"They don't {RIVER}"]),
    (f"<article><p title='a > b' data-x=\"c > d\">{RIVER}</p><p title=\"open>{RIVER}</p></article>", [RIVER, RIVER]),
    (f"<body><form id=page><nav><a href=1>Home</a></nav><article><h1>T</h1><p>{RIVER}</p></article><footer>f</footer></form></body>", ["T", RIVER]),
    (
        f"<body><form id=page><div id=nav><a href=1>Home</a><a href=2>About</a></div><div><h1>T</h1><p>{RIVER}</p><p>{RIVER}</p></div>"
        "<div class=x><form class=y>Search the site now.</form></div></form></body>", ["T", RIVER, RIVER],
    ),
])
def test_markup_that_once_lost_the_article(page, blocks):
    assert html_text.main_text(page) == "\n".join(blocks)


LAYOUTS = {
    "forum": (
        "<body><div class=topnav><a href=1>Forums</a> <a href=2>Login</a></div><div class=thread><h1>Pump fails</h1>"
        + "".join(f"<div class=message><div class=msg-body><p>{RIVER}</p><p>Thanks, {i}.</p></div></div>" for i in range(4))
        + "</div><div class=footer>Powered by a board. All rights reserved.</div></body>",
        ["Pump fails", *[t for i in range(4) for t in (RIVER, f"Thanks, {i}.")]],
    ),
    "layout table": (
        "<html><body><table><tr><td colspan=2><a href=1>Home</a> | <a href=2>Mail</a></td></tr><tr><td width=120>"
        f"<a href=a>News</a><br><a href=b>Sport</a></td><td><h2>Flood</h2><p>{RIVER}</p><p>{RIVER} {RIVER}</p><ul><li>first item</li>"
        "<li>second item</li></ul></td></tr><tr><td colspan=2><a href=c>Copyright 2004</a> <a href=d>Imprint</a></td></tr></table></body></html>",
        ["Flood", RIVER, f"{RIVER} {RIVER}", "first item", "second item"],
    ),
    "wiki": (
        "<body><div id=mw-navigation><ul><li><a href=1>Main page</a></li></ul></div><div id=content role=main><h1>River</h1>"
        f"<div id=toc><ul><li><a href=#1>History</a></li><li><a href=#2>Course</a></li></ul></div><p>{RIVER}</p><h2>History</h2>"
        f"<p>{RIVER}<sup><a href=#r>[1]</a></sup></p><table class=infobox><tr><th>Length</th><td>120 km</td></tr></table></div></body>",
        ["River", RIVER, "History", f"{RIVER}[1]", "Length", "120 km"],
    ),
    "docs": (
        "<body><aside class=toc><a href=1>Install</a><a href=2>Usage</a></aside><main><h1>Usage</h1>"
        f"<p>{RIVER}</p><pre><code>run --fast\n  now</code></pre><dl><dt>--fast</dt><dd>Be quick about it.</dd></dl></main>"
        "<div class=pagination><a href=p>Prev</a><a href=n>Next</a></div></body>",
        ["Usage", RIVER, "run --fast now", "--fast", "Be quick about it."],
    ),
    "listing": (
        "<body><header><a href=1>Shop</a></header><ul class=results>"
        + "".join(f"<li><h3><a href=p{i}>Pump {i}</a></h3><p>{RIVER}</p></li>" for i in range(4))
        + "</ul><div class=sidebar><p>Buy now, save more, pay less.</p></div></body>",
        [t for i in range(4) for t in (f"Pump {i}", RIVER)],
    ),
    "many comments": (
        f"<body><article><h1>T</h1><p>{RIVER}</p><p>{RIVER}</p></article><section id=comments><h2>Comments</h2>"
        + "".join(f"<div class=comment><p>I agree, {RIVER}</p></div>" for _ in range(9)) + "</section></body>",
        ["T", RIVER, RIVER],
    ),
}


@pytest.mark.parametrize("name", sorted(LAYOUTS))
def test_unlike_layouts(name):
    page, blocks = LAYOUTS[name]
    assert html_text.main_text(page) == "\n".join(blocks)
