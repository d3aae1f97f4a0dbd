from collections import Counter

import pytest

from riskloom.llm import html_main
from riskloom.llm.html_main import main_text

KIND = "page_id long, url string, html string, text string, fixed int"


def test_markup():
    assert main_text("") == ""
    assert main_text("<p>a &amp;amp; b&nbsp;&#8364;<br>c\n d<p>e <b>f</b>g") == "a &amp; b € c d\n\ne fg"
    page = ("<html><head><title>t</title><style>p{}</style></head><body><nav><ul><li>m</ul></nav><div class='ad box'>buy</div>"
            "<article><h1>H</h1><p>one <i>two</i></p><script>var t='</p>';</script><aside>side</aside><ul><li>x<li>y</ul>"
            "<section id=comments><p>me too</p></section><form><p>mail</form><p>last</article><footer>f</footer>")
    assert main_text(page) == "H\n\none two\n\nx\n\ny\n\nlast"
    assert main_text("<!-- <p>no</p> --><p>1 < 2 & 3 <div hidden>h</div><span class=advert>z</span>w") == "1 < 2 & 3\n\nw"
    assert main_text("<article>a</article><p>out</p><article>b</article>") == "a\n\nb"
    assert main_text("<script>never closed <p>x") == "" and main_text("plain") == "plain" and main_text("</div></p>a<") == "a<"
    assert main_text("<div>" * 3000 + "deep") == "deep"


def test_exclusions_do_not_take_the_page():
    for page in ["<div class='layout with-sidebar'><article>kept</article></div>", "<div id='page' class='has-nav'><article>kept</article></div>",
                 "<form><div><main>kept</main></div></form>", "<form><p>kept</p></form>", "<form class=search><p>kept</form><nav>m</nav>",
                 "<div class=sidebar><div class=menu><article>kept</article></div></div>"]:
        assert main_text(page) == "kept"
    assert main_text("<p>x</p><div hidden>never shown, however long it may be</div>") == "x"
    inner = "<article><p>a</p><section id='discussion'>b</section><div class='related-work'>c</div><p class='notice'>d</p></article>"
    assert main_text(inner) == "a\n\nb\n\nc\n\nd"
    # Exclusions that leave an article stay, also those of articles.
    assert main_text("<article>a<div id=comments><article>me too, and at length</article></div></article>") == "a"
    assert main_text("<article>a</article><div class=sidebar><article>other</article></div><form>b, and more of it</form>") == "a"


def frame(spark):
    rows, want = [], {}
    for i in range(12):  # one host whose menu and notice are plain elements, so only its template tells them
        text = f"Story number {i} with its own words."
        rows.append((i, f"http://h.example/{i}", f"<div><b>Home</b></div><div>Fixed words on all pages.</div><div><p>{text}</p><p>More {i % 2}</p></div><div>Bye</div>"))
        want[i] = f"{text}\n\nMore {i % 2}"
    for i in range(12, 14):  # a host of two pages has no template
        rows.append((i, f"http://two.example/{i}", f"<div>Home</div><p>{i}</p>"))
        want[i] = f"Home\n\n{i}"
    for i in range(14, 24):  # copies of one page are one page
        rows.append((i, "http://copies.example/", "<div>Home</div><p>always this</p>"))
        want[i] = "Home\n\nalways this"
    rows += [(24, None, None), (25, None, ""), (26, "no host", "<p>x"), (None, None, "<p>y")]
    want |= {24: "", 25: "", 26: "x", None: "y"}
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], KIND), rows, want


def test_template_of_a_host(spark):
    df, rows, want = frame(spark)
    got = html_main.extract(df).collect()
    assert Counter((r["page_id"], r["url"], r["text"]) for r in got) == Counter((i, u, want[i]) for i, u, _ in rows)


def test_template_inside_the_article(spark):
    rows = [(i, f"http://h.example/{i}", f"<article><h1>Title {i}</h1><div class=x1>Tell your friends</div><p>Own words {i}.</p>"
             f"<section class=x2><p>Comments are closed.</p></section></article>", "", 0) for i in range(8)]
    rows += [(20 + i, "http://same.example/", f"<!-- {i} --><article>The same on all pages</article>", "", 0) for i in range(6)]
    got = {r["page_id"]: r["text"] for r in html_main.extract(spark.createDataFrame(rows, KIND)).collect()}
    assert got == {i: f"Title {i}\n\nOwn words {i}." for i in range(8)} | {20 + i: "The same on all pages" for i in range(6)}


def test_repeated_rows_and_empty_table(spark):
    df, rows, _ = frame(spark)
    assert html_main.extract(df.unionByName(df)).count() == 2 * len(rows)
    assert html_main.extract(df.where("false")).count() == 0


PROSE = "A long enough sentence of the article itself that goes on for a while, and then some more of it."


@pytest.mark.parametrize("name", [
    "comment-list", "user_comments", "ad-slot", "ads", "share", "share-buttons", "related", "related-posts", "sidebar", "notice",
    "cookie-notice", "newsletter-box", "social-links", "post-nav", "sponsored-content"])
def test_named_parts_of_an_article_are_left_out(name):
    page = f"<html><body><article><h1>Title</h1><p>{PROSE}</p><div class='{name}'><p>not this</p></div><p>End.</p></article></body></html>"
    assert html_main.main_text(page) == f"Title\n\n{PROSE}\n\nEnd."


@pytest.mark.parametrize("name", ["cookie-banner", "main-nav", "site-footer", "site-header", "sidebar-left", "breadcrumb-list", "comment-section"])
def test_named_parts_of_a_page_without_an_article_are_left_out(name):
    page = f"<body><div class='{name}'>not this</div><div class='post-body'><p>{PROSE}</p></div><div id='{name}'>nor this</div></body>"
    assert html_main.main_text(page) == PROSE


@pytest.mark.parametrize("name", ["has-sidebar", "layout-nav", "no-comments", "ad-free related-post"])
def test_names_do_not_take_what_holds_the_text(name):
    assert html_main.main_text(f"<body><div class='{name}'><p>{PROSE}</p></div><p>More.</p></body>").startswith(PROSE)
    assert html_main.main_text(f"<article><h1>T</h1><div class='{name}'><p>{PROSE}</p></div></article>") == f"T\n\n{PROSE}"
    assert html_main.main_text(f"<div class='{name}'><article><p>{PROSE}</p></article></div>") == PROSE


def test_names_that_parts_of_articles_have_stay():
    page = f"<article><div class='entry-header'><h1>T</h1></div><p>{PROSE}</p><div class='discussion'><p>We discuss.</p></div></article>"
    assert html_main.main_text(page) == f"T\n\n{PROSE}\n\nWe discuss."


def test_containers_nested_very_deep_keep_what_stands_around_them():
    deep = "<div>" * 3000
    assert html_main.main_text(f"<article><p>{PROSE}</p>{deep}<p>deep</p></article>") == f"{PROSE}\n\ndeep"
    assert html_main.main_text(f"<article><p>{PROSE}</p><div class='comments'>{deep}<p>deep</p></div></article>") == PROSE


def test_a_very_long_page_takes_no_square_of_its_length():
    page = "<article>" + f"<p>{PROSE}</p><div class='ad-slot'>x</div>" * 30_000 + "</article>"
    assert html_main.main_text(page) == "\n\n".join([PROSE] * 30_000)
