"""Pages whose main text lies where tags and names alone would not look."""

from __future__ import annotations

from sparkmart.llm import html_text

TEXT = "A long sentence of the story that goes on for a while, with commas and words enough."


def test_story_in_divs_beside_teasers_in_articles():
    teasers = "<article><p>Teaser one</article><article><a href=x>Teaser two</a></article>"
    got = html_text.extract(f"<body><div><p>{TEXT}<p>{TEXT}</div><hr>{teasers}")
    assert got.startswith(f"{TEXT} {TEXT}")
    got = html_text.extract(f"<main><div><p>{TEXT}<p>{TEXT}</div>{teasers}</main>")
    assert got.startswith(f"{TEXT} {TEXT}")


def test_article_is_whole_where_it_holds_the_surge():
    links = "<ul>" + "<li><a href=x>link</a>" * 9 + "</ul>"
    got = html_text.extract(f"<p>Site</p><article><p>{TEXT}{links}<p>End</article><p>Imprint</p>")
    assert got == f"{TEXT}{' link' * 9} End"
    assert html_text.extract(f"<article>{links}</article><p>Imprint</p>") == " ".join(["link"] * 9)


def test_regions_need_a_surge():
    assert html_text.regions([0, 100, 0, 0, 0, 0, 5, 0]) == [(1, 2, True), (6, 7, False)]


def test_parts_behind_dropped_elements_and_link_lists_stay():
    for dropped in ("<div class=ad>buy</div>", "<form>x</form>", "<aside>x</aside>"):
        page = f"<div><p>{TEXT * 5}</p>{dropped}<p>short closing paragraph</p></div>"
        assert html_text.extract(page) == f"{TEXT * 5} short closing paragraph"
    links = "<ul>" + "<li><a href=x>link</a></li>" * 9 + "</ul>"
    for a, b in (("<p>", "</p>"), ("<div>", "</div>")):
        page = f"<div>{a}{TEXT * 5}{b}{links}{a}short closing part{b}</div><div>{links}</div><div><div>far</div></div>"
        assert html_text.extract(page) == f"{TEXT * 5} short closing part"


def test_what_boilerplate_opens_stays_out():
    assert html_text.extract("<div class=ad><div>a</div><span>b</span>c</div>text</div> more") == "text more"
    assert html_text.extract("<p>one <span class=ad>x <span>y</span> z</span> two</p>") == "one two"
    assert html_text.extract("<div>" * 20_000 + "deep" + "</i></section>" * 20_000) == "deep"


def test_titles_in_ids_and_classes_mark_nothing():
    page = f"""<article><p>{TEXT}<section id=related-work><h2 id=search-algorithms>Search</h2><p>1</p></section>
        <section id="notice-period"><p>2</p></section><section id=search><h2 id=header>H</h2>3</section>
        <div class="share-price" title="hidden costs">4</div><p id=hidden-costs>5</p></article>"""
    assert html_text.extract(page) == f"{TEXT} Search 1 2 H 3 4 5"
    for marked in ("class=ad", 'class="x ad-box"', "class=cookieNotice", "id=site-footer", "role=search", "hidden=''",
                   "class=share-buttons", "aria-hidden=true", "style='display: none'", "id=comments"):
        got = html_text.extract(f"<article><p>{TEXT}<div {marked}>no</div>yes</article>")
        assert got == f"{TEXT} yes"


def test_dropped_elements_without_end_tags_end_at_the_next():
    page = f"<article><p>{TEXT}<p class=notice>no<p>1<p>2<ul><li class=ad>no<li>3<li class=ad>no</ul>4</article>"
    assert html_text.extract(page) == f"{TEXT} 1 2 3 4"
    page = f"<article><div><p class=ad>no</div><p>{TEXT}<p class=ad>no<h2>1</h2><dl><dt class=ad>no<dd>2</dl>"
    assert html_text.extract(page) == f"{TEXT} 1 2"
    page = f"<article><p>{TEXT}<table><tr><td class=ad>no<td>1<tr class=ad><td>no<tr><td>2</table>"
    assert html_text.extract(page) == f"{TEXT} 1 2"
    page = f"<article><p>{TEXT}<ul><li class=ad>no<ul><li>no</ul>no<li>1</ul>"
    assert html_text.extract(page) == f"{TEXT} 1"


def test_teasers_in_closed_boilerplate_stay_out():
    teaser = "<article><p>A teaser of another story that is long enough to be taken for one, were it not marked as such.</article>"
    for name in ("aside", "footer", "nav", "header", "form"):
        page = f"<main><article><p>{TEXT}</p></article><{name}>{teaser}<{name}>x</{name}>{teaser}</{name}></main>"
        assert html_text.extract(page) == TEXT
        page = f"<{name}>{teaser}</{name}><main><article><p>{TEXT}</p></article></main>"
        assert html_text.extract(page) == TEXT
    # Where the end tag is missing the main part ends it, inner elements of the name or not.
    for name in ("aside", "header", "form"):
        page = f"<{name}><p>x</p><main><article><{name}>y</{name}><p>{TEXT}</p></article></main>"
        assert html_text.extract(page) == TEXT
    page = f"<article><p>{TEXT}</p></article><div class=sidebar>{teaser}</div><p>far</p>"
    assert html_text.extract(page) == TEXT
    assert html_text.extract(f"<div class=sidebar><p>x<article><p>{TEXT}</p></article></div>") == TEXT


def test_comments_and_related_lists_by_their_place_in_a_class():
    for mark in ("user-comments", "articleComments", "post-replies", "related-articles", "recommended-reading"):
        page = f"<article><p>{TEXT}</p><div class='{mark}'><p>{TEXT}</p></div></article>"
        assert html_text.extract(page) == TEXT
    for mark in ("share-price", "comments-free-zone", "unrelated", "reply-speed"):
        page = f"<article><p>{TEXT}</p><div class='{mark}'><p>yes</p></div></article>"
        assert html_text.extract(page) == f"{TEXT} yes"
