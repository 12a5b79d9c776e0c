import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridtally.llm import htmldiff, queries

SF = "/root/testdata/sf0.001"


def lcs_length(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@pytest.mark.parametrize("bits", [1 << 28, 6])
def test_alignment_is_a_longest_common_subsequence(bits, monkeypatch):
    monkeypatch.setattr(htmldiff, "TABLE_BITS", bits)

    @settings(max_examples=200, deadline=None)
    @given(st.lists(st.integers(0, 4), max_size=14), st.lists(st.integers(0, 4), max_size=14))
    def check(a, b):
        found = htmldiff.common_lines(a, b)
        rest = iter(b)
        assert len(found) == lcs_length(a, b) and found == sorted(set(found))
        assert all(any(x == a[i] for x in rest) for i in found)

    check()


def text(page, before=None, after=None):
    lines = [htmldiff.lines_of(p) if p is not None else None for p in (page, before, after)]
    return htmldiff.main_text(*lines)


def page(body, n=0):
    return (
        f"<html><head><title>t{n}</title><script>if(a<b)'</p>'</script></head><body><nav><ul><li>Home</ul></nav>"
        f"<div class='cookie-notice'>We use <b>cookies</b></div>{body}<aside>side</aside><footer>&copy; {n}</footer></body>"
    )


def test_marked_parts_go():
    body = (
        "<article><header><h1>A &amp; B</h1></header><p>one <b>t</b>wo<br>three&nbsp; four<p>five</p>"
        "<div class='ad'>buy <div>now</div> this</div><form>name <input> </form><!-- no -->six"
        "<section id='comments'><p>nice!</p></section><style>p{}</style></article>"
    )
    assert text(page(body)) == "A & B one two three four five six"
    assert text("<p>unclosed <div class=ad>gone<p>gone") == "unclosed"
    assert text("<article><div class=ad>gone</article><p>outside</p><article>in</article>") == "in"
    assert htmldiff.lines_of(None) == [] and text("") == text("<p> </p>") == ""
    assert text('<p title="a>b">x < y &lt; z</p>') == "x < y < z"


def test_neighbours_decide_where_nothing_is_marked():
    plain = "<div>Top of site</div><p>{}</p><p>{}</p><div>Bottom line</div>"
    a, b = plain.format("first story", "goes on"), plain.format("second story", "is other")
    assert text(a) == "Top of site first story goes on Bottom line"
    assert text(a, b) == text(a, None, b) == "first story goes on"
    assert text(a, a, b) == "first story goes on"  # a copy tells nothing, the other neighbour is asked
    assert text(a, a, a) == text(a)
    inside = page("<article><p>shared</p><p>{}</p></article>")
    assert text(inside.format("x y z"), inside.format("u")) == "shared x y z"


def test_differencing_decides_lines_outside_the_article():
    cards = "<div>Top</div><h1>{0}</h1><p>long story {0}</p><article>teaser {0}</article><div>Bottom</div>"
    a, b = page(cards.format("one")), page(cards.format("two"))
    assert text(a, b) == text(a, None, b) == text(a, a, b) == "one long story one teaser one"
    assert text(a) == text(a, a, a) == "teaser one"


def test_names_do_not_mark_what_holds_the_content():
    story = "<article><p>the story</p></article><div class='side'>gone</div>"
    assert text(f"<body class='right-sidebar'>{story}</body>") == "the story"
    assert text(f"<html id='no-header'><div class='layout-with-sidebar'><div id='page-header'>{story}</div></div>") == "the story"
    assert text("<main class='has-menu'>the <div class='ad'>gone</div>story</main>") == "the story"
    assert text("<article class='post share'>the story</article>") == "the story"
    plain = "<div class='with-sidebar'><p>menu</p><p>the story {0} is long</p></div><div class='ad'>buy {0}</div>"
    assert text(plain.format(1), plain.format(2)) == "the story 1 is long"
    # Comments in an article and a long advert beside one are marked as before.
    assert text("<main><div class='has-sidebar'><article>the story</article></div><p class='ad'>gone</p></main>") == "the story"
    assert text("<article>by me<div class='share-box'>the story</div></article>") == "by me the story"
    assert text("<article>the story<section id='comments'><article>nice</article></section></article>") == "the story"
    assert text("<div class='ad'>much longer than that</div><article>in</article>") == "in"


def result(spark, rows):
    pages = spark.createDataFrame([(*r, "h", 1) for r in rows], "page_id long, url string, html string, host string, cell int")
    return sorted((tuple(r) for r in htmldiff.extract(pages).collect()), key=repr)


def by_hand(rows):
    def split(url):
        m = re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)([^?#]*)", url or "")
        return (m[1].lower(), m[2]) if m else ("", "")

    lines = {i: htmldiff.lines_of(r[2]) for i, r in enumerate(rows)}
    order = sorted(range(len(rows)), key=lambda i: (*split(rows[i][1]), rows[i][0] is not None, rows[i][0] or 0))
    out = []
    for k, i in enumerate(order):
        near = [
            lines[order[n]] if 0 <= n < len(order) and split(rows[order[n]][1])[0] == split(rows[i][1])[0] else None
            for n in (k - 1, k + 1)
        ]
        found = htmldiff.main_text(lines[i], *near)
        out.append((rows[i][0], rows[i][1], found, len(found)))
    return sorted(out, key=repr)


def test_rows(spark):
    rng = random.Random(3)
    rows = []
    for i in range(60):
        host = rng.choice(["a.example.com", "B.example.com", "c.example.org:80"])
        body = f"<div>{host} menu</div><p>story {i} {rng.random()}</p><div>all about {host}</div>"
        rows.append((i, f"https://{host}/x/{rng.randrange(99)}?q={i}", body))
    rows += [(100, None, "<p>alone</p>"), (101, "no url", None), (None, "https://a.example.com/zz", "<p>z</p>")]
    rows += [(102, "https://long.example.com/", "<p>word</p>" * 20_000), (59, rows[59][1], rows[59][2])]
    assert result(spark, rows) == by_hand(rows)
    assert result(spark, rows[:1])[0][0] == 0
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert htmldiff.extract(empty).count() == 0


def test_hot_host_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(htmldiff, "CELL_PAGES", 5)
    rows = [(i, f"https://h/{i}", f"<div>menu</div><p>{'story ' * 9}{i}</p>") for i in range(100)]
    found = result(spark, rows)
    assert [r[2] for r in found if "menu" in r[2]] == [] or all("story" in r[2] for r in found)


def test_every_page_of_a_hot_host_meets_its_nearest_url(spark, monkeypatch):
    monkeypatch.setattr(htmldiff, "CELL_PAGES", 5)
    # Each section of three pages has a template of its own, and some pages are copies.
    rows = [
        (i, f"https://h/{i // 3:03}/{i}", f"<div>menu {i // 3}</div><p>{'story ' * 9}{i // 2 if i % 7 else 0}</p>")
        for i in range(150)
    ]
    rows += [(None, "https://g/a", "<p>g</p>"), (7, rows[7][1], "<div>menu 2</div><p>other</p>"), rows[8]]
    bounds, guests = htmldiff._ranges(spark.createDataFrame([("h", f"/{i:03}", i) for i in range(90)], "host string, path string, page_id long"))
    assert len(bounds) > 1 and len(guests) == 2 * len(bounds)
    assert result(spark, rows) == by_hand(rows)


def test_articles_of_the_given_pages(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    found = {r.page_id: r.text for r in queries.QUERIES["op8_html"](spark, SF).collect()}
    import html

    for r in rows:
        article = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        article = re.sub(r"</?(b|i|em|a|span)\b[^>]*>", "", article)
        assert found[r.page_id] == " ".join(html.unescape(re.sub(r"<[^>]+>", " ", article)).split())


KEPT = [
    ('<div id="share-of-market"><p>market text</p></div>', "market text"),
    ('<section class="related-work"><p>work text</p></section>', "work text"),
    ('<p>an <span class="notice">inline</span> part</p>', "an inline part"),
    ('<p>with a <span class="side-note">side note</span> in it</p>', "with a side note in it"),
    ('<p>un<em class="hl">believ</em>able <code id="ad">code</code></p>', "unbelievable code"),
    ('<p>E=mc<sup class="n">2</sup> and a<img src="x">b, c<wbr>d<br>e</p>', "E=mc2 and ab, cd e"),
    ('<p><a class="share" href="#">shared <b role="note">link</b></a></p>', "shared link"),
]


@pytest.mark.parametrize("part,words", KEPT)
def test_articles_lose_nothing_and_words_stay_whole(part, words):
    rest = "<p>" + "much other text of this article " * 5 + "</p>"
    body = f"<article>{rest}{part}{rest}</article>"
    other = page(f"<article><p>{'something else ' * 9}</p></article>", 2)
    want = " ".join(f"{'much other text of this article ' * 5}{words} {'much other text of this article ' * 5}".split())
    assert text(page(body), other) == want
    assert text(page(f"<main>{rest}{part}{rest}</main>"), other) == want


def test_what_is_unmistakable_goes_in_an_article_too():
    marked = "ad ad-1 cookie-banner newsletter-box comment-list related-links sidebar_left share-buttons".split()
    inner = "".join(f'<div class="{name}"><p>gone {i}</p></div>' for i, name in enumerate(marked))
    rest = "the article itself has quite some text " * 12
    assert text(page(f"<article><p>{rest}</p>{inner}</article>")) == " ".join(rest.split())
