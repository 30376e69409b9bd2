import random

import pytest

from wordloom.llm.html_text import common, extract_text, line_keys, main_lines, main_text, page_lines, same_lines

MENU = '<div><a href="/a">Home</a><br><a href="/b">About us</a></div>'


def lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


@pytest.mark.parametrize("most", [1 << 20, 0])
def test_common_subsequence(most):
    rng = random.Random(1)
    for _ in range(400):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(12))] for _ in range(2))
        found = common(a, b, most)
        rest = iter(b)
        assert found == sorted(set(found)) and len(found) == lcs(a, b) and all(a[i] in rest for i in found)


def test_markup():
    html = (
        "<!doctype html><head><title>T</title><style>p{}</style></head><body><nav>menu</nav><header>site</header><article><h1>Head &amp; tail</h1>"
        "<p>One  <b>two</b>\nthree<p>four<br>five&nbsp;six<script>var x='</p>'</script><div class='advert box'>buy</div><footer>by me</footer>"
        "<section id=comments><p>nice</p></section></article><aside>side</aside><div class='cookie-notice'>ok?</div><p>loose</p><footer>&copy;</footer>"
    )
    assert main_text(*main_lines(*page_lines(html)), []) == "Head & tail One two three four five six"


@pytest.mark.parametrize("html,text", [("", ""), ("plain &lt;text&gt;", "plain <text>"), ("<p>a<p>b", "a b"), ("a<!-- x", "a"), ("<p hidden>a</p>b", "b"), ("a < b and c > d", "a < b and c > d"), ("<div class=x>one</div><form>f<input></form>", "one"), ("<script>never closed", ""), ('<p title="a > b">c</p>', "c"), ("<ul><li>x<li>y</ul>z", "x y z")])
def test_small_pages(html, text):
    assert main_text(*main_lines(*page_lines(html)), []) == text


def test_lines_of_the_nearest_page_go(spark):
    pages = [
        (1, "http://Site.example/news/1", f"{MENU}<p>First story.</p><p>All about site</p>"),
        (2, "http://site.example/news/2", f"{MENU}<p>Second story.</p><p>All about site</p>"),
        (3, "http://site.example/shop/x", "<p>Buy</p><p>Second story.</p>"),
        (4, "http://other.example/news/1", f"{MENU}<p>First story.</p>"),
        (5, "http://twin.example/a", "<p>Same</p><p>page</p>"),
        (6, "http://twin.example/b", "<p>Same</p><p>page</p>"),
        (7, "http://art.example/1", f"{MENU}<article><p>Kept though shared</p><p>one</p></article>"),
        (8, "http://art.example/2", f"{MENU}<article><p>Kept though shared</p><p>two</p></article>"),
    ]
    got = {r.page_id: r.text for r in extract_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {
        1: "First story.", 2: "Second story.", 3: "Buy", 4: "Home About us First story.", 5: "Same page", 6: "Same page",
        7: "Kept though shared one", 8: "Kept though shared two",
    }


def test_odd_rows(spark):
    long = "<p>" + "word " * 60000 + "</p>"
    pages = [(1, None, "<p>a</p>", 1), (None, "http://h.example/", None, 2), (2, "http://[bad", "", 3), (3, "http://h.example/x", long, 4), (3, "http://h.example/x", long, 4)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, text int")
    rows = extract_text(df).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in rows) == [(0, 0), (1, 1), (2, 0), (3, 299999), (3, 299999)]
    assert all(len(r.text) == r.n_chars for r in rows)
    assert extract_text(df.limit(0)).count() == 0


def test_differencing_inside_articles(spark):
    article = lambda *lines: "<article>" + "".join(f"<p>{x}</p>" for x in lines) + "</article>"
    tale, other = "A long tale that only this page of the site tells to its readers", "Something else altogether, told at some length on the other page"
    cards = "<article><p>Teaser</p></article>"
    pages = [
        (1, "http://a.example/1", article(tale, "Read more every day")),
        (2, "http://a.example/2", article(other, "Read more every day")),
        # Three copies of one article in a row: each is compared with the pages beyond them.
        (3, "http://b.example/x/1", article(other, "All rights reserved")),
        (4, "http://b.example/y/1", article(tale, "All rights reserved")),
        (5, "http://b.example/y/2", article(tale, "All rights reserved", "Printed")),
        (6, "http://b.example/y/3", article(tale, "All rights reserved")),
        # Articles with less text than stands beside them are cards: both stay, but for what the next page has too.
        (7, "http://c.example/1", f"{cards}<div>{tale}</div><div>Imprint</div>"),
        (8, "http://c.example/2", f"{cards}<div>{other}</div><div>Imprint</div>"),
        # Copies without articles are passed over as well.
        (9, "http://d.example/1", f"{MENU}<p>{tale}</p>"),
        (10, "http://d.example/2", f"{MENU}<p>{tale}</p>"),
        (11, "http://d.example/3", f"{MENU}<p>{tale}</p>"),
        (12, "http://d.example/4", f"{MENU}<p>{other}</p>"),
    ]
    got = {r.page_id: r.text for r in extract_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {
        1: tale, 2: other, 3: other, 4: tale, 5: f"{tale} Printed", 6: tale, 7: tale, 8: other, 9: tale, 10: tale, 11: tale, 12: other,
    }


def test_line_keys():
    lines, kinds = ["menu", "menu", "a" * 2000], [0, 2, 1]
    keys = line_keys(lines, kinds)
    assert [k & 3 for k in keys] == kinds and [k >> 2 & 1023 for k in keys] == [4, 4, 1023]
    assert same_lines(keys)[0] == same_lines(keys)[1] != same_lines(keys)[2] and all(-(1 << 63) <= k < 1 << 63 for k in keys)
