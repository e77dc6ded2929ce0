import html
import re

import pytest
from llm_rows import *  # noqa: F403

from gateflow.llm import html_text, queries


def brute(page):
    inner = re.search(r"<article>(.*?)(?:</article>|<footer>|$)", page, re.S)[1]
    inner = re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1|br)\b[^>]*>", " ", inner))
    assert "<" not in inner
    return " ".join(html.unescape(inner).split())


def test_query_equals_brute_force(spark):
    rows = queries.op2_html_text(spark, "/root/testdata/sf0.01").collect()
    pages = {r.page_id: r for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        assert (r.text, r.url) == (brute(pages[r.page_id].html), pages[r.page_id].url)
        assert r.n_chars == len(r.text)


@pytest.mark.parametrize("page, text", [
    ("", ""), ("just text", "just text"), ("<div>open", "open"), ("<![odd", ""), ("<p>" * 5000 + "x", "x"),
    ("<div>" * 5000 + "deep", "deep"), ("<article><p>a<p>b &amp; c&nbsp;&eacute;</article>", "a b & c é"),
    ("<body><nav><a href=x>menu</a></nav><div class=post><h1>Title of it</h1><div><p>Long text is here and it is good."
     "</p><p>More <b>te</b>xt<br>line</p></div></div><div class='comments'><p>reader says a lot of words here too, many"
     " words</p></div><div id=sidebar>side</div><form>name</form><footer>foot</footer></body>",
     "Title of it Long text is here and it is good. More text line"),
    ("<main><header>x</header><article><header><h1>Head</h1></header><p>x y z</p><div class='ad'>buy</div></article></main>",
     "Head x y z"),
    ("<article>a<script>var x='</p><p>no'</script><style>p{}</style>b<!-- c --></article>", "ab"),
    ("<nav>only menus</nav>", ""),
])
def test_pages(page, text):
    assert html_text.main_text(page) == text


def test_article_wins_over_link_lists():
    links = "<div>" + "".join(f"<p><a href=/{i}>some link text number {i}</a></p>" for i in range(60)) + "</div>"
    body = "<div>" + "<p>Prose that goes on for a while and has no link in it at all, as text does.</p>" * 8 + "</div>"
    assert html_text.main_text(f"<body>{links}{body}{links}</body>") == " ".join(
        ["Prose that goes on for a while and has no link in it at all, as text does."] * 8)


def test_odd_rows(spark):
    rows = [(1, None, None), (None, "u", ""), (2, "u", "<p>x"), (2, "u", "<p>x"), (3, "u", "<p>" + "y " * 300_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'c' as text", "'d' as tag")
    got = sorted(((r.page_id or 0, r.url, r.text) for r in html_text.extract(df).collect()), key=str)
    assert got == sorted([(1, None, ""), (0, "u", ""), (2, "u", "x"), (2, "u", "x"), (3, "u", ("y " * 300_000).strip())],
                         key=str)
    assert html_text.extract(df.limit(0)).count() == 0


def test_sibling_articles_are_kept():
    one, two = ("<article>" + f"<p>{w} words that go on for a while and make a paragraph of text.</p>" * 5 + "</article>"
                for w in ("First", "Second"))
    text = html_text.main_text(f"<body><div>{one}{two}</div></body>")
    assert text.count("First") == text.count("Second") == 5


def test_bare_text_beside_the_content_is_kept():
    bare = "<br>".join(["bareword " * 31] * 9)
    quote = "<blockquote>" + ("<p>" + "quoted " * 50 + "</p>") * 2 + "</blockquote>"
    text = html_text.main_text(f"<body><div>{bare}{quote}</div></body>")
    assert text.count("bareword") == 279 and text.count("quoted") == 100


@pytest.mark.parametrize("name", ["content has-sidebar", "no-sidebar", "with-menu", "post comments-open", "widget"])
@pytest.mark.parametrize("tag", ["article", "div"])
def test_layout_wrappers_are_kept(name, tag):
    page = f"<body><nav>menu</nav><div class='{name}'><{tag}><p>The text of it.</p><p>More of it.</p></{tag}></div></body>"
    assert html_text.main_text(page) == "The text of it. More of it."


def test_named_parts_are_still_cut():
    page = ("<article><p>The text of it.</p><div class='related-posts'><p>other</p></div></article>"
            "<div class='comments'><article><p>" + "A reader says much. " * 20 + "</p></article></div>")
    assert html_text.main_text(f"<body>{page}</body>") == "The text of it."


def variants(page):
    div = page.replace("<article>", "<div>").replace("</article>", "</div>")
    yield from (page, div, page.replace("</nav>", ""))
    for p in (page, div):
        yield p.replace("<body>", "<body><form>").replace("</body>", "</form></body>")


def test_pages_without_articles_in_forms_and_open_menus(spark):
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect() if r.html]
    for p in pages:
        want = brute(p)
        assert all(html_text.main_text(v) == want for v in variants(p))


def test_forms_and_menus_are_cut_beside_a_text():
    text = "<div>" + "<p>Prose that goes on for a while, as text does.</p>" * 6 + "</div>"
    page = f"<body><form><label>Your name</label><p>Fill in</p></form><aside><p>Aside</p></aside>{text}<nav>menu</nav></body>"
    assert html_text.main_text(page) == " ".join(["Prose that goes on for a while, as text does."] * 6)
    assert html_text.main_text("<div role=navigation><article><p>Its text.</p></article></div>") == "Its text."
    reader = "<aside><article><p>A reader says much. </p></article></aside>"
    assert html_text.main_text(f"<article><p>The text.</p></article>{reader}") == "The text."


def test_short_paragraphs_beside_a_chosen_one_are_kept():
    long = "A paragraph much longer than all others. " * 40
    page = f"<body><div><p><b>{long}</b></p><p>Short.</p></div></body>"
    assert html_text.main_text(page) == long + "Short."


def brute_density(node, body_share):
    """The composite density of a node, counted anew below it."""
    def below(n):
        for p in n.parts:
            if not isinstance(p, str) and not p.cut:
                yield p
                yield from below(p)

    def chars(n):
        return sum(len(re.sub(r"\s", "", p)) for m in [n, *below(n)] for p in m.parts if isinstance(p, str))

    inside = [node, *below(node)]
    c, t = chars(node), len(inside) - 1
    links = [n for n in inside if n.tag == "a"]
    lc = sum(chars(n) for n in links if not any(n is not m and n in list(below(m)) for m in links))
    if not c:
        return 0.0
    t, lt = max(t, 1), max(len(links), 1)
    base = html_text.math.log(c / max(c - lc, 1) * lc + body_share * c + html_text.math.e)
    return max(0.0, c / t * html_text.math.log(c / max(lc, 1) * t / lt) / max(html_text.math.log(base), 0.01))


def test_density_sums_equal_brute_force():
    import random
    r = random.Random(3)

    def some(depth):
        out = ""
        for _ in range(r.randrange(1, 5)):
            kind = r.choice(["text", "p", "div", "a", "b", "ul"] if depth else ["text"])
            words = "".join(r.choice(["word ", "longerword", " it "]) for _ in range(r.randrange(1, 30)))
            out += words if kind == "text" else f"<a href=x>{words}</a>" if kind == "a" else f"<{kind}>{some(depth - 1)}</{kind}>"
        return out

    for _ in range(60):
        page = html_text.Page(f"<body>{some(4)}</body>")
        body = html_text.measure(page)
        kept = [n for n in page.nodes if not n.cut]
        share = body.link_chars / max(body.chars, 1)
        for n in kept:
            assert abs(n.density - brute_density(n, share)) < 1e-6
        for n in kept:
            assert abs(n.total - sum(c.density for c in n.parts if not isinstance(c, str) and not c.cut)) < 1e-6


@pytest.mark.parametrize("page", ["<i><hr>" * 40_000, "<div>" * 8000 + "</span></b></section>" * 12_000, "<p><i>" * 40_000,
                                  "<div class=menu>" * 20_000 + "x", "<article>a<div>" * 16_000, "<i><article></i>" * 16_000,
                                  "<ul><li>" * 30_000 + "</td>" * 30_000])
def test_time_grows_with_the_length(page):
    import time
    start = time.time()
    html_text.main_text(page)
    whole = time.time() - start
    start = time.time()
    html_text.main_text(page[:len(page) // 4])
    assert whole < 1 + 8 * (time.time() - start)
