import html
import random

import pytest

from paytide.llm import html_text
from paytide.llm.queries import REGISTRY
from paytide.llm.tables import table


def pages(spark, rows):
    return spark.createDataFrame([(*r, 1, "z") for r in rows], "page_id long, url string, html string, text int, host string")


def texts(df):
    return {r["page_id"]: r["text"] for r in df.collect()}


def test_query_takes_the_article(spark):
    sf = "/root/testdata/sf0.01"
    told = {r["page_id"]: r for r in REGISTRY["op2_host_suffix_array"](spark, sf).collect()}
    for page in table(spark, sf, "pages").collect():
        inside = page["html"].split("<article>", 1)[1].split("</article>", 1)[0]
        for tag in ("p", "/p", "h1", "/h1", "br"):
            inside = inside.replace(f"<{tag}>", " ")
        want = " ".join(html.unescape(inside.replace("<b>", "").replace("</b>", "")).split())
        r = told[page["page_id"]]
        assert (r["text"], r["n_chars"], r["url"]) == (want, len(want), page["url"])


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain &amp; text", "plain & text"),
    ("<article>a<b>b</b> c<br>d<p>e\n f</article>", "ab c d e f"),
    ("<nav>n</nav><article>x</article><footer>f</footer>", "x"),
    ("<main><h1>t</h1><form>q</form><p>x</main>tail", "t x"),
    ("<article>x<div class='user-comments'><p>no</p></div><aside>no</aside><p>y</article>", "x y"),
    ("<div id=sidebar>no</div><div>yes</div><div role='navigation'>no</div><div hidden>no</div>", "yes"),
    ("<article>1 < 2 &lt;b&gt; <script>if (a</b) '</p>'</script><style>p{}</style><!-- no --> end", "1 < 2 <b> end"),
    ("<div class='ad'><article>still here</article></div>", "still here"),
    ("<section class=comments><article>a comment</article></section><article>x</article>", "x"),
    ("<article><p title='a>b'>x</p><p title=\"unclosed>y</p></article>", "x y"),
])
def test_blocks(spark, page, text):
    assert texts(html_text.extract(pages(spark, [(1, "http://h/", page)]))) == {1: text}


@pytest.mark.parametrize("page", [
    *(f"<body><div class='{c}'><article><h1>t</h1><p>x</article></div>" for c in (
        "has-sidebar", "content-with-sidebar", "page no-comments", "widget-area-off", "layout-sidebar", "banner",
    )),
    "<div id='sidebar-layout'><main><h1>t</h1>x</main></div>", "<div class='ad-free'><main><h1>t</h1>x</main></div>",
    "<article class='post header-image'><h1>t</h1>x</article>", "<article class='post comments-open'><h1>t</h1>x</article>",
    "<div class='has-sidebar'><article>t<p>x<div class='user-comments'><article>no</article></div></article>"
    "<div class='sidebar'><article>no</article></div></div>",
    "<article>t x</article><div class='related-posts'><article>no</article></div>",
    "<section class='user-comments'><article>no</article></section><main>t x</main>",
])
def test_layout_classes_leave_the_article(spark, page):
    assert texts(html_text.extract(pages(spark, [(1, "http://h/", page)]))) == {1: "t x"}


@pytest.mark.parametrize("element", [
    "section class='related-work'", "p class='notice-text'", "div class='social-policy'", "p class='share-price'", "div id=ad-astra",
    "div class='banner-year promotion-rules'", "p class=login-problem",
])
def test_topics_are_no_parts_of_a_page(spark, element):
    page = f"<article><h1>t</h1><{element}>x</article>"
    assert texts(html_text.extract(pages(spark, [(1, "http://h/", page)]))) == {1: "t x"}


@pytest.mark.parametrize("name", [
    "related-posts", "share", "share-buttons", "social-links", "ad-slot", "ads", "promo_box", "notice", "cookie-notice", "signup-form",
    "newsletter-text", "comment-text", "site-footer", "nav-main", "recommended articles", "header-menu", "subscribe-panel top",
])
def test_parts_of_a_page_are_no_text(spark, name):
    page = f"<article><h1>t</h1><div class='{name}'>no</div><p>x</article>"
    assert texts(html_text.extract(pages(spark, [(1, "http://h/", page)]))) == {1: "t x"}


def brute_covered(texts, pages, least):
    where = {}
    for text, page in zip(texts, pages):
        w = text.split(" ")
        for i in range(len(w) - least + 1):
            where.setdefault(tuple(w[i : i + least]), set()).add(page)
    out = []
    for text in texts:
        w = text.split(" ")
        inside = set()
        for i in range(len(w) - least + 1):
            if len(where[tuple(w[i : i + least])]) > 1:
                inside |= set(range(i, i + least))
        out.append([(a, next(b for b in range(a, len(w) + 1) if b not in inside)) for a in sorted(inside) if a - 1 not in inside])
    return out


def test_covered_runs_by_brute_force():
    rnd = random.Random(3)
    for _ in range(300):
        texts = [" ".join(rnd.choice("abc") for _ in range(rnd.randint(1, 30))) for _ in range(rnd.randint(1, 6))]
        owners = [rnd.randint(1, 3) for _ in texts]
        least = rnd.randint(2, 6)
        assert html_text.covered(texts, owners, least) == brute_covered(texts, owners, least)


def test_suffix_array():
    import numpy as np

    rnd = random.Random(8)
    for _ in range(100):
        tokens = [rnd.randint(0, 3) for _ in range(rnd.randint(1, 40))]
        order, common = html_text.suffix_array(np.array(tokens))
        want = sorted(range(len(tokens)), key=lambda i: tokens[i:])
        assert order.tolist() == want
        for a, b, n in zip(want, want[1:], common.tolist()):
            x, y = tokens[a:], tokens[b:]
            assert n == next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))


@pytest.mark.parametrize("chunk", [200_000, 40])
def test_boilerplate_of_a_host_goes_and_unique_runs_stay(spark, monkeypatch, chunk):
    """Pages without an article; dividing the host changes nothing."""
    monkeypatch.setattr(html_text, "CHUNK_WORDS", chunk)
    rnd = random.Random(2)
    shared = " ".join(f"s{i}" for i in range(20))

    def own(n):
        return " ".join(f"u{n}x{rnd.randrange(10**6)}" for _ in range(15))

    rows, want = [], {}
    for n in range(12):
        a, b = own(n), own(n)
        rows.append((n, "http://Host.example:80/x", f"<div>Same on all.</div><p>{a}</p><p>{a.split()[0]} {shared} {b}</p>"))
        want[n] = f"{a} {a.split()[0]} {b}"
    rows.append((50, "http://other.example/", f"<div>Same on all.</div><p>{shared}</p>"))
    want[50] = f"Same on all. {shared}"
    rows.append((51, None, f"<p>{shared}</p>"))
    want[51] = shared
    assert texts(html_text.extract(pages(spark, rows))) == want


@pytest.mark.parametrize("chunk", [200_000, 40])
def test_copies_of_a_page_and_few_unique_words_stay(spark, monkeypatch, chunk):
    monkeypatch.setattr(html_text, "CHUNK_WORDS", chunk)
    text, other = (" ".join(f"{a}{i}" for i in range(60)) for a in "to")
    shared, few = " ".join(f"s{i}" for i in range(200)), " ".join(f"f{i}" for i in range(40))
    page = f"<p>{text}</p><p>Menu of all</p>"
    rows = [(n, "http://h/x", page) for n in (1, 2, 3)] + [(4, "http://h/y", f"<p>{other}</p><p>Menu of all</p>")]
    rows += [(5, "http://i/", f"<p>{few} {shared}</p>"), (6, "http://i/", f"<p>{shared}</p><p>{other}</p>")]
    assert texts(html_text.extract(pages(spark, rows))) == {1: text, 2: text, 3: text, 4: other, 5: few, 6: other}


@pytest.mark.parametrize("chunk", [200_000, 40])
def test_boxes_that_articles_repeat_go(spark, monkeypatch, chunk):
    """Boxes in articles are judged by the arrays; paragraphs, short rows, main containers and copies stay."""
    monkeypatch.setattr(html_text, "CHUNK_WORDS", chunk)
    box = " ".join(f"b{i}" for i in range(20))
    quote = " ".join(f"q{i}" for i in range(20))

    def own(n):
        return " ".join(f"u{n}x{i}" for i in range(60))

    def page(n, extra=""):
        return f"<article><div class=text><h1>t{n}</h1><p>{own(n)}<p>{quote}</div><div class=zz><section>{box} {extra}</section></div><table><tr><td>Yes</table></article>"

    rows = [(n, "http://h/", page(n)) for n in range(6)]
    want = {n: f"t{n} {own(n)} {quote} Yes" for n in range(6)}
    rows += [(6, "http://h/", page(6, "own words")), (7, "http://other/", page(7))]
    want |= {6: f"t6 {own(6)} {quote} own words Yes", 7: f"t7 {own(7)} {quote} {box} Yes"}
    # Copies of one article, on a host with no other.
    rows += [(n, "http://copies/", page(8)) for n in (8, 9, 10)]
    want |= {n: f"t8 {own(8)} {quote} {box} Yes" for n in (8, 9, 10)}
    # Two articles in containers of their own are no boxes.
    rows += [(n, "http://two/", f"<main><div><article>{own(n)}</article></div><div><article>{quote}</article></div></main>") for n in (11, 12)]
    want |= {n: f"{own(n)} {quote}" for n in (11, 12)}
    assert texts(html_text.extract(pages(spark, rows))) == want


def test_containers_in_containers():
    """A container holds what its inner ones hold; depth costs no more than length."""
    many = " ".join(f"w{i}" for i in range(13))
    page = f"<article><div><div><p>{many}</div><ul><li>{many}</ul></div><ol><li>{many}<li>few</ol></article>"
    main = [(text, around) for _, text, around in html_text.blocks(page)]
    assert html_text.boxed(main) == [True, True, True, False]
    deep = "<article>" + f"<div><p>{many}" * 20_000
    assert len(html_text.blocks(deep)) == 20_000
    assert sum(html_text.boxed([(text, around) for _, text, around in html_text.blocks(deep)])) == 9_999


def test_odd_rows(spark):
    long = "<article>" + "<p>word &eacute; " * 50_000
    rows = [(None, None, None), (1, "u", long), (1, "u", long), (2, "", "<"), (3, "http://[", "&#0;&bogus;")]
    out = html_text.extract(pages(spark, rows)).collect()
    assert len(out) == 5 and all(r["n_chars"] == len(r["text"]) for r in out)
    assert {r["text"][:13] for r in out if r["page_id"] == 1} == {"word é word é"}
    assert html_text.extract(pages(spark, [])).count() == 0
