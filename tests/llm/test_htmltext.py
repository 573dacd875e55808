import pytest

from stayline.llm import htmltext
from stayline.llm.htmltext import blocks, extract, fit, labelled_blocks, labelled_pages


@pytest.fixture(scope="module")
def chain():
    return fit(labelled_pages())


def test_held_out_pages(chain):
    wrong = total = 0
    for page in labelled_pages(200, seed=77):
        features, labels = labelled_blocks(page)
        found = chain.decode([htmltext.Block("", f) for f in features])
        wrong += sum(a != bool(b) for a, b in zip(found, labels))
        total += len(labels)
    assert wrong / total < 0.01


def test_given_pages(spark, tiny, chain):
    """The article of every given page, read by its tag."""
    import html
    import re

    rows = htmltext.main_texts(spark.read.parquet(f"{tiny}/pages.parquet"), chain).collect()
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{tiny}/pages.parquet").collect()}
    for r in rows:
        inner = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id], re.DOTALL)[1]
        plain = re.sub(r"<(?:br|/?p|/?h1)>", " ", inner)
        assert r.text == " ".join(html.unescape(re.sub(r"<[^>]+>", "", plain)).split()) and r.n_chars == len(r.text)


PAGE = """<html><head><title>T</title><script>if (a < b) x("</p>")</script></head><body>
<header class="masthead"><a href="/">Site name</a></header><nav><ul><li><a href=/1>One</a><li><a href=/2>Two</a></ul></nav>
<div class="cookie-notice"><p>We use cookies. Accept them all, please, and read on.</p></div>
<article><h1>A   title &amp; more</h1><p>First <b>para</b>graph with enough words to read, &lt;b&gt; and caf&eacute; &#233;&nbsp;too.
<p>Second one, 3 < 4, unclosed<div class="ad">Buy our things today, they are the best of all.</div><p>Third paragraph goes on for a while here.</p></article>
<section class="comments"><p>I read this article and liked the second paragraph best of all.</p></section>
<aside class="sidebar"><a href=x>Related</a></aside><form><label>Name</label><input><button>Send</button></form>
<footer>&copy; 2020 Us</footer></body></html>"""


def test_one_page(chain):
    assert extract(PAGE, chain) == (
        "A title & more First paragraph with enough words to read, <b> and café é too. Second one, 3 < 4, unclosed Third paragraph goes on for a while here."
    )


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<p", "<!--", "<script>", "</p></p>", "<a href='x", "<p title=\">\">", "<![CDATA[x", "&#xFFFFFFF; &bogus;", "<div>" * 3000, "<p>" + "a" * 200_000])
def test_broken_pages_do_not_fail(page, chain):
    assert isinstance(extract(page, chain), str)


def test_blocks():
    texts = [b.text for b in blocks("<p>a<b>b</b>c<br>d<p>e</p>f<li>g<li>h<!-- x --><textarea><b></textarea><td>i")]
    assert texts == ["abc", "d", "e", "f", "g", "h", "<b>", "i"]


def test_viterbi_is_the_best_of_all_sequences(chain):
    from itertools import product

    page = blocks(PAGE)[:9]
    gains = [sum(chain.weights.get(f, 0.0) for f in b.features) for b in page]

    def value(states):
        steps = sum(chain.steps[a, b] for a, b in zip(states, states[1:]))
        return chain.first[states[0]] + steps + sum(g for g, s in zip(gains, states) if s)

    best = max(product((0, 1), repeat=len(page)), key=value)
    assert [int(s) for s in chain.decode(page)] == list(best)


def test_odd_rows(spark, chain):
    rows = [(1, "u", None), (None, None, "<article><p>Words of a page without an id are read as well.</p></article>"), (2, "u", ""), (2, "u", "")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS n_chars")
    found = htmltext.main_texts(frame, chain).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in found) == [(0, 47), (1, 0), (2, 0), (2, 0)]
    assert htmltext.main_texts(frame.limit(0), chain).count() == 0


def test_a_head_without_its_end_tag(chain):
    assert extract(PAGE.replace("</head>", ""), chain) == extract(PAGE, chain)
    assert extract(PAGE.replace("</head><body>", ""), chain) == extract(PAGE, chain)
    assert [b.text for b in blocks("<head><title>T</title><meta name=a>plain <b>text</b><p>more")] == ["plain text", "more"]
    assert [b.text for b in blocks("<html><head><title>T</title><span>a</span>")] == ["a"]
    assert [b.text for b in blocks("<head><noscript><div>x</div></noscript><title>T</title></head><body>y")] == ["y"]
    assert [b.text for b in blocks("<head><noscript><div>x</div><body>y")] == ["y"]


STATES = ["has-sidebar", "post comments-open has-sidebar", "menu-open", "ad-free", "no-ads newsletter-popup", "single-post comment-form", "sidebar-right", "content-sidebar-wrap", "header-fixed footer-visible", "with-comments cookie-consent"]


@pytest.mark.parametrize("states", STATES)
def test_classes_of_body_wrapper_and_article_lose_no_article(chain, states):
    """What they name is elsewhere on the page."""
    prose = "<h1>A title</h1><p>First paragraph with quite enough words to be read.</p><p>Second one, which goes on for a while.</p>"
    want = "A title First paragraph with quite enough words to be read. Second one, which goes on for a while."
    around = '<nav><a href=/>Home</a> <a href=/a>About us</a></nav>{}<aside class="sidebar"><p>Other things to read here.</p></aside><section class="comments"><p>I liked it very much, thanks for it.</p></section><footer>&copy; 2020 Us</footer>'
    for page in (
        f'<body class="{states}">{prose}</body>',
        f'<body class="{states}">{around.format(f"<article>{prose}</article>")}</body>',
        f'<body><div class="{states}">{around.format(f"<article>{prose}</article>")}</div></body>',
        f'<body>{around.format(f"""<article class="{states}">{prose}</article>""")}</body>',
        f'<body class="{states}">{around.format(f"""<main class="{states}"><article class="{states}">{prose}</article></main>""")}</body>',
    ):
        assert extract(page, chain) == want, page


def test_held_out_pages_with_such_classes(chain):
    pages = [p for p in labelled_pages(600, seed=78) if any(f"-{w}" in p.split(">")[5] or f"{w}-" in p.split(">")[5] for w in ("sidebar", "comments", "menu", "ad"))]
    wrong = total = 0
    for page in pages or labelled_pages(100, seed=79):
        features, labels = labelled_blocks(page)
        found = chain.decode([htmltext.Block("", f) for f in features])
        wrong += sum(a != bool(b) for a, b in zip(found, labels))
        total += len(labels)
    assert total > 100 and wrong / total < 0.01


def test_wide_side_matters_stay_out(chain):
    """A long comments section and a long sidebar beside a short article."""
    talk = "".join(f"<div class='comment'><p>Reader number {i} says that all of this was said before.</p></div>" for i in range(30))
    page = "<body><article><h1>Short</h1><p>Only one paragraph is here to read today.</p></article><section class='comments'>{}</section></body>".format(talk)
    assert extract(page, chain) == "Short Only one paragraph is here to read today."
    side = "".join(f"<p>Another teaser, number {i}, of something else on this site.</p>" for i in range(30))
    page = f"<body><article><h1>Short</h1><p>Only one paragraph is here to read today.</p></article><aside class='sidebar'>{side}</aside></body>"
    assert extract(page, chain) == "Short Only one paragraph is here to read today."
