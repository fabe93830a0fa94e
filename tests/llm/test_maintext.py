import itertools
import random
import time

import pytest

from flowquarry.llm import maintext

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body class="no-sidebar">
<header><h1>Site name</h1></header><ul id=menu><li><a href=/>Home</a><li><a href=/x>About us</a></ul>
<div class="cookie-notice">We use cookies to make this site better for you and for us all.</div>
<div class=wrap><div class="post-content"><h1>The title</h1><p>First paragraph of the story is long enough to count, it is &amp; it&nbsp;goes on.<p>Short one.
<div class="ad">Buy this thing now! It is cheap and good and new and blue.</div><p>Another <b>bold</b><i>italic</i> text &lt;tag&gt;<br>with words.<blockquote>Quoted text here.</blockquote></div>
<section id="comments"><h2>3 comments</h2><div class=comment><p>I think that this article is very good and I say so in many words, thank you.</p></div></section></div>
<aside><h3>Related</h3><p>Something else that we have written about on another day of the week.</p></aside>
<form action=x><label>Your mail</label><input><button>Send</button></form><!-- note --><footer><p>&copy; Somebody. All rights reserved.</p></footer>"""


def test_article_alone_remains():
    assert maintext.main_text(PAGE).split("\n") == ["The title", "First paragraph of the story is long enough to count, it is & it goes on.", "Short one.", "Another bolditalic text <tag> with words.", "Quoted text here."]


WORDS = "A paragraph of the story that has enough words in it to be content of the page."


def test_embedded_elements_lose_no_text():
    for tag in ("object", "svg", "math", "video", "audio", "canvas"):
        inner = f"<{tag} width=3>Words inside of it.</{tag}>"
        assert maintext.main_text(f"<article><p>{WORDS} {inner} {WORDS}</p></article>") == f"{WORDS} Words inside of it. {WORDS}"
        unclosed = f"<article><p>{WORDS}</p><{tag}><p>{WORDS} Two.</p><p>{WORDS} Three.</p></article>"
        assert maintext.main_text(unclosed).split("\n") == [WORDS, WORDS + " Two.", WORDS + " Three."]


def test_drawings_hold_no_raw_text():
    page = lambda x: maintext.main_text(f"<article><p>{WORDS}</p>{x}<p>{WORDS} Two.</p></article>").split("\n")
    assert page("<svg><style>a>b{}</style><path/></svg>") == [WORDS, WORDS + " Two."]
    assert page("<svg><title>")[-1] == page("<svg><style>")[-1] == page("<svg><script></svg>")[-1] == WORDS + " Two."
    assert page("<svg/><style>a>b{}</style>") == [WORDS, WORDS + " Two."]
    assert page("<script>") == page("<svg></svg><style>") == [WORDS]  # raw text lasts to the end


def test_main_stands_against_its_frame():
    page = '<body><div class="layout-sidebar"><main><p>The content of this page, long enough to be a paragraph of it.</p><div class="share">Share this</div></main><div class="sidebar"><p>Some other words that nobody came here for at all.</p></div></div>'
    assert maintext.main_text(page) == "The content of this page, long enough to be a paragraph of it."


def test_cut_is_of_least_cost():
    rnd = random.Random(3)
    for _ in range(800):
        n = rnd.randint(1, 8)
        scores = [rnd.randint(-30, 30) for _ in range(n)]
        edges = [(a, b, rnd.randint(1, 15)) for a in range(n) for b in range(a + 1, n) if rnd.random() < 0.4]
        cost = lambda labels: sum(abs(x) for x, k in zip(scores, labels, strict=True) if x and (x > 0) != k) + sum(c for a, b, c in edges if labels[a] != labels[b])  # noqa: B023, E731
        assert cost(maintext.minimum_cut(scores, edges)) == min(map(cost, itertools.product([False, True], repeat=n)))


def brute_labels(scores, edges):
    """All labellings of least cost; the one with fewest content blocks, as ties go to boilerplate."""
    cost = lambda labels: sum(abs(x) for x, k in zip(scores, labels, strict=True) if x and (x > 0) != k) + sum(c for a, b, c in edges if labels[a] != labels[b])
    return list(min(itertools.product([False, True], repeat=len(scores)), key=lambda x: (cost(x), sum(x))))


def random_page(rnd):
    inner = ["Bake the cookies for ten minutes.", "Short one", "A line that ends here, with some more words in it.", "<a href=x>A link and nothing else here</a>", "All rights reserved", "x"]
    open_ = ["<div>", "<div class=ad>", "<article>", "<div class='post'>", "<footer>", "<section>", "<form>"]
    return "".join(rnd.choice(["", "", rnd.choice(open_), "</div>", "</article>"]) + f"<p>{rnd.choice(inner)}</p>" for _ in range(rnd.randint(1, 11)))


def test_pages_equal_brute_force_labelling(spark):
    rnd = random.Random(12)
    pages = [random_page(rnd) for _ in range(150)]
    rows = [(i, "u", p) for i, p in enumerate(pages)] * 2  # repeated rows give repeated rows
    got = {}
    for r in maintext.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect():
        got.setdefault(r.page_id, []).append(r.text)
    flipped = 0
    for i, page in enumerate(pages):
        blocks = maintext.blocks_of(page)
        scores = [maintext.score(x) for x in blocks]
        labels = brute_labels(scores, maintext.edges_of(blocks))
        flipped += sum((s > 0) != k for s, k in zip(scores, labels, strict=True))
        assert got[i] == ["\n".join(x.text for x, k in zip(blocks, labels, strict=True) if k)] * 2
    assert flipped > 50  # the cut decides, not the scores alone


def test_cut_keeps_a_doubtful_block_among_content_and_drops_one_among_boilerplate():
    page = f"<body><div><p>{WORDS}</p><p>Bake the cookies for ten minutes.</p><p>{WORDS} Two.</p></div>"
    blocks = maintext.blocks_of(page)
    assert [maintext.score(x) > 0 for x in blocks] == [True, False, True]
    assert maintext.main_text(page).split("\n") == [WORDS, "Bake the cookies for ten minutes.", WORDS + " Two."]
    links = "<p><a href=x>Some words that link to another page</a></p>"
    page = f"<body><div>{links}<p>Five words stand right here.</p>{links}</div><article><p>{WORDS}</p></article>"
    assert [maintext.score(x) > 0 for x in maintext.blocks_of(page)] == [False, True, False, True]
    assert maintext.main_text(page) == WORDS


def test_hidden_inline_elements():
    page = lambda x: maintext.main_text(f"<article><p>{WORDS} {x} {WORDS}</p></article>")
    for x in ("<span hidden>a <span>b</span> c</span>", "<span class='ad top'>a</span>", "<b style='display: none'>a</b>", "<i aria-hidden=true>a</i>"):
        assert page(x) == f"{WORDS} {WORDS}"
    assert page("<span class=comment data-id=ad>kept</span>") == f"{WORDS} kept {WORDS}"
    assert maintext.main_text(f"<article><p>{WORDS}<span hidden>a</p><p>{WORDS} Two.</p></article>").split("\n") == [WORDS, WORDS + " Two."]


MALFORMED = {
    "open tags": "<a ", "divs": "<div></section>", "quotes": '<a x=" y="><a "', "styles": "<svg><style>", "contents": "<div class=content>a", "paragraphs": "<p>a", "comments": "<!--", "signs": "<", "hidden": "<span hidden>a",
    "doubtful": f"<p>{WORDS}</p><p>a</p><p>cookies</p>",
}


@pytest.mark.parametrize("kind", MALFORMED)
def test_long_malformed_pages_take_time_in_proportion(kind):
    start = time.process_time()
    maintext.main_text(MALFORMED[kind] * (1_000_000 // len(MALFORMED[kind])))
    assert time.process_time() - start < 10


def test_quotes_and_tags():
    assert maintext.main_text(f"<article><p title='a > b' class=x>{WORDS}</p><p data-x=\"it's\">{WORDS} Two.</p>").split("\n") == [WORDS, WORDS + " Two."]
    assert maintext.main_text(f"<article><p title=\"never closed>{WORDS}</p><p>{WORDS} Two.</p>").split("\n") == [WORDS, WORDS + " Two."]
    assert maintext.main_text(f"<article><p it's=1>{WORDS}</p><p>{WORDS} 1 < 2.</p><p>cut <a href=").split("\n") == [WORDS, WORDS + " 1 < 2.", "cut"]


def test_edge_rows(spark):
    pages = [(1, "u", None), (2, None, ""), (3, "u", "<"), (4, "u", "<p>" + "long words stand here now. " * 4000), (5, "u", "<div><div></p></article><p>One paragraph that has some words, enough of them to be content."), (5, "u", "plain text without any markup at all, but a good many words in it"), (None, "u", "<p>x<script>never closed")]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, text string")
    rows = maintext.extract_pages(df).collect()
    assert len(rows) == len(pages) and all(r.n_chars == len(r.text) for r in rows)
    by = {r.page_id: r.text for r in rows}
    assert by[1] == by[2] == "" and len(by[4]) == len("long words stand here now. " * 4000) - 1
    assert maintext.extract_pages(df.limit(0)).count() == 0
