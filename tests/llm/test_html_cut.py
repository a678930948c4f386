import itertools
import random
import re
import time
from html import unescape

import pytest

from citylake.llm.html_cut import blocks, extract, main_text, minimum_cut
from tests.llm.helpers import with_extra

PROSE = "A long sentence of plain words that a reader would call an article, with a comma or two."


def test_cut_is_the_cheapest_labelling():
    rng = random.Random(8)
    for _ in range(200):
        n = rng.randrange(0, 8)
        content, boiler = [rng.random() * 3 for _ in range(n)], [rng.random() * 3 for _ in range(n)]
        arcs = [(a, b, rng.random() * 2) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.5]
        def cost(labels):
            return sum(c if x else b for x, c, b in zip(labels, content, boiler)) + sum(w for a, b, w in arcs if labels[a] != labels[b])
        best = min(map(cost, itertools.product([True, False], repeat=n)))
        assert abs(cost(minimum_cut(content, boiler, arcs)) - best) < 1e-6


CASES = [
    ("", ""),
    ("just text", "just text"),
    (f"<p>{PROSE}</p><p>Two&nbsp;&amp; more\n  words</p>", f"{PROSE}\nTwo & more words"),
    (f"<nav><ul><li><a href='/x'>Home</a></li></ul></nav><article><h1>T</h1><p>{PROSE}<p>Short.</article><footer>&copy; me</footer>", f"T\n{PROSE}\nShort."),
    (f"<div class='sidebar'>{PROSE}</div><main><p>{PROSE}</p><p>{PROSE}</p></main>", f"{PROSE}\n{PROSE}"),
    (f"<header><h2>Site</h2></header><article><p>{PROSE}</p><aside>{PROSE}</aside><p>End</p></article>", f"{PROSE}\nEnd"),
    (f"<article><p>{PROSE}</p></article><section id='comments'><article><p>{PROSE}</p></article></section>", PROSE),
    (f"<div class='cookie-notice'>We use {PROSE}</div><div id='content'><p>{PROSE}</p></div><form><label>{PROSE}</label></form>", PROSE),
    (f"<script>var a='</p>';if(a<b){{}}</script><style>p{{}}</style><!-- <p>no</p> --><p>{PROSE}</p>", PROSE),
    (f"<div class='ad'>{PROSE}</div><article><p><b>{PROSE}<br><p>Next &lt;b&gt; &#233;</p></article>", f"{PROSE}\nNext <b> é"),
    (f"<article><p>{PROSE} <a href='x'>a link</a> inside</p><ul><li>One<li>Two</ul><table><tr><td>a<td>b</table></article>", f"{PROSE} a link inside\nOne\nTwo\na\nb"),
    (f"<article><p>{PROSE}</p>tail text <div>in a div</div> after</article>", f"{PROSE}\ntail text\nin a div\nafter"),
    ("<nav><a href='/'>A</a> <a href='/b'>B</a></nav>", ""),
    (f"<div class='post has-sidebar'><p>{PROSE}</p></div><div class='sidebar'><p>{PROSE}</p></div>", PROSE),
    (f"<header><p>Site name</p></header><article><header><h1>Title here</h1></header><p>{PROSE}</p></article>", f"Title here\n{PROSE}"),
    (f"<p title='a > b'>{PROSE}</p><p>1 < 2 and 3", f"{PROSE}\n1 < 2 and 3"),
]


@pytest.mark.parametrize("html, text", CASES)
def test_pages(html, text):
    assert main_text(html) == text


def test_table(spark):
    rows = [(i, "u", h) for i, (h, _) in enumerate(CASES)] + [(None, None, None), (0, "u", CASES[0][0])]
    got = extract(with_extra(spark.createDataFrame(rows, "page_id long, url string, html string"))).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert {r.page_id: r.text for r in got if r.page_id} == {i: t for i, (_, t) in enumerate(CASES) if i}
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_given_pages(spark):
    """In the given pages the article element is the main text."""
    for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        inner = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        lines = [" ".join(unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)\b[^>]*>", inner)]
        assert main_text(r.html) == "\n".join(x for x in lines if x)


def test_long_and_broken_pages():
    assert main_text("<p>" + "word " * 200_000).count("word") == 200_000
    assert main_text("<div>" * 50_000 + PROSE) == PROSE
    assert main_text("<" * 20_000 + PROSE).endswith(PROSE)
    assert len(main_text("".join(f"<p>{PROSE} {i}</p>" for i in range(5000))).split("\n")) == 5000


@pytest.mark.parametrize("above", ["<div>" * 500, "<font>" * 500, "<b><i><span>" * 300, "<p><a name='x'><font>" * 3 + "<span>" * 600])
def test_elements_count_at_any_depth(above):
    page = f"<article>{above}<p>{PROSE}</p><nav>{PROSE}</nav><div hidden>{PROSE}</div><select><option>{PROSE}</select><aside>{PROSE}</aside><p>{PROSE}</p></article>"
    assert main_text(page) == f"{PROSE}\n{PROSE}"
    deep = "<div>" * 500 + f"<div><p>{PROSE}</p></div>" + "</div>" * 500
    assert main_text(f"<div class='sidebar'>{deep}{PROSE}</div><article><p>{PROSE}</p></article>") == PROSE  # the sidebar stays open


def test_cost_of_deep_pages_is_in_proportion():
    took = []
    for n in (2_000, 20_000):
        page = "".join(f"<div><font><p>word {i}</b></p>" for i in range(n))
        start = time.process_time()
        assert len(blocks(page)) == n
        took.append(time.process_time() - start)
    assert took[1] < 40 * max(took[0], 0.01)


@pytest.mark.parametrize("html, text", [
    (f"<html><head><meta charset=utf-8><title>T</title><body><p>{PROSE}</p></body></html>", PROSE),
    (f"<html><head>\n<title>T</title>\n<link rel=x href=y>\n<script>var a;</script><style>p{{}}</style>\n<p>{PROSE}</p>", PROSE),
    (f"<head><title>T</title>{PROSE}<p>{PROSE}</p>", f"{PROSE}\n{PROSE}"),
    (f"<head><title>T</title></body>{PROSE}", PROSE),
    (f"<html><head><title>T</title></head><body><p>{PROSE}</p></body></html>", PROSE),
    (f"<head><title>T</title><body><nav>{PROSE}</nav><p>{PROSE}</p><div hidden>{PROSE}</div>", PROSE),
])
def test_head_without_end_tag(html, text):
    assert main_text(html) == text


@pytest.mark.parametrize("tag", ['<b title="x"">', "<b title='x''>", '<b title="x" ">', '<b "title=x>', "<b title=it's>", '<b title=x">', '<b title = "a > b"">', '<b title="x>'])
def test_stray_quote_in_a_tag(tag):
    end = "</b>"
    assert main_text(f"<p>{tag}{PROSE}{end}</p><p>{PROSE}</p>") == f"{PROSE}\n{PROSE}"
    if tag != '<b title="x>':  # there the value runs to the next quote
        assert main_text(f"<p>{tag}{PROSE}{end}</p><p title=\"it's\">{PROSE}</p><nav class='n'>{PROSE}</nav>") == f"{PROSE}\n{PROSE}"
    assert main_text(tag * 20_000 + PROSE).endswith(PROSE)


def test_text_of_scripts_and_frames_never_leaks():
    page = "<body><article><p>Kept words of the article, long enough to count as content here.</p>{}<p>More kept words of the article.</p></article>"
    for odd in ("<script src=/js/>var leaked = 1;</script>", "<iframe src=//ads.example/>frame text</iframe>", "<script/>var leaked = 2;</script>",
                "<style media=all/>p{leaked:1}</style>", "<textarea/>leaked</textarea>", "<svg viewBox='0 0 1 1'/>", "<svg width=1/>leaked</svg>"):
        text = main_text(page.format(odd))
        assert text.split("\n") == ["Kept words of the article, long enough to count as content here.", "More kept words of the article."], odd


def test_pages_that_end_inside_a_tag_or_comment():
    start = "<body><article><p>Kept words of the article, long enough to count as content here.</p>"
    want = "Kept words of the article, long enough to count as content here."
    assert main_text(start + "<!-- never ends <p>x</p>") == want
    assert main_text(start + "</article") == want and main_text(start + "<!doctype") == want
    assert main_text(start + "<p>more words <a href=") == want + "\nmore words <a href="


def test_long_and_odd_pages_take_about_linear_time():
    import time
    t = time.time()
    page = "<body>" + "".join(f"<p>paragraph {i} " + "with some words of plain text " * 3 + f"</p><p><a href='/{i}'>link {i} to another page</a></p>" for i in range(4000))
    assert main_text(page).count("paragraph") > 0
    main_text("<a " * 33_000)
    main_text("<p>x</p>" + "<a b='" * 20_000)
    assert time.time() - t < 8


def test_cut_of_long_random_graphs_is_least():
    rng = random.Random(9)
    for _ in range(200):
        n = rng.randrange(1, 9)
        content, boilerplate = [[rng.choice([0.0, 0.5, 1.0, 2.0, 5.0]) for _ in range(n)] for _ in range(2)]
        arcs = [(a, b, rng.choice([0.2, 0.5, 1.0, 3.0])) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.5]

        def cost(mask):
            return sum(content[i] if mask >> i & 1 else boilerplate[i] for i in range(n)) + sum(w for a, b, w in arcs if (mask >> a & 1) != (mask >> b & 1))

        got = minimum_cut(content, boilerplate, arcs)
        assert abs(cost(sum(1 << i for i, k in enumerate(got) if k)) - min(map(cost, range(1 << n)))) < 1e-6
