"""Main text of pages: markup by hand, held-out layouts, the given pages, exact marginals."""

import html
import itertools
import re
import time

import numpy as np
import pytest

from gainledger.llm.common import table
from gainledger.llm.html_extract import Forest, Potentials, as_arrays, extract, fit_extractor
from gainledger.llm.html_tree import read_page

PAGES = "page_id long, url string, html string, text string, main_text string"


@pytest.fixture(scope="module")
def model(spark, folder):
    return fit_extractor(table(spark, folder, "pages"))


def blocks(page):
    return [text for _, text in read_page(page)[1]]


def test_blocks_of_markup():
    assert blocks("<p>a <b>b</b>c<br>d<p>e &amp; &lt;f&gt; &#233;&nbsp; g</p>loose") == ["a bc d", "e & <f> é g", "loose"]
    assert blocks("<ul><li>one<li>two<ul><li>in</ul></ul>") == ["one", "two", "in"]
    assert blocks("<table><tr><td>a<td>b<tr><th>c</table>") == ["a", "b", "c"]
    assert blocks("<script>if (a < b) '</p>'</script><style>p{}</style><!-- x <p>y --><p title='a>b'>z") == ["z"]
    assert blocks("<div>a<div>b</div>c</div>") == ["a", "b", "c"]
    assert blocks("") == blocks("<p></p> \n") == blocks("<") [1:] == []
    assert blocks("a < b <p>c</p") == ["a < b", "c"]


def test_elements_that_hide_text_and_elements_that_show_it():
    assert blocks("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds") == ["so x=2 holds"]
    assert blocks("<p>a<xmp><b>&amp;</b></xmp>c") == ["a", "<b>&amp;</b>", "c"]
    assert blocks("<object data=x><p>instead</p></object><p>a") == ["instead", "a"]
    for tag in ("svg", "select", "audio", "video", "canvas", "template", "datalist", "noscript"):
        assert blocks(f"<{tag} a=b><p>article") == ["article"]
        assert blocks(f"<{tag}><p>article</p><{tag}>x</{tag}><p>b") == ["article", "b"]
        assert blocks(f"<{tag}>x<{tag}>y</{tag}>z</{tag}><p>article") == ["article"]
    for tag in ("script", "style", "title", "textarea", "iframe", "noembed", "noframes"):
        assert blocks(f"<p>a</p><{tag}><p>b") == ["a"]
    assert len(blocks("<svg><p>x</p>" * 3_000)) == 3_000


def test_page_without_end_is_read_in_linear_time():
    assert blocks("<a href=\"x" * 20_000) == []
    assert len(blocks("<p>" * 5_000 + "x")) == 1
    assert len(blocks("<!--" * 20_000)) == 0


@pytest.mark.parametrize("nested", ["<div>", "<table><tr><td>", "<ul><li>"])
def test_nested_elements_are_read_in_linear_time(nested):
    began = time.perf_counter()
    nodes, blocks = read_page(nested * 200_000 + "deep")
    assert time.perf_counter() - began < 20
    assert len(blocks) == 1 and blocks[0][1] == "deep" and len(nodes) == 1 + nested.count("<") * 200_000


def test_marginals_are_exact():
    draw = np.random.default_rng(0)
    page = "<body><div class='menu'><p>a</p></div><main><p>Text.</p><ul><li>b</li></ul></main></body>"
    forest = Forest.of([as_arrays(read_page(page)[0])])
    model = Potentials(draw.normal(size=200)[: 60], draw.normal(size=(3, 2, 2)))
    n = len(forest.parent)
    own = np.zeros(n)
    np.add.at(own, forest.node, model.unary[forest.feature])
    total, chance = 0.0, np.zeros(n)
    for states in itertools.product((0, 1), repeat=n):
        score = sum(own[i] for i in range(n) if states[i])
        score += sum(model.edge[forest.kind[i], states[p], states[i]] for i, p in enumerate(forest.parent) if p >= 0)
        total += np.exp(score)
        chance += np.exp(score) * np.array(states)
    assert np.allclose(model.marginals(forest)[0], chance / total)


def test_given_pages(spark, folder, model):
    pages = table(spark, folder, "pages")
    found = {r.page_id: r.main_text for r in extract(pages, model, ["page_id"]).collect()}
    for row in pages.collect():
        main = re.search("<article>(.*)</article>", row.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub("</?b>|<br>", " ", p)).split()) for p in re.split("</?p>|</?h1>", main)]
        assert found[row.page_id] == "\n".join(p for p in parts if p)


SENTENCE = "After the rain the old road to the mill could be used again by carts."
LAYOUTS = [
    "<div class='post-content'>%s</div>", "<main><div class='inner'>%s</div></main>", "<article class='entry'>%s</article>",
    "<div id='storyText'>%s</div>", "<section>%s</section>", "%s", "<div itemprop='articleBody'>%s</div>",
]
OTHERS = [
    f"<aside class='sidebar'><h3>Hot</h3><p>{SENTENCE}</p></aside>", f"<div id='cookieBar'>We use cookies. {SENTENCE}</div>",
    f"<div class='user-comments'><p>{SENTENCE}</p><p>ok</p></div>", "<form><label>mail</label><p>Send it to us.</p></form>",
    f"<footer><p>{SENTENCE}</p></footer>", "<nav><a href=x>Home</a></nav>", f"<div class='ad'>{SENTENCE}</div>",
    "<header><h1>Site</h1><p>News of the day.</p></header>", f"<div class='sidebar'><p>{SENTENCE}</p></div>",
    "<ul class='menu'><li><a href='/'>Start</a></li></ul>", f"<section id='comments'><div class='comment'>{SENTENCE}</div></section>",
]


def test_layouts_that_were_not_learned(spark, model):
    main = f"<h1>Mill</h1><p>{SENTENCE} {SENTENCE}</p><ul><li>one thing</li></ul><p>{SENTENCE}</p>"
    rows = []
    for i, (layout, k) in enumerate(itertools.product(LAYOUTS, range(len(OTHERS)))):
        others = [OTHERS[(k + j * (1 + i % 4)) % len(OTHERS)] for j in range(4)]
        before = [o for o in others[:2]]
        rows.append((i, f"<html><body>{''.join(before)}{layout % main}{''.join(others[2:])}</body></html>"))
    pages = spark.createDataFrame([(i, "u", p, "t", "m") for i, p in rows], PAGES)
    wanted = f"Mill\n{SENTENCE} {SENTENCE}\none thing\n{SENTENCE}"
    found = [r.main_text == wanted for r in extract(pages, model, ["page_id"]).collect()]
    assert np.mean(found) > 0.95


def test_null_empty_repeated_and_long_pages(spark, model):
    long = "<article>" + f"<p>{SENTENCE}</p>" * 20_000 + "</article>"
    rows = [(1, None), (2, ""), (None, "<p></p>"), (4, long), (4, long), (5, "<nav><a href='/'>x</a></nav>")]
    pages = spark.createDataFrame([(i, "u", p, "t", "m") for i, p in rows], PAGES)
    found = [(r.page_id, len(r.main_text)) for r in extract(pages, model, ["page_id"]).collect()]
    size = 20_000 * (len(SENTENCE) + 1) - 1
    assert sorted(found, key=str) == sorted([(1, 0), (2, 0), (None, 0), (4, size), (4, size), (5, 0)], key=str)
    assert extract(pages.limit(0), model, ["page_id"]).count() == 0
    assert fit_extractor(pages.limit(0)).unary.any()
