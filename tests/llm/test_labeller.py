"""Block labelling: the page reader, the network's gradient, and what is extracted from many layouts."""

import re

import numpy as np
import pytest

from suarakit.llm import htmlblocks, labeller, layouts
from tests.llm import fixtures

LONG = "Ein langer Absatz mit vielen Worten, der von etwas handelt, das hier wichtig ist, und noch weiter geht."
MORE = "Another paragraph of the story follows here. It has two sentences and quite a few words in them."


def texts_of(page):
    return [b.text for b in htmlblocks.read(page)[0]]


@pytest.mark.parametrize(
    "page, wanted",
    [
        ("", []),
        ("just text &amp; more", ["just text & more"]),
        ("<p>a<p>b</p>c", ["a", "b", "c"]),
        ("<p><b>De.<br><p>Oi</p></article>x", ["De.", "Oi", "x"]),
        ("a<b>b</b>c <i>d\n\te</i>", ["abc d e"]),
        ('<script>var t="</p>";if(a<b){}</script><p>x</p><style>p{}</style>', ["x"]),
        ("<script>never closed <p>x</p>", []),
        ("<!-- a <p>b</p> --><p>c</p><!-- open <p>d</p>", ["c"]),
        ("<p title='a > b' class=\"x>y\">c</p>", ["c"]),
        ("<p it's>a</p><p>b</p>", ["a", "b"]),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", ["a", "b", "c", "d", "e"]),
        ("<table><tr><td>a<td>b<tr><td><p>c</table>d", ["a", "b", "c", "d"]),
        ("x < y and <3 &lt;p&gt;", ["x < y and <3 <p>"]),
        ("<p>a</p><p>b <a href='", ["a", "b"]),
        ("<p>&#233;&eacute;&nbsp;&bogus; &#x1F600;", ["éé &bogus; 😀"]),
        ("<select><option>a</select><textarea>b</textarea><button>c</button><p>d", ["d"]),
        ("<h2>a</h3><p>b</p>", ["a", "b"]),
        ("</div></p></b>a", ["a"]),
        ("<title>t</title><noscript>n</noscript>a", ["a"]),
    ],
)
def test_reader(page, wanted):
    assert texts_of(page) == wanted


def test_paths():
    blocks, paths = htmlblocks.read('<div id="sideBar-list" class=\'x_y\'><p><b>a<p>b</div><h1>c</h2><p>d')
    above = [sorted(paths[b.path].above) for b in blocks]
    assert above[1] == ["c:bar", "c:list", "c:side", "c:x", "c:y", "t:div", "t:p"]
    assert above[2:] == [["t:h1"], ["t:p"]]


@pytest.mark.parametrize("page", ["<div>" * 200_000 + "x", "<a " * 200_000, "<p>x" * 100_000, "<b><p></b>" * 50_000, '<a x="' * 100_000, "&" * 500_000])
def test_reader_is_linear(page):
    import time

    start = time.perf_counter()
    htmlblocks.read(page)
    assert time.perf_counter() - start < 20


def test_gradient():
    rng = np.random.default_rng(1)
    made = [htmlblocks.read(p) for p in ("<p>a b<div class=x>c<h1>d. e</h1>", "<p>q", "", "<li>a<li>b b b")]
    given = labeller.features(made)
    n = len(given.stats)
    label, weight = rng.integers(0, 2, n) == 1, rng.random(n).astype(np.float32)
    model = {k: v.astype(np.float64) for k, v in labeller._start(rng).items()}
    _, grad = labeller.loss_and_gradient(model, given, label, weight)
    for name, value in model.items():
        at = np.unravel_index(np.argmax(np.abs(grad[name])), value.shape)
        old, step = value[at], 1e-3
        value[at] = old + step
        high, _ = labeller.loss_and_gradient(model, given, label, weight)
        value[at] = old - step
        low, _ = labeller.loss_and_gradient(model, given, label, weight)
        value[at] = old
        assert abs((high - low) / (2 * step) - grad[name][at]) < 2e-3 * max(1e-2, abs(grad[name][at])) + 2e-5, name


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return labeller.fit(spark.read.parquet(f"{sf_dir}/pages.parquet"))


CASES = {
    "notices and comments": (
        f'<body><div id="cookie-banner"><p>{MORE}</p><button>Accept</button></div><header class="site-header"><a href="/">Site</a></header>'
        f'<main><h1>Titel</h1><p>{LONG}</p><p>{MORE}</p></main><aside class="sidebar"><h3>Related</h3><p>{MORE}</p></aside>'
        f'<section id="comments"><h2>Comments</h2><article class="comment"><p>{LONG}</p></article></section><footer><p>{MORE}</p></footer>',
        ["Titel", LONG, MORE],
    ),
    "no landmarks": (
        f'<div class="wrapper"><div class="top-nav"><a href=a>Home</a> <a href=b>News</a></div><div class="post"><h1>Titel</h1>'
        f'<div class="post-content"><p>{LONG}<p>{MORE}<div class="ad-slot">{MORE}</div><p>Short.</div></div>'
        f'<div class="comments-area"><p>{MORE}</p></div><div class="footer">Copyright</div></div>',
        ["Titel", LONG, MORE, "Short."],
    ),
    "form within": (
        f"<article><header><h1>Titel</h1></header><p>{LONG}</p><form><label>E-mail</label><p>{MORE}</p></form><p>{MORE}</p>"
        f'<div class="comments"><p>{LONG}</p></div></article>',
        ["Titel", LONG, MORE],
    ),
    "bare": (f"<html><body><h1>Titel</h1><p>{LONG}</p><p>{MORE}</p></body></html>", ["Titel", LONG, MORE]),
    "text alone": (LONG, [LONG]),
    "everything": (
        f'<nav><ul><li><a href="/x">x</a></li></ul></nav><div class="notice">{LONG}</div><div class="sidebar">{LONG}</div><article><h1>T</h1>'
        f'<p>{LONG}</p><aside>{MORE}</aside><p>{MORE}</p><section class="comments"><p>{LONG}</p></section></article><div class="ad">{MORE}</div>'
        f"<form><p>{LONG}</p></form><footer>{LONG}</footer>",
        ["T", LONG, MORE],
    ),
    "roles": (
        f'<div role="navigation"><a href=x>A</a></div><div role="main"><h2>T</h2><p>{LONG}</p><ul><li>Short.</li><li>{MORE}</li></ul></div>'
        f'<div role="complementary"><p>{MORE}</p></div><div role="contentinfo"><p>{LONG}</p></div>',
        ["T", LONG, "Short.", MORE],
    ),
    "page header": (f"<header><h1>Site</h1><p>{MORE}</p></header><article><h1>T</h1><p>{LONG}</p></article>", ["T", LONG]),
}


@pytest.mark.parametrize("name", list(CASES))
def test_layouts(model, name):
    page, wanted = CASES[name]
    assert labeller._extracted(model, [page])[0][0] == "\n\n".join(wanted)


def test_held_out_accuracy(model):
    words = "zorn albe trent qui sed morla vint oupe".split()
    prose = [" ".join(words[(i * j) % 8] for j in range(20 + i)) + "." for i in range(1, 9)]
    maker = layouts.Maker(prose, [" ".join(words[i : i + 3]) for i in range(6)], seed=77)
    pages, labels = [], []
    for _ in range(300):
        blocks, paths = htmlblocks.read(maker.page())
        blocks, label = labeller._split_marked(blocks)
        if blocks:
            pages.append((blocks, paths))
            labels.append(label)
    label = np.concatenate(labels)
    good = (labeller.probability(model, labeller.features(pages)) > 0.5) == (label == 1)
    assert good[label >= 0].mean() > 0.98


def test_pages_together_or_alone(model):
    """A page's blocks depend on that page alone."""
    given = [page for page, _ in CASES.values()]
    together = labeller._extracted(model, given)
    assert together == [labeller._extracted(model, [page])[0] for page in given]


def test_awkward_rows(spark, model):
    page = CASES["form within"][0]
    rows = [(1, "u", page, "x"), (1, "u", page, "x"), (None, None, page, "y"), (2, "v", None, None), (3, None, "", ""), (4, "w", "<nav><a href=x>x</a></nav>", "")]
    rows.append((5, "long", "<article>" + f"<p>{LONG}</p>" * 20_000 + "</article><footer>x</footer>", ""))
    df = spark.createDataFrame(rows, "page_id int, url string, html string, text string").repartition(3)
    found = labeller.main_text(df, model)
    assert found.columns == ["page_id", "url", "text", "n_blocks", "n_main"]
    got = sorted(((r.page_id or 0, r.url or "", r.text) for r in found.collect()))
    wanted = "\n\n".join(CASES["form within"][1])
    assert got[0] == (0, "", wanted) and got[1] == got[2] == (1, "u", wanted)
    assert got[3] == (2, "v", "") and got[4] == (3, "", "") and got[5] == (4, "w", "")
    assert got[6][2] == "\n\n".join([LONG] * 20_000)
    assert labeller.main_text(df.limit(0), model).count() == 0


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([(1, None)], "page_id int, html string")
    model = labeller.fit(none, n_layouts=600)
    page, wanted = CASES["everything"]
    assert labeller._extracted(model, [page])[0][0] == "\n\n".join(wanted)


def test_given_pages(spark, sf_dir, model):
    """The pages have one article each, whose tags are few."""
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    for r, (text, _, _) in zip(rows, labeller._extracted(model, [r.html for r in rows])):
        inside = re.search("<article>(.*)</article>", r.html, re.S)[1]
        blocks = [" ".join(b) for b in (texts_of(x) for x in re.split("</?(?:p|h1)>", inside)) if b]
        assert text == "\n\n".join(blocks)
