from __future__ import annotations

import itertools
import time

import numpy as np
import pytest

from indexpanel.llm import dom_crf as d
from indexpanel.llm.dom_blocks import blocks_of


@pytest.fixture(scope="module")
def model():
    return d.trained(d.labelled_pages(d.TRAINING_PAGES, d.SEED))


def test_held_out_accuracy(model):
    weights, moves = model
    right = total = 0
    for page in d.labelled_pages(200, 1234):
        rows, labels = d.labels_of(page)
        got = d.decoded([sum(weights.get(f, 0.0) for f in row) for row in rows], moves)
        right += sum(a == b for a, b in zip(got, labels, strict=True))
        total += len(labels)
    assert right / total > 0.99


PROSE = "This is a plain sentence of the article, long enough to be told from a menu. It has another one as well."


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", '<div class="content">{}</div>', "<div>{}</div>"])
def test_layouts(model, wrap):
    body = f"<h1>Title &amp; more</h1><p>{PROSE}<p><b>{PROSE}<br>next&nbsp;\n\t line</p><script>var t='</p>';</script>"
    page = ('<html><head><title>x</title><style>p{}</style></head><body><nav><ul><li><a href="/">Home</a></li><li><a href="/a">About us</a></li>'
            f'</ul></nav><div class="cookie-notice"><p>{PROSE}</p></div>' + wrap.format(body)
            + f'<section class="comments"><p>{PROSE}</p></section><footer>&copy; x &middot; y</footer></body></html>')
    assert d.main_text(page, *model) == f"Title & more\n{PROSE}\n{PROSE} next line"


def test_blocks_close_what_html_closes():
    page = "<ul><li>a<li>b <i>c</i></ul><table><tr><td>d<td>e</table><p>f<div>g</div></p>h<!-- <p>i --><template>j</template></x>&lt;k&gt; 1 < 2"
    assert [b.text for b in blocks_of(page)] == ["a", "b c", "d", "e", "f", "g", "h<k> 1 < 2"] or [b.text for b in blocks_of(page)] == [
        "a", "b c", "d", "e", "f", "g", "h", "<k> 1 < 2"]


@pytest.mark.parametrize("page", [
    f"<html><head><title>T</title><article><h1>H</h1><p>{PROSE}</p></article></html>",
    f"<html><title>T</title><article><h1>H</h1><p>{PROSE}</article>",
    f'<head><meta charset="utf-8"><style>p{{}}</style><article><h1>H<!-- x --></h1><p>{PROSE}</p></article>',
    f'<html><head><noscript><link rel="x"><img src="y"></noscript><script>var a</script><article><h1>H</h1><p>{PROSE}</p></article>',
    f"<html><head><title>T</title></head><article><h1>H</h1><p>{PROSE}</p></article>",
])
def test_pages_without_end_of_head_and_body(model, page):
    assert d.main_text(page, *model) == f"H\n{PROSE}"


def test_head_ends_at_text_and_holds_only_head_content():
    page = "<head><title>T</title><template><p>a</p></template>\n<style>b</style>c<p>d</p></head><p>e"
    assert [b.text for b in blocks_of(page)] == ["c", "d", "e"]


def test_text_in_math_and_noscript_is_kept(model):
    page = (f"<article><p>{PROSE} So <math><mi>x</mi><mspace/><mo>=</mo><mn>2</mn></math> holds.</p>"
            f"<noscript><p>{PROSE}</p></noscript></article>")
    assert [b.text for b in blocks_of(page)] == [f"{PROSE} So x=2 holds.", PROSE]
    assert d.main_text(page, *model) == f"{PROSE} So x=2 holds.\n{PROSE}"


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<p", "</p></p>", "<!-- open", "<script>x", "<p></p>", "<a href='x", "\x00"])
def test_odd_pages_do_not_fail(model, page):
    assert isinstance(d.main_text(page, *model), str)


@pytest.mark.parametrize("page", [
    f"<article><p data-x=it's>{PROSE}</p></article>",
    f'<article><p title="a"b">{PROSE}</p></article>',
    f'<article><p title=\'a > b\' x="</p>">{PROSE}</p></article>',
    f"<article><p a = b/c =d e=>{PROSE}</p ></article x>",
    f"<article><p><![CDATA[{PROSE}]]></p></article>",
    f'<article><iframe src="x"><p>{PROSE}</p></article>',
    f"<article><select><p>{PROSE}</p></article>",
    f"<article><iframe><p>hidden</p></IFRAME ><p>{PROSE}</p></article>",
    f"<article><script>if (a < b) x = '<p>no</p>';</script x><!--><p>{PROSE}</p><?pi x?><!x></article>",
    f'<body class="home page sidebar-right"><div class="has-sidebar"><article class="post tag-ads"><p>{PROSE}</p></article></div></body>',
    f'<body class="with-comments"><div class="layout with-menu"><ul class="menu"><li><a href="/">Home</a></li><li><a href="/">More</a></li></ul>'
    f'<main class="type-post"><p>{PROSE}</p></main><div class="sidebar"><ul><li><a href="/">Other</a></li></ul></div></div>',
])
def test_broken_markup_and_layout_words(model, page):
    assert d.main_text(page, *model) == PROSE


def test_text_outside_markup_is_whole():
    page = "<p>1 < 2 &lt;b&gt; a<b>b</b>c <3 &am<i>p;</i> <![CDATA[<x> &amp;]]></p><p>d</ x>e</p>f <g h"
    assert [b.text for b in blocks_of(page)] == ["1 < 2 <b> abc <3 &amp; <x> &amp;", "de", "f"]


@pytest.mark.parametrize("unit", [
    "<a '", "<a ", '<a b="', "<p a='", "<", "</", "<!--", "<![CDATA[", "</script", "<iframe>", "<svg>x", "<div>x", "<i><b>x</i>", "<div></x>",
    "<noscript>x", "<p x=", "<p/", "<p  ", '<div class="has-x">y'])
def test_time_grows_with_the_length_alone(model, unit):
    def seconds(n: int) -> float:
        start = time.process_time()
        d.main_text("<head>" + unit * n, *model)
        return time.process_time() - start

    assert seconds(80_000 // len(unit)) < 4.0
    assert seconds(320_000 // len(unit)) < 16.0


def test_scores_equal_the_sum_over_all_features(model):
    weights, _ = model
    for page in d.labelled_pages(30, 77):
        blocks = blocks_of(page)
        rows, _ = d.labels_of(page)
        assert d.scores(blocks, weights) == pytest.approx([sum(weights.get(f, 0.0) for f in row) for row in rows])
        assert all(len(row) == len(set(row)) for row in rows)


def test_viterbi_and_marginals_equal_sums_over_all_label_paths():
    rng = np.random.default_rng(3)
    for length in (1, 2, 3, 6):
        for _ in range(20):
            emission, moves = rng.normal(0, 2, length), rng.normal(0, 2, (3, 2))
            paths = list(itertools.product((0, 1), repeat=length))
            scores = np.array([moves[2][p[0]] + sum(moves[a][b] for a, b in itertools.pairwise(p)) + np.dot(p, emission) for p in paths])
            assert tuple(d.decoded(emission.tolist(), moves)) == paths[int(scores.argmax())]
            odds = np.exp(scores - scores.max())
            odds /= odds.sum()
            padded = np.zeros((1, 8))
            padded[0, :length] = emission
            share, pairs = d._marginals(padded, moves, np.arange(8)[None] < length)
            assert share[0, :length] == pytest.approx(odds @ np.array(paths))
            expected = np.zeros((3, 2))
            for p, o in zip(paths, odds, strict=True):
                expected[2][p[0]] += o
                for a, b in itertools.pairwise(p):
                    expected[a][b] += o
            assert pairs == pytest.approx(expected)


def test_query_shape(spark):
    rows = [(1, "u", f"<article><p>{PROSE}</p></article>", "z"), (1, "u", f"<article><p>{PROSE}</p></article>", "z"), (None, None, None, "z"),
            (2, "v", "<article>" + f"<p>{PROSE}</p>" * 3000 + "</article>", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = d.extracted(pages).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got) == sorted(
        [(1, PROSE, len(PROSE))] * 2 + [(0, "", 0), (2, "\n".join([PROSE] * 3000), 3001 * len(PROSE) - len(PROSE) + 2999)])
    assert d.extracted(pages.limit(0)).count() == 0
