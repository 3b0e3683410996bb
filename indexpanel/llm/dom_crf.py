"""Main text of pages by a linear-chain conditional random field over DOM leaf blocks.

A block's features are its ancestors' tags, the words in their class, id and role, and traits of its text; a page is a
chain of blocks labelled main text or not, decoded by Viterbi. The field is trained by maximum likelihood with an L2 penalty
on TRAINING_PAGES labelled pages, which `labelled_pages` writes from layouts with known parts; that number is the bound of the
training set. Pages are decoded where they lie, one after the other; no page meets another.

A page takes time and memory by its length, whatever its markup: very long ones, unclosed tags and quotes, deep nesting.

Defined results: null, empty and text-free html give an empty text; unclosed and stray tags are closed by the rules of
HTML or skipped, and a frame or other hidden element without an end hides nothing; text in CDATA sections is text; repeated
rows give repeated results; an empty table gives an empty result. Further columns of `pages`, also one named like an output
column, are not read.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexpanel.llm.common import map_arrow, quoted
from indexpanel.llm.dom_blocks import blocks_of, features, label_of, scores

TRAINING_PAGES = 400
SEED = 5
STEPS = 300
RATE = 0.15
PENALTY = 0.00005

# Parts of training pages: (tag, class or id words) of containers, main or not.
MAIN = [("article", ""), ("article", "post"), ("main", ""), ("div", "content"), ("div", "article-body"), ("section", "story"),
        ("div", "entry-content"), ("div", "post-text"), ("div", "mainContent"), ("div", ""), ("body", ""), ("div", "page")]
# Classes of wrappers and articles that name parts of the page without being one.
LAYOUTS = ["wrapper", "container", "page has-sidebar", "layout with-menu", "row no-ads", "site sidebar-right", "columns sidebar-left",
           "with-footer grid", "has-comments page", "outer"]
FILED = ["", "", "", " tag-ads", " category-menu", " tag-sidebar hentry", " has-comments", " format-standard", " tag-promo topic-forms",
         " type-post cat-footer"]
OTHER = {
    "menu": [("nav", ""), ("nav", "menu"), ("div", "navbar"), ("ul", "menu-items"), ("div", "breadcrumbs"), ("div", "navigation"),
             ("div", "tabs"), ("header", "topnav")],
    "header": [("header", ""), ("div", "header"), ("div", "masthead"), ("div", "site-title"), ("header", "banner")],
    "footer": [("footer", ""), ("div", "footer"), ("div", "copyright"), ("footer", "site-footer"), ("div", "legal")],
    "sidebar": [("aside", ""), ("div", "sidebar"), ("aside", "related"), ("div", "widget"), ("div", "recommended"), ("div", "popular"),
                ("section", "more-stories"), ("div", "trending"), ("div", "share-buttons"), ("div", "social"), ("div", "tags")],
    "notice": [("div", "cookie-notice"), ("div", "consent"), ("div", "gdpr-banner"), ("div", "popup"), ("div", "modal"),
               ("div", "alert"), ("div", "notice"), ("div", "subscribe"), ("div", "newsletter"), ("div", "paywall")],
    "advert": [("div", "ad"), ("div", "ads"), ("div", "advert"), ("div", "advertisement"), ("div", "sponsored"), ("aside", "promo"),
               ("div", "adslot"), ("section", "sponsor")],
    "form": [("form", ""), ("form", "search"), ("form", "login"), ("form", "signup"), ("form", "contact")],
    "comments": [("div", "comments"), ("section", "comment-list"), ("ol", "commentlist"), ("div", "discussion"),
                 ("div", "replies"), ("section", "responses"), ("div", "disqus")],
}


def _words(rng: random.Random, low: int, high: int) -> str:
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(rng.randint(low, high))]
    return " ".join(words).capitalize()


def _prose(rng: random.Random) -> str:
    return ". ".join(_words(rng, 4, 16) for _ in range(rng.randint(1, 5))) + rng.choice([".", ".", ".", "?", "!", ""])


def _opened(tag: str, name: str, label: int) -> str:
    attribute = f' class="{name}"' if name else ""
    return f'<{tag}{attribute} data-label="{label}">'


def _other(rng: random.Random, kind: str) -> str:
    tag, name = rng.choice(OTHER[kind])
    items = []
    for _ in range(rng.randint(1, 6)):
        if kind == "menu" or kind == "sidebar" and rng.random() < 0.6:
            items.append(f'<li><a href="/x">{_words(rng, 1, 5 if kind == "menu" else 10)}</a></li>')
        elif kind == "comments":
            items.append(f'<div class="{rng.choice(["comment", "reply", "user", "post"])}"><b>{_words(rng, 1, 2)}</b>'
                         f"<p>{_prose(rng)}</p></div>")
        elif kind == "footer":
            items.append(rng.choice(["<p>&copy; {}</p>", "<span>{}</span>", '<a href="/t">{}</a>', "&copy; {}. "]).format(_words(rng, 1, 9)))
        elif kind == "form":
            items.append(rng.choice(["<label>{}</label><input>", "<button>{}</button>", "<p>{}</p>"]).format(_words(rng, 1, 8)))
        elif kind == "header":
            items.append(rng.choice(["<h1>{}</h1>", "<p>{}</p>", '<a href="/">{}</a>', "<div>{}</div>"]).format(_words(rng, 1, 7)))
        else:
            items.append(rng.choice(["<p>{}</p>", "<div>{}</div>", "{} ", "<span>{}</span>"]).format(rng.choice([_prose(rng), _words(rng, 1, 12)])))
    return _opened(tag, name, 0) + "".join(items) + f"</{tag}>"


def _main(rng: random.Random) -> str:
    tag, name = rng.choice(MAIN)
    parts = [f"<h1>{_words(rng, 2, 10)}</h1>"] if rng.random() < 0.8 else []
    for _ in range(rng.randint(1, 14)):
        shape = rng.random()
        if shape < 0.7:
            lead = rng.choice(["", "", "<b>", '<a href="/y">' + _words(rng, 1, 3) + "</a> "])
            parts.append(f"<p>{lead}{_prose(rng) if rng.random() < 0.9 else _words(rng, 1, 6)}</p>")
        elif shape < 0.76:
            parts.append(f"<h2>{_words(rng, 1, 7)}</h2>")
        elif shape < 0.82:
            parts.append("<ul>" + "".join(f"<li>{_words(rng, 1, 14)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>")
        elif shape < 0.86:
            parts.append(f"<blockquote>{_prose(rng)}</blockquote>")
        elif shape < 0.90:
            parts.append(f"<div>{_prose(rng)}</div>")
        else:
            parts.append(_other(rng, rng.choice(["advert", "sidebar", "notice", "form"])))
    body = "".join(parts)
    if tag == "body":
        return f'<section data-label="1">{body}</section>' if rng.random() < 0.3 else f'<div data-label="1">{body}</div>'
    return _opened(tag, (name + rng.choice(FILED)).strip(), 1) + body + f"</{tag}>"


def labelled_pages(n: int, seed: int) -> list[str]:
    """Pages whose parts carry data-label 1 (main text) or 0; the attribute is the label, not a feature."""
    rng = random.Random(seed)
    pages = []
    for _ in range(n):
        above = [_other(rng, k) for k in ("notice", "header", "menu", "advert", "form") if rng.random() < 0.6]
        below = [_other(rng, k) for k in ("sidebar", "form", "comments", "advert", "notice") if rng.random() < 0.45]
        rng.shuffle(above)
        rng.shuffle(below)
        wrapped = rng.random() < 0.4
        opened = f'<div class="{rng.choice(LAYOUTS)}">' * wrapped
        pages.append("<html><head><title>x</title></head><body>" + opened + "".join(above) + _main(rng)
                     + "".join(below) + (_other(rng, "footer") if rng.random() < 0.8 else "") + "</div>" * wrapped + "</body></html>")
    return pages


def labels_of(page: str) -> tuple[list[list[str]], list[int]]:
    """Features and labels of the blocks of a labelled page; the innermost data-label counts."""
    blocks = blocks_of(page)
    return [features(b, i / max(1, len(blocks) - 1)) for i, b in enumerate(blocks)], [label_of(b) for b in blocks]


def trained(pages: list[str]) -> tuple[dict[str, float], np.ndarray]:
    """Weights of the features for main text against the rest, and the 3 x 2 scores of transitions (row 2: from the start)."""
    chains = [labels_of(p) for p in pages]
    chains = [c for c in chains if c[1]]
    names = {f: i for i, f in enumerate(sorted({f for rows, _ in chains for row in rows for f in row}))}
    n, longest = len(chains), max(len(y) for _, y in chains)
    y, real = np.zeros((n, longest), int), np.zeros((n, longest), bool)
    cell, feature = [], []
    for i, (rows, marks) in enumerate(chains):
        y[i, :len(marks)], real[i, :len(marks)] = marks, True
        for t, row in enumerate(rows):
            cell += [i * longest + t] * len(row)
            feature += [names[f] for f in row]
    cell, feature = np.array(cell), np.array(feature)
    weights, moves = np.zeros(len(names)), np.zeros((3, 2))
    state = [[np.zeros_like(v) for _ in range(2)] for v in (weights, moves)]
    total = real.sum()
    for step in range(1, STEPS + 1):
        emission = np.bincount(cell, weights[feature], n * longest).reshape(n, longest)
        share, pairs = _marginals(emission, moves, real)
        slope = np.bincount(feature, ((y - share) * real).ravel()[cell], len(names)) / total - PENALTY * weights
        seen = np.zeros((3, 2))
        np.add.at(seen, (2, y[:, 0]), 1)
        inner = real[:, 1:]
        np.add.at(seen, (y[:, :-1][inner], y[:, 1:][inner]), 1)
        turn = (seen - pairs) / total - PENALTY * moves
        for (m, v), value, g in zip(state, (weights, moves), (slope, turn), strict=True):  # Adam, upwards
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            value += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return {f: float(weights[i]) for f, i in names.items()}, moves


def _marginals(emission: np.ndarray, moves: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of main text per block, and expected numbers of transitions, by forward and backward sums."""
    n, longest = emission.shape
    score = np.stack([np.zeros_like(emission), emission], axis=2)
    forward, backward = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
    forward[:, 0] = moves[2] + score[:, 0]
    for t in range(1, longest):
        step = np.logaddexp(forward[:, t - 1, 0, None] + moves[0], forward[:, t - 1, 1, None] + moves[1]) + score[:, t]
        forward[:, t] = np.where(real[:, t, None], step, forward[:, t - 1])
    for t in range(longest - 2, -1, -1):
        ahead = score[:, t + 1] + backward[:, t + 1]
        step = np.logaddexp(moves[:2, 0] + ahead[:, 0, None], moves[:2, 1] + ahead[:, 1, None])
        backward[:, t] = np.where(real[:, t + 1, None], step, 0.0)
    whole = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
    share = np.exp(forward + backward - whole[:, None, None])
    pairs = np.zeros((3, 2))
    pairs[2] = share[:, 0].sum(axis=0)
    joint = np.exp(forward[:, :-1, :, None] + moves[:2] + (score + backward)[:, 1:, None, :] - whole[:, None, None, None])
    pairs[:2] = joint[real[:, 1:]].sum(axis=0)
    return share[:, :, 1], pairs


def decoded(emission: list[float], moves: np.ndarray) -> list[int]:
    """The likeliest labels (Viterbi)."""
    if not emission:
        return []
    (a, b), (c, d), (e, f) = moves.tolist()
    rest, main, back = e, f + emission[0], []
    for x in emission[1:]:
        from_main = (c + main > a + rest, d + main > b + rest)
        rest, main = max(a + rest, c + main), max(b + rest, d + main) + x
        back.append(from_main)
    labels = [int(main > rest)]
    for step in reversed(back):
        labels.append(int(step[labels[-1]]))
    return labels[::-1]


def main_text(page: str | None, weights: dict[str, float], moves: np.ndarray) -> str:
    blocks = blocks_of(page)
    labels = decoded(scores(blocks, weights), moves)
    return "\n".join(b.text for b, label in zip(blocks, labels, strict=True) if label)


def extracted(pages: DataFrame, html: str = "html", training_pages: int = TRAINING_PAGES, seed: int = SEED) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    weights, moves = trained(labelled_pages(training_pages, seed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p, weights, moves) for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.col(quoted(html)).alias("html"))
    return map_arrow(rows, run, "page_id long, url string, text string, n_chars long")
