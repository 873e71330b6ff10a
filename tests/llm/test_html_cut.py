"""Main text of pages: what the cut and the model decide, and what counts as an article's own text."""

import itertools
import random

import pytest

from postsieve.llm import html_text as H

#: Sentences, links and short pieces in elements that say nothing.
LONG = "This is a sentence of the story, which has commas, words and a full stop."
SHORT = "Then nothing"
LINK = "<a href='/x'>More</a>"
POINTER = "The whole report is here"
SOUP = f"<div><p>{LONG}</p><p><a href='/r'>{POINTER}</a></p><p>{LONG}</p></div><div><div>{LINK}</div><div>{LINK}</div><div>{LINK}</div></div>"


@pytest.fixture(scope="module")
def weights(spark):
    rng = random.Random(3)
    pages = []
    for k in range(40):
        story = "".join(f"<p>{LONG * rng.randint(1, 3)}</p>" for _ in range(4))
        menu = "".join(f"<li><a href='/{n}'>Menu {n}</a>" for n in range(rng.randint(3, 9)))
        pages.append((k, f"<nav><ul>{menu}</ul></nav><article><h1>Title</h1>{story}</article><footer>Imprint</footer>"))
    return H.train(spark.createDataFrame(pages, "page_id long, html string"))


def kept(page, weights, smooth=True):
    blocks = H.blocks_of(page)
    return [b.text for b, keep in zip(blocks, H.label(blocks, weights, smooth)) if keep]


def test_model_and_cut_decide(weights):
    """Each alone is wrong on a page whose elements say nothing."""
    assert kept(SOUP, weights) == [LONG, POINTER, LONG]
    assert kept(SOUP, weights, smooth=False) == [LONG, LONG]
    assert kept(SOUP, []) == []
    # Nothing on its own is unbeatable: what surrounds a block can outweigh each mark.
    most = max(H.BAD_TAG_COST, H.BAD_NAME_COST, H.GOOD_TAG_COST)
    assert most - H.LOOKS <= 2 * H.SMOOTH


def price(blocks, weights, labels):
    """The cost of a labelling, written out anew: terms of single blocks, then of pairs."""
    total = 0.0
    for b, content in zip(blocks, labels):
        looks = min(H.LOOKS, max(-H.LOOKS, sum(w * f for w, f in zip(weights, b.features))))
        wants = looks - b.bad if b.bad else looks + b.good
        total += max(0.0, -wants) if content else max(0.0, wants)
    for j, k in itertools.combinations(range(len(blocks)), 2):
        if labels[j] == labels[k]:
            continue
        a, b = blocks[j], blocks[k]
        share = 1.0 if a.mark == b.mark else H.APART
        if k == j + 1:
            steps = max(0, a.depth + b.depth - 2 * b.shared - 2)
            total += H.SMOOTH * share / (1 + steps) ** 2
        elif a.parent == b.parent and not any(blocks[i].parent == a.parent for i in range(j + 1, k)):
            total += H.SMOOTH / 2 * share
    return total


def test_whole_pages_by_brute_force(weights):
    """No labelling of a page is cheaper than the one found."""
    rng, decided = random.Random(5), 0
    pieces = [LONG, SHORT, LINK, f"{SHORT} {LINK}", "", "42"]
    for _ in range(150):
        page = ""
        for _ in range(rng.randint(1, 3)):
            inner = "".join(f"<{t}>{rng.choice(pieces)}</{t}>" for t in rng.choices(["p", "li", "div", "h2"], k=rng.randint(1, 3)))
            name = rng.choice(["div", "div class=ad", "section", "article", "nav", "ul", "div class=content"])
            page += f"<{name}>{inner}</{name.split()[0]}>"
        blocks = H.blocks_of(page)
        labels = H.label(blocks, weights)
        best = min(price(blocks, weights, c) for c in itertools.product([False, True], repeat=len(blocks)))
        assert abs(price(blocks, weights, labels) - best) < 1e-9
        decided += labels != H.label(blocks, weights, smooth=False)
    assert decided > 0


ARTICLE = f"<article><h1>Title</h1><p>{LONG}</p>%s<p>{LONG}</p></article>"


@pytest.mark.parametrize(
    "inside, text",
    [
        ("<p>So <math><mi>a</mi><mo>+</mo><mn>1</mn></math> holds.</p>", "So a+1 holds."),
        ("<object data='x'><p>Instead of a picture, words.</p></object>", "Instead of a picture, words."),
        ("<p hidden>Shown later, when asked for.</p>", "Shown later, when asked for."),
        ("<p style='display: none'>Shown later, when asked for.</p>", "Shown later, when asked for."),
        ("<p aria-hidden='true'>Not read aloud.</p>", "Not read aloud."),
        ("<section class='discussion'><p>We find that it works, mostly.</p></section>", "We find that it works, mostly."),
        ("<h2 id='trending'>Trending now</h2>", "Trending now"),
        ("<table class='form'><tr><td>A cell</table>", "A cell"),
        ("<p>Comments</p>", "Comments"),
        ("<div><p>Some text, and more.</p><h2>Comments</h2><p>Of the minister, as told.</p></div>", "Of the minister, as told."),
    ],
)
def test_own_text_stays(weights, inside, text):
    assert text in kept(ARTICLE % inside, weights) and kept(ARTICLE % inside, weights).count(LONG) == 2


@pytest.mark.parametrize("inside", ["<div class='ad'>%s</div>", "<form><p>%s</p></form>", "<aside><p>%s</p></aside>",
                                    "<div class='notice'><p>%s</p></div>", "<nav>%s</nav>", "<select><option>%s</select>"])
def test_foreign_text_goes(weights, inside):
    """Also where it looks like the article's."""
    prose = "Buy this, which is a fine thing, and buy it today."
    assert kept(ARTICLE % (inside % prose), weights) == ["Title", LONG, LONG]


@pytest.mark.parametrize("title", ["Comments", "3 Comments", "Kommentare", "Reader comments (12)", "Commentaires :"])
def test_comments_without_a_name(weights, title):
    said = "<p>I like it, it is a nice one, thanks.</p>" * 4
    page = ARTICLE % "" + f"<section><h2>{title}</h2><div>{said}</div></section>"
    assert kept(page, weights) == ["Title", LONG, LONG]
    assert kept(ARTICLE % f"<section><h2>{title}</h2><div>{said}</div></section>", weights) == ["Title", LONG, LONG]


def test_training_is_bounded(spark, weights, monkeypatch):
    """Rows of one page count once, with or without an id, and a sample of one page is one page."""
    page = f"<nav>{LINK}</nav>" + ARTICLE % ""
    one = H.train(spark.createDataFrame([(1, page)], "page_id long, html string"))
    many = spark.createDataFrame([(1, page)] * 300, "page_id long, html string")
    assert H.train(many) == one and any(one)
    got = []
    monkeypatch.setattr(H, "fit", lambda rows, labels: got.append(len(rows)))
    blocks = len(H.blocks_of(page))
    others = spark.createDataFrame([(1, page + " " * k) for k in range(50)] + [(None, page)] * 20, "page_id long, html string")
    H.train(others, sample=7)
    H.train(many)
    assert got == [7 * blocks, blocks]
