"""Frames of pages: what is closed, what is not, comments, and blocks of the article's own."""

import random
import tracemalloc

from assaymill.llm import pages


def text(page):
    return " ".join(pages.blocks(page)[0])


def test_closed_frames_go_with_the_articles_inside():
    after = '<section id="comments"><article>reader comment</article></section>'
    assert text(f"<main><p>Body</p></main>{after}") == "Body"
    assert text("<aside><article>teaser</article></aside><article>real</article>") == "real"
    assert text("<aside><article>teaser</aside><article>real</article>") == "real"


def test_frames_that_are_not_closed():
    assert text("<nav><ul><li>x</ul><article>real</article>") == "real"
    assert text('<div class="ad">zz<article>real</article>') == "real"
    assert text("<article>a<aside>b</article><article>c</article>") == "a c"
    assert text('<div id=w><article>a<div class="ad">b</article></div><article>c</article>') == "a c"


def test_articles_inside_an_article_are_comments():
    assert text("<article>main<article>comment</article> tail</article>") == "main tail"
    assert text("<main><article>one</article><article>two</article></main>") == "one two"


def test_blocks_of_the_article_itself():
    own = '<div class="related-work">b</div><p class="notice">c</p><ul class="menu"><li>d</li></ul>'
    frames = '<div class="ad">x</div><div class="share-buttons">y</div><div id="cookie-notice">z</div>'
    assert text(f"<article><p>a</p>{own}{frames}</article>") == "a b c d"


def test_empty_article_does_not_empty_the_page():
    assert pages.blocks("<article> </article><p>text here</p>") == (["text here"], False)


def test_many_frames_take_linear_time():
    assert pages.blocks("<nav>" * 50_000 + "<div class=ad>" * 50_000) == ([], False)
    assert text("<nav>x</nav>" * 50_000 + "y") == "y"


def test_shared_lines_need_little_memory():
    rng = random.Random(5)
    own = [rng.randrange(1 << 60) for _ in range(10_000)]
    other = [x if rng.random() < 0.5 else rng.randrange(1 << 60) for x in own]
    tracemalloc.start()
    found = pages.shared_lines(own, other)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == {i for i, (x, y) in enumerate(zip(own, other)) if x == y}
    assert peak < 8 << 20  # rows of all lines would take 12.5 MB
