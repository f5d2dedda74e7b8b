"""Unmarked pages with copies, and main content with frame words in its class."""

from assaymill.llm import pages

FRAME = "<p>Site</p><p>Menu</p><p>%s</p><p>Imprint</p>"


def test_copies_are_no_partners(spark):
    texts = {1: "one", 2: "one", 3: "one", 4: "four", 5: "one", 6: "six"}
    rows = [(i, f"http://h/a/{i}", FRAME % t) for i, t in texts.items()]
    rows += [(7, "http://copies/1", FRAME % "x"), (8, "http://copies/2", FRAME % "x")]  # nothing to difference with
    rows += [(9, "http://part/1", "<p>Site</p><p>Menu</p>"), (10, "http://part/2", FRAME % "more")]
    rows += [(11, "http://v/1", FRAME % "old"), (11, "http://v/1", FRAME % "new"), (12, "http://v/2", FRAME % "old"), (13, "http://v/3", FRAME % "z")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r.page_id, r.text) for r in pages.extract(df).collect())
    want = list(texts.items()) + [(7, "Site Menu x Imprint"), (8, "Site Menu x Imprint"), (9, "Site Menu"), (10, "more Imprint")]
    assert got == sorted(want + [(11, "old"), (11, "new"), (12, "old"), (13, "z")])


def test_class_of_main_content_is_no_frame():
    page = '<nav>m</nav><main class="has-sidebar"><article class="post comments-open" id="share"><p>Text<article class="comment">me</article></article></main>'
    assert pages.blocks(page) == (["Text"], True)
    assert pages.blocks('<article class="search">a</article><div class="comments"><article class="comment">b</article></div>') == (["a"], True)
    assert pages.blocks('<main hidden>a</main><p>b') == (["b"], False)
