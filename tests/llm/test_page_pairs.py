"""Pages that mark their main content are differenced too, and the structure of both pages checks it."""

from assaymill.llm import pages


def texts(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.text for r in pages.extract(df).collect()}


def test_frame_inside_marked_content(spark):
    """What the nearest page shows outside its article is frame; what both articles say is not."""
    rows = [
        (1, "http://h/a/1", "<nav>m</nav><article><p>one</p><p>License</p></article><p>Follow us</p>"),
        (2, "http://h/a/2", "<nav>m</nav><article><p>two</p><p>License</p><p>Follow us</p></article>"),
        (3, "http://h/b/1", "<nav>two</nav><article><p>Follow us</p></article>"),
    ]
    assert texts(spark, rows) == {1: "one License", 2: "two License", 3: "Follow us"}


def test_unmarked_page_beside_marked_ones(spark):
    rows = [
        (1, "http://h/a/1", "<p>Site</p><article><p>one</p><p>License</p></article><p>Imprint</p>"),
        (2, "http://h/a/2", "<p>Site</p><p>two</p><p>License</p><p>Imprint</p>"),
        (3, "http://k/a/1", "<p>Site</p><article><p>one</p></article>"),
    ]
    assert texts(spark, rows) == {1: "one License", 2: "two License", 3: "one"}


def test_lines_of_the_whole_page():
    page = "<head><title>t</title></head><nav>a<p>b<i>c</i></nav>x<article>y<div class=ad>z<script>q</script></article><footer>f"
    kinds = [("a", pages.FRAME), ("bc", pages.FRAME), ("x", pages.LOOSE), ("y", pages.MARKED), ("z", pages.FRAME), ("f", pages.FRAME)]
    assert pages.lines(page) == kinds
