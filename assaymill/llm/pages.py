"""Main text of web pages: page structure, and differencing against nearest-URL pages.

A page is cut into text blocks. Blocks inside menus, headers, footers, sidebars, notices,
adverts, forms, comments and the like are frame by element, role and class. Every page
is paired with the page of the nearest URL on its host: the one with the longest common
path of directories, the smallest page id among those, copies of the page left out. Pages that
mark their main content (``article``, ``main``) are paired with such pages, the others with others,
or with marked pages where there are none. The two pages' lines are aligned by longest common subsequence, and
the shared lines, which are the site's frame, are deleted, unless that were the whole text.

What is deleted is checked against the structure of both pages. Differencing alone can't give right
results where articles repeat on a host, as it deletes every shared paragraph of theirs and keeps
menus that differ (see the README for figures). So a line of marked content stays unless the other
page has it outside its own marked content and frames, and what lies outside goes, shared or not.

A NULL html gives the empty text. Pages without a usable URL pair among themselves. Rows with
equal lines or with a common id are no partners for each other; pages without an id come last.
"""

from __future__ import annotations

import html as entities
import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaymill.llm.common import append_columns
from assaymill.session import materialize

# Elements and class words.
RAW = {"script", "style", "textarea", "title", "xmp", "noembed", "noframes"}
DROPPED = {
    "head", "nav", "header", "footer", "aside", "form", "noscript", "template", "iframe", "svg", "canvas",
    "button", "select", "object", "dialog", "menu", "video", "audio", "map", "math",
}
#: Places of a line whose bits are set anew for each use; more have a mask of their own.
FEW_PLACES = 64
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
    "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
    "time", "tt", "u", "var", "wbr", "img",
}
MAIN = {"article", "main"}
#: Elements of running text: inside main content their class says how they look, not what they are.
PROSE = {
    "p", "ul", "ol", "li", "dl", "dt", "dd", "blockquote", "pre", "table", "tr", "td", "th", "figure", "figcaption",
    "h1", "h2", "h3", "h4", "h5", "h6", "br", "hr",
}
FRAME_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "banner",
    "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "popup", "modal", "newsletter", "subscribe",
    "sidebar", "widget", "related", "recommended", "share", "sharing", "social", "breadcrumb", "breadcrumbs", "menu",
    "nav", "navbar", "navigation", "footer", "masthead", "comment", "comments", "disqus", "replies", "pagination",
    "pager", "login", "signup", "search", "skip", "toc",
}
HOLDERS = {
    "area", "articles", "bar", "block", "bottom", "box", "buttons", "container", "left", "links", "list", "panel",
    "posts", "right", "section", "top", "wrapper",
}
FRAME_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu"}

#: What a line is by its page's structure. On a page that marks no main content, loose lines are the text.
FRAME, LOOSE, MARKED = range(3)

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_WORDS = re.compile(r"[a-z0-9]+")
_RAW_ENDS = {name: re.compile(rf"</{name}\s*[^>]*>", re.I) for name in RAW}


def _names_frame(token: str) -> bool:
    """Whether a class or id says "frame" by its head word: "cookie-notice", but not "related-work"."""
    words = _WORDS.findall(token)
    while len(words) > 1 and words[-1] in HOLDERS:
        words.pop()
    return bool(words) and words[-1] in FRAME_WORDS


def _is_frame(name: str, attributes: str, inside_main: bool, words: bool = True) -> bool:
    """Whether an element is part of the frame; ``words``: also by its class and id."""
    if name in DROPPED:
        return not (name == "header" and inside_main)
    if not attributes or name in ("html", "body"):
        return False
    values = {k.lower(): (v or "").strip("\"'").lower() for k, v in _ATTRIBUTE.findall(attributes)}
    if "hidden" in values or values.get("aria-hidden") == "true":
        return True
    if "display:none" in values.get("style", "").replace(" ", "") or values.get("role") in FRAME_ROLES:
        return True
    if not words:
        return False
    named = f"{values.get('class', '')} {values.get('id', '')}"
    if inside_main:
        return name not in PROSE and any(map(_names_frame, named.split()))
    return not FRAME_WORDS.isdisjoint(_WORDS.findall(named))


def _is_main(name: str, attributes: str) -> bool:
    return name in MAIN or bool(re.search(r"""role\s*=\s*["']?main\b""", attributes, re.I))


def _raw_end(page: str, name: str, at: int) -> int:
    """The end of an element whose content, from ``at`` on, is no markup."""
    ended = _RAW_ENDS[name].search(page, at)
    return ended.end() if ended else len(page)


def closed_at(page: str) -> dict[int, int]:
    """The end of each element that is closed, by the place of its opening tag.

    An element is closed by the next tag of its name that closes no other one, within the main
    content that it stands in: what is open there when that ends was never closed.
    """
    ends: dict[int, int] = {}
    scopes: list[tuple[str, dict[str, list[int]]]] = [("", {})]
    at = 0
    while (begin := page.find("<", at)) >= 0:
        tag = _TAG.match(page, begin)
        at = tag.end() if tag else begin + 1
        if not tag or tag[2] is None:
            continue
        closing, name, attributes = tag[1] == "/", tag[2].lower(), tag[3]
        if not closing and name in RAW:
            at = _raw_end(page, name, at)
        elif not closing and name not in VOID and not attributes.endswith("/"):
            scopes[-1][1].setdefault(name, []).append(begin)
            if name in MAIN:
                scopes.append((name, {}))
        elif closing:
            # Main content is opened in one scope and has the next one to itself.
            held = next((i for i in range(len(scopes) - 1, -1, -1) if scopes[i][1].get(name)), None)
            if held is not None:
                del scopes[held + 1 :]
                ends[scopes[held][1][name].pop()] = at
    return ends


def blocks(page: str | None) -> tuple[list[str], bool]:
    """The text blocks outside the page's frame, and whether they are marked main content.

    Marked content without any text counts as not marked.
    """
    found = lines(page)
    marked = [text for text, kind in found if kind == MARKED]
    return (marked, True) if marked else ([text for text, kind in found if kind == LOOSE], False)


def lines(page: str | None) -> list[tuple[str, int]]:
    """The text blocks of the whole page in its order, each with its kind.

    A frame element goes with all it holds, up to its closing tag. One that is never closed ends
    where main content begins or ends. An article inside an article is a reader's comment.
    """
    page = page or ""
    ends = closed_at(page)
    found: list[tuple[str, int]] = []
    parts: list[str] = []
    frame: str | None = None  # the element that is being dropped, and depth: of its own kind
    depth = inner = 0  # inner: elements inside it that are named like the open main content
    mains: list[str] = []

    def end_block() -> None:
        text = " ".join(entities.unescape("".join(parts)).split())
        parts.clear()
        if text:
            found.append((text, FRAME if frame is not None else MARKED if mains else LOOSE))

    at = 0
    size = len(page)
    while at < size:
        begin = page.find("<", at)
        tag = _TAG.match(page, begin) if begin >= 0 else None
        if begin < 0 or not tag:
            stop = size if begin < 0 else begin + 1
            parts.append(page[at:stop])
            at = stop
            continue
        if begin > at:
            parts.append(page[at:begin])
        at = tag.end()
        if tag[2] is None:
            continue
        closing, name, attributes = tag[1] == "/", tag[2].lower(), tag[3]
        if not closing and name in RAW:
            at = _raw_end(page, name, at)
            if name != "title" and frame is None and name == "textarea":
                end_block()
            continue
        # The class of main content says how the page looks; inside a frame or another
        # article, one with such a class is a comment or the like.
        worded = frame is not None or "article" in mains
        is_main = not closing and _is_main(name, attributes) and not _is_frame(name, attributes, False, worded)
        comment = name == "article" and "article" in mains
        is_main = is_main and not comment
        if frame is not None:
            if name not in INLINE:
                end_block()
            if is_main and depth and frame not in ("template",) and not mains:
                frame = None  # an element of the frame was never closed
            else:
                if name == frame and not attributes.endswith("/"):
                    depth += -1 if closing else 1
                    if not depth:
                        end_block()
                        frame = None
                elif mains and name == mains[-1] and (inner or not closing):
                    inner += -1 if closing else 1
                elif closing and name in ("body", "html", *mains[-1:]):
                    end_block()
                    frame = None
                if frame is not None or not closing or name not in mains:
                    continue
        if name not in INLINE:
            end_block()
        if closing:
            if mains and name == mains[-1]:
                mains.pop()
        elif is_main:
            mains.append(name)
        elif name not in VOID and not attributes.endswith("/") and (
            comment or _is_frame(name, attributes, bool(mains))
        ):
            end_block()
            if begin in ends:
                found += [(text, FRAME) for text in _plain_lines(page, at, ends[begin])]
                at = ends[begin]
            else:
                frame, depth, inner = name, 1, 0
    end_block()
    return found


def _plain_lines(page: str, at: int, end: int) -> list[str]:
    """The text blocks between two places, whatever elements they stand in."""
    out: list[str] = []
    parts: list[str] = []

    def end_block() -> None:
        text = " ".join(entities.unescape("".join(parts)).split())
        parts.clear()
        if text:
            out.append(text)

    while at < end:
        begin = page.find("<", at, end)
        if begin < 0:
            parts.append(page[at:end])
            break
        tag = _TAG.match(page, begin, end)
        parts.append(page[at : begin if tag else begin + 1])
        at = tag.end() if tag else begin + 1
        if tag and tag[2] is not None:
            name = tag[2].lower()
            if tag[1] != "/" and name in RAW:
                at = _raw_end(page, name, at)
            elif name not in INLINE:
                end_block()
    end_block()
    return out


def shared_lines(own: list[int], other: list[int]) -> set[int]:
    """Places in ``own`` on one longest common subsequence with ``other``."""
    return set(aligned_lines(own, other))


def aligned_lines(own: list[int], other: list[int]) -> dict[int, int]:
    """Places in ``own`` on one longest common subsequence with ``other``, each with its place there.

    Bit-parallel: a zero bit ``j`` in a row means that the length grows at column ``j``. Every
    ``n``-th row is kept, ``n`` being the root of their number, and the rows between two of them are
    made again on the way back, so that memory grows with that root and not with the lines.
    """
    places: dict[int, list[int]] = {}
    for j, x in enumerate(other):
        places.setdefault(x, []).append(j)
    masks = {x: sum(1 << j for j in at) for x, at in places.items() if len(at) > FEW_PLACES}
    full = (1 << len(other)) - 1

    def after(row: int, x: int) -> int:
        mask = masks.get(x)
        if mask is None:
            mask = sum(1 << j for j in places.get(x, ()))
        hit = row & mask
        return ((row + hit) | (row - hit)) & full if hit else row

    step = math.isqrt(len(own)) + 1
    kept, row = [], full
    for i, x in enumerate(own):
        if i % step == 0:
            kept.append(row)
        row = after(row, x)
    out = {}
    j = len(other)
    for k in range(len(kept) - 1, -1, -1):
        first = k * step
        rows = [kept[k]]
        for x in own[first : first + step]:
            rows.append(after(rows[-1], x))
        i = len(rows) - 1
        while i and j:
            if own[first + i - 1] == other[j - 1]:
                i, j = i - 1, j - 1
                out[first + i] = j
            elif rows[i] >> (j - 1) & 1:
                j -= 1
            else:
                i -= 1
    return out


def line_hash(line: str | bytes) -> int:
    return xxhash.xxh64_intdigest(line) - (1 << 63)


def _parsed(pages: DataFrame) -> DataFrame:
    """Per page the hashes and kinds of its lines, and ``text``, a hash of those that are its text.

    Of a page that marks no main content the frames by structure are left out: nothing else is known
    of its lines, and what they share with the other page is all frame.
    """
    fields = [
        T.StructField("hashes", T.ArrayType(T.LongType())),
        T.StructField("kinds", T.BinaryType()),
        T.StructField("marked", T.BooleanType()),
        T.StructField("text", T.LongType()),
    ]

    def start():
        def step(htmls):
            rows = []
            for html in htmls:
                found, marked = _sequence(html.as_py())
                hashes = np.array([line_hash(text) for text, _ in found], np.int64)
                kinds = np.array([kind for _, kind in found], np.uint8)
                own = hashes[kinds == (MARKED if marked else LOOSE)]
                rows.append((hashes, kinds.tobytes(), marked, line_hash(own.tobytes())))
            return [pa.array(list(c), t) for c, t in zip(zip(*rows), (pa.list_(pa.int64()), pa.binary(), pa.bool_(), pa.int64()))]

        return step

    return append_columns(pages, ["html"], fields, start)


def _sequence(html: str | None) -> tuple[list[tuple[str, int]], bool]:
    """The lines that are aligned, and whether the page marks main content."""
    found = lines(html)
    marked = any(kind == MARKED for _, kind in found)
    return (found if marked else [x for x in found if x[1] == LOOSE]), marked


def _others(page: str, id_of: str, lines_of: str) -> Column:
    """Whether ``page`` has another id than ``id_of`` and other lines than ``lines_of``; no id is like no other."""
    same_id = F.col(f"{page}.id").isNotNull() & F.col(f"{page}.id").eqNullSafe(F.col(f"{id_of}.id"))
    return ~same_id & (F.col(f"{page}.hash") != F.col(f"{lines_of}.hash"))


def _deleted(pages: DataFrame) -> DataFrame:
    """``key`` and ``gone``: the pages whose text loses lines to differencing, and their places."""
    place = F.split(F.regexp_replace(F.coalesce("url", F.lit("")), r"^[a-zA-Z]+://|[?#].*$", ""), "/")
    # Every directory above a page, from the host on; the last segment is the page's own name.
    levels = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("path") - 1, F.lit(1))),
        lambda n: F.struct(n.alias("deep"), F.array_join(F.slice("path", 1, n), "/").alias("folder")),
    )
    own = F.struct(F.col("page_id").isNull().alias("none"), F.col("page_id").alias("id"), F.col("text").alias("hash"))
    filed = pages.select("key", own.alias("own"), "marked", "hashes", "kinds", place.alias("path"))
    filed = filed.withColumn("l", F.explode(levels)).select(
        "key", "own", "marked", F.struct("hashes", "kinds").alias("lines"), "l.deep", F.struct("marked", "l.folder").alias("folder")
    )
    smallest = F.min_by(F.struct("own", "lines"), "own")
    # Four pages of a folder hold a partner for each of its pages: the first; the first that may be
    # its partner; and the first partners of pages with the id of one and the lines of the other.
    first = filed.groupBy("folder").agg(smallest.alias("a"))
    second = filed.join(first, "folder").where(_others("own", "a.own", "a.own")).groupBy("folder").agg(smallest.alias("b"))
    two = first.join(second, "folder", "left")
    crossed = [_others("own", "a.own", "b.own"), _others("own", "b.own", "a.own")]
    third = (
        filed.join(two.where("b IS NOT NULL"), "folder")
        .where(crossed[0] | crossed[1])
        .groupBy("folder")
        .agg(*[F.min_by(F.when(x, F.struct("own", "lines")), F.when(x, F.col("own"))).alias(n) for x, n in zip(crossed, "cd")])
    )
    four = two.join(third, "folder", "left")
    partner = F.coalesce(*[F.when(_others("own", f"{n}.own", f"{n}.own"), F.col(f"{n}.lines")) for n in "abcd"])
    # Pages without marked content look at the folders of marked pages too, and take those last.
    own_kind = filed.select("key", "own", "deep", "folder", F.lit(True).alias("like"))
    marked = F.struct(F.lit(True).alias("marked"), "folder.folder").alias("folder")
    asked = own_kind.unionByName(filed.where("NOT marked").select("key", "own", "deep", marked, F.lit(False).alias("like")))
    found = (
        asked.join(four, "folder")
        .select("key", "like", "deep", partner.alias("other"))
        .where(F.col("other").isNotNull())
        .groupBy("key")
        .agg(F.max_by("other", F.struct("like", "deep")).alias("other"))
    )
    paired = pages.select("key", "hashes", "kinds", "marked").join(found, "key")
    paired = paired.select("key", "hashes", "kinds", "marked", "other.hashes", "other.kinds").toDF(
        "key", "hashes", "kinds", "marked", "other", "other_kinds"
    )

    def start():
        def step(hashes, kinds, marked, others, other_kinds):
            out = []
            for own, kind, is_marked, other, its in zip(*(x.to_pylist() for x in (hashes, kinds, marked, others, other_kinds))):
                text = MARKED if is_marked else LOOSE
                gone = [i for i, j in aligned_lines(own, other).items() if kind[i] == text and its[j] == LOOSE]
                # What an unmarked page shares with a marked one may be text on either.
                if is_marked and MARKED not in its or len(gone) == kind.count(text):  # no page is all frame
                    gone = []
                out.append(sorted(gone))
            return [pa.array(out, pa.list_(pa.int32()))]

        return step

    gone = T.StructField("gone", T.ArrayType(T.IntegerType()))
    made = append_columns(paired, ["hashes", "kinds", "marked", "other", "other_kinds"], [gone], start)
    return made.where(F.size("gone") > 0).select("key", "gone").dropDuplicates(["key"])


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` (code points) of each row of ``pages``.

    Pages are differenced by hashes of their lines. Only pages that lose lines are joined with
    them, and the pages are cut into lines once more for their text, which is never shuffled where
    those are few. Equal rows have one ``key``, a 64-bit hash.
    """
    keyed = pages.select("page_id", "url", "html", F.xxhash64("page_id", "url", "html").alias("key"))
    parsed = materialize(_parsed(keyed).drop("html"), "page-lines")
    gone = materialize(_deleted(parsed), "page-deleted")
    both = keyed.join(gone, "key", "left").drop("key")

    def start():
        def step(htmls, deleted):
            out = []
            for html, gone in zip(htmls, deleted):
                found, marked = _sequence(html.as_py())
                gone = set(gone.as_py() or ())
                text = MARKED if marked else LOOSE
                out.append(" ".join(x for i, (x, kind) in enumerate(found) if kind == text and i not in gone))
            return [pa.array(out, pa.string())]

        return step

    text = append_columns(both, ["html", "gone"], [T.StructField("text", T.StringType())], start)
    return text.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))
