"""Benchmark decontamination with a generalised suffix automaton over words.

The automaton holds every run of words of the test items. A document is streamed through it
once; the automaton keeps the longest run that ends at the current word, so a window of ``n``
item words has occurred as soon as that length reaches ``n``. Items shorter than the window
count as one window each. Words outside the items' vocabulary cut a document into runs; runs
shorter than the shortest window are skipped unread.

Test items are broadcast as automata of at most ``MOST_WORDS`` words each, cut by item so that
no window is lost; more items give more automata, one pass each over the documents.

NULL and empty texts have no words and no hits; items without words are no windows. Repeated
items count once by id. Items with a NULL id are matched, but can't be named: their hits count
in ``n_hit`` only.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaymill.llm.common import append_columns

WINDOW = 10
#: Words in one automaton, which has at most twice as many states (about 1 GB of memory).
MOST_WORDS = 500_000

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").encode().lower().decode())


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences; state 0 is the empty run."""

    def __init__(self, items: Iterable[tuple[str | None, list[str]]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        owners: dict[int, set[str | None]] = {}
        whole: dict[int, set[str | None]] = {}
        shortest = window
        for item_id, words in items:
            last = 0
            for w in words:
                last = self._extend(last, w)
                owners.setdefault(last, set()).add(item_id)
            if 0 < len(words) < window:
                whole.setdefault(last, set()).add(item_id)
                shortest = min(shortest, len(words))
        self.shortest = shortest if len(self.next) > 1 else 0
        self._mark_windows(owners, whole)

    def _extend(self, last: int, w: str) -> int:
        nxt, link, length = self.next, self.link, self.length
        if w in nxt[last]:
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else self._clone(last, w, q)
        cur = self._state({}, length[last] + 1)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p < 0:
            link[cur] = 0
        else:
            q = nxt[p][w]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, w, q)
        return cur

    def _state(self, edges: dict[str, int], length: int) -> int:
        self.next.append(edges)
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _clone(self, p: int, w: str, q: int) -> int:
        new = self._state(dict(self.next[q]), self.length[p] + 1)
        self.link[new], self.link[q] = self.link[q], new
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = new
            p = self.link[p]
        return new

    def _mark_windows(self, owners: dict[int, set], whole: dict[int, set]) -> None:
        """Per state, what occurs when a run ending in it is long enough.

        ``full``: the items that hold the last ``window`` words. ``short``: the whole items below
        that size as ``(words, items)``; each is the longest run of its own state.
        """
        states = sorted(range(1, len(self.next)), key=self.length.__getitem__)
        # A run that ends in a state also ends in all its suffixes.
        for s in reversed(states):
            owners.setdefault(self.link[s], set()).update(owners.get(s, ()))
        same: dict[frozenset, frozenset] = {}
        self.full: list[frozenset] = [frozenset()] * len(self.next)
        self.short: list[tuple[tuple[int, frozenset], ...]] = [()] * len(self.next)
        for s in states:
            up = self.link[s]
            if self.length[up] >= self.window:
                self.full[s] = self.full[up]
            elif self.length[s] >= self.window:
                own = frozenset(owners[s])
                self.full[s] = same.setdefault(own, own)
            own_short = ((self.length[s], frozenset(whole[s])),) if s in whole else ()
            self.short[s] = own_short + self.short[up]

    def scan(self, words: list[str]) -> tuple[list[tuple[int, int]], set[str | None]]:
        """Merged hit spans ``[begin, end)`` in words, and the items that occurred."""
        spans: list[tuple[int, int]] = []
        items: set[str | None] = set()
        if not self.shortest:
            return spans, items
        known = bytes(map(self.next[0].__contains__, words))
        for run in re.finditer(b"\x01{%d,}" % self.shortest, known):
            self._scan_run(words, run.start(), run.end(), spans, items)
        return spans, items

    def _scan_run(self, words, begin, end, spans, items) -> None:
        nxt, link, length, window = self.next, self.link, self.length, self.window
        s = run = 0
        for i in range(begin, end):
            w = words[i]
            while s and w not in nxt[s]:
                s = link[s]
                run = length[s]
            if w in nxt[s]:
                s = nxt[s][w]
                run += 1
            hit = 0
            if run >= window:
                hit = window
                items |= self.full[s]
            for size, owners in self.short[s]:
                if size <= run:
                    hit = max(hit, size)
                    items |= owners
            if hit:
                at = i + 1 - hit
                while spans and spans[-1][1] >= at:
                    at = min(at, spans.pop()[0])
                spans.append((at, i + 1))


def _shards(
    benchmark: DataFrame, item_id: str, text: str
) -> Iterator[list[tuple[str | None, str]]]:
    """The items in lists of at most about ``MOST_WORDS`` words, read one after another."""
    items = benchmark.select(F.col(item_id).cast("string").alias("i"), F.coalesce(text, F.lit("")).alias("t")).distinct()
    size = items.agg(F.coalesce(F.sum(F.size(F.split("t", r"\s+"))), F.lit(0))).first()[0]
    n = max(1, -(-int(size) // MOST_WORDS))
    part = F.pmod(F.xxhash64("t"), F.lit(n))
    for k in range(n):
        yield [(r.i, r.t) for r in items.where(part == k).collect()]


def with_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """Append ``n_words``, ``hit_spans`` (word positions, end exclusive) and ``hit_items``."""
    span = T.StructType([T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType())])
    fields = [
        T.StructField("n_words", T.LongType()),
        T.StructField("hit_spans", T.ArrayType(span)),
        T.StructField("hit_items", T.ArrayType(T.StringType())),
    ]
    out = docs
    for k, shard in enumerate(_shards(benchmark, item_id, item_text)):
        automaton = SuffixAutomaton(((i, words_of(t)) for i, t in shard), window)
        shared = docs.sparkSession.sparkContext.broadcast(automaton)
        first = k == 0

        def start(shared=shared, first=first):
            sam = shared.value

            def step(texts, old_spans=None, old_items=None):
                n_words, all_spans, all_items = [], [], []
                for j, t in enumerate(texts):
                    words = words_of(t.as_py())
                    spans, items = sam.scan(words)
                    if not first:
                        spans = _merged([(s["begin"], s["end"]) for s in old_spans[j].as_py()] + spans)
                        items = items | set(old_items[j].as_py())
                    n_words.append(len(words))
                    all_spans.append([{"begin": a, "end": b} for a, b in spans])
                    all_items.append(sorted(i for i in items if i is not None))
                kinds = [pa.int64(), pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())])), pa.list_(pa.string())]
                return [pa.array(v, k) for v, k in zip((n_words, all_spans, all_items), kinds)]

            return step

        inputs = [text] if first else [text, "hit_spans", "hit_items"]
        out = append_columns(out, inputs, fields, start)
    return out


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: words, hit words, items and whether it is contaminated."""
    hits = with_hits(docs.select("doc_id", F.col("text").alias("_text")), benchmark, "_text", window=window)
    n_hit = F.aggregate(
        "hit_spans", F.lit(0).cast("bigint"), lambda n, s: n + (s["end"] - s["begin"]).cast("bigint")
    )
    return hits.select("doc_id", "n_words", n_hit.alias("n_hit"), "hit_items").select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("hit_items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "hit_items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of ``spans`` and what stands between them."""
    lowered = text.encode().lower().decode()
    places = [m.span() for m in _WORD.finditer(lowered)]
    out, at = [], 0
    for a, b in spans:
        out.append(text[at : places[a][0]])
        at = places[b - 1][1]
    return "".join([*out, text[at:]])


def clean(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    window: int = WINDOW,
    longest_span: int = WINDOW - 1,
    most_coverage: float = 0.0,
) -> DataFrame:
    """Append ``clean_text``: hit spans longer than ``longest_span`` words are cut out.

    Once the hit words exceed the share ``most_coverage`` of a document, all its hit spans go,
    short items included. With the defaults every hit is cut. NULL texts stay NULL.
    """

    def start():
        def step(texts, spans):
            out = []
            for t, s in zip(texts.to_pylist(), spans.to_pylist()):
                found = [(x["begin"], x["end"]) for x in s]
                if t is None or not found:
                    out.append(t)
                    continue
                share = sum(b - a for a, b in found) / len(words_of(t))
                cut = found if share > most_coverage else [x for x in found if x[1] - x[0] > longest_span]
                out.append(cut_spans(t, cut))
            return [pa.array(out, pa.string())]

        return step

    hits = with_hits(docs, benchmark, text, window=window)
    return append_columns(hits, [text, "hit_spans"], [T.StructField("clean_text", T.StringType())], start)
