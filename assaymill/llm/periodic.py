"""Runs of repeated words, found with a run-length grammar built by recompression.

A run is a stretch of words with smallest period q that is at least ``max(LEAST_WORDS, REPEATS * q)`` words
long and that no neighbouring word extends.

Recompression shortens the word sequence level by level: blocks of one symbol become one symbol,
then neighbouring pairs whose first symbol is of the left class and whose second is of the right class
become one. Both rules look at symbols only, so equal stretches get equal symbols but near their ends,
and a fixed share of the sequence goes per level: a grammar of logarithmic height whose levels
take linear space. The longest common extension (LCE) of two places climbs the levels as long as
both stand at the start of a symbol, takes at most one step a level, and goes down again from the first
difference. All questions of a batch climb together, as arrays.

Candidates lie on a harmonic grid: for period p every 2p-th word. A run of 4p words or more covers
some grid word m together with m + p and m + 2p, which must then be equal; for each such m the LCE
of m and m + p forwards and backwards gives the exact stretch of period p. The grid of all periods has
(n / 2) ln(n / 4) words. A stretch that several periods share has the smallest of them.

Each document is handled in the task that reads it; the documents of a batch share one grammar, kept
apart by symbols that occur once. Cases: NULL and empty texts have no words and no runs; very long
texts are one sequence of their own, with memory linear in their words; repeated rows each give their
result. Input columns stay, but those named like a new one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaymill.llm.common import append_columns

LEAST_WORDS = 6
REPEATS = 4
#: Bytes of the documents that share a grammar (one document may hold more).
BATCH_BYTES = 2_000_000
#: Candidates that are extended together.
CANDIDATES = 400_000

WORD = r"[^\x20\x09-\x0D]+"
RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


@dataclass(frozen=True)
class Level:
    """One sequence of the grammar and how it becomes the next one.

    ``symbols`` ends with -1 for the end of the sequence. ``unit`` gives for each symbol the index of
    the next level's symbol that it is part of; ``first`` the place here at which each symbol of the
    next level begins, then the length twice. ``blocks`` tells a block level from a pair level.
    """

    symbols: np.ndarray
    unit: np.ndarray | None = None
    first: np.ndarray | None = None
    blocks: bool = False

    def is_start(self, at: np.ndarray) -> np.ndarray:
        return self.first[self.unit[at]] == at

    def step(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Symbols to pass at two places with the same symbol: one, or the shorter block's rest."""
        if not self.blocks:
            return np.ones(len(x), dtype=x.dtype)
        return np.minimum(self.first[self.unit[x] + 1] - x, self.first[self.unit[y] + 1] - y)

    def mirrored(self) -> Level:
        symbols = np.append(self.symbols[:-1][::-1], self.symbols[-1:])
        if self.unit is None:
            return Level(symbols)
        n, m = len(symbols) - 1, self.unit[-1]
        unit = np.append(m - 1 - self.unit[:-1][::-1], m).astype(self.unit.dtype)
        first = np.append(n - self.first[:-1][::-1], n).astype(self.first.dtype)
        return Level(symbols, unit, first, self.blocks)


def _named(keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Equal keys as equal numbers from 0 on, and how many there are."""
    values, numbers = np.unique(keys, return_inverse=True)
    return numbers.reshape(-1).astype(np.int64), len(values)


def _level(symbols: np.ndarray, starts: np.ndarray, blocks: bool) -> Level:
    """``starts`` marks the symbols at which a symbol of the next level begins."""
    n, m = len(symbols), int(starts.sum())
    return Level(
        np.append(symbols, -1).astype(np.int32),
        np.append(np.cumsum(starts) - 1, m).astype(np.int32),
        np.append(np.flatnonzero(starts), [n, n]).astype(np.int32),
        blocks,
    )


def _right(symbols: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Whether each place's symbol is of the right class: one mixed bit of the symbol."""
    mixed = np.arange(size, dtype=np.uint64) + np.uint64(seed)
    for shift in (29, 32):
        mixed = (mixed + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(shift)
    return ((mixed >> np.uint64(17)) & np.uint64(1)).astype(bool)[symbols]


def _pairs(symbols: np.ndarray, size: int, level: int) -> np.ndarray:
    """Marks the first places of the pairs to join; no neighbours are equal, so some split has pairs."""
    seed = level << 32
    while True:
        right = _right(symbols, size, seed)
        forth, back = ~right[:-1] & right[1:], right[:-1] & ~right[1:]
        joined = forth if forth.sum() >= back.sum() else back
        if joined.any():
            return joined
        seed += 1 << 20


def grammar(symbols: np.ndarray) -> list[Level]:
    """The levels of a sequence of numbers from 0 on; the last one has a single symbol."""
    levels: list[Level] = []
    symbols, size = _named(symbols)
    while len(symbols) > 1:
        starts = np.append(True, symbols[1:] != symbols[:-1])
        blocks = not starts.all()
        if blocks:
            heads = np.flatnonzero(starts)
            second = np.diff(np.append(heads, len(symbols)))
        else:
            joined = _pairs(symbols, size, len(levels))
            starts = np.append(True, ~joined)
            heads = np.flatnonzero(starts)
            second = np.where(np.append(joined, False), np.append(symbols[1:], 0) + 1, 0)[heads]
        levels.append(_level(symbols, starts, blocks))
        symbols, size = _named(symbols[heads] * (int(second.max()) + 1) + second)
    levels.append(Level(np.append(symbols, -1).astype(np.int32)))
    return levels


def extensions(levels: list[Level], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many symbols are equal from the places ``a`` and ``b`` on; ``a != b`` throughout."""
    stopped = []
    who, x, y = np.arange(len(a)), a, b
    for level in levels:
        same = level.symbols[x] == level.symbols[y]
        if level.unit is None:
            stopped.append((who, x, y))
            break
        # Where both begin a symbol of the next level, that one is compared instead.
        climb = level.is_start(x) & level.is_start(y)
        go = ~climb & same
        step = np.where(go, level.step(x, y), 0)
        x, y = x + step, y + step
        climb |= go & level.is_start(x) & level.is_start(y) if level.blocks else go
        stopped.append((who[~climb], x[~climb], y[~climb]))
        who, x, y = who[climb], level.unit[x[climb]], level.unit[y[climb]]
    who, x, y = stopped.pop()
    for level in levels[-2::-1]:
        # From differing symbols to their first parts, past those that are equal.
        x, y = level.first[x], level.first[y]
        step = np.where(level.symbols[x] == level.symbols[y], level.step(x, y), 0)
        here = stopped.pop()
        who = np.append(who, here[0])
        x, y = np.append(x + step, here[1]), np.append(y + step, here[2])
    found = np.empty(len(a), dtype=np.int64)
    found[who] = x - a[who]
    return found


def _grid(w: np.ndarray, begin: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """Candidates by period: grid places m at which the words m, m + p and m + 2p are equal."""
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    period = 1
    while True:
        long_enough = int(np.searchsorted(-size, -max(LEAST_WORDS, REPEATS * period), side="right"))
        if not long_enough:
            return
        width = 2 * period
        counts = (size[:long_enough] - 1 - width) // width + 1
        before = np.cumsum(counts) - counts
        m = np.repeat(begin[:long_enough] - width * before, counts) + width * np.arange(counts.sum())
        here = w[m + period]
        m = m[(w[m] == here) & (here == w[m + width])]
        if len(m):
            yield m, period
        period += 1


def stretches(w: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All runs as rows ``(start, length, period)`` by start and period; places count over all texts.

    ``w`` holds the words of several texts as numbers, each text followed by a number of its own.
    """
    found = [np.zeros((0, 3), dtype=np.int64)]
    levels = mirror = None
    waiting: list[tuple[np.ndarray, int]] = []

    def extend() -> None:
        nonlocal levels, mirror
        if not waiting:
            return
        if levels is None:
            levels = grammar(w)
            mirror = [level.mirrored() for level in levels]
        m = np.concatenate([places for places, _ in waiting])
        period = np.repeat([p for _, p in waiting], [len(places) for places, _ in waiting])
        waiting.clear()
        back = extensions(mirror, len(w) - m, len(w) - m - period)
        length = back + period + extensions(levels, m, m + period)
        long_enough = length >= np.maximum(LEAST_WORDS, REPEATS * period)
        rows = np.stack([m - back, length, period], axis=1)[long_enough]
        found.append(np.unique(rows, axis=0))

    held = 0
    for m, period in _grid(w, begin, size):
        waiting.append((m, period))
        held += len(m)
        if held >= CANDIDATES:
            extend()
            held = 0
    extend()
    rows = np.unique(np.concatenate(found), axis=0)
    # The smallest period of each stretch comes first.
    new = np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1))[: len(rows)]
    rows = rows[new]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words (between ASCII white space) and their number in each text."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words, text = split.flatten(), pc.list_parent_indices(split)
    filled = pc.greater(pc.binary_length(words), 0)
    counts = np.bincount(text.filter(filled).to_numpy(), minlength=len(texts))
    return words.filter(filled), counts


def _runs_of(texts: pa.Array) -> list[pa.Array]:
    words, counts = _words(texts)
    n_texts, n_words = len(counts), len(words)
    numbers = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    # Each text is followed by a number that occurs once.
    begin = np.cumsum(counts) - counts
    text = np.repeat(np.arange(n_texts), counts)
    w = np.empty(n_words + n_texts, dtype=np.int64)
    w[np.arange(n_words) + text] = numbers
    w[begin + counts + np.arange(n_texts)] = n_words + np.arange(n_texts)
    rows = stretches(w, begin + np.arange(n_texts), counts)

    owner = np.searchsorted(begin + np.arange(n_texts), rows[:, 0], side="right") - 1
    start = rows[:, 0] - owner  # among the words alone
    marks = np.zeros(n_words + 1, dtype=np.int64)
    np.add.at(marks, start + rows[:, 2], 1)
    np.add.at(marks, start + rows[:, 1], -1)
    kept = np.cumsum(marks[:-1]) == 0

    ends = np.append(0, np.cumsum(np.bincount(text, weights=kept, minlength=n_texts))).astype(np.int32)
    collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), words.filter(pa.array(kept))), " ")
    ends = np.append(0, np.cumsum(np.bincount(owner, minlength=n_texts))).astype(np.int32)
    columns = [pa.array(c) for c in (start - begin[owner], rows[:, 1], rows[:, 2])]
    runs = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(columns, names=RUN.fieldNames()))
    return [pa.array(counts.astype(np.int64)), runs, collapsed]


def _batches(texts: pa.Array) -> Iterator[pa.Array]:
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64)
    batch = (np.cumsum(sizes) - sizes) // BATCH_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(batch)) + 1).tolist(), len(texts)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield texts.slice(a, b - a)


def find_runs(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``n_words``, ``runs`` (by start, then period) and ``collapsed`` to each row.

    ``collapsed`` is the text without the words of a run after the run's first period, joined by
    single spaces. The start of a run is a word number from 0 on.
    """
    fields = [
        T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(RUN)),
        T.StructField("collapsed", T.StringType()),
    ]

    def start():
        def step(texts: pa.Array) -> list[pa.Array]:
            parts = [_runs_of(part) for part in _batches(texts)]
            return [pa.concat_arrays(column) for column in zip(*parts)]

        return step

    return append_columns(df, [text_col], fields, start)


def with_planted_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The texts, those of every tenth id hash with their end replaced by repeats of a part of it.

    With h the crc32 of the decimal id (of empty text for a NULL id) and g = h div 10, a text of n words
    with h a multiple of 10 goes on from word a = g mod n with period 1 + (n - a) div (3 + g mod 8).
    """
    h = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    chosen = F.pmod(h, F.lit(10)) == 0
    kept = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")
    words = F.when(chosen, F.regexp_extract_all(F.col(text_col), F.lit(WORD), F.lit(0)))
    rows = df.select(kept, words.alias("_words"), _div(h, F.lit(10)).alias("_g"))
    rows = rows.withColumn("_n", F.size("_words"))
    g, n = F.col("_g"), F.col("_n")
    begin = F.when(n > 0, F.pmod(g, n)).cast("int")
    rows = rows.withColumn("_a", begin)
    left = n - F.col("_a")
    rows = rows.withColumn("_p", (_div(left, F.pmod(g, F.lit(8)) + 3) + 1).cast("int"))
    unit = F.slice("_words", F.col("_a") + 1, F.col("_p"))
    tail = F.slice(F.flatten(F.array_repeat(unit, _div(left + F.col("_p") - 1, F.col("_p")).cast("int"))), F.lit(1), left)
    made = F.array_join(F.concat(F.slice("_words", F.lit(1), F.col("_a")), tail), " ")
    text = F.when(n > 0, made).otherwise(F.col(f"_row.`{text_col}`"))
    return rows.select(*[text.alias(c) if c == text_col else F.col(f"_row.`{c}`") for c in df.columns])


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: number of runs, the longest one, and digests of all runs and of the collapsed text."""
    planted = with_planted_repeats(df.select(id_col, text_col), id_col, text_col)
    found = find_runs(planted, text_col)
    # By length, then by smallest start and period.
    ranked = F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    best = F.col("_best")
    return found.withColumn("_best", F.array_max(ranked)).select(
        id_col,
        F.size("runs").cast("bigint").alias("n_runs"),
        (-best["s"]).alias("start"),
        best["length"].alias("length"),
        (-best["p"]).alias("period"),
        _div(best["length"] * 1000, -best["p"]).alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
