"""Toxicity by a weighted finite-state grammar over clauses.

A word transducer maps tokens to symbols with a lexical weight: insult, threat, target, negation,
reported speech, quotation, or other. Three transducers read the symbols of one clause, each a table
of arcs with factors: ``negation`` lowers what follows a negation, ``speech`` what is reported or
quoted, and ``address`` raises an insult with a target near by and lets a threat count only with one.
Where the target may still come, ``address`` has two arcs, one of which promises it; a path that breaks
its promise ends. Composition multiplies the factors of a token, a path adds factor times lexical
weight, and the best path that ends in a final state is the clause's weight. A document's evidence is
that of its heaviest clause and a little for each more.

The insult transducer's entries are a short public seed list and words and word beginnings
learned from labelled texts: weight is the log odds of the label, support is counted in texts
that differ by a min-hash of their words, so that copies of one text count about once. The
sample that is learned from has about ``SAMPLE_ROWS`` rows. A logistic curve fitted to the
same sample turns evidence into a score.

NULL and empty texts have no evidence and the lowest score there is. Without labels the seed
list and fixed curve are used; there a seed word alone, negated or reported stays below one half.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaymill.llm.common import append_columns, bounded_sample
from assaymill.session import materialize

#: Labelled rows that the fit reads at most.
SAMPLE_ROWS = 12_000
#: A learned entry has this many distinct positive texts, and this share of all of them.
LEAST_SUPPORT, LEAST_SHARE = 4, 0.01
#: Least share of positive among all labelled texts with the entry.
LEAST_PRECISION = 0.85
#: Learned word beginnings have between so many letters.
STEM = (4, 8)

# Seed words of the transducers, in four languages.
INSULTS = (
    "idiot idiots moron morons scum stupid worthless pathetic loser disgusting vermin "
    "imbécile crétin abruti connard idiota imbécil estúpido estúpida basura "
    "dummkopf abschaum trottel arschloch"
).split()
THREATS = (
    "kill hurt destroy stab shoot beat tuer frapper détruire matar golpear destruir "
    "töten umbringen verprügeln vernichten"
).split()
TARGETS = (
    "you your yours u he she they him her them tu toi vous ton ta votre il elle ils elles "
    "usted ustedes te ti él ella ellos ellas du dich dir euch sie ihr dein deine"
).split()
NEGATIONS = "not no never ne pas jamais nunca tampoco nicht kein keine nie".split()
REPORTS = (
    "said says say told called wrote claims claimed quoted reported dit disait écrit affirme "
    "dijo dice escribió afirma sagte sagt schrieb behauptet"
).split()
APOSTROPHE = "’"
QUOTES = "\"“”„«»"

SEED_WEIGHT = 4.0
THREAT_WEIGHT = 5.0
#: Factors on a weight: with a target near by, negated, reported.
TARGETED, NEGATED, REPORTED = 1.25, 0.6, 0.7
#: Tokens that a negation, or a target, reaches.
NEGATION_REACH, TARGET_REACH = 3, 4
MORE_CLAUSES = 0.25

_CLAUSE_END = re.compile(r"[.!?;\n]")
_TOKEN = re.compile(r"[^\W_]+(?:'[^\W_]+)*|[" + QUOTES + "]")
_WORD_PART = re.compile(r"[^\W_]")

INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, OTHER = range(7)


SYMBOLS = range(7)


@dataclass(frozen=True)
class Transducer:
    """A weighted transducer over symbols, as data; state 0 is the start.

    ``arcs[state][symbol]`` holds ``(next state, symbol given, factor)``; none, and the path ends.
    """

    arcs: tuple
    final: frozenset[int]

    def best(self, read: list[tuple[int, float]]) -> float:
        """The heaviest path over ``(symbol, lexical weight)`` pairs that ends in a final state."""
        paths = {0: 0.0}
        for symbol, lexical in read:
            onward: dict[int, float] = {}
            for state, total in paths.items():
                for after, _, factor in self.arcs[state][symbol]:
                    weight = total + factor * lexical
                    if weight >= onward.get(after, 0.0):
                        onward[after] = weight
            paths = onward
        return max((w for state, w in paths.items() if state in self.final), default=0.0)


def compose(first: Transducer, second: Transducer) -> Transducer:
    """``second`` reads what ``first`` gives; factors multiply. Only pairs that can be reached count."""
    numbers, pairs, arcs = {(0, 0): 0}, [(0, 0)], []
    for one, two in pairs:  # grows while it is walked
        row = []
        for symbol in SYMBOLS:
            found = []
            for after_one, given, f in first.arcs[one][symbol]:
                for after_two, result, g in second.arcs[two][given]:
                    pair = after_one, after_two
                    if pair not in numbers:
                        numbers[pair] = len(pairs)
                        pairs.append(pair)
                    found.append((numbers[pair], result, f * g))
            row.append(tuple(found))
        arcs.append(tuple(row))
    final = frozenset(n for (a, b), n in numbers.items() if a in first.final and b in second.final)
    return Transducer(tuple(arcs), final)


def negation() -> Transducer:
    """State: how many more tokens the last negation reaches."""
    arcs = []
    for left in range(NEGATION_REACH + 1):
        row = []
        for symbol in SYMBOLS:
            after = NEGATION_REACH if symbol == NEGATION else max(0, left - 1)
            row.append(((after, symbol, NEGATED if left and symbol in (INSULT, THREAT) else 1.0),))
        arcs.append(tuple(row))
    return Transducer(tuple(arcs), frozenset(range(NEGATION_REACH + 1)))


def speech() -> Transducer:
    """State: 1 after a word of reporting, and 2 more inside quotation marks."""
    arcs = []
    for state in range(4):
        row = []
        for symbol in SYMBOLS:
            after = state | 1 if symbol == REPORT else state ^ 2 if symbol == QUOTE else state
            row.append(((after, symbol, REPORTED if state and symbol in (INSULT, THREAT) else 1.0),))
        arcs.append(tuple(row))
    return Transducer(tuple(arcs), frozenset(range(4)))


def address() -> Transducer:
    """States 0 to ``TARGET_REACH``: how many more tokens the last target reaches. The states above
    them: a target is promised within so many tokens; they are not final."""
    reach = TARGET_REACH
    with_target, alone = {INSULT: TARGETED, THREAT: 1.0}, {INSULT: 1.0, THREAT: 0.0}
    arcs = []
    for near in range(reach + 1):
        row = []
        for symbol in SYMBOLS:
            after = reach if symbol == TARGET else max(0, near - 1)
            if near or symbol not in alone:
                row.append(((after, symbol, with_target.get(symbol, 1.0)),))
            else:
                promise = (2 * reach, symbol, with_target[symbol])
                row.append(((after, symbol, alone[symbol]), promise))
        arcs.append(tuple(row))
    for due in range(1, reach + 1):
        row = []
        for symbol in SYMBOLS:
            if symbol == TARGET:
                row.append(((reach, symbol, 1.0),))
            elif due > 1:
                row.append(((reach + due - 1, symbol, with_target.get(symbol, 1.0)),))
            else:
                row.append(())
        arcs.append(tuple(row))
    return Transducer(tuple(arcs), frozenset(range(reach + 1)))


@cache
def clause_transducer() -> Transducer:
    return compose(compose(negation(), speech()), address())


def plain(text: str) -> str:
    """Lower case, with the typewriter's apostrophe; the fit's expression does the same."""
    return text.lower().replace(APOSTROPHE, "'")


@dataclass
class Grammar:
    """The word transducer's entries and the curve; ``weigh`` runs a clause through the grammar."""

    words: dict[str, float]
    stems: dict[str, float] = field(default_factory=dict)
    slope: float = 3.0
    intercept: float = -13.5

    def __post_init__(self):
        self.symbols = {
            **dict.fromkeys(REPORTS, REPORT),
            **dict.fromkeys(NEGATIONS, NEGATION),
            **dict.fromkeys(TARGETS, TARGET),
            **dict.fromkeys(THREATS, THREAT),
        }
        self.stem_sizes = sorted({len(s) for s in self.stems})
        self.triggers = ahocorasick.Automaton()
        for w in [*self.words, *self.stems, *THREATS]:
            self.triggers.add_word(w, len(w))
        if len(self.triggers):
            self.triggers.make_automaton()

    def __getstate__(self):
        return self.words, self.stems, self.slope, self.intercept

    def __setstate__(self, state):
        self.words, self.stems, self.slope, self.intercept = state
        self.__post_init__()

    def symbol(self, token: str) -> tuple[int, float]:
        """The word transducer: a token's symbol and lexical weight."""
        weight = self.words.get(token, 0.0)
        for n in self.stem_sizes:
            weight = max(weight, self.stems.get(token[:n], 0.0))
        if weight:
            return INSULT, weight
        if token in QUOTES:
            return QUOTE, 0.0
        kind = NEGATION if token.endswith("n't") else self.symbols.get(token, OTHER)
        return kind, THREAT_WEIGHT if kind == THREAT else 0.0

    def weigh(self, tokens: list[str]) -> float:
        """The weight of one clause's tokens."""
        return clause_transducer().best([self.symbol(token) for token in tokens])

    def clauses(self, text: str) -> list[tuple[int, int]]:
        """Bounds of the clauses that hold a trigger at the start of a word."""
        if not len(self.triggers):
            return []
        starts = []
        for end, size in self.triggers.iter(text):
            at = end - size + 1
            if not at or not _WORD_PART.match(text[at - 1]):
                starts.append(at)
        if not starts:
            return []
        ends = [m.start() for m in _CLAUSE_END.finditer(text)]
        found: dict[int, tuple[int, int]] = {}
        for at in starts:
            k = bisect_right(ends, at)
            found[k] = (ends[k - 1] + 1 if k else 0, ends[k] if k < len(ends) else len(text))
        return [found[k] for k in sorted(found)]

    def matches(self, text: str | None) -> list[tuple[int, int, float]]:
        """Clauses with a positive weight: begin, end (in the lower-cased text), weight."""
        low = plain(text or "")
        weighed = ((a, b, self.weigh(_TOKEN.findall(low[a:b]))) for a, b in self.clauses(low))
        return [x for x in weighed if x[2] > 0]

    def evidence(self, text: str | None) -> float:
        weights = [w for *_, w in self.matches(text)]
        return max(weights) + MORE_CLAUSES * math.log(len(weights)) if weights else 0.0

    def score(self, text: str | None) -> float:
        z = self.slope * self.evidence(text) + self.intercept
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))


def fit(
    docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, text: str = "text",
    label: str = "toxic",
) -> Grammar:
    """Learn insult entries and the curve on about ``sample_rows`` labelled rows of ``docs``.

    Labels are joined by ``doc_id``. Only the entries that pass, and evidence with labels of
    the sampled rows, come to the driver.
    """
    known = labels.where(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).alias("y"))
    count = known.count()
    known = bounded_sample(known, F.col("doc_id"), sample_rows, count)
    # Stored: else the expression below would be pushed under the join and read every document.
    sample = docs.select("doc_id", F.col(text).alias("t")).join(known, "doc_id").select("t", "y")
    sample = materialize(sample, "toxicity-sample")
    tokens = F.array_distinct(
        F.regexp_extract_all(F.translate(F.lower("t"), APOSTROPHE, "'"), F.lit(r"[\p{L}\p{N}]+(?:'[\p{L}\p{N}]+)*"), F.lit(0))
    )
    rows = sample.select("y", tokens.alias("w")).where(F.size("w") > 0)
    rows = rows.select(
        "y", "w", F.array_min(F.transform("w", lambda w: F.xxhash64(w))).alias("sketch")
    )
    texts = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.countDistinct("sketch").alias("n")).collect()}
    positive, negative = texts.get(1, 0), texts.get(0, 0)
    grammar = Grammar(dict.fromkeys(INSULTS, SEED_WEIGHT))
    if positive:
        support = max(LEAST_SUPPORT, math.ceil(LEAST_SHARE * positive))
        learned = _entries(rows, positive, negative, support)
        words = {f: w for f, w, stem in learned if not stem}
        stems = _shortest({f: w for f, w, stem in learned if stem})
        words = {f: w for f, w in words.items() if not any(f.startswith(s) for s in stems)}
        grammar = Grammar(grammar.words | words, stems)
    pairs = with_evidence(sample.select("y", "t"), grammar, "t").select("y", "evidence").toArrow()
    return _calibrated(grammar, np.array(pairs["evidence"]), np.array(pairs["y"], float))


def _entries(rows: DataFrame, positive: int, negative: int, support: int) -> list[tuple[str, float, bool]]:
    """Words and word beginnings that tell the label, with their log odds."""
    words = rows.select("y", "sketch", F.explode("w").alias("w"))
    sizes = F.sequence(F.lit(STEM[0]), F.least(F.lit(STEM[1]), F.char_length("w")))
    stems = F.when(
        F.char_length("w") >= STEM[0],
        F.transform(sizes, lambda n: F.struct(F.substring(F.col("w"), F.lit(1), n).alias("f"), F.lit(True).alias("stem"))),
    ).otherwise(F.array().cast("array<struct<f:string,stem:boolean>>"))
    both = F.concat(F.array(F.struct(F.col("w").alias("f"), F.lit(False).alias("stem"))), stems)
    features = words.select("y", "sketch", F.hash("w").alias("h"), F.explode(both).alias("x"))
    per_text = features.groupBy("x.f", "x.stem", "y", "sketch").agg(F.max("h").alias("hi"), F.min("h").alias("lo"))
    counted = per_text.groupBy("f", "stem").agg(
        F.count_if(F.col("y") == 1).alias("p"),
        F.count_if(F.col("y") == 0).alias("n"),
        (F.max("hi") != F.min("lo")).alias("several"),
    )
    # A beginning stands for several words, else the word itself is the entry.
    passed = counted.where(
        (F.col("p") >= support)
        & (F.col("p") >= LEAST_PRECISION * (F.col("p") + F.col("n")))
        & (~F.col("stem") | F.col("several"))
    )
    odds = lambda r: math.log((r.p + 0.5) / (positive + 1)) - math.log((r.n + 0.5) / (negative + 1))
    return [(r.f, min(8.0, odds(r)), r.stem) for r in passed.collect() if odds(r) > 1]


def _shortest(stems: Mapping[str, float]) -> dict[str, float]:
    """Stems without those that begin with another one."""
    kept: dict[str, float] = {}
    for s in sorted(stems, key=lambda s: (len(s), s)):
        if not any(s[:k] in kept for k in range(STEM[0], len(s))):
            kept[s] = stems[s]
    return kept


def _calibrated(grammar: Grammar, x: np.ndarray, y: np.ndarray) -> Grammar:
    """Slope and intercept of the logistic curve, by a few damped Newton steps."""
    if not len(y) or y.min() == y.max():
        return grammar
    design = np.stack([x, np.ones_like(x)], axis=1)
    theta = np.array([grammar.slope, grammar.intercept])
    prior = theta.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        gradient = design.T @ (p - y) + (theta - prior)
        hessian = design.T @ (design * (p * (1 - p))[:, None]) + np.eye(2)
        theta = theta - np.linalg.solve(hessian, gradient)
    grammar.slope, grammar.intercept = max(0.1, float(theta[0])), float(theta[1])
    return grammar


def with_evidence(df: DataFrame, grammar: Grammar, text: str = "text") -> DataFrame:
    """Append ``evidence``, ``score`` and ``clauses`` (begin, end and weight of each match)."""
    clause = T.StructType(
        [T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("weight", T.DoubleType())]
    )
    fields = [
        T.StructField("evidence", T.DoubleType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("clauses", T.ArrayType(clause)),
    ]
    shared = df.sparkSession.sparkContext.broadcast(grammar)

    def start():
        own = shared.value

        def step(texts):
            evidence, scores, found = [], [], []
            for t in texts:
                hits = own.matches(t.as_py())
                e = max(h[2] for h in hits) + MORE_CLAUSES * math.log(len(hits)) if hits else 0.0
                z = max(-50.0, min(50.0, own.slope * e + own.intercept))
                evidence.append(e)
                scores.append(1 / (1 + math.exp(-z)))
                found.append([{"begin": a, "end": b, "weight": w} for a, b, w in hits])
            kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("weight", pa.float64())]))
            return [pa.array(evidence, pa.float64()), pa.array(scores, pa.float64()), pa.array(found, kind)]

        return step

    return append_columns(df, [text], fields, start)
