"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. The probability
of a word is the sum over all its segmentations into pieces, computed by a forward recursion
over its characters; a text's is the product over its words. Piece probabilities are fitted by
expectation maximisation, whose expected counts come from the same recursion run both ways.

Words are runs of letters (Unicode category L) in lower case with the vocabulary's word marker in
front. The fit reads a bounded sample of different labelled texts (``SAMPLE_ROWS``) and cuts runs
of more than ``FIT_RUN`` letters. Prediction reads whole texts and sums over all segmentations of
whole runs, however long, at a cost linear in their letters.

NULL texts and texts without letters get ``und`` and score 0; so does everything if there was
nothing to learn from. Equal scores go to the first label in sorted order.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaymill.llm.common import append_columns, chunks, give_back_memory, low_hash
from assaymill.llm.sentencepiece_codec import model_bytes, parse_model

UNKNOWN = "und"
MARK = "▁"
#: Labelled texts that the fit reads at most, over all languages.
SAMPLE_ROWS = 6_000
ITERATIONS = 2
FIT_RUN = 32
#: Letters after which the forward values are rescaled, long before they leave a double's range.
RESCALE = 16
#: Probability of a letter that is no piece, and the least of any piece.
FLOOR = 1e-7
#: Words kept with their scores per Python worker.
CACHE_WORDS = 200_000

_LETTERS = re.compile(r"[^\W\d_]+")


class Pieces:
    """A trie of vocabulary pieces, walked for many words at a time."""

    def __init__(self, pieces: Sequence[str]):
        usable = {p.lower() for p in pieces}
        usable = {p for p in usable if re.fullmatch(f"{MARK}?[^\\W\\d_]*", p) and p}
        self.pieces = sorted(usable)
        self.longest = max(map(len, self.pieces), default=1)
        nodes: dict[str, int] = {"": 0}
        for p in self.pieces:
            for k in range(1, len(p) + 1):
                nodes.setdefault(p[:k], len(nodes))
        keys = [(nodes[p[:-1]] << 21) | ord(p[-1]) for p in nodes if p]
        child = [n for p, n in nodes.items() if p]
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.array(keys, np.int64)[order]
        self.child = np.array(child, np.int64)[order]
        self.piece_at = np.full(len(nodes), -1, np.int64)
        for i, p in enumerate(self.pieces):
            self.piece_at[nodes[p]] = i

    def lookup(self, codes: np.ndarray) -> list[np.ndarray]:
        """For each length ``l``, the piece that starts at each place of each word, or -1.

        ``codes`` holds words of one length, a row of code points each.
        """
        m, n = codes.shape
        out = []
        state = np.zeros((m, n), np.int64)
        for size in range(1, min(self.longest, n) + 1):
            state = state[:, : n - size + 1]
            rows, cols = np.nonzero(state >= 0)
            if not len(rows):
                break
            want = (state[rows, cols] << 21) | codes[rows, cols + size - 1]
            at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
            found = np.where(self.keys[at] == want, self.child[at], -1)
            state = np.full((m, n - size + 1), -1, np.int64)
            state[rows, cols] = found
            out.append(np.where(state >= 0, self.piece_at[np.maximum(state, 0)], -1))
        return out


def _forward(ids: list[np.ndarray], probs: np.ndarray, n: int, m: int) -> list[np.ndarray]:
    """``alpha[j]``: probability of the first ``j`` characters, per word and language."""
    languages = probs.shape[1]
    alpha = [np.ones((m, languages))]
    for j in range(1, n + 1):
        total = np.zeros((m, languages))
        for size, piece in enumerate(ids[: min(j, len(ids))], 1):
            i = j - size
            at = piece[:, i]
            step = probs[at]  # row -1 is zero
            if size == 1:
                step = np.where((at >= 0)[:, None], step, FLOOR)
            total += alpha[i] * step
        alpha.append(total)
    return alpha


def _forward_log(ids: list[np.ndarray], probs: np.ndarray, n: int, m: int) -> np.ndarray:
    """Log of the last forward value, for words of any length: only as many values as the longest
    piece has letters are kept, and each is rescaled per word and language."""
    last = [np.ones((m, probs.shape[1]))]
    scale = np.zeros((m, probs.shape[1]))
    for j in range(1, n + 1):
        total = np.zeros_like(scale)
        for size, piece in enumerate(ids[: min(j, len(ids))], 1):
            at = piece[:, j - size]
            step = probs[at]
            if size == 1:
                step = np.where((at >= 0)[:, None], step, FLOOR)
            total += last[-size] * step
        last = [*last[-max(1, len(ids)) :], total]
        if j % RESCALE == 0:
            scale += np.log(total)
            last = [a / total for a in last]
    return scale + np.log(last[-1])


def _backward(ids: list[np.ndarray], probs: np.ndarray, n: int, m: int) -> list[np.ndarray]:
    beta = [np.ones((m, probs.shape[1]))] * (n + 1)
    for i in range(n - 1, -1, -1):
        total = np.zeros((m, probs.shape[1]))
        for size, piece in enumerate(ids[: min(n - i, len(ids))], 1):
            at = piece[:, i]
            step = probs[at]
            if size == 1:
                step = np.where((at >= 0)[:, None], step, FLOOR)
            total += beta[i + size] * step
        beta[i] = total
    return beta


def _by_length(words: Sequence[str]):
    """Blocks of equally long words: their places and code points."""
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        groups.setdefault(len(w), []).append(i)
    for n, places in groups.items():
        for at in range(0, len(places), 20_000):
            block = places[at : at + 20_000]
            text = "".join(words[i] for i in block)
            codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
            yield block, codes.reshape(len(block), n)


@dataclass
class Model:
    labels: list[str]
    pieces: Pieces
    #: One row per piece and a last one of zeros, one column per label.
    probs: np.ndarray

    def word_scores(self, words: Sequence[str]) -> np.ndarray:
        """Log probability of each marked word under each language."""
        out = np.zeros((len(words), len(self.labels)))
        for block, codes in _by_length(words):
            m, n = codes.shape
            out[block] = _forward_log(self.pieces.lookup(codes), self.probs, n, m)
        return out


def marked_words(text: str) -> list[str]:
    """Runs of letters in lower case. Python's word characters hold other numerals too, as in ½."""
    words = _LETTERS.findall(text.lower())
    if all(map(str.isalpha, words)):
        return words
    return [w for run in words for w in "".join(c if c.isalpha() else " " for c in run).split()]


def fit(
    docs: DataFrame, model_path: str, text: str = "text", label: str = "lang",
    sample_rows: int = SAMPLE_ROWS, iterations: int = ITERATIONS,
) -> Model:
    """Fit piece probabilities per label on about ``sample_rows`` labelled rows.

    The sample is spread evenly over the labels and chosen by a hash of the text. Only its
    word counts come to the driver.
    """
    rows = docs.where(F.col(label).isNotNull() & F.col(text).rlike(r"\p{L}")).select(
        F.col(label).cast("string").alias("label"), F.col(text).alias("t")
    )
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    labels = sorted(counts)
    pieces = Pieces([p.text for p in parse_model(model_bytes(model_path)).pieces])
    if not labels:
        return Model([], pieces, np.zeros((len(pieces.pieces) + 1, 0)))
    each = max(1, sample_rows // len(labels))
    chosen = F.lit(False)
    for k in labels:
        chosen = F.when(F.col("label") == k, low_hash(F.col("t"), each, counts[k])).otherwise(chosen)
    # A text that many rows repeat is one text of the sample.
    sample = rows.where(chosen).distinct()
    words = sample.select(
        "label", F.explode(F.regexp_extract_all(F.lower("t"), F.lit(r"\p{L}{1,%d}" % FIT_RUN), F.lit(0))).alias("w")
    )
    table = words.groupBy("label", "w").count().toArrow().to_pydict()
    place = {w: i for i, w in enumerate(dict.fromkeys(table["w"]))}
    weight = np.zeros((len(place), len(labels)))
    column = {k: j for j, k in enumerate(labels)}
    for k, w, n in zip(table["label"], table["w"], table["count"]):
        weight[place[w], column[k]] += n
    words = [MARK + w for w in place]
    del table, place
    model = _expectation_maximisation(labels, pieces, words, weight, iterations)
    del words, weight
    give_back_memory()  # the driver goes on with other work
    return model


def _expectation_maximisation(labels, pieces, words, weight, iterations) -> Model:
    size = len(pieces.pieces)
    probs = np.vstack([np.full((size, len(labels)), 1 / max(1, size)), np.zeros((1, len(labels)))])
    for _ in range(iterations):
        expected = np.zeros((size, len(labels)))
        # Looked up anew each time: the places of all words' pieces are much larger than the words.
        for block, codes in _by_length(words):
            ids, (m, n) = pieces.lookup(codes), codes.shape
            alpha, beta = _forward(ids, probs, n, m), _backward(ids, probs, n, m)
            scale = weight[block] / np.maximum(alpha[-1], 1e-300)
            for length, piece in enumerate(ids, 1):
                for i in range(n - length + 1):
                    at = piece[:, i]
                    hit = at >= 0
                    if hit.any():
                        share = scale[hit] * alpha[i][hit] * probs[at[hit]] * beta[i + length][hit]
                        for j in range(len(labels)):
                            expected[:, j] += np.bincount(at[hit], share[:, j], size)
        # A piece that a language hasn't shown keeps a little of what the others show.
        pooled = expected.sum(axis=1, keepdims=True) / max(expected.sum(), 1e-9)
        smooth = expected + 10.0 * pooled + 0.01
        probs[:size] = np.maximum(smooth / smooth.sum(axis=0), FLOOR)
    return Model(labels, pieces, probs)


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Append ``lang_pred`` and ``score``, the tempered posterior of the predicted language.

    A text's log odds grow with its words; divided by the square root of their number they
    stay comparable, so that the score is not always 1.
    """
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    shared = df.sparkSession.sparkContext.broadcast(model)

    def start():
        own = shared.value
        place: dict[str, int] = {}
        store = [np.zeros((0, len(own.labels)))]

        def one(text: str | None, words: list[str]) -> tuple[str, float]:
            if not words or not own.labels:
                return UNKNOWN, 0.0
            at = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
            total = store[0][at].sum(axis=0)
            best = int(total.argmax())
            odds = np.exp((total - total[best]) / math.sqrt(len(words)))
            return own.labels[best], float(1 / odds.sum())

        def step(texts):
            values = texts.to_pylist()
            langs, scores = [], []
            for a, b in chunks(values, 500_000):
                split = [marked_words(t) if t else [] for t in values[a:b]]
                if len(place) > CACHE_WORDS:
                    place.clear()
                    store[0] = store[0][:0]
                fresh = list({w for ws in split for w in ws if w not in place})
                if fresh and own.labels:
                    got = own.word_scores([MARK + w for w in fresh])
                    for i, w in enumerate(fresh, len(store[0])):
                        place[w] = i
                    store[0] = np.vstack([store[0], got])
                for t, ws in zip(values[a:b], split):
                    lang, score = one(t, ws)
                    langs.append(lang)
                    scores.append(score)
            return [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]

        return step

    return append_columns(df, [text], fields, start)


def accepted(least: float) -> Column:
    """Whether a prediction is good enough to keep its document."""
    return (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)
