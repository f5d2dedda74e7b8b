"""Letters, long runs and the sample of language identification."""

import itertools
import math

import numpy as np
from pyspark.sql import functions as F

from assaymill.llm import langid
from assaymill.llm.common import bounded_sample, low_hash


def small_model(rng):
    pieces = langid.Pieces(["a", "b", "ab", "ba", "aba", langid.MARK + "a", langid.MARK])
    probs = np.vstack([rng.uniform(0.01, 0.3, (len(pieces.pieces), 3)), np.zeros((1, 3))])
    return langid.Model(["x", "y", "z"], pieces, probs)


def brute(model, word):
    """Sum over every segmentation."""
    place = {p: i for i, p in enumerate(model.pieces.pieces)}
    total = np.zeros(3)
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        parts, at = [], 0
        for k, cut in enumerate([*cuts, 1], 1):
            if cut:
                parts.append(word[at:k])
                at = k
        one = np.ones(3)
        for p in parts:
            one = one * (model.probs[place[p]] if p in place else langid.FLOOR if len(p) == 1 else 0.0)
        total += one
    return np.log(total)


def test_forward_sums_over_all_segmentations():
    model = small_model(np.random.default_rng(1))
    words = [langid.MARK + "".join(w) for n in (1, 3, 7, 12) for w in itertools.islice(itertools.product("abc", repeat=n), 0, 400, 37)]
    for word, got in zip(words, model.word_scores(words)):
        assert np.allclose(got, brute(model, word), rtol=1e-10)


def test_long_runs_are_one_word():
    model = small_model(np.random.default_rng(2))
    assert langid.marked_words("AB" * 500 + " c") == ["ab" * 500, "c"]
    short, long = model.word_scores([langid.MARK + "ab" * 20, langid.MARK + "ab" * 5000])
    assert np.isfinite(long).all()
    # Per pair of letters the score goes on at the same rate.
    longer = model.word_scores([langid.MARK + "ab" * 5100])[0]
    rate = (longer - long) / 100
    assert np.allclose(long - short, rate * 4980, rtol=1e-3)


def test_letters_are_those_of_unicode(spark):
    assert langid.marked_words("½ ² ³ Ⅷ a²b x½ 5_y") == ["a", "b", "x", "y"]
    docs = spark.createDataFrame([("some words here", "en"), ("andere worte dort", "de")] * 3, "text string, lang string")
    model = langid.fit(docs, "/opt/tokenizers/piece_bpe_32k.model")
    odd = spark.createDataFrame([("½",), ("² ³",), ("Ⅷ 12",), (None,), ("words ½",)], "text string")
    found = {r.text: (r.lang_pred, r.score) for r in langid.predict(odd, model).collect()}
    assert [found[t] for t in ("½", "² ³", "Ⅷ 12", None)] == [("und", 0.0)] * 4
    assert found["words ½"][0] == "en"


def test_sample_keeps_its_share_at_any_size(spark):
    def kept(most, count):
        return bounded_sample(spark.range(200_000), F.col("id"), most, count).count()

    assert abs(kept(1_000, 10_000) - 20_000) < 1_000
    assert kept(5, 5) == 200_000
    # 10^12 rows: the share is not rounded away.
    condition = low_hash(F.col("id"), 1_500 * 10**6, 10**12)
    assert abs(spark.range(2_000_000).where(condition).count() - 3_000) < 300
    low = str(low_hash(F.lit(1), 1_500, 10**12))
    assert str((1_500 << 64) // 10**12 - (1 << 63)) in low and math.log2((1_500 << 64) // 10**12) > 30


def test_a_repeated_text_is_learnt_once(spark):
    rows = [("eins zwei drei", "de")] * 900 + [(f"one two three {'abc'[i % 3]}{i}", "en") for i in range(900)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    model = langid.fit(docs, "/opt/tokenizers/piece_bpe_32k.model", sample_rows=400)
    assert model.labels == ["de", "en"]
