"""What the driver holds while it fits."""

import itertools
import tracemalloc

import numpy as np

from assaymill.llm import langid


def fit_peak(lengths):
    words = [langid.MARK + "".join(w).ljust(n, "e") for n in lengths for w in itertools.islice(itertools.product("abcdef", repeat=5), 4_000)]
    pieces = langid.Pieces(["e" * k for k in range(1, 13)] + list("abcdef"))
    weight = np.ones((len(words), 2))
    tracemalloc.start()
    try:
        langid._expectation_maximisation(["a", "b"], pieces, words, weight, 2)
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_the_fit_holds_the_pieces_of_one_block_at_a_time():
    assert fit_peak(range(13, 21)) < 2 * fit_peak([20])
