"""The clause grammar against its definition, over all short clauses of symbols."""

import itertools

import pytest

from assaymill.llm import toxicity
from assaymill.llm.toxicity import (
    INSULT, NEGATED, NEGATION, NEGATION_REACH, OTHER, QUOTE, REPORT, REPORTED, SYMBOLS, TARGET, TARGET_REACH,
    TARGETED, THREAT, Grammar, Transducer, clause_transducer, compose,
)

LEXICAL = {INSULT: 4.0, THREAT: 5.0}


def defined(symbols):
    """Each insult and threat on its own, from what stands around it."""
    total = 0.0
    for i, symbol in enumerate(symbols):
        if symbol not in LEXICAL:
            continue
        weight = LEXICAL[symbol]
        if NEGATION in symbols[max(0, i - NEGATION_REACH) : i]:
            weight *= NEGATED
        if REPORT in symbols[:i] or symbols[:i].count(QUOTE) % 2:
            weight *= REPORTED
        targeted = TARGET in symbols[max(0, i - TARGET_REACH) : i + TARGET_REACH + 1]
        if symbol == INSULT:
            total += weight * (TARGETED if targeted else 1.0)
        elif targeted:
            total += weight
    return total


def weighed(symbols):
    return clause_transducer().best([(s, LEXICAL.get(s, 0.0)) for s in symbols])


@pytest.mark.parametrize("length", range(6))
def test_all_clauses_of_symbols(length):
    for symbols in itertools.product(SYMBOLS, repeat=length):
        assert weighed(symbols) == pytest.approx(defined(symbols)), symbols


def test_longer_clauses_reach_as_far_as_defined():
    few = (INSULT, THREAT, TARGET, NEGATION, OTHER)
    gaps = [(a, *[OTHER] * n, b, *[OTHER] * m, c) for a, b, c in itertools.product(few, repeat=3)
            for n, m in itertools.product(range(6), repeat=2)]
    for symbols in gaps:
        assert weighed(symbols) == pytest.approx(defined(symbols)), symbols


def test_composition_multiplies_and_chains():
    def relabel(source, result, factor):
        row = tuple(((0, result if s == source else s, factor if s == source else 1.0),) for s in SYMBOLS)
        return Transducer((row,), frozenset([0]))

    both = compose(relabel(OTHER, INSULT, 0.5), relabel(INSULT, THREAT, 0.25))
    assert both.arcs[0][OTHER] == ((0, THREAT, 0.125),)
    assert both.arcs[0][INSULT] == ((0, THREAT, 0.25),)
    dead = Transducer((tuple(() for _ in SYMBOLS),), frozenset([0]))
    assert compose(both, dead).best([(OTHER, 1.0)]) == 0.0


@pytest.mark.parametrize(
    "text, toxic",
    [
        ("The word idiot is in the dictionary.", False),
        ("He was called an idiot in the report.", False),
        ("You aren't stupid.", False),
        ("You aren’t stupid.", False),
        ("You're not an idiot", False),
        ("This will kill time before the show.", False),
        ("You are an idiot.", True),
        ("I will kill you", True),
        ("", False),
        (None, False),
    ],
)
def test_seed_grammar_scores_clauses_not_words(text, toxic):
    grammar = Grammar(dict.fromkeys(toxicity.INSULTS, toxicity.SEED_WEIGHT))
    assert (grammar.score(text) >= 0.5) == toxic


def test_apostrophes_score_alike():
    grammar = Grammar(dict.fromkeys(toxicity.INSULTS, toxicity.SEED_WEIGHT))
    assert grammar.score("You aren’t stupid.") == grammar.score("You aren't stupid.")
