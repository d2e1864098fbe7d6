from __future__ import annotations

import math
import random
from functools import reduce

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tickloom.llm import toxicity
from tickloom.llm.transducers import Arc, Table, compose, readings, transducer

SYMBOLS = st.lists(st.integers(0, (1 << toxicity.CLASS_BITS) - 1), max_size=40)


def in_sequence(parts, symbols):
    """Every machine over the whole output of the one before it."""
    weights = [1.0] * len(symbols)
    for part in parts:
        read = list(part.run(symbols))
        symbols = [symbol for symbol, _ in read]
        weights = [a * b for a, (_, b) in zip(weights, read, strict=True)]
    return list(zip(symbols, weights, strict=True))


@settings(max_examples=400, deadline=None)
@given(SYMBOLS)
def test_composed_machine_does_what_its_parts_do_in_sequence(symbols):
    parts = toxicity.parts()
    assert list(reduce(compose, parts).run(symbols)) == in_sequence(parts, symbols)


@settings(max_examples=200, deadline=None)
@given(SYMBOLS)
def test_table_walks_like_the_machine(symbols):
    table, row, got = toxicity.machine(), 0, []
    for symbol in symbols:
        at = row + symbol
        got.append((symbol | table.marks[at], table.weights[at]))
        row = table.next[at]
    assert got == in_sequence(toxicity.parts(), symbols)


def test_composition_is_associative():
    a, b, c, d, e = toxicity.parts()
    dice = random.Random(3)
    symbols = [dice.randrange(1 << toxicity.CLASS_BITS) for _ in range(3000)]
    left = reduce(compose, [a, b, c, d, e])
    right = compose(a, compose(b, compose(c, compose(d, e))))
    assert list(left.run(symbols)) == list(right.run(symbols))


def test_weights_multiply_and_marks_are_read():
    """The second machine counts the first one's marks, two of them at a time."""
    first = transducer(0, 1, lambda s, bits: Arc(s, 4 if bits else 0, 0.5))
    second = transducer(0, 4 | 2, lambda s, bits: Arc((s + (bits & 4 > 0)) % 2, 8 if s and bits & 4 else 0, 3.0))
    both = compose(first, second)
    assert both.reads == 3 and both.writes == 12
    assert list(both.run([1, 0, 1, 3])) == [(5, 1.5), (0, 1.5), (13, 1.5), (7, 1.5)]


def test_table_refuses_a_machine_that_waits_for_marks():
    with pytest.raises(ValueError):
        Table(toxicity.threat(3), toxicity.CLASS_BITS)


def test_readings():
    assert sorted(readings(0b1010)) == [0, 2, 8, 10] and list(readings(0)) == [0]


def decided(text):
    """Scored with the given lexicon and weights."""
    constant, *weights = toxicity.PRIOR
    figures = toxicity.grammar({"=" + w: v for w, v in toxicity.INSULTS.items()}).figures(text)
    return 1 / (1 + math.exp(-constant - sum(f * w for f, w in zip(figures, weights, strict=True)))) >= toxicity.THRESHOLD


@pytest.mark.parametrize(
    ("text", "toxic"),
    [
        ("You stupid idiot, get out", True),
        ("You are not a stupid idiot", False),  # denied
        ("She wrote that you are a stupid idiot", False),  # quoted
        ("She wrote to us. You are a stupid idiot", True),  # the quotation ends with its clause
        ("Not that it helps here, you stupid idiot", True),  # beyond the scope of the negation
        ("You are trash", False),
        ("You are trash, I will kill you", True),  # threat and insult
        ("You are trash, I will never kill you", False),  # threat denied
        ("You are trash, he said I will kill you", False),  # threat quoted
        ("You are trash, I will kill the lights and then see you", False),  # target too far away
    ],
)
def test_scopes_change_decisions(text, toxic):
    assert decided(text) == toxic


def test_a_match_near_a_target_weighs_more():
    machine = toxicity.Grammar({"=idiot": 2.0})
    near, far = machine.clause("you utter idiot".split()), machine.clause("an utter idiot".split())
    assert near[0] == far[0] and near[1] > far[1]
