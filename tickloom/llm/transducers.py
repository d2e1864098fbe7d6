"""Weighted finite-state transducers over words whose classes and marks are bits of one number.

An arc reads some bits of a symbol, adds marks to it and moves on; bits that it does not read pass
through. Composition feeds what the first machine leaves on a word to the second, and multiplies the
weights of their arcs; it explores the pairs of states that can be reached and gives a machine of the same kind, with one explicit arc for
each state and each reading.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable, Iterator
from dataclasses import dataclass
from typing import NamedTuple


class Arc(NamedTuple):
    state: Hashable
    marks: int
    weight: float


@dataclass(frozen=True)
class Transducer:
    """Arcs by state and by the bits read. ``writes`` holds all bits that any arc may add."""

    start: Hashable
    reads: int
    writes: int
    arcs: dict[tuple[Hashable, int], Arc]

    def run(self, symbols: Iterable[int]) -> Iterator[tuple[int, float]]:
        """Each symbol with its marks, and the weight of the arc that read it."""
        state = self.start
        for symbol in symbols:
            state, marks, weight = self.arcs[state, symbol & self.reads]
            yield symbol | marks, weight


def readings(bits: int) -> Iterator[int]:
    """All numbers made of some of the bits."""
    found = bits
    while True:
        yield found
        if not found:
            return
        found = (found - 1) & bits


def transducer(start: Hashable, reads: int, step: Callable[[Hashable, int], Arc]) -> Transducer:
    """The machine of all arcs that ``step`` gives from the states that can be reached."""
    arcs: dict[tuple[Hashable, int], Arc] = {}
    todo, known, writes = [start], {start}, 0
    while todo:
        state = todo.pop()
        for bits in readings(reads):
            arc = arcs[state, bits] = step(state, bits)
            writes |= arc.marks
            if arc.state not in known:
                known.add(arc.state)
                todo.append(arc.state)
    return Transducer(start, reads, writes, arcs)


def compose(first: Transducer, second: Transducer) -> Transducer:
    """One machine that does what ``second`` does to the output of ``first``. A mark of ``first`` is an
    input of the whole only where ``first`` reads it too, so marks must not come with the words."""

    def step(state: Hashable, bits: int) -> Arc:
        a = first.arcs[state[0], bits & first.reads]
        b = second.arcs[state[1], (bits | a.marks) & second.reads]
        return Arc((a.state, b.state), a.marks | b.marks, a.weight * b.weight)

    return transducer((first.start, second.start), first.reads | (second.reads & ~first.writes), step)


class Table:
    """A transducer as flat lists for walking: row of the next state, marks and weight, by row and symbol."""

    def __init__(self, machine: Transducer, bits: int) -> None:
        """``bits``: number of low bits that hold the classes of a word; the machine reads no others."""
        if machine.reads >> bits:
            raise ValueError("the machine reads bits that are no class of a word")
        states = list({state: None for state, _ in machine.arcs})
        states.sort(key=lambda state: state != machine.start)
        rows = {state: at << bits for at, state in enumerate(states)}
        every = [machine.arcs[state, symbol & machine.reads] for state in states for symbol in range(1 << bits)]
        self.next = [rows[arc.state] for arc in every]
        self.marks = [arc.marks for arc in every]
        self.weights = [arc.weight for arc in every]
