"""Weighted acyclic automata: minimal transducers from word sequences to counts.

Keys are tuples of words, added in ascending order. States that can no longer change are looked up among those there are, so equal
ends are stored once; weights lie as near to the start as they can, so that a key's weight is the sum along its path.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator, Mapping
from itertools import groupby
from typing import Any

import pyarrow as pa

Key = tuple[str, ...]

#: A transducer as columns: its words, then for each state how many arcs leave it and the weight of ending there (-1: none ends),
#: then word, target and weight of every arc. States come after those that they lead to; the last one is the start.
COLUMNS = "words array<string>, arcs array<int>, ends array<long>, arc_word array<int>, arc_to array<int>, arc_weight array<long>"
_FIELDS = (("words", pa.string()), ("arcs", pa.int32()), ("ends", pa.int64()), ("arc_word", pa.int32()), ("arc_to", pa.int32()), ("arc_weight", pa.int64()))


class Transducer:
    """``states`` has for each state the weight of ending there (None: no key ends) and its arcs (word, target, weight), by word."""

    def __init__(self, states: list[tuple[int | None, tuple[tuple[str, int, int], ...]]]):
        self.states = states

    @property
    def start(self) -> int:
        return len(self.states) - 1

    def items(self) -> Iterator[tuple[Key, int]]:
        """All keys with their weights, ascending."""
        stack: list[tuple[int, Key, int]] = [(self.start, (), 0)]
        while stack:
            state, key, weight = stack.pop()
            end, arcs = self.states[state]
            if end is not None:
                yield key, weight + end
            stack.extend((to, (*key, word), weight + more) for word, to, more in reversed(arcs))

    def compose(self, asked: "Transducer") -> Iterator[tuple[Key, int]]:
        """The keys of ``asked`` that are here, with the weights they have here: both are walked at once."""
        stack: list[tuple[int, int, Key, int]] = [(self.start, asked.start, (), 0)]
        while stack:
            state, other, key, weight = stack.pop()
            (end, arcs), (wanted, further) = self.states[state], asked.states[other]
            if end is not None and wanted is not None:
                yield key, weight + end
            targets = {word: to for word, to, _ in further}
            stack.extend((to, targets[word], (*key, word), weight + more) for word, to, more in reversed(arcs) if word in targets)

    def row(self) -> dict[str, list]:
        """The columns of ``COLUMNS``."""
        arcs = [arc for _, own in self.states for arc in own]
        words = sorted({word for word, _, _ in arcs})
        place = {word: i for i, word in enumerate(words)}
        return {
            "words": words, "arcs": [len(own) for _, own in self.states], "ends": [-1 if end is None else end for end, _ in self.states],
            "arc_word": [place[word] for word, _, _ in arcs], "arc_to": [to for _, to, _ in arcs], "arc_weight": [weight for _, _, weight in arcs]}

    @classmethod
    def from_row(cls, row: Mapping[str, Any]) -> "Transducer":
        words, at, states = row["words"], 0, []
        arcs = list(zip((words[i] for i in row["arc_word"]), row["arc_to"], row["arc_weight"], strict=True))
        for n, end in zip(row["arcs"], row["ends"], strict=True):
            states.append((None if end < 0 else end, tuple(arcs[at:at + n])))
            at += n
        return cls(states)


def arrays(transducers: Iterable[Transducer]) -> list[pa.Array]:
    """The columns of several transducers, one row each."""
    rows = [t.row() for t in transducers]
    return [pa.array([r[name] for r in rows], pa.list_(kind)) for name, kind in _FIELDS]


class _Open:
    """A state on the path of the last key: it may still get arcs."""

    def __init__(self) -> None:
        self.end: int | None = None
        self.arcs: list[list] = []

    def push(self, weight: int) -> None:
        """Carry weight over the state to all that goes on from it."""
        if self.end is not None:
            self.end += weight
        for arc in self.arcs:
            arc[2] += weight


class Builder:
    """Builds the minimal transducer of keys that come in ascending order, each once."""

    def __init__(self) -> None:
        self._states: list = []
        self._known: dict = {}
        self._path = [_Open()]
        self._last: Key = ()

    def add(self, key: Key, weight: int) -> None:
        shared = 0
        while shared < len(self._last) and shared < len(key) and self._last[shared] == key[shared]:
            shared += 1
        self._close(shared)
        for i in range(shared):
            arc = self._path[i].arcs[-1]
            common = min(arc[2], weight)
            self._path[i + 1].push(arc[2] - common)
            arc[2], weight = common, weight - common
        for word in key[shared:]:
            self._path[-1].arcs.append([word, -1, weight])
            self._path.append(_Open())
            weight = 0
        self._path[-1].end = weight
        self._last = key

    def _close(self, keep: int) -> None:
        """Settle the states of the last key's path beyond the first ``keep`` words."""
        while len(self._path) > keep + 1:
            state = self._path.pop()
            self._path[-1].arcs[-1][1] = self._settled(state)

    def _settled(self, state: _Open) -> int:
        content = (state.end, tuple(map(tuple, state.arcs)))
        if content not in self._known:
            self._known[content] = len(self._states)
            self._states.append(content)
        return self._known[content]

    def finish(self) -> Transducer:
        self._close(0)
        start = self._path[0]
        self._states.append((start.end, tuple(map(tuple, start.arcs))))
        return Transducer(self._states)


def build(items: Iterable[tuple[Key, int]]) -> Transducer:
    builder = Builder()
    for key, weight in items:
        builder.add(key, weight)
    return builder.finish()


def union(transducers: Iterable[Transducer], least: int = 0) -> Transducer:
    """All keys of all, weights summed up; those of less than ``least`` in all are left out."""
    merged = groupby(heapq.merge(*(t.items() for t in transducers)), key=lambda item: item[0])
    summed = ((key, sum(weight for _, weight in same)) for key, same in merged)
    return build((key, weight) for key, weight in summed if weight >= least)
