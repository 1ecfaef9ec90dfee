"""Weighted acyclic automata over words: count transducers that map a phrase to its count.

A phrase is a tuple of byte strings. Every arc carries a word and the count of the phrase that ends on it (0: no phrase
ends there). States with the same arcs, counts included, are one state, so endings that phrases have in common are stored
once. ``build`` takes phrases in ascending order and settles a state as soon as no later phrase can reach it.

Many phrases are rows of word numbers (-1 behind a phrase's end) with their counts, in arrays: ``rows`` unfolds an automaton
to them, ``built`` folds ascending rows by height, ``union`` adds rows up. Python objects for each phrase take ten times that.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np

Phrase = tuple[bytes, ...]
HEAD = struct.Struct("<4sIII")
MAGIC = b"WAT1"
SMALL = 384  # so few phrases fold faster one by one


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, so many as its size, behind one another."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def keys_of(ids: np.ndarray, words: int) -> list[np.ndarray]:
    """A few whole numbers a row, the first one decides first, that order rows as their columns do."""
    base = words + 1
    fit = max(1, 63 // base.bit_length())
    keys = []
    for at in range(0, ids.shape[1], fit):
        key = np.zeros(len(ids), np.int64)
        for column in ids.T[at:at + fit]:
            key *= base
            key += column + 1
        keys.append(key)
    return keys


def summed(ids: np.ndarray, counts: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Ascending rows, each once, counts added."""
    if not len(ids):
        return ids, counts
    keys = keys_of(ids, words)
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(ids), bool)
    new[0] = True
    for key in keys:
        key = key[order]
        new[1:] |= key[1:] != key[:-1]
    first = np.flatnonzero(new)
    return ids[order[first]], np.add.reduceat(counts[order], first)


class Automaton:
    """States by number, the last one the root; of each the first of its arcs, which are sorted by word."""

    def __init__(self, words: list[bytes], first, label, target, weight):
        self.words, self.first, self.label, self.target, self.weight = words, first, label, target, weight

    @property
    def root(self) -> int:
        return len(self.first) - 2

    @cached_property
    def plain(self) -> tuple[list[int], list[int], list[int], list[int]]:
        """Firsts, labels, targets and weights as lists, to walk arc by arc."""
        return tuple(x.tolist() if isinstance(x, np.ndarray) else x
                     for x in (self.first, self.label, self.target, self.weight))

    def items(self) -> Iterator[tuple[Phrase, int]]:
        """All phrases in ascending order, with their counts."""
        first, label, target, weight = self.plain
        path: list[bytes] = []
        open_arcs = [iter(range(first[self.root], first[self.root + 1]))]
        while open_arcs:
            arc = next(open_arcs[-1], None)
            if arc is None:
                open_arcs.pop()
                if path:
                    path.pop()
                continue
            path.append(self.words[label[arc]])
            if weight[arc]:
                yield tuple(path), weight[arc]
            open_arcs.append(iter(range(first[target[arc]], first[target[arc] + 1])))

    def rows(self) -> tuple[np.ndarray, np.ndarray]:
        """All phrases in ascending order, as rows of numbers of ``words``, with their counts."""
        first, label, target, weight = (np.asarray(x, np.int64) for x in (self.first, self.label, self.target, self.weight))
        state, counts, columns = np.array([self.root]), np.zeros(1, np.int64), []
        # Each round puts behind every phrase those that are one word longer.
        while True:
            begin = first[state]
            arcs = np.where(state >= 0, first[state + 1] - begin, 0)
            if not arcs.any():
                break
            own = (counts > 0).astype(np.int64)
            source = np.repeat(np.arange(len(state)), arcs + own)
            place = ranges(np.zeros(len(state), np.int64), arcs + own) - own[source]
            longer = place >= 0
            arc = np.where(longer, begin[source] + place, 0)
            columns = [column[source] for column in columns]
            columns.append(np.where(longer, label[arc], -1).astype(np.int32))
            counts = np.where(longer, weight[arc], counts[source])
            state = np.where(longer, target[arc], -1)
        some = counts > 0
        return np.column_stack([np.zeros((some.sum(), 0), np.int32), *(c[some] for c in columns)]), counts[some]

    def to_bytes(self) -> bytes:
        ends = np.cumsum([len(word) for word in self.words], dtype="<u4")
        return b"".join([
            HEAD.pack(MAGIC, len(self.words), len(self.first), len(self.label)), ends.tobytes(),
            np.array(self.first, "<u4").tobytes(), np.array(self.label, "<u4").tobytes(),
            np.array(self.target, "<u4").tobytes(), np.array(self.weight, "<u8").tobytes(), *self.words])

    @classmethod
    def from_bytes(cls, data: bytes) -> Automaton:
        magic, words, states, arcs = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a weighted automaton")
        at, parts = HEAD.size, []
        for kind, n in (("<u4", words), ("<u4", states), ("<u4", arcs), ("<u4", arcs), ("<u8", arcs)):
            parts.append(np.frombuffer(data, kind, n, at))
            at += n * (8 if kind == "<u8" else 4)
        ends = [at + end for end in parts[0].tolist()]
        return cls([data[a:b] for a, b in zip([at, *ends], ends, strict=False)], *parts[1:])


def build(phrases: Iterable[tuple[Phrase, int]]) -> Automaton:
    """The automaton of phrases that come in ascending order, each once."""
    known: dict[tuple, int] = {}
    states: list[tuple] = []
    path: list[list[list]] = [[]]  # arcs of the states along the last phrase, [word, count, target]
    last: Phrase = ()

    def settle(arcs: list[list]) -> int:
        state = tuple(map(tuple, arcs))
        if state not in known:
            known[state] = len(states)
            states.append(state)
        return known[state]

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            state = settle(path.pop())
            path[-1][-1][2] = state

    for phrase, weight in phrases:
        if phrase <= last:
            raise ValueError("phrases must ascend")
        same = 0
        while same < min(len(last), len(phrase)) and last[same] == phrase[same]:
            same += 1
        close(same)
        for word in phrase[same:]:
            path[-1].append([word, 0, None])
            path.append([])
        path[len(phrase) - 1][-1][1] = weight
        last = phrase
    close(0)
    states.append(tuple(map(tuple, path[0])))  # the root is the last, even where it equals another state

    words = sorted({arc[0] for state in states for arc in state})
    number = {word: i for i, word in enumerate(words)}
    first, label, target, weights = [0], [], [], []
    for state in states:
        for word, weight, to in state:
            label.append(number[word])
            target.append(to)
            weights.append(weight)
        first.append(len(label))
    return Automaton(words, first, label, target, weights)


def codes(*columns: np.ndarray) -> np.ndarray:
    """The same number where all columns are the same."""
    order = np.lexsort(columns)
    new = np.zeros(len(order), bool)
    for column in columns:
        column = column[order]
        new[1:] |= column[1:] != column[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def built(words: list[bytes], ids: np.ndarray, counts: np.ndarray) -> Automaton:
    """The automaton of ascending rows of numbers of ``words`` (ascending, too), each once."""
    if len(ids) < max(SMALL, 1):
        return build((tuple(words[i] for i in row if i >= 0), n) for row, n in zip(ids.tolist(), counts.tolist(), strict=True))
    # A node for each different beginning of a phrase, by length: its last word, count, and the node one word shorter.
    fresh = np.ones(ids.shape, bool)
    np.not_equal(ids[1:], ids[:-1], out=fresh[1:])
    label, weight, above, borders, node = [np.zeros(1, np.int32)], [np.zeros(1, np.int64)], [], [0, 1], np.zeros(len(ids), np.int64)
    for length in range(ids.shape[1]):
        if length:
            fresh[:, length] |= fresh[:, length - 1]
        here = fresh[:, length] & (ids[:, length] >= 0)
        rows = np.flatnonzero(here)
        ends = ids[rows, length + 1] < 0 if length + 1 < ids.shape[1] else np.ones(len(rows), bool)
        label.append(ids[rows, length])
        weight.append(np.where(ends, counts[rows], 0))
        above.append(node[rows])
        node = borders[-1] + np.cumsum(here) - 1
        borders.append(borders[-1] + len(rows))
    label, weight, above = np.concatenate(label), np.concatenate(weight), np.concatenate(above)
    arcs = np.bincount(above, minlength=len(label))
    begin = 1 + np.cumsum(arcs) - arcs
    height = np.zeros(len(label), np.int64)
    for start, end in zip(borders[-2:0:-1], borders[:1:-1], strict=True):
        np.maximum.at(height, above[start - 1:end - 1], height[start:end] + 1)
    # Nodes with the same arcs are one state; their arcs lead to nodes of less height, whose states are known.
    state, states, shown = np.zeros(len(label), np.int64), 1, [np.flatnonzero(height == 0)[:1]]
    for level in range(1, int(height[0]) + 1):
        nodes = np.flatnonzero(height[1:] == level) + 1
        own = ranges(begin[nodes], arcs[nodes])
        code, at = codes(label[own], weight[own], state[own]), np.cumsum(arcs[nodes]) - arcs[nodes]
        sizes, kind, times = np.unique(arcs[nodes], return_inverse=True, return_counts=True)
        alone = nodes[times[kind] == 1]
        state[alone] = states + np.arange(len(alone))
        shown.append(alone)
        states += len(alone)
        for size in sizes[times > 1].tolist():
            some = np.flatnonzero(arcs[nodes] == size)
            sets = code[at[some][:, None] + np.arange(size)]
            sets = sets[:, 0] if size == 1 else sets.view(np.dtype((np.void, 8 * size)))[:, 0]
            _, one, place = np.unique(sets, return_index=True, return_inverse=True)
            state[nodes[some]] = states + place
            shown.append(nodes[some][one])
            states += len(one)
    shown = np.concatenate([*shown, [0]])  # the root is the last, even where it equals another state
    own = ranges(begin[shown], arcs[shown])
    used, number = np.unique(label[own], return_inverse=True)
    return Automaton([words[i] for i in used.tolist()], np.append(0, np.cumsum(arcs[shown])), number, state[own], weight[own])


def union(parts: Iterable[Automaton], least: int = 1, always: int = 0) -> Automaton:
    """The automaton of all phrases of the parts, counts added; those below ``least`` go if longer than ``always``."""
    parts = list(parts)
    words = sorted(set().union(*(part.words for part in parts)))
    number = {word: i for i, word in enumerate(words)}
    unfolded = [(np.array([*map(number.__getitem__, part.words), -1], np.int32), *part.rows()) for part in parts]
    width = max((ids.shape[1] for _, ids, _ in unfolded), default=0)
    ids = np.full((sum(len(n) for *_, n in unfolded), width), -1, np.int32)
    at = 0
    for here, own, _ in unfolded:
        ids[at:at + len(own), :own.shape[1]] = here[own]
        at += len(own)
    counts = np.concatenate([np.zeros(0, np.int64), *(n for *_, n in unfolded)])
    ids, counts = summed(ids, counts, len(words))
    left = (counts >= least) | ((ids >= 0).sum(axis=1) <= always)
    return built(words, ids[left], counts[left])


def compose(asked: Automaton, counts: Automaton) -> Automaton:
    """The phrases that ``asked`` accepts with the counts that ``counts`` gives them; both are walked at once."""
    tables: dict[int, dict[bytes, int]] = {}
    first, label, target, weight = counts.plain
    ask_first, ask_label, ask_target, ask_weight = asked.plain

    def table(state: int) -> dict[bytes, int]:
        if state not in tables:
            tables[state] = {counts.words[label[arc]]: arc for arc in range(first[state], first[state + 1])}
        return tables[state]

    def walk(one: int, other: int, path: Phrase) -> Iterator[tuple[Phrase, int]]:
        there = table(other)
        for arc in range(ask_first[one], ask_first[one + 1]):
            word = asked.words[ask_label[arc]]
            match = there.get(word)
            if match is not None:
                here = (*path, word)
                if ask_weight[arc] and weight[match]:
                    yield here, weight[match]
                yield from walk(ask_target[arc], target[match], here)

    return build(walk(asked.root, counts.root, ()))
