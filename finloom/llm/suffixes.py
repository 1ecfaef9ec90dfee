"""Suffix arrays by induced sorting, in array operations.

Suffixes are L or S type (larger or smaller than the one after them). The leftmost-smaller ones are sorted by their
substrings up to the next such place; equal substrings get one name, and the string of names is sorted in turn. From
their order all L suffixes follow in one pass over the buckets of first bytes, and from those all S suffixes in a pass
back. A pass handles what a bucket holds at once and deals the preceding suffixes to their buckets, so its cost is
linear and only the buckets are looped over.
"""

from __future__ import annotations

import numpy as np

BUCKETED = 4096  # strings over more symbols than this are sorted by doubling instead


def doubled(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; only suffixes whose order is open are sorted again."""
    size = len(text)
    order = np.argsort(text, kind="stable")
    new = np.concatenate([[True], text[order][1:] != text[order][:-1]])
    rank = np.empty(size, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(size), 0))
    step = 1
    while not new.all():
        bounds = np.flatnonzero(np.append(new, True))
        tied = np.repeat(np.diff(bounds) > 1, np.diff(bounds))
        at = np.flatnonzero(tied)
        own = order[at]
        beyond = np.where(own + step < size, rank[np.minimum(own + step, size - 1)], -1)
        group = rank[own]
        inner = np.lexsort((beyond, group))
        own, beyond, group = own[inner], beyond[inner], group[inner]
        order[at] = own
        new[at] = np.concatenate([[True], (group[1:] != group[:-1]) | (beyond[1:] != beyond[:-1])])
        rank[order] = np.maximum.accumulate(np.where(new, np.arange(size), 0))
        step *= 2
    return order


def deal(places: np.ndarray, text: np.ndarray, wanted: np.ndarray, piles: list[list[np.ndarray]]) -> None:
    """Puts the places before these, where they are wanted, on the piles of their symbols; order is kept."""
    before = places[places > 0] - 1
    before = before[wanted[before]]
    if not len(before):
        return
    symbols = text[before]
    by = np.argsort(symbols, kind="stable")
    before, symbols = before[by], symbols[by]
    cuts = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1]]))
    for begin, end in zip(cuts, [*cuts[1:], len(before)], strict=True):
        piles[symbols[begin]].append(before[begin:end])


def induce(text: np.ndarray, symbols: int, smaller: np.ndarray, stars: np.ndarray) -> np.ndarray:
    """The order of all suffixes that follows from the order of the leftmost-smaller ones (``stars``)."""
    larger = ~smaller
    seeds: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    heads: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    tails: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    by = np.argsort(text[stars], kind="stable")
    for part in np.split(stars[by], np.flatnonzero(np.diff(text[stars][by])) + 1):
        if len(part):
            seeds[text[part[0]]].append(part)
    # The end of the text is smaller than all else: the last suffix is the first to be induced.
    heads[text[-1]].append(np.array([len(text) - 1]))
    for symbol in range(symbols):
        done = 0
        while done < len(heads[symbol]):
            fresh = np.concatenate(heads[symbol][done:])
            done = len(heads[symbol])
            deal(fresh, text, larger, heads)
        for part in seeds[symbol]:
            deal(part, text, larger, heads)
    for symbol in range(symbols - 1, -1, -1):
        done = 0
        while done < len(tails[symbol]):
            fresh = np.concatenate(tails[symbol][done:])
            done = len(tails[symbol])
            deal(fresh, text, smaller, tails)
        if heads[symbol]:
            deal(np.concatenate(heads[symbol])[::-1], text, smaller, tails)
    out = []
    for symbol in range(symbols):
        out.extend(heads[symbol])
        if tails[symbol]:
            out.append(np.concatenate(tails[symbol])[::-1])
    return np.concatenate(out)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The starts of all suffixes in lexicographic order; a suffix comes before those it begins."""
    size = len(text)
    if size < 2:
        return np.arange(size)
    symbols = int(text.max()) + 1
    if symbols > BUCKETED:
        return doubled(text)
    # S type: the next different symbol is larger. The last suffix is L type.
    change = np.flatnonzero(text[1:] != text[:-1])
    following = np.append(change, size - 1)[np.searchsorted(change, np.arange(size))]
    smaller = np.zeros(size, bool)
    known = following < size - 1
    smaller[known] = text[following[known]] < text[following[known] + 1]
    stars = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if len(stars) > 1:
        order = induce(text, symbols, smaller, stars)
        is_star = np.zeros(size, bool)
        is_star[stars] = True
        ordered = order[is_star[order]]
        end = np.zeros(size, np.int64)
        end[stars] = np.append(stars[1:], size - 1) + 1  # a substring ends with the next star
        lengths = end[ordered] - ordered
        one, other = ordered[:-1], ordered[1:]
        same = lengths[:-1] == lengths[1:]
        at = np.flatnonzero(same)
        spans = lengths[:-1][at]
        firsts = np.cumsum(spans) - spans
        inside = np.arange(int(spans.sum())) - np.repeat(firsts, spans)
        if len(at):
            equal = text[np.repeat(one[at], spans) + inside] == text[np.repeat(other[at], spans) + inside]
            same[at] = np.logical_and.reduceat(equal, firsts)
            same[at] &= (end[one[at]] < size) & (end[other[at]] < size)
        names = np.concatenate([[0], np.cumsum(~same)])
        if names[-1] + 1 < len(stars):
            named = np.zeros(size, np.int64)
            named[ordered] = names
            ordered = stars[suffix_array(named[stars])]
        stars = ordered
    return induce(text, symbols, smaller, stars)


def permuted_common_prefixes(text: np.ndarray, order: np.ndarray, limit: int,
                             wanted: np.ndarray | None = None) -> np.ndarray:
    """For each place the common prefix with the suffix before it in ``order``, up to ``limit`` symbols of a byte.

    In order of places: comparing in steps of eight bytes, only suffixes that still agree go on. Where ``wanted`` is
    given, only its places are compared; the others get zero.
    """
    size = len(text)
    padded = np.concatenate([text.astype(np.uint8), np.zeros(limit + 16, np.uint8)])
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)
    before = np.full(size, -1, np.int64)
    before[order[1:]] = order[:-1]
    out = np.zeros(size, np.int64)
    at = np.flatnonzero(before >= 0 if wanted is None else (before >= 0) & wanted)
    other = before[at]
    for step in range(0, limit, 8):
        if not len(at):
            break
        equal = np.ascontiguousarray(eight[at + step]) == np.ascontiguousarray(eight[other + step])
        run = np.where(equal.all(axis=1), 8, equal.argmin(axis=1))
        out[at] += run
        on = (run == 8) & (at + step + 8 < size) & (other + step + 8 < size)
        at, other = at[on], other[on]
    inside = np.minimum(size - np.arange(size), np.where(before >= 0, size - before, 0))
    return np.minimum(np.minimum(out, limit), inside)
