"""Simple-8b: whole numbers packed into 64-bit words, encoded and decoded with array operations.

The top four bits of a word select how many values it holds and their width; the other 60 bits hold them, first
value lowest. Selector 0 is an escape: the word's payload is an index into a list of full 64-bit values behind the
words. Since every word says how many values it holds, decoding places all words of one selector at once.
"""

from __future__ import annotations

import numpy as np

# Fixed values: (values per word, bits per value) by selector; selector 0 is the escape.
SELECTORS = ((1, 60), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12),
             (4, 15), (3, 20), (2, 30), (1, 60))
COUNTS = np.array([count for count, _ in SELECTORS])
PAYLOAD = np.uint64((1 << 60) - 1)
SMALL = 1 << 18  # numbers below have their bits in a table
BITS = np.frexp(np.arange(SMALL))[1].astype(np.uint8)


def bits_of(values: np.ndarray) -> np.ndarray:
    """The bits of each value, as bytes."""
    if not len(values) or values.max() < SMALL:
        return BITS[values.astype(np.intp)]
    return np.searchsorted(np.uint64(1) << np.arange(64, dtype=np.uint64), values, side="right").astype(np.uint8)


def widest(bits: np.ndarray) -> dict[int, np.ndarray]:
    """By number of values: the most bits that so many of them have, from each place on."""
    size, longest = len(bits), int(COUNTS.max())
    runs, length = {1: np.concatenate([bits, np.zeros(longest, np.uint8)])}, 1
    while 2 * length <= longest:
        runs[2 * length] = np.maximum(runs[length][:-length], runs[length][length:])
        length *= 2
    out = {}
    for count in set(COUNTS.tolist()):  # two runs of a power of two, which may overlap
        half = 1 << (count.bit_length() - 1)
        run = runs[half]
        out[count] = np.maximum(run[:size], run[count - half:count - half + size])
    return out


def choose(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word starts, and its selector: at every place the one that takes most values."""
    size = len(values)
    selector = np.zeros(size, np.uint8)
    most = widest(bits_of(values))  # values beyond the end count as zeros
    for at in range(len(SELECTORS) - 1, 0, -1):
        count, width = SELECTORS[at]
        np.copyto(selector, np.uint8(at), where=most[count] <= width)
    steps = COUNTS[selector].astype(np.uint8).tobytes()  # as bytes they are read without a list of numbers
    starts, at = [], 0
    while at < size:
        starts.append(at)
        at += steps[at]
    starts = np.array(starts, np.int64)
    return starts, selector[starts]


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and escaped values of an array of unsigned 64-bit numbers."""
    values = values.astype(np.uint64)
    starts, selectors = choose(values)
    padded = np.concatenate([values, np.zeros(128, np.uint64)])
    words = selectors.astype(np.uint64) << np.uint64(60)
    escaped = padded[starts[selectors == 0]]
    words[selectors == 0] |= np.arange(len(escaped), dtype=np.uint64)
    for at in range(1, len(SELECTORS)):
        count, width = SELECTORS[at]
        own = np.flatnonzero(selectors == at)
        if width and len(own):
            taken = padded[starts[own][:, None] + np.arange(count)]
            words[own] |= np.bitwise_or.reduce(taken << (np.arange(count) * width).astype(np.uint64), axis=1)
    return words, escaped


def decode(words: np.ndarray, escaped: np.ndarray, size: int) -> np.ndarray:
    """The first ``size`` values of the words."""
    selectors = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[selectors]
    starts = np.cumsum(counts) - counts
    out = np.zeros(size + 128, np.uint64)
    for at, (count, width) in enumerate(SELECTORS):
        own = np.flatnonzero(selectors == at)
        if not len(own):
            continue
        payload = words[own] & PAYLOAD
        if at == 0:
            out[starts[own]] = escaped[payload.astype(np.int64)]
        elif width:
            shifted = payload[:, None] >> (np.arange(count) * width).astype(np.uint64)
            out[starts[own][:, None] + np.arange(count)] = shifted & np.uint64((1 << width) - 1)
    return out[:size]
