"""Anchors: content-chosen places that let equal windows meet without comparing all windows.

A window of ``length`` symbols holds ``length - gram + 1`` grams; its anchor is
the gram of least hash, the leftmost of equals. The choice depends on nothing
but the window's content, so equal windows have the same anchor gram at the same
place within. Neighbouring windows mostly share their anchor: they form one run,
a stretch of text that is described by one row. About two of ``length - gram + 2``
symbols become anchors, whatever the text.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from corvane.llm.words import powers

#: Low bits of a sort key that hold a place within a block.
PLACE_BITS = 26


class Runs(NamedTuple):
    """Runs of windows with one anchor; all places are within the block."""

    first: np.ndarray  # start of the first window
    windows: np.ndarray  # number of windows
    anchor: np.ndarray  # start of the anchor gram
    gram: np.ndarray  # hash of the anchor gram
    stretch: np.ndarray  # hash of all the run covers, and of where the anchor lies in it


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def spread_bytes() -> np.ndarray:
    """A 64-bit value for each byte."""
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def prefix_sums(symbols: np.ndarray) -> np.ndarray:
    """Sums whose differences, scaled by ``powers``, are polynomial hashes of stretches."""
    up, _ = powers(1 << max(20, (len(symbols) + 1).bit_length()))
    sums = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(symbols * up[: len(symbols)], out=sums[1:])
    return sums


def stretch_hash(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = powers(1 << max(20, len(sums).bit_length()))
    return (sums[end] - sums[begin]) * down[begin]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    out, span = values, 1
    while 2 * span <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def runs(symbols: np.ndarray, ends: np.ndarray, length: int, gram: int) -> Runs:
    """The runs of all windows within texts that end at ``ends`` in ``symbols``.

    ``symbols`` are 64-bit values, equal where the text's symbols are equal.
    """
    n, width = len(symbols), length - gram + 1
    if n < length:
        none = np.zeros(0, np.int64)
        return Runs(none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    if n >> PLACE_BITS:
        raise ValueError("a block must stay below 2**26 symbols")
    sums = prefix_sums(symbols)
    _, down = powers(1 << max(20, (n + 1).bit_length()))
    grams = mix((sums[gram:] - sums[:-gram]) * down[: n - gram + 1])
    low = np.uint64((1 << PLACE_BITS) - 1)
    keyed = (grams & ~low) | np.arange(n - gram + 1, dtype=np.uint64)
    anchor = (sliding_min(keyed, width) & low).astype(np.int64)
    begins = np.concatenate([[0], ends[:-1]])
    change = np.zeros(n + 1, np.int32)
    usable = np.maximum(begins, ends - length + 1)
    np.add.at(change, begins, 1)
    np.add.at(change, usable, -1)
    valid = np.cumsum(change)[: n - length + 1] > 0
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1])
    last = valid.copy()
    last[:-1] &= ~valid[1:] | (anchor[1:] != anchor[:-1])
    first, final = np.flatnonzero(new), np.flatnonzero(last)
    at, windows = anchor[first], final - first + 1
    shape = (windows.astype(np.uint64) << np.uint64(32)) ^ (at - first).astype(np.uint64)
    stretch = mix(stretch_hash(sums, first, final + length) ^ mix(shape))
    return Runs(first, windows, at, grams[at], stretch)
