"""Runs: maximal periodic stretches of words, found exactly, and texts with the repetition taken out.

A run is a stretch of words with smallest period q that no neighbouring word extends. Every run has a Lyndon word
as root in one of the two orders of the alphabet, and that root is the longest Lyndon word at its place; so two
candidates for each place are enough. The longest Lyndon word ends where the next smaller suffix begins. A
candidate is extended to the right and to the left as far as its period holds; both lengths are longest common
extensions, read from the suffix trees of the words and of their reversal: the depth of the lowest common
ancestor of two leaves, a range minimum over the Euler tour in constant time.

Ukkonen's algorithm makes the trees, in time proportional to the words. It is run on those stretches only that can
hold a run long enough. In a run of length l >= MIN_REPEATS * q, every word behind the first q has stood at most q
words before, so all these l - q words repeat within a third of their number (with MIN_REPEATS = 4). Words that do
not repeat within that share of the stretch around them cut it, again and again, until nothing changes. What is left
is searched, with as many words before it as its longest period could have. Nothing is lost or added: see
``candidates``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corvane.llm.bpe import blocks
from corvane.llm.tables import texts

#: A run is at least so many words long, and so many times its period.
MIN_WORDS, MIN_REPEATS = 6, 4
#: Turns of the Euler tour that share one entry of the table for range minima.
BLOCK = 16
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_RUN = "struct<start: long, length: long, period: long>"
FOUND = f"doc_id long, n_words long, runs array<{_RUN}>, strongest {_RUN}, collapsed string"


class RangeMin:
    """Minima of ranges of a fixed array, in constant time and linear memory."""

    def __init__(self, values: np.ndarray):
        n = -(-max(1, len(values)) // BLOCK)
        self.rows = np.full(n * BLOCK, np.iinfo(np.int32).max, np.int32)
        self.rows[: len(values)] = values
        by_block = self.rows.reshape(n, BLOCK)
        self.to_here = np.minimum.accumulate(by_block, 1).ravel()
        self.from_here = np.minimum.accumulate(by_block[:, ::-1], 1)[:, ::-1].ravel()
        self.tables = [by_block.min(1)]
        while len(self.tables[-1]) > 1 << (len(self.tables) - 1):
            half, last = 1 << (len(self.tables) - 1), self.tables[-1]
            self.tables.append(np.minimum(last[:-half], last[half:]))

    def least(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The least value at places a to b, both included; a <= b."""
        block_a, block_b = a // BLOCK, b // BLOCK
        out = np.minimum(self.from_here[a], self.to_here[b])
        between = block_b - block_a - 1
        level = np.frexp(np.maximum(between, 1))[1] - 1
        for k in np.unique(level[between > 0]).tolist():
            of = np.flatnonzero((between > 0) & (level == k))
            table, first = self.tables[k], block_a[of] + 1
            out[of] = np.minimum(out[of], np.minimum(table[first], table[block_b[of] - (1 << k)]))
        same = np.flatnonzero(between < 0)
        if len(same):
            at = a[same]
            least = self.rows[at]
            for _ in range(BLOCK - 1):
                at = np.minimum(at + 1, b[same])
                least = np.minimum(least, self.rows[at])
            out[same] = least
        return out


class SuffixTree:
    """The suffix tree of numbers, whose last stands nowhere else, by Ukkonen's algorithm."""

    def __init__(self, signs: list[int]):
        n = len(signs)
        self.n, base = n, 1 + max(signs)
        arcs: dict[int, int] = {}  # node * base + sign -> node
        first, last, link = [0], [0], [0]
        depth = [0]  # in signs, -1 for leaves, which appear in the order of their suffixes
        node = edge = length = left = 0
        for i, sign in enumerate(signs):
            left += 1
            made = 0
            while left:
                if not length:
                    edge = i
                key = node * base + signs[edge]
                below = arcs.get(key)
                if below is None:
                    arcs[key] = len(first)
                    first.append(i)
                    last.append(n)
                    link.append(0)
                    depth.append(-1)
                    if made:
                        link[made] = node
                        made = 0
                else:
                    size = last[below] - first[below]
                    if length >= size:
                        edge += size
                        length -= size
                        node = below
                        continue
                    at = first[below] + length
                    if signs[at] == sign:
                        length += 1
                        if made:
                            link[made] = node
                        break
                    split = len(first)
                    first += (first[below], i)
                    last += (at, n)
                    link += (0, 0)
                    depth += (left - 1, -1)
                    arcs[key] = split
                    arcs[split * base + sign] = split + 1
                    arcs[split * base + signs[at]] = below
                    first[below] = at
                    if made:
                        link[made] = split
                    made = split
                left -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - left + 1
        keys = np.fromiter(arcs.keys(), np.int64, len(arcs))
        self.child = np.fromiter(arcs.values(), np.int64, len(arcs))
        self.above, sign = keys // base, keys % base
        self.sign = np.where(sign == signs[-1], -base, sign)  # the end comes first in either order
        self.depth = np.array(depth)
        self.parent = np.empty(len(depth), np.int64)
        self.parent[self.child] = self.above
        self.leaf = self.depth < 0
        self.suffix = np.cumsum(self.leaf) - 1

    def preorder(self, falling: bool = False) -> np.ndarray:
        """Nodes in the order of their words, or of those by the reversed order of signs."""
        rank = np.where(self.sign < 0, self.sign, -self.sign) if falling else self.sign
        order = np.lexsort((-rank, self.above))
        child, begin = self.child[order].tolist(), np.searchsorted(self.above[order], np.arange(len(self.depth) + 1)).tolist()
        leaf, stack, out = self.leaf.tolist(), [0], []
        while stack:
            node = stack.pop()
            out.append(node)
            if not leaf[node]:
                stack += child[begin[node] : begin[node + 1]]
        return np.array(out)

    def suffixes(self, falling: bool = False) -> np.ndarray:
        """Where the suffixes start, from the least to the greatest."""
        order = self.preorder(falling)
        return self.suffix[order[self.leaf[order]]]

    def tour(self) -> np.ndarray:
        """Readies ``common``; gives the suffixes in order.

        Of the Euler tour only the turns between neighbouring leaves are kept: the tour climbs from a leaf to the
        parent of the node that follows the leaf in preorder, and the least depth between two leaves is at a turn.
        """
        order = self.preorder()
        leaves = np.flatnonzero(self.leaf[order])
        turns = self.depth[self.parent[order[leaves[:-1] + 1]]]
        self.depths = RangeMin(np.append(0, turns))
        found = self.suffix[order[leaves]]
        self.place = np.empty(self.n, np.int64)
        self.place[found] = np.arange(self.n)
        return found

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many signs the suffixes from a and from b share; a and b differ."""
        x, y = self.place[a], self.place[b]
        return self.depths.least(np.minimum(x, y) + 1, np.maximum(x, y))


def next_smaller(rank: list[int]) -> list[int]:
    """The next place with a smaller rank, for all but the last place, whose rank is the least."""
    out, stack = [0] * (len(rank) - 1), [len(rank) - 1]
    for i in range(len(rank) - 2, -1, -1):
        own = rank[i]
        while rank[stack[-1]] > own:
            stack.pop()
        out[i] = stack[-1]
        stack.append(i)
    return out


def find_runs(signs: np.ndarray, min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS) -> np.ndarray:
    """Rows (start, length, period) of the runs in ``signs``, by start, then period; ``min_repeats`` is 2 or more."""
    n = len(signs)
    if n < max(min_words, min_repeats):
        return np.zeros((0, 3), np.int64)
    _, signs = np.unique(signs, return_inverse=True)
    end = int(signs.max()) + 1
    forward = SuffixTree([*signs.tolist(), end])
    backward = SuffixTree([*signs[::-1].tolist(), end])
    backward.tour()
    found = []
    for suffixes in (forward.tour(), forward.suffixes(falling=True)):
        rank = np.empty(n + 1, np.int64)
        rank[suffixes] = np.arange(n + 1)
        to = np.array(next_smaller(rank.tolist()))
        at = np.arange(n)
        period = to - at
        ahead = forward.common(at, to)
        behind = backward.common(n - at, n - to)
        start, length = at - behind, period + behind + ahead
        right = length >= np.maximum(min_words, min_repeats * period)
        found.append(np.stack([start[right], length[right], period[right]], 1))
    rows = np.unique(np.concatenate(found), axis=0)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def candidates(signs: np.ndarray, doc: np.ndarray) -> list[tuple[int, int, int]]:
    """Stretches (from, core, to) outside of which no run lies; a run's words behind its first period are in a core.

    A run of length l and period q has l - q >= 3 * q words behind its first period, each of which equals the
    word q before it. Let all of them be in a stretch of L words. Then q <= L / 3, and so is the distance to the
    last equal word; a word with a greater distance is none of them and cuts the stretch. A stretch too short for
    any run goes. ``from`` is L // 3 words before the core, or where the document starts.
    """
    n = len(signs)
    order = np.argsort((doc.astype(np.int64) << 32) | signs, kind="stable")
    same = (signs[order[1:]] == signs[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
    gap = np.full(n, n + 1, np.int64)
    gap[order[1:][same]] = (order[1:] - order[:-1])[same]
    at = np.flatnonzero(gap <= n)
    while len(at):
        new = np.append(True, (np.diff(at) != 1) | (doc[at[1:]] != doc[at[:-1]]))
        first = np.flatnonzero(new)
        sizes = np.diff(np.append(first, len(at)))
        size = np.repeat(sizes, sizes)
        stay = ((MIN_REPEATS - 1) * gap[at] <= size) & (size >= MIN_WORDS - 1)
        if stay.all():
            break
        at = at[stay]
    if not len(at):
        return []
    doc_from = np.searchsorted(doc, doc[at[first]])
    start = np.maximum(doc_from, at[first] - sizes // (MIN_REPEATS - 1))
    return list(zip(start.tolist(), at[first].tolist(), (at[first] + sizes).tolist(), strict=True))


def runs_of(docs: list[list[bytes]]) -> list[np.ndarray]:
    """The runs of each document's words."""
    sizes = np.fromiter(map(len, docs), np.int64, len(docs))
    flat = [w for d in docs for w in d]
    number = {w: k for k, w in enumerate(dict.fromkeys(flat))}
    signs = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
    doc = np.repeat(np.arange(len(docs)), sizes)
    begin = np.cumsum(sizes) - sizes
    out: list[list[np.ndarray]] = [[] for _ in docs]
    for a, core, b in candidates(signs, doc):
        found = find_runs(signs[a:b])
        found[:, 0] += a
        found = found[found[:, 0] + found[:, 2] >= core]
        if len(found):
            own = int(doc[core])
            found[:, 0] -= begin[own]
            out[own].append(found)
    return [np.concatenate(x) if x else np.zeros((0, 3), np.int64) for x in out]


def strongest(runs: list[list[int]]) -> list[int] | None:
    """The run with the greatest length / period, exactly; of equal ones the first, then the shorter period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapse(docs: DataFrame) -> DataFrame:
    """Every document's runs of words, and its words without what only repeats.

    Takes ``doc_id`` and ``text``; other columns are not used, rows without an id are left out, repeated rows give
    a row each. Words are what white space of ASCII parts; a null text has none. ``runs`` are in order of
    start, then period; ``strongest`` is the one with the greatest length / period (ties: least start, then
    period), null if there is none; ``collapsed`` drops each word that a run holds behind its first period
    and joins the others by single spaces. In place: nothing is shuffled. A task holds some megabytes of text
    and the trees of one stretch, about a kilobyte a word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, given in blocks(batches):
            docs_ = [t.encode().split() for t in given]
            found = runs_of(docs_)
            kept = []
            for own, runs in zip(docs_, found, strict=True):
                if len(runs):
                    stays = np.ones(len(own), bool)
                    for start, length, period in runs.tolist():
                        stays[start + period : start + length] = False
                    own = [own[k] for k in np.flatnonzero(stays).tolist()]
                kept.append(b" ".join(own).decode())
            rows = [r.tolist() for r in found]
            names = ("start", "length", "period")
            listed = [[dict(zip(names, r, strict=True)) for r in x] for x in rows]
            best = [dict(zip(names, r, strict=True)) if (r := strongest(x)) else None for x in rows]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([*map(len, docs_)], pa.int64()), pa.array(listed, pa.list_(RUN)),
                 pa.array(best, RUN), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "runs", "strongest", "collapsed"],
            )

    return texts(docs).mapInArrow(run, FOUND)
