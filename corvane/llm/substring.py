"""Repeated word passages, found with suffix automata of reference shards.

The reference is the corpus itself, so its automata cannot be broadcast: they
grow with it. Instead the stretches that may repeat are dealt by the hash of
their anchor gram, and each bucket is a shard with an automaton of its own. The
shard's stretches are streamed in document order: matching statistics against
all earlier stretches come first, then the stretch is added. A word is removed
if it lies in a match of ``window`` words or more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corvane.llm import anchors, repeats
from corvane.llm.bpe import blocks

WINDOW, GRAM = 20, 6
_BYTES = anchors.spread_bytes()
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes hashed at once; longer texts are cut at white space.
PART = 1 << 20


def word_places(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the words, runs of bytes other than space, tab to carriage return."""
    edge = np.diff(_WHITE[raw].astype(np.int8), prepend=1, append=1)
    return np.flatnonzero(edge < 0), np.flatnonzero(edge > 0)


def word_hashes(raw: np.ndarray) -> np.ndarray:
    out, at = [], 0
    while at < len(raw):
        end = min(len(raw), at + PART)
        while end < len(raw):
            white = np.flatnonzero(_WHITE[raw[end : end + PART]])
            if len(white):
                end += int(white[0])
                break
            end = min(len(raw), end + PART)
        part = raw[at:end]
        begin, stop = word_places(part)
        size = stop - begin
        first = np.cumsum(size) - size
        own = np.repeat(begin - first, size) + np.arange(int(size.sum()))
        place = (own - np.repeat(begin, size)).astype(np.uint64)
        # each byte is mixed with its place before bytes are summed: no regular text cancels out
        value = anchors.mix(_BYTES[part[own]] + place * np.uint64(0x9E3779B97F4A7C15))
        sums = np.add.reduceat(value, first) if len(first) else value
        out.append(anchors.mix(sums ^ anchors.mix(size.astype(np.uint64))))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def word_symbols(text: str) -> tuple[np.ndarray, np.ndarray]:
    values = word_hashes(np.frombuffer(text.encode(), np.uint8))
    return values, values


class SuffixAutomaton:
    """Suffix automaton of several sequences, which can be extended by one more at any time."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]

    def matches(self, sequence: list[int]) -> list[int]:
        """For each end, the length of the longest match with a sequence added before."""
        step, link, size = self.next, self.link, self.size
        state = length = 0
        out = []
        for symbol in sequence:
            to = step[state].get(symbol)
            while to is None and state:
                state = link[state]
                length = size[state]
                to = step[state].get(symbol)
            if to is not None:
                state = to
                length += 1
            out.append(length)
        return out

    def _split(self, p: int, symbol: int, q: int) -> int:
        """The state of the strings of q that end a path through p; q itself if that is all of them."""
        step, link, size = self.next, self.link, self.size
        if size[q] == size[p] + 1:
            return q
        copy = len(size)
        step.append(step[q].copy())
        link.append(link[q])
        size.append(size[p] + 1)
        link[q] = copy
        while p >= 0 and step[p].get(symbol) == q:
            step[p][symbol] = copy
            p = link[p]
        return copy

    def add(self, sequence: list[int]) -> None:
        step, link, size = self.next, self.link, self.size
        last = 0
        for symbol in sequence:
            q = step[last].get(symbol)
            if q is not None:
                last = self._split(last, symbol, q)
                continue
            new = len(size)
            step.append({})
            link.append(0)
            size.append(size[last] + 1)
            p = last
            while p >= 0 and symbol not in step[p]:
                step[p][symbol] = new
                p = link[p]
            if p >= 0:
                link[new] = self._split(p, symbol, step[p][symbol])
            last = new


def decider(window: int):
    def decide(doc, place, symbols):
        shard = SuffixAutomaton()
        docs, begins = [], []
        for d, at, raw in zip(doc.tolist(), (place >> 18).tolist(), symbols, strict=True):
            sequence = np.frombuffer(raw, np.int64).tolist()
            for end, length in enumerate(shard.matches(sequence)):
                if length >= window:
                    docs.append(d)
                    begins.append(at + end + 1 - window)
            shard.add(sequence)
        return np.array(docs, np.int64), np.array(begins, np.int64), np.ones(len(docs), np.int64)

    return decide


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot_least: int = 1000) -> DataFrame:
    """Texts without words of passages that also start earlier.

    Takes ``doc_id`` and ``text`` (null: no words) and returns ``doc_id``,
    ``n_words``, ``n_removed``, ``kept`` (the kept words joined by one space) and
    ``removed`` (begin and end of the removed stretches, in words). Windows are
    judged on the input: a removed passage still makes later ones late. A text of
    fewer words than a window keeps all. Rows that repeat in id and text get the
    same result.
    """
    kind = repeats.Symbols(window, gram, word_symbols, lambda *rows: rows)
    dealt, spans = repeats.late_spans(docs, kind, decider(window), hot_least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_words", "n_removed", "kept", "removed"]
        for part, texts in blocks(batches):
            rows = [[] for _ in names[1:]]
            for text, own in zip(texts, part.column(2).to_pylist(), strict=True):
                raw = text.encode()
                begin, end = word_places(np.frombuffer(raw, np.uint8))
                gone = repeats.covered(own, window, len(begin))
                keep = np.ones(len(begin), bool)
                for a, b in gone.tolist():
                    keep[a:b] = False
                kept = b" ".join(raw[a:b] for a, b in zip(begin[keep].tolist(), end[keep].tolist(), strict=True))
                for column, value in zip(rows, (len(begin), int((~keep).sum()), kept.decode(), gone.tolist()), strict=True):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(c, t) for c, t in zip(rows, kinds, strict=True))], names
            )

    return dealt.join(spans, "doc_id", "left").select("doc_id", "text", "spans").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept string, removed array<array<long>>"
    )
