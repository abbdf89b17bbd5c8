"""Repeated byte strings, found by a distributed merge sort of suffixes.

The suffixes that are sorted begin at anchors (``anchors``): every window holds
one, at a place its content decides, so two windows are equal exactly if their
anchors' suffixes agree far enough to the right and the bytes before them agree
far enough to the left. A suffix array of all bytes would have to move the whole
corpus a hundred times over; anchored suffixes that may repeat are a few percent
of that and lose no window.

Map tasks send, for each bucket of anchor grams, one sorted and front-coded run:
each suffix as the length it shares with the one before and the rest. The
bucket merges its runs with a loser tree whose nodes remember the prefix they
share with the last winner; a comparison begins behind what is known, so no
byte of a known prefix is compared again. The sorted order and its shared
prefixes decide all windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from corvane.llm import anchors, repeats
from corvane.llm.bpe import blocks
from corvane.llm.tables import schema_of

WINDOW, GRAM = 100, 21
_BYTES = anchors.spread_bytes()


def byte_symbols(text: str) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(text.encode(), np.uint8)
    return _BYTES[raw], raw


def shared(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, at least ``known``."""
    n = min(len(a), len(b))
    while known + 16 <= n and a[known : known + 16] == b[known : known + 16]:
        known += 16
    while known < n and a[known] == b[known]:
        known += 1
    return known


def front_code(bucket: list, doc: list, place: list, symbols: list) -> tuple[list, list, list, list]:
    """One sorted, front-coded run for each bucket."""
    by_bucket: dict[int, list[int]] = {}
    for k, b in enumerate(bucket):
        by_bucket.setdefault(b, []).append(k)
    runs = []
    for own in by_bucket.values():
        items = sorted((symbols[k][place[k] & 255 :], k) for k in own)
        lcp, rest, before = [], [], b""
        for suffix, _ in items:
            same = shared(before, suffix, 0)
            lcp.append(same)
            rest.append(suffix[same:])
            before = suffix
        order = [k for _, k in items]
        head = np.array([len(items)], "<i8"), np.array([doc[k] for k in order], "<i8"), np.array([place[k] for k in order], "<i8")
        sizes = np.array(lcp, "<i4"), np.array([len(r) for r in rest], "<i4")
        left = [symbols[k][: place[k] & 255] for k in order]
        runs.append(b"".join([*(x.tobytes() for x in (*head, *sizes)), *left, *rest]))
    return list(by_bucket), [0] * len(runs), [0] * len(runs), runs


class Run:
    def __init__(self, raw: bytes):
        n = int(np.frombuffer(raw, "<i8", 1)[0])
        self.doc = np.frombuffer(raw, "<i8", n, 8)
        self.place = np.frombuffer(raw, "<i8", n, 8 + 8 * n)
        self.lcp = np.frombuffer(raw, "<i4", n, 8 + 16 * n).tolist()
        sizes = np.frombuffer(raw, "<i4", n, 8 + 20 * n).tolist()
        at = 8 + 24 * n
        self.left = []
        for size in (self.place & 255).tolist():
            self.left.append(raw[at : at + size])
            at += size
        self.suffix, before = [], b""
        for same, size in zip(self.lcp, sizes, strict=True):
            before = before[:same] + raw[at : at + size]
            self.suffix.append(before)
            at += size


def merge(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[tuple[int, int]], list[int]]:
    """(run, place in it) of all strings in sorted order, and what each shares with the one before.

    ``runs`` are sorted strings and what each shares with the one before it.
    """
    count = 1 << max(0, len(runs) - 1).bit_length()
    heads: list[bytes] = [r[0][0] if r[0] else b"" for r in runs] + [b""] * (count - len(runs))
    at = [0] * count
    known = [0 if k < len(runs) and runs[k][0] else -1 for k in range(count)]  # -1: exhausted
    losers = [0] * count

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's ``known`` is then what it shares with the winner."""
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        if known[a] < 0:
            return a, b
        x, y = heads[a], heads[b]
        same = shared(x, y, known[a])
        if same == len(x) or (same < len(y) and x[same] < y[same]):
            known[b] = same
            return a, b
        known[a] = same
        return b, a

    def build(node: int) -> int:
        if node >= count:
            return node - count
        winner, losers[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    winner = build(1)
    order, lcp = [], []
    while known[winner] >= 0:
        order.append((winner, at[winner]))
        lcp.append(known[winner])
        strings, own = runs[winner]
        at[winner] += 1
        if at[winner] < len(strings):
            heads[winner], known[winner] = strings[at[winner]], own[at[winner]]
        else:
            heads[winner], known[winner] = b"", -1
        node = (winner + count) >> 1
        while node:
            winner, losers[node] = play(winner, losers[node])
            node >>= 1
    return order, lcp


def decider(window: int):
    def decide(doc, place, symbols):
        runs = [Run(raw) for raw in symbols]
        if not runs:
            return (np.zeros(0, np.int64),) * 3
        order, lcp = merge([(r.suffix, r.lcp) for r in runs])
        offset = np.cumsum([0, *(len(r.doc) for r in runs)])
        right = np.array([offset[r] + k for r, k in order])
        doc, place = (np.concatenate([getattr(r, name) for r in runs]) for name in ("doc", "place"))
        lefts = [x for r in runs for x in r.left]
        begin, windows, left = repeats.unpack_place(place)
        m, width = len(doc), int(left.max()) + 1
        # what the bytes before the anchors share, read from the anchor to the left
        padded = np.zeros((m, width), np.uint8)
        for k, x in enumerate(lefts):
            padded[k, : len(x)] = np.frombuffer(x, np.uint8)[::-1]
        by_left = np.argsort(padded.view(f"S{width}").ravel(), kind="stable")
        differ = padded[by_left[1:]] != padded[by_left[:-1]]
        left_lcp = np.where(differ.any(1), differ.argmax(1), width)
        right_lcp = np.array(lcp[1:], np.int64)
        first = np.lexsort((begin + left, doc))  # document order
        late = np.zeros((m, width), bool)
        class_right, class_left = np.zeros(m, np.int64), np.zeros(m, np.int64)
        for before in range(width):
            own = first[(left[first] >= before) & (left[first] - windows[first] < before)]
            if len(own) < 2:
                continue
            class_right[right[1:]] = np.cumsum(right_lcp < window - before)
            class_left[by_left[1:]] = np.cumsum(left_lcp < before)
            late[own, before] = repeats.later_of_equals(class_right[own], class_left[own])
        edge = np.diff(late.astype(np.int8), axis=1, prepend=0, append=0)
        item, low = np.nonzero(edge > 0)
        _, high = np.nonzero(edge < 0)
        return doc[item], begin[item] + left[item] - (high - 1), high - low

    return decide


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot_least: int = 1000, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Texts without bytes of strings that also start earlier.

    Takes ``doc_id`` and ``text`` (null: empty) and returns ``doc_id``, ``n_bytes``,
    ``n_removed``, ``n_spans``, ``kept`` (the remaining bytes) and ``kept_text``:
    what remains if spans are first narrowed to whole characters. Strings are
    judged on the input. A text shorter than a window keeps all. Rows that repeat
    in id and text get the same result. Columns named in ``carry`` come along.
    """
    symbols = repeats.Symbols(window, gram, byte_symbols, front_code)
    dealt, spans = repeats.late_spans(docs, symbols, decider(window), hot_least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_text"]
        for part, texts in blocks(batches):
            rows = [[] for _ in names[1:]]
            for text, own in zip(texts, part.column(2).to_pylist(), strict=True):
                raw = text.encode()
                gone = repeats.covered(own, window, len(raw)).tolist()
                kept, whole, at, whole_at = [], [], 0, 0
                for a, b in gone:
                    kept.append(raw[at:a])
                    at = b
                    while a < b and raw[a] & 0xC0 == 0x80:
                        a += 1
                    while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
                        b -= 1
                    whole.append(raw[whole_at:a])
                    whole_at = b
                kept.append(raw[at:])
                whole.append(raw[whole_at:])
                values = len(raw), sum(b - a for a, b in gone), len(gone), b"".join(kept), b"".join(whole).decode()
                for column, value in zip(rows, values, strict=True):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
            made = [pa.array(c, t) for c, t in zip(rows, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), *made, *part.columns[3:]], [*names, *carry])

    both = dealt.join(spans, "doc_id", "left")
    if carry:  # small columns go by themselves, so that the texts are dealt once for both uses
        both = both.join(docs.select("doc_id", *carry).dropDuplicates(["doc_id"]), "doc_id")
    kind = schema_of(
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_text string"
    )
    kind = T.StructType([*kind.fields, *(docs.schema[c] for c in carry)])
    return both.select("doc_id", "text", "spans", *carry).mapInArrow(run, kind)
