"""Splitting texts into the pieces a byte-level tokenizer merges within, whole batches at a time.

The pieces are those of the pattern that stands beside the public vocabulary
(``public_tokenizers.PATTERN``): contractions, runs of letters, digits or other
signs with one space before them, and runs of white space. They are found with
array operations over code points, so the cost of Python is paid per batch and
per *distinct* piece, never per piece.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np

SPACE, LETTER, DIGIT, OTHER, STOP, UNKNOWN = range(6)
#: White space as the pattern's ``\\s`` has it.
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Longer texts are cut before a single space or line break between two signs, where a piece always begins.
SLICE = 1 << 18
SPACES = "".join(map(chr, WHITE))
_CUT = re.compile(f"(?<=[^{SPACES}])(?=[ \\n][^{SPACES}])")
#: Odd, so that it can be inverted modulo 2**64.
BASE = 0x9E3779B97F4A7C15


@lru_cache(1)
def classes() -> np.ndarray:
    """The class of each code point; UNKNOWN is what this Python has no category for, as its Unicode may be older."""
    kinds = {"L": LETTER, "N": DIGIT, "Cn": UNKNOWN}
    names = map(unicodedata.category, map(chr, range(sys.maxunicode + 1)))
    table = np.fromiter((kinds.get(x, kinds.get(x[0], OTHER)) for x in names), np.uint8, sys.maxunicode + 1)
    table[WHITE] = SPACE
    return table


def has_unknown(piece: str) -> bool:
    return not piece.isascii() and bool((classes()[np.frombuffer(piece.encode("utf-32-le"), np.uint32)] == UNKNOWN).any())


@lru_cache(1)
def lower() -> np.ndarray:
    """Each code point's lower case, where that is one code point, else itself."""
    low = np.arange(sys.maxunicode + 1, dtype=np.uint32)
    for c in range(sys.maxunicode + 1):
        if len(to := chr(c).lower()) == 1:
            low[c] = ord(to)
    return low


@lru_cache(4)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of BASE and of its inverse, modulo 2**64."""
    out = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        row = np.full(n, base, np.uint64)
        row[:1] = 1
        out.append(np.cumprod(row, dtype=np.uint64))
    return out[0], out[1]


def byte_level(given) -> Callable[[list[str]], list[list[int]]]:
    """Encodes pieces by the byte-level model of a tokenizer of the tokenizers library.

    Pieces need no further splitting, but for those with unknown signs, which go
    through the whole tokenizer.
    """
    model = given.model
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    written = {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}

    def one(piece: str) -> list[int]:
        return [t.id for t in model.tokenize(piece.encode().decode("latin-1").translate(written))]

    def encode(pieces: list[str]) -> list[list[int]]:
        if not has_unknown("".join(pieces)):
            return [one(p) for p in pieces]
        return [given.encode(p, add_special_tokens=False).ids if has_unknown(p) else one(p) for p in pieces]

    return encode


def slices(text: str, size: int = SLICE) -> Iterator[str]:
    at = 0
    while len(text) - at > size:
        cut = _CUT.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def starts(code: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Where pieces begin in concatenated texts, each followed by a stop sign."""
    kind = classes()[code]
    kind[stops] = STOP
    first = np.empty(len(kind), bool)
    first[:1] = True
    np.not_equal(kind[1:], kind[:-1], out=first[1:])
    first[stops] = True
    last_white = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] > SPACE) & (kind[1:] != STOP))
    first[last_white] = True
    first[last_white[code[last_white] == 32] + 1] = False
    contractions(code, kind, first)
    whole_units(code, kind, first, stops)
    return np.flatnonzero(first)


def word_starts(code: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """As ``starts``, but white space stands by itself and each digit is a piece."""
    kind = classes()[code]
    kind[stops] = STOP
    first = np.empty(len(kind), bool)
    first[:1] = True
    np.not_equal(kind[1:], kind[:-1], out=first[1:])
    first |= kind == DIGIT
    first[stops] = True
    contractions(code, kind, first)
    whole_units(code, kind, first, stops)
    return np.flatnonzero(first)


def unit_starts(code: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Where white space follows another sign: whole words with the white space before them."""
    white = classes()[code] == SPACE
    white[stops] = False
    first = np.empty(len(code), bool)
    first[:1] = True
    np.greater(white[1:], white[:-1], out=first[1:])
    first[stops] = True
    first[stops[:-1] + 1] = True
    return np.flatnonzero(first)


def whole_units(code: np.ndarray, kind: np.ndarray, first: np.ndarray, stops: np.ndarray) -> None:
    """A word with an unknown sign, and the white space before it, becomes one piece."""
    odd = np.flatnonzero(kind == UNKNOWN)
    if len(odd):
        begin = unit_starts(code, stops)
        for unit in np.unique(np.searchsorted(begin, odd, "right") - 1):
            end = begin[unit + 1] if unit + 1 < len(begin) else len(code)
            first[begin[unit] : end] = False
            first[begin[unit]] = True


def contractions(code: np.ndarray, kind: np.ndarray, first: np.ndarray) -> None:
    """Marks the pieces 's 't 'm 'd 're 've 'll and what follows them in ``first``."""
    quote = np.flatnonzero((code == 39) & first)
    quote = quote[quote + 1 < len(code)]
    quote = quote[kind[quote + 1] == LETTER]
    if len(quote):
        one = code[quote + 1]
        two = np.where(quote + 2 < len(code), code[np.minimum(quote + 2, len(code) - 1)], 0)
        two[kind[np.minimum(quote + 2, len(code) - 1)] != LETTER] = 0
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.zeros(len(quote), bool)
        for a, b in ("re", "ve", "ll"):
            long |= (one == ord(a)) & (two == ord(b))
        long &= ~short
        for found, width in ((quote[short], 2), (quote[long], 3)):
            first[found + 1] = False
            if width == 3:
                first[found + 2] = False
            first[found + width] = True


class PieceTable:
    """Ids of the pieces met so far, found by a 64-bit hash and compared sign by sign.

    A piece whose hash belongs to another piece is encoded by itself, so no hash
    decides a result. The table forgets everything when ``limit`` pieces are held:
    memory is bounded and results do not depend on it. ``cut`` gives the places where
    pieces begin; ``fold``, if given, maps code points that mean the same to
    ``encode`` to one of them.
    """

    def __init__(
        self,
        encode: Callable[[list[str]], list[list[int]]],
        limit: int = 1 << 20,
        cut: Callable[[np.ndarray, np.ndarray], np.ndarray] = starts,
        fold: np.ndarray | None = None,
    ):
        self.encode, self.limit, self.cut, self.fold = encode, limit, cut, fold
        self.clear()

    def clear(self, room: int = 0) -> None:
        self.bits = (2 * max(self.limit, room) - 1).bit_length()
        size = 1 << self.bits
        self.keys, self.entry = np.zeros(size, np.uint64), np.zeros(size, np.int32)
        self.n = 0
        self.spelled, self.signs = np.zeros(1024, np.int64), np.zeros(1024, np.int32)
        self.begin, self.count = np.zeros(1024, np.int64), np.zeros(1024, np.int32)
        self.codes, self.spelled_to = np.zeros(4096, np.uint32), 0
        self.ids, self.used = np.zeros(4096, np.uint32), 0

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, key: np.ndarray) -> np.ndarray:
        slot = self._slot(key)
        held = self.keys[slot]
        found = np.where(held == key, self.entry[slot], -1)
        open_ = np.flatnonzero((held != key) & (held != 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            held, want = self.keys[slot[open_]], key[open_]
            hit = held == want
            found[open_[hit]] = self.entry[slot[open_[hit]]]
            open_ = open_[~hit & (held != 0)]
        return found

    def add(self, key: np.ndarray, sizes: np.ndarray, codes: np.ndarray, ids: list[list[int]]) -> None:
        """``key``: distinct and not held yet; ``codes``: the signs of all pieces, so many as ``sizes`` says."""
        n, total, signs = len(key), sum(map(len, ids)), len(codes)
        for name in ("spelled", "signs", "begin", "count"):
            old = getattr(self, name)
            if self.n + n > len(old):
                setattr(self, name, np.resize(old, 2 * (self.n + n)))
        if self.used + total > len(self.ids):
            self.ids = np.resize(self.ids, 2 * (self.used + total))
        if self.spelled_to + signs > len(self.codes):
            self.codes = np.resize(self.codes, 2 * (self.spelled_to + signs))
        counts = np.fromiter(map(len, ids), np.int32, n)
        self.count[self.n : self.n + n], self.signs[self.n : self.n + n] = counts, sizes
        self.begin[self.n : self.n + n] = self.used + np.cumsum(counts) - counts
        self.spelled[self.n : self.n + n] = self.spelled_to + np.cumsum(sizes) - sizes
        self.ids[self.used : self.used + total] = np.fromiter(chain.from_iterable(ids), np.uint32, total)
        self.codes[self.spelled_to : self.spelled_to + signs] = codes
        self.used += total
        self.spelled_to += signs
        left, slot = np.arange(n), self._slot(key)
        while len(left):
            free = left[self.keys[slot[left]] == 0]
            _, pick = np.unique(slot[free], return_index=True)
            placed = free[pick]
            self.keys[slot[placed]], self.entry[slot[placed]] = key[placed], self.n + placed
            left = np.setdiff1d(left, placed, assume_unique=True)
            slot[left] = np.where(self.keys[slot[left]] != 0, (slot[left] + 1) & ((1 << self.bits) - 1), slot[left])
        self.n += n

    def ids_of(self, texts: list[str], special: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one after the other, and the number of ids of each."""
        parts: list[str] = []
        owner: list[int] = []
        after: list[int] = []  # the special id behind a part, or -1
        pattern = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        for k, text in enumerate(texts):
            at = 0
            for hit in pattern.finditer(text) if pattern and any(s in text for s in special) else ():
                for part in slices(text[at : hit.start()]):
                    parts.append(part)
                    owner.append(k)
                    after.append(-1)
                after[-1] = special[hit.group()]
                at = hit.end()
            for part in slices(text[at:] if at else text):
                parts.append(part)
                owner.append(k)
                after.append(-1)
        out, counts = [], np.zeros(len(texts), np.int64)
        begin = 0
        while begin < len(parts):
            end, size = begin, 0
            while end < len(parts) and (end == begin or size + len(parts[end]) <= SLICE):
                size += len(parts[end]) + 1
                end += 1
            ids, each = self._batch(parts[begin:end], np.array(after[begin:end]))
            out.append(ids)
            np.add.at(counts, owner[begin:end], each)
            begin = end
        return (np.concatenate(out) if out else np.zeros(0, np.uint32)), counts

    def _batch(self, parts: list[str], after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        whole = "\n".join(parts) + "\n"
        code = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        n = len(code)
        stops = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
        code = code if self.fold is None else self.fold[code]
        first = self.cut(code, stops)
        ends = np.append(first[1:], n)
        up, down = powers(1 << max(20, (n - 1).bit_length()))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(code * up[:n], out=sums[1:])
        key = (sums[ends] - sums[first]) * down[first]
        key[key == 0] = 1
        is_stop = np.zeros(n, bool)
        is_stop[stops] = True
        piece = np.flatnonzero(~is_stop[first])
        entry = self.find(key[piece])
        fresh = piece[entry < 0]
        if len(fresh):
            _, at = np.unique(key[fresh], return_index=True)
            new = fresh[at]
            if self.n + len(new) > self.limit:
                _, at = np.unique(key[piece], return_index=True)
                new = piece[at]
                self.clear(len(new))
            made = self.encode([whole[a:b] for a, b in zip(first[new].tolist(), ends[new].tolist(), strict=True)])
            sizes = ends[new] - first[new]
            signs = np.repeat(first[new] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            self.add(key[new], sizes, code[signs], made)
            entry = self.find(key[piece])
        counts = np.zeros(len(first), np.int64)
        begin = np.zeros(len(first), np.int64)
        counts[piece], begin[piece] = self.count[entry], self.begin[entry]
        ids = self.ids
        sizes = ends - first
        shift = -first
        shift[piece] += self.spelled[entry]
        held = self.codes[np.minimum(np.repeat(shift, sizes) + np.arange(n), len(self.codes) - 1)]
        unlike = np.logical_or.reduceat(held != code, first)[piece]
        wrong = np.flatnonzero(unlike | (self.signs[entry] != sizes[piece]))
        if len(wrong):  # two pieces of one hash: these are encoded by themselves
            own = self.encode([whole[first[i] : ends[i]] for i in piece[wrong]])
            each = np.fromiter(map(len, own), np.int64, len(own))
            counts[piece[wrong]] = each
            begin[piece[wrong]] = self.used + np.cumsum(each) - each
            ids = np.concatenate([ids[: self.used], np.fromiter(chain.from_iterable(own), np.uint32)])
        stop_at = np.flatnonzero(is_stop[first])
        marked = np.flatnonzero(after >= 0)
        if len(marked):
            counts[stop_at[marked]] = 1
            begin[stop_at[marked]] = len(ids) + np.arange(len(marked))
            ids = np.concatenate([ids, after[marked].astype(np.uint32)])
        place = np.cumsum(counts)
        total = int(place[-1])
        source = np.repeat(begin - (place - counts), counts) + np.arange(total)
        return ids[source], np.diff(place[stop_at], prepend=0)
