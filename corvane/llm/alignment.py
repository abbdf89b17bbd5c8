"""Two tokenizations of the same bytes, aligned.

A byte-level tokenizer (A) and a piece tokenizer with byte fallback (B) spell the same bytes of a text. Tokens whose
byte ranges overlap are linked; the places where a token of either ends cut the text into groups. Both come from
a merge in lockstep: one state vector holds a pointer into A's and B's tokens for every document of a batch, each
step links the tokens under all pointers, cuts where both end, moves the pointer of the token that ends first (or
both) and drops the documents that are through. A long document enters as several stretches between places where
tokens of both end, so one document does not keep a batch going by itself.

How often an id pair is linked in the corpus is counted in documents. A task lists the pairs its documents hold
once per *block* of about BLOCK_BYTES of text; documents name pairs by their number in that list. The lists, not
the documents' pairs, are shuffled to be summed and brought back to their blocks, where each document adds up what
its links count. A block's size bounds what a task holds, whatever pair or document is common.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm import words
from corvane.llm.bpe import blocks, byte_alphabet
from corvane.llm.tables import fresh_folder, texts

#: Bytes of text whose documents share one list of pairs.
BLOCK_BYTES = 1 << 24
#: Bytes of text merged at once.
MERGED_BYTES = 1 << 20
#: About so many tokens of A go through the merge between two places where tokens of both end.
STRETCH = 64
#: Stands for a word whose tokens do not spell it.
BAD = (1 << 32) - 1
STAGED = (
    "doc_id long, block long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string,"
    " pairs binary, times binary, met binary, met_in binary"
)
ALIGNED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long,"
    " groups_sha256 string, groups string"
)


def unit_cuts(code: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Where a space or line break follows a sign that is not white space."""
    white = words.classes()[code] == words.SPACE
    white[stops] = False
    first = np.empty(len(code), bool)
    first[:1] = True
    first[1:] = ((code[1:] == 32) | (code[1:] == 10)) & ~white[:-1]
    first[stops] = True
    first[stops[:-1] + 1] = True
    return np.flatnonzero(first)


@lru_cache(1)
def byte_tokens(path: str) -> tuple[words.PieceTable, np.ndarray]:
    """Encodes by a byte-level vocabulary, special strings as plain text; and the bytes that each id spells, counted."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    given = Tokenizer.from_file(path)
    given.no_truncation()
    given.no_padding()
    given.encode_special_tokens = True
    alphabet = byte_alphabet()
    sizes = np.zeros(given.get_vocab_size(), np.int64)
    for text, i in given.get_vocab(with_added_tokens=False).items():
        sizes[i] = len(bytes(alphabet[c] for c in text))
    return words.PieceTable(words.byte_level(given), 1 << 19), sizes


@lru_cache(1)
def piece_tokens(path: str) -> tuple[words.PieceTable, np.ndarray]:
    """The same of a piece vocabulary. A word that its tokens do not spell byte by byte gets the one id BAD.

    Words are encoded by themselves, with the white space before them. That is right as no piece holds a
    line break, nor a space behind another sign, which is checked.
    """
    import sentencepiece

    given = sentencepiece.SentencePieceProcessor(model_file=path)
    spelled = []
    for i in range(given.get_piece_size()):
        text = given.id_to_piece(i)
        if given.is_byte(i):
            spelled.append(bytes([int(text[3:5], 16)]))
            continue
        if "\n" in text or "▁" in text.lstrip("▁"):
            raise ValueError(f"piece {text!r} goes across words")
        spelled.append(b"" if given.is_control(i) or given.is_unknown(i) else text.replace("▁", " ").encode())
    blank = given.piece_to_id("▁")

    def encode(units: list[str]) -> list[list[int]]:
        # The library puts a space before what it encodes: a unit's own first space, or one that is taken off again.
        made = given.encode([u.removeprefix(" ") for u in units], num_threads=1)
        out = []
        for unit, ids in zip(units, made, strict=True):
            if unit == " ":
                ids = [blank]
            elif unit[0] != " ":
                ids = ids[1:] if ids[:1] == [blank] else [BAD]
            whole = BAD not in ids and b"".join([spelled[i] for i in ids]) == unit.encode()
            out.append(ids if whole else [BAD])
        return out

    return words.PieceTable(encode, 1 << 19, cut=unit_cuts), np.array([*map(len, spelled)], np.int64)


def lockstep(
    a_end: np.ndarray, b_end: np.ndarray, a_from: np.ndarray, b_from: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links and cuts of many stretches at once: numbers of linked tokens, and whether both end there.

    ``a_end`` and ``b_end`` are ends on one rising byte scale; stretch k has the tokens from ``a_from[k]`` and
    ``b_from[k]`` up to the next stretch's, and both sides of it end at the same byte.
    """
    last = np.append(a_from[1:], len(a_end))
    some = a_from < last
    a, b, last = a_from[some], b_from[some], last[some]
    links_a, links_b, cuts = [], [], []
    while len(a):
        x, y = a_end[a], b_end[b]
        links_a.append(a)
        links_b.append(b)
        cuts.append(x == y)
        a, b = a + (x <= y), b + (y <= x)
        going = a < last
        if not going.all():
            a, b, last = a[going], b[going], last[going]
    if not links_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    return np.concatenate(links_a), np.concatenate(links_b), np.concatenate(cuts)


def stretches(
    a_end: np.ndarray, b_end: np.ndarray, a_from: np.ndarray, b_from: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The starts of documents, and more where a token of both ends at about every STRETCH-th token of A."""
    tried = np.arange(STRETCH - 1, len(a_end), STRETCH)
    at = np.searchsorted(b_end, a_end[tried])
    common = b_end[np.minimum(at, len(b_end) - 1)] == a_end[tried] if len(tried) else tried > 0
    more_a, more_b = tried[common] + 1, at[common] + 1
    return np.sort(np.append(a_from, more_a)), np.sort(np.append(b_from, more_b))


@lru_cache(1)
def written(n: int) -> np.ndarray:
    """Each id below n in decimal with each of the three signs behind it, in eight bytes, zeros at the end."""
    rows = b"".join(f"{i}{sign}".encode().ljust(8, b"\0") for i in range(n) for sign in ",|;")
    return np.frombuffer(rows, np.uint64)


class Aligned:
    """The alignment of a batch of texts, as arrays over their tokens, links and groups."""

    def __init__(self, texts_: list[str], a_path: str, b_path: str):
        (a_table, a_size), (b_table, b_size) = byte_tokens(a_path), piece_tokens(b_path)
        given = [f" {t}" if t else "" for t in texts_]
        a, n_a = a_table.ids_of(given, {})
        b, n_b = b_table.ids_of(given, {})
        doc = np.repeat(np.arange(len(given)), n_b)
        right = np.ones(len(given), bool)
        right[doc[b == BAD]] = False
        if not right.all():
            a, b = a[np.repeat(right, n_a)], b[np.repeat(right, n_b)]
            n_a, n_b = np.where(right, n_a, 0), np.where(right, n_b, 0)
        self.a, self.b, self.n_a, self.n_b = a, b, n_a, n_b
        a_end, b_end = np.cumsum(a_size[a]), np.cumsum(b_size[b])
        some = n_a > 0
        a_from, b_from = (np.cumsum(n_a) - n_a)[some], (np.cumsum(n_b) - n_b)[some]
        self.link_a, self.link_b, cut = lockstep(a_end, b_end, *stretches(a_end, b_end, a_from, b_from))
        doc_a = np.repeat(np.arange(len(given)), n_a)
        self.link_doc = doc_a[self.link_a]
        self.n_links = np.bincount(self.link_doc, minlength=len(given))
        self.last_a, self.last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        self.last_a[self.link_a[cut]] = True
        self.last_b[self.link_b[cut]] = True
        self.n_groups = np.bincount(doc_a[self.last_a], minlength=len(given))
        self.ids_a, self.ids_b = len(a_size), len(b_size)

    def groups(self) -> list[bytes]:
        """Each text's groups, ``a1,a2|b1;a3|b2,b3``: ids of A and B in order; empty without tokens."""
        in_a = np.cumsum(self.last_a) - self.last_a
        in_b = np.cumsum(self.last_b) - self.last_b
        a_before = np.flatnonzero(self.last_a) + 1  # tokens of A up to the end of each group
        b_before = np.append(0, np.flatnonzero(self.last_b) + 1)  # tokens of B before each group
        text = np.zeros(len(self.a) + len(self.b), np.uint64)
        pool = written(max(self.ids_a, self.ids_b))
        text[np.arange(len(self.a)) + b_before[in_a]] = pool[3 * self.a.astype(np.int64) + self.last_a]
        text[np.arange(len(self.b)) + a_before[in_b]] = pool[3 * self.b.astype(np.int64) + 2 * self.last_b]
        signs = text.view(np.uint8)
        shown = signs != 0
        ends = np.cumsum(self.n_a + self.n_b)
        width = np.append(0, np.cumsum(shown.reshape(-1, 8).sum(1, dtype=np.uint8), dtype=np.int64))
        out = memoryview(signs[shown].tobytes())
        to = width[ends]
        return [bytes(out[a : b - 1]) if b > a else b"" for a, b in zip([0, *to[:-1].tolist()], to.tolist(), strict=True)]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (text, id pair) in order of texts: the text, the pair (A's id << 32 | B's), and its links."""
        n_b = np.uint64(self.ids_b)
        n = np.uint64(self.ids_a) * n_b
        pair = self.a[self.link_a].astype(np.uint64) * n_b + self.b[self.link_b]
        key, times = np.unique(self.link_doc.astype(np.uint64) * n + pair, return_counts=True)
        pair = key % n
        return (key // n).astype(np.int64), (pair // n_b) << np.uint64(32) | pair % n_b, times


def align(docs: DataFrame, a_path: str, b_path: str, with_groups: bool = False) -> DataFrame:
    """Every document's alignment and what the corpus makes of its links.

    Takes ``doc_id`` and ``text``; other columns are not used, rows without an id are left out, rows that share
    one are documents each. A text that is null, empty or not spelled by its tokens has no tokens and zeros.
    ``n_best`` counts the links whose pair is, in documents, the most frequent of its A id, ``count_sum`` adds up
    the documents of each link's pair. ``groups_sha256`` hashes ``groups``, which is null unless asked for.
    """
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, held, size = TaskContext.get().partitionId(), 0, [], 0
        for part, given in blocks(batches, chars=MERGED_BYTES):
            held.append(_rows(part, Aligned(given, a_path, b_path), with_groups))
            size += sum(map(len, given))
            if size >= BLOCK_BYTES:
                yield from _block(held, task << 32 | number)
                number, held, size = number + 1, [], 0
        if held:
            yield from _block(held, task << 32 | number)

    folder = fresh_folder(spark, "aligned")
    texts(docs).mapInArrow(run, STAGED).write.parquet(folder)
    staged = spark.read.parquet(folder)
    met = staged.filter("met is not null").select("block", "met", "met_in").mapInArrow(
        _unpacked, "block long, number int, a long, b long, docs long"
    )
    totals = met.groupBy("a", "b").agg(F.sum("docs").alias("total"))
    best = F.col("total") == F.max("total").over(Window.partitionBy("a"))
    counted = met.select("block", "number", "a", "b").join(totals.withColumn("best", best), ["a", "b"])
    kept = staged.drop("met", "met_in")
    return kept.groupBy("block").cogroup(
        counted.select("block", "number", "total", "best").groupBy("block")
    ).applyInArrow(_summed, ALIGNED)


def _rows(part: pa.RecordBatch, made: Aligned, with_groups: bool) -> tuple:
    groups = made.groups()
    doc, pair, times = made.pairs()
    hashes = [hashlib.sha256(g).hexdigest() if g else "" for g in groups]
    shown = [g.decode() for g in groups] if with_groups else [None] * len(groups)
    first = np.searchsorted(doc, np.arange(len(groups) + 1))
    return part.column(0), made.n_a, made.n_b, made.n_groups, made.n_links, hashes, shown, first, pair, times


def _block(held: list[tuple], block: int) -> Iterator[pa.RecordBatch]:
    """The rows of a block; its first row carries the block's pairs and in how many of its documents they are."""
    met, met_in = np.unique(np.concatenate([h[8] for h in held]), return_counts=True)
    first = True
    for keys, n_a, n_b, n_groups, n_links, hashes, shown, at, pair, times in held:
        n = len(keys)
        number, times = np.searchsorted(met, pair).astype("<u4"), times.astype("<u4")
        parts = [(a, b) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        lists = [[met.astype("<u8").tobytes()], [met_in.astype("<u4").tobytes()]] if first else [[None], [None]]
        yield pa.RecordBatch.from_arrays(
            [
                keys, pa.array([block] * n, pa.int64()), pa.array(n_a), pa.array(n_b), pa.array(n_groups),
                pa.array(n_links), pa.array(hashes, pa.string()), pa.array(shown, pa.string()),
                pa.array([number[a:b].tobytes() for a, b in parts], pa.binary()),
                pa.array([times[a:b].tobytes() for a, b in parts], pa.binary()),
                *(pa.array(x + [None] * (n - 1), pa.binary()) for x in lists),
            ],
            ["doc_id", "block", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups", "pairs", "times",
             "met", "met_in"],
        )
        first = False


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, met, met_in in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            pair, docs = np.frombuffer(met, "<u8"), np.frombuffer(met_in, "<u4")
            for at in range(0, len(pair), 1 << 16):
                some = pair[at : at + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(some), block, np.int64)),
                        pa.array(np.arange(at, at + len(some), dtype=np.int32)),
                        pa.array((some >> np.uint64(32)).astype(np.int64)),
                        pa.array((some & np.uint64(BAD)).astype(np.int64)),
                        pa.array(docs[at : at + (1 << 16)].astype(np.int64)),
                    ],
                    ["block", "number", "a", "b", "docs"],
                )


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all rows of a binary column, and how many each row has."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), "<u4"), np.fromiter((len(r) >> 2 for r in rows), np.int64, len(rows))


def _summed(docs: pa.Table, counted: pa.Table) -> pa.Table:
    number, each = _flat(docs.column("pairs"))
    times, _ = _flat(docs.column("times"))
    total, best = np.zeros(counted.num_rows, np.int64), np.zeros(counted.num_rows, np.int64)
    at = counted.column("number").to_numpy()
    total[at] = counted.column("total").to_numpy()
    best[at] = counted.column("best").to_numpy()
    ends = np.append(0, np.cumsum(each))
    sums = {}
    for name, value in (("n_best", best), ("count_sum", total)):
        added = np.append(0, np.cumsum(value[number] * times))
        sums[name] = added[ends[1:]] - added[ends[:-1]]
    names = [c.split()[0] for c in ALIGNED.split(", ")]
    return pa.table({c: sums[c] if c in sums else docs.column(c) for c in names})


def spelled(a_path: str, b_path: str) -> Callable[[str], str]:
    """The groups of one text, for a look at an alignment."""
    return lambda text: Aligned([text], a_path, b_path).groups()[0].decode()
