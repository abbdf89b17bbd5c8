"""Packing tokenized documents into fixed windows, best fit decreasing.

A document longer than a window is first cut into full windows; its rest, and
every shorter document, is one piece. Pieces are dealt by a hash of document and
start into groups of about ``GROUP_PIECES`` pieces, so no source, document or
length can crowd one. Within a group pieces go from the longest to the shortest
into the open window with the least room that still fits, which a segment tree
over remaining capacity finds in log2(window) steps. ``windows`` writes the ids of
every window, padded, and shuffles the ids of each piece once; ``pack`` gives places
alone and shuffles only lengths and checksums.

The padding lost is at most a window or so per group, well under one percent.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm import words
from corvane.llm.bpe import blocks
from corvane.llm.tables import kept

WINDOW = 2048
#: Pieces of one packing group, on average; three times as many where every byte is a token.
GROUP_PIECES = 1024
END_ID = 1
#: Fills a window behind its last piece.
PAD_ID = 0
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
PLACED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
FILLED = f"{PLACED}, window_ids binary"


def tokenizer(path: str):
    """The table of pieces for a vocabulary, and its special tokens; a worker keeps one."""
    return kept(("packing", path), lambda: _tokenizer(path))


def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    given = Tokenizer.from_file(path)
    given.no_truncation()
    given.no_padding()
    special = {t.content: i for i, t in given.get_added_tokens_decoder().items()}

    return words.PieceTable(words.byte_level(given)), special


def pieces(docs: DataFrame, path: str, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """The pieces of every document: full windows and the rest.

    Takes ``doc_id`` and ``text`` (null: empty); a document's ids end with
    END_ID, so an empty text is one piece of one id. ``ids`` holds little-endian
    unsigned 32-bit ids if asked for, else null. In place: nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, special = tokenizer(path)
        for part, texts in blocks(batches):
            ids, counts = table.ids_of(texts, special)
            bounds = np.concatenate([[0], np.cumsum(counts)])
            keys = part.column(0).to_pylist()
            rows: list[tuple] = []
            for key, a, b in zip(keys, bounds[:-1], bounds[1:], strict=True):
                own = np.append(ids[a:b], np.uint32(END_ID)).astype("<u4")
                for start in range(0, len(own), window):
                    raw = own[start : start + window].tobytes()
                    rows.append((key, start, len(raw) // 4, zlib.crc32(raw), len(own), raw if with_ids else None))
            kinds = [pa.int64()] * 5 + [pa.binary()]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


class OpenWindows:
    """Open windows by the room left in them; a tree of counts finds the tightest fit."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.tree = [0] * (2 * self.size)
        self.at: list[list[int]] = [[] for _ in range(window + 1)]

    def put(self, room: int, name: int) -> None:
        self.at[room].append(name)
        node = self.size + room
        while node:
            self.tree[node] += 1
            node >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """The (room, window) with the least room that is at least ``length``."""
        tree, node = self.tree, self.size + length
        if not tree[node]:
            while node > 1 and (node & 1 or not tree[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node + (not tree[2 * node])
        room = node - self.size
        while node:
            tree[node] -= 1
            node >>= 1
        return room, self.at[room].pop()


def best_fit(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Window number and offset for lengths in falling order, and the number of windows."""
    open_ = OpenWindows(window)
    number, offset, used = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    for k, length in enumerate(lengths.tolist()):
        found = open_.take(length)
        room, name = found if found else (window, used)
        used += not found
        number[k], offset[k] = name, window - room
        if room > length:
            open_.put(room - length, name)
    return number, offset, used


def expected_pieces(docs: DataFrame, window: int = WINDOW) -> int:
    """About how many pieces the documents have, at three bytes a token; never less than a third of them."""
    length = F.coalesce(F.octet_length("text"), F.lit(0))
    return docs.agg(F.sum(1 + F.floor(length / F.lit(3 * window))).alias("n")).first().n or 0


def pack(cut: DataFrame, expected: int, window: int = WINDOW) -> DataFrame:
    """A place for every piece: ``sequence_id`` and ``offset``.

    ``expected`` is about the number of pieces and sets the number of groups. Pieces that are alike in every column may trade places; nothing
    else depends on the order of rows. No pieces, no rows.
    """

    def place(frame: pd.DataFrame) -> pd.DataFrame:
        return placed(frame, window)[0].drop(columns="packing_group")

    return dealt(cut, expected).groupBy("packing_group").applyInPandas(place, PLACED)


def windows(cut: DataFrame, expected: int, window: int = WINDOW) -> DataFrame:
    """The places that ``pack`` gives, and the packed windows themselves.

    ``cut`` holds ``ids``. The row of the first piece of each window (``offset`` 0)
    carries the whole window as ``window_ids``, little-endian unsigned 32-bit ids,
    PAD_ID behind the last piece unless what is filled is a power of two long; it is null in other rows. ``ids_crc32`` is taken
    from the filled window.
    """

    def fill(frame: pd.DataFrame) -> pd.DataFrame:
        frame, used = placed(frame, window)
        filled = np.full((used, window), PAD_ID, "<u4")
        raws, sums = [], []
        number = (frame["sequence_id"] & 0xFFFFFFFF).to_numpy()
        for ids, row, at, length in zip(frame["ids"], number, frame["offset"], frame["length"], strict=True):
            filled[row, at : at + length] = np.frombuffer(ids, "<u4")
        ends = np.bincount(number, frame["length"], used).astype(np.int64)
        ends[ends & (ends - 1) != 0] = window
        for row, at, length in zip(number, frame["offset"], frame["length"], strict=True):
            raws.append(None if at else filled[row, : ends[row]].tobytes())
            sums.append(zlib.crc32(filled[row, at : at + length]))
        frame["ids_crc32"], frame["window_ids"] = sums, raws
        return frame.drop(columns=["packing_group", "ids"])

    return dealt(cut, expected, "ids").groupBy("packing_group").applyInPandas(fill, FILLED)


def dealt(cut: DataFrame, expected: int, *more: str) -> DataFrame:
    groups = max(1, -(-expected // GROUP_PIECES))
    return cut.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", *more,
        F.pmod(F.xxhash64("doc_id", "start"), F.lit(groups)).alias("packing_group"),
    )


def placed(frame: pd.DataFrame, window: int) -> tuple[pd.DataFrame, int]:
    """A group's pieces with their places, and the number of its windows."""
    frame = frame.sort_values(
        ["length", "doc_id", "start", "ids_crc32", "doc_tokens"], ascending=[False, True, True, True, True]
    )
    number, offset, used = best_fit(frame["length"].to_numpy(), window)
    frame["sequence_id"] = (frame["packing_group"].to_numpy() << 32) + number
    frame["offset"] = offset
    return frame, used
