"""Encoding and decoding with byte-pair merges compiled into an automaton.

The automaton reads pieces of text token by token: its states are the last token
read, its arcs the tokens that may follow, and its only path that spells a piece
is the piece's encoding. It is made by one gadget for each merge (u, v) -> w, in
the order of the merges. Gadget m

* removes the arc v behind every state that ends in u,
* adds an arc w wherever there was an arc u (and v behind it), and
* lets the state w continue as the state v did at that moment, so what gadgets
  before m had removed behind v stays removed behind w, and later removals behind
  v do not touch w.

All arcs of 50,000 states would fill a table of billions, so the gadgets are
applied to an arc when it is first asked for: ``arc`` walks back through the
gadgets that made its two tokens and looks whether one has removed it. The
answer enters the transition table; every later use is one lookup. The gadgets
treat the leftmost of equal pairs first, as merging does.

Encoding walks a piece once: from each position with a known state it follows
the byte trie of the labels and marks the ends whose arc exists. An end has
exactly one such arc. Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from corvane.llm import words

#: Rows of text handled at once inside a task, in characters.
BLOCK_CHARS = 1 << 22


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies write for the 256 bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class MergeAutomaton:
    def __init__(self, path: str):
        self.path, self.splitter = path, None
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        alphabet = byte_alphabet()
        spelled = {text: bytes(alphabet[c] for c in text) for text in given["model"]["vocab"]}
        self.special = {t["content"]: t["id"] for t in given.get("added_tokens", ())}
        vocab = {text: i for text, i in given["model"]["vocab"].items() if text not in self.special}
        size = 1 + max([*vocab.values(), *self.special.values()])
        self.label = [b""] * size
        for text, i in vocab.items():
            self.label[i] = spelled[text]
        for text, i in self.special.items():
            self.label[i] = text.encode()
        self.born, self.left, self.right = [-1] * size, [-1] * size, [-1] * size
        self.rank: dict[int, int] = {}
        for m, (a, b) in enumerate(x if isinstance(x, list) else x.split(" ") for x in given["model"]["merges"]):
            u, v, w = vocab[a], vocab[b], vocab[a + b]
            if self.born[w] >= 0:
                raise ValueError(f"two merges make {a + b!r}")
            self.born[w], self.left[w], self.right[w], self.rank[u << 20 | v] = m, u, v, m
        self.table: dict[int, bool] = {}
        self.step: dict[int, int] = {}  # byte trie: node << 8 | byte -> node
        self.ends = [-1]  # the token that ends at a node
        for i in vocab.values():
            node = 0
            for byte in self.label[i]:
                node = self.step.setdefault(node << 8 | byte, len(self.ends))
                if node == len(self.ends):
                    self.ends.append(-1)
            self.ends[node] = i
        sizes = np.fromiter(map(len, self.label), np.int64, size)
        self.label_size, self.label_begin = sizes, np.cumsum(sizes) - sizes
        self.label_bytes = np.frombuffer(b"".join(self.label), np.uint8)

    def arc(self, x: int, y: int) -> bool:
        """Whether token y may stand behind token x once all gadgets are applied."""
        stage = len(self.rank)
        while True:
            merged = self.rank.get(x << 20 | y)
            if merged is not None and merged < stage:
                return False
            born_x, born_y = self.born[x], self.born[y]
            if born_x < 0 and born_y < 0:
                return True
            if born_x > born_y:
                x, stage = self.right[x], min(stage, born_x)
            else:
                y, stage = self.left[y], min(stage, born_y + 1)

    def encode(self, piece: bytes) -> list[int]:
        n, step, ends, table = len(piece), self.step, self.ends, self.table
        state = [-1] * (n + 1)
        for at in range(n):
            last = state[at]
            node = 0
            for end in range(at, n):
                node = step.get(node << 8 | piece[end], -1)
                if node < 0:
                    break
                token = ends[node]
                if token >= 0 and state[end + 1] < 0:
                    if at:
                        key = last << 20 | token
                        there = table.get(key)
                        if there is None:
                            if len(table) >= 1 << 21:
                                table.clear()
                            there = table[key] = self.arc(last, token)
                        if not there:
                            continue
                    state[end + 1] = token
        out, at = [], n
        while at:
            out.append(state[at])
            at -= len(self.label[state[at]])
        return out[::-1]

    def encode_all(self, pieces: list[str]) -> list[list[int]]:
        return [
            [i for part in self.split(p) for i in self.encode(part.encode())]
            if words.has_unknown(p)
            else self.encode(p.encode())
            for p in pieces
        ]

    def split(self, piece: str) -> list[str]:
        """A word with signs that ``words`` has no class for, split as the library does."""
        from tokenizers import Tokenizer

        self.splitter = self.splitter or Tokenizer.from_file(self.path).pre_tokenizer
        return [piece[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(piece)]

    def emit(self, ids: np.ndarray) -> bytes:
        sizes = self.label_size[ids]
        place = np.cumsum(sizes)
        total = int(place[-1]) if len(place) else 0
        source = np.repeat(self.label_begin[ids] - (place - sizes), sizes) + np.arange(total)
        return self.label_bytes[source].tobytes()


@lru_cache(1)
def compiled(path: str) -> tuple[MergeAutomaton, words.PieceTable]:
    automaton = MergeAutomaton(path)
    return automaton, words.PieceTable(automaton.encode_all)


def blocks(
    batches: Iterator[pa.RecordBatch], column: str = "text", chars: int = 0
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """The batches in parts of about ``chars`` (or BLOCK_CHARS) bytes of text, with the texts (null: empty)."""
    chars = chars or BLOCK_CHARS
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(batch.schema.get_field_index(column))
        sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        begin = 0
        while begin < batch.num_rows:
            base = sizes[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(sizes, base + chars, "right")))
            yield batch.slice(begin, end - begin), [t or "" for t in texts.slice(begin, end - begin).to_pylist()]
            begin = end


def encode(docs: DataFrame, path: str) -> DataFrame:
    """Each text's ids, and the text that decoding them gives.

    Takes ``doc_id`` and ``text`` (other columns are not used; a null text is
    empty) and returns ``doc_id``, ``n_tokens``, ``ids`` (little-endian unsigned
    32-bit integers) and ``decoded``. One row in, one row out, in place: nothing
    is shuffled. Added tokens spelled out in a text become their ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, table = compiled(path)
        for part, texts in blocks(batches):
            ids, counts = table.ids_of(texts, automaton.special)
            bounds = np.concatenate([[0], np.cumsum(counts)])
            own = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array([x.astype("<u4").tobytes() for x in own], pa.binary()),
                    pa.array([automaton.emit(x).decode("utf-8", "replace") for x in own], pa.string()),
                ],
                ["doc_id", "n_tokens", "ids", "decoded"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded string")
