"""Token ids against the tokenizers library, and packing against its rules."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corvane.llm import bpe, packing, words

PATH = public_tokenizers.path("byte_bpe_50k.json")
SIGNS = [
    "it's", " 's", "'re", "'''s", "\n\n a", "  \t b", "é è", "12a 3", "日本 語", "😀👍", "<|endoftext|>", "aaaaaaa",
    "'d'd", "don't", "we've ", "\u0085", "ⅷ²", "\x1c", "...!!?", " ", "   ", " x", "'S", "\r\n", "'",
    "\u1c89", "\U000105c0a", "\ua7da!",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def mixed(n, seed):
    rng = random.Random(seed)
    made = ["".join(rng.choices(SIGNS, k=rng.randint(0, 25))) for _ in range(n)]
    return [*made, "", " ", "a" * 4000, "ab " * 3000, "<|endoftext|>"]


def test_ids_equal_the_library(library):
    automaton, table = bpe.compiled(PATH)
    given = mixed(600, 1)
    ids, counts = table.ids_of(given, automaton.special)
    parts = np.split(ids, np.cumsum(counts)[:-1])
    for text, own in zip(given, parts, strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert own.tolist() == want
        assert automaton.emit(own).decode("utf-8", "replace") == library.decode(want, skip_special_tokens=False)


def thue_morse(n):
    """Two words of 2**n signs, nowhere equal, which any polynomial hash modulo 2**64 takes for one from n = 10 on."""
    a, b = "a", "b"
    for _ in range(n):
        a, b = a + b, b + a
    return a, b


@pytest.mark.parametrize("n", [10, 11])
def test_hashes_decide_nothing(library, n):
    a, b = thue_morse(n)
    _, special = packing.tokenizer(PATH)
    for table in (bpe.compiled(PATH)[1], packing.tokenizer(PATH)[0]):
        for given in ([a, b], [b], [f"{b} x {a} {a}", a]):
            ids, _ = table.ids_of(given, special)
            assert ids.tolist() == [i for t in given for i in library.encode(t, add_special_tokens=False).ids]


def test_slices_and_forgetting_change_nothing(library, monkeypatch):
    automaton, _ = bpe.compiled(PATH)
    monkeypatch.setattr(words, "SLICE", 50)
    given = mixed(80, 2)
    ids, counts = words.PieceTable(automaton.encode_all, limit=20).ids_of(given, automaton.special)
    for text, own in zip(given, np.split(ids, np.cumsum(counts)[:-1]), strict=True):
        assert own.tolist() == library.encode(text, add_special_tokens=False).ids


def test_encode_operator(spark, library):
    rows = [(k, t) for k, t in enumerate(mixed(60, 3))] + [(900, None), (900, None)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, ids string")
    got = {r.doc_id: r for r in bpe.encode(docs, PATH).collect()}
    assert len(got) == len(rows) - 1
    for key, text in rows:
        want = library.encode(text or "", add_special_tokens=False).ids
        assert bytes(got[key].ids) == np.array(want, "<u4").tobytes() and got[key].n_tokens == len(want)
        assert got[key].decoded == library.decode(want, skip_special_tokens=False)


def test_best_fit_takes_the_tightest():
    rng = random.Random(5)
    for window in (7, 8, 64):
        lengths = sorted((rng.randint(1, window) for _ in range(200)), reverse=True)
        number, offset, used = packing.best_fit(np.array(lengths), window)
        rooms = []
        for k, length in enumerate(lengths):
            fits = [r for r in rooms if r >= length]
            if not fits:
                rooms.append(window)
                room = window
            else:
                room = min(fits)
            assert window - offset[k] == room
            rooms.remove(room)
            rooms.append(room - length)
        assert used == len(rooms) == number.max() + 1


def test_packing(spark, library, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 20)
    given = [*mixed(60, 4), None]
    docs = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string").repartition(3)
    rows = packing.pack(packing.pieces(docs, PATH, 64), docs.count(), 64).collect()
    for key, text in enumerate(given):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        own = sorted((r for r in rows if r.doc_id == key), key=lambda r: r.start)
        assert [r.start for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))]
        assert sum(r.length for r in own) == len(ids)
        for r in own:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) and r.doc_tokens == len(ids)
    windows = {}
    for r in rows:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in windows.values():
        spans.sort()
        assert [o for o, _ in spans] == [sum(n for _, n in spans[:k]) for k in range(len(spans))]
        assert sum(n for _, n in spans) <= 64
    full = sum(r.length for r in rows)
    assert full / (64 * len(windows)) > 0.9


def test_windows_hold_the_ids(spark, library, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 20)
    given = [*mixed(60, 5), None]
    docs = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string").repartition(3)
    rows = packing.windows(packing.pieces(docs, PATH, 64, with_ids=True), docs.count(), 64).collect()
    packed = {r.sequence_id: np.frombuffer(r.window_ids, "<u4") for r in rows if r.window_ids is not None}
    assert len(packed) == sum(r.offset == 0 for r in rows) == len({r.sequence_id for r in rows})
    left = {k: w.copy() for k, w in packed.items()}
    for key, text in enumerate(given):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        own = sorted((r for r in rows if r.doc_id == key), key=lambda r: r.start)
        assert [i for r in own for i in packed[r.sequence_id][r.offset : r.offset + r.length].tolist()] == ids
        for r in own:
            assert r.ids_crc32 == zlib.crc32(packed[r.sequence_id][r.offset : r.offset + r.length].tobytes())
            left[r.sequence_id][r.offset : r.offset + r.length] = packing.PAD_ID
    for key, w in left.items():
        used = sum(r.length for r in rows if r.sequence_id == key)
        assert len(w) == (used if used in (1, 2, 4, 8, 16, 32, 64) else 64) and (w == packing.PAD_ID).all()
    places = packing.pack(packing.pieces(docs, PATH, 64), docs.count(), 64).collect()
    assert sorted(tuple(r) for r in places) == sorted(tuple(r)[:7] for r in rows)


@pytest.mark.parametrize(("words", "size"), [(31, 32), (30, 64), (63, 64), (0, 1)])
def test_windows_of_a_power_of_two_are_not_padded(spark, words, size):
    docs = spark.createDataFrame([(1, " a" * words)], "doc_id long, text string")
    row = packing.windows(packing.pieces(docs, PATH, 64, with_ids=True), 1, 64).first()
    assert row.length == words + 1 and len(row.window_ids) == 4 * size


def test_expected_pieces(spark):
    docs = spark.createDataFrame([(1, "a" * 599), (2, None), (3, "é" * 400)], "doc_id long, text string")
    assert packing.expected_pieces(docs, 100) == 2 + 1 + 3


def test_packing_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.expected_pieces(docs) == 0
    assert packing.pack(packing.pieces(docs, PATH), 0).collect() == []
    assert bpe.encode(docs, PATH).collect() == []


def test_hashes_of_the_query(spark):
    from corvane.llm.queries import QUERIES

    rows = QUERIES["op10_bpe"](spark, "/root/testdata/sf0.001").collect()
    texts = dict(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect())
    assert len(rows) == len(texts)
    for r in rows:
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
