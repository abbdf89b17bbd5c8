"""The store of token ids against the tokenizers library, and its index against a dictionary."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corvane.llm import tokenstore
from corvane.llm.tables import fresh_folder

PATH = public_tokenizers.path("word_bpe_49k.json")
SIGNS = [
    "it's", " 'S", "'Re", "'''s", "\n\n A", "  \t b", "é È", "é", "́", "12a 3", "日本 語", "😀👍", "<|endoftext|>",
    "aaaaaaa", "İstanbul", "İ!", "ΟΔΟΣ ς", "Ⅷ²", "Å", "ﬁ", "\u0085", "\x1c", "\x1cA", "...!!?", " ", "_a_", "Ᲊb",
    "<|startoftext|>", "X", "#", "1234", "DON'T", "we'Ve ", " x", "Ǆ", "ẞ", "Ꟛ!",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def mixed(n, seed):
    rng = random.Random(seed)
    made = ["".join(rng.choices(SIGNS, k=rng.randint(0, 25))) for _ in range(n)]
    return [*made, "", " ", "a" * 4000, "ab " * 3000, "é x" * 500]


def wanted(library, text):
    return np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")


def test_ids_equal_the_library(library):
    encode, width = tokenstore.word_encoder(PATH)
    assert width == 2
    given = mixed(800, 1) + SIGNS
    ids, counts = encode(given)
    for text, own in zip(given, np.split(ids, np.cumsum(counts)[:-1]), strict=True):
        assert own.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("n", [0, 1, 2, 63, 5000])
def test_perfect_hash_is_minimal(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 40, n).astype(np.uint64))
    copies = rng.integers(0, 3, len(keys)).astype(np.uint32)
    found = tokenstore.PerfectHash.of(keys, copies)
    assert sorted(found.slots(keys, copies).tolist()) == list(range(len(keys)))
    same = np.full(300, 7, np.uint64)
    other = tokenstore.PerfectHash.of(same, np.arange(300, dtype=np.uint32))
    assert sorted(other.slots(same, np.arange(300)).tolist()) == list(range(300))


def test_store_gives_back_every_document(spark, library, monkeypatch):
    monkeypatch.setattr(tokenstore, "PART_KEYS", 16)
    monkeypatch.setattr(tokenstore, "READ_IDS", 500)
    given = [(k * 7 - 40, t) for k, t in enumerate(mixed(90, 2))] + [(5000, None), (5001, "x"), (None, "lost")]
    given += [(100, "b"), (100, "a"), (100, "a"), (-3, None), (-3, "")] + [(6000, f"t{k % 40}") for k in range(120)]
    docs = spark.createDataFrame([(*r, "y") for r in given], "doc_id long, text string, place string").repartition(5)
    store = tokenstore.write(docs, fresh_folder(spark, "store"), PATH, end_id=2)
    asked = docs.select("doc_id").union(spark.createDataFrame([(k,) for k in range(9000, 9500)], "doc_id long"))
    got = sorted(tokenstore.lookup(store, asked).collect(), key=lambda r: r.start)
    assert len(got) == len(given) - 1
    assert [r.doc_id for r in got] == sorted(k for k, _ in given if k is not None)
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:k]) for k in range(len(got))]
    assert [r.copy for r in got if r.doc_id == 6000] == list(range(120))
    texts = {}
    for key, text in given:
        texts.setdefault(key, []).append(wanted(library, text).tobytes())
    for key in {r.doc_id for r in got}:
        assert sorted(bytes(r.ids) for r in got if r.doc_id == key) == sorted(texts[key])
    assert all(len(r.ids) == 4 * r.n_tokens for r in got)
    one = tokenstore.lookup(store, spark.createDataFrame([(5001,), (None,)], "doc_id long")).collect()
    assert [bytes(r.ids) for r in one] == [wanted(library, "x").tobytes()]
    back = tokenstore.decode(tokenstore.lookup(store, spark.createDataFrame([(5001,)], "doc_id long")), PATH).collect()
    assert [r.text for r in back] == [library.decode(library.encode("x", add_special_tokens=False).ids)]


def test_store_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    store = tokenstore.write(docs, fresh_folder(spark, "store"), PATH, end_id=2)
    assert tokenstore.lookup(store, spark.createDataFrame([(1,)], "doc_id long")).collect() == []


def test_query_equals_the_library(spark, library):
    from corvane.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    texts = dict(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    start, want = 0, set()
    for key in sorted(texts):
        ids = wanted(library, texts[key])
        want.add((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert {tuple(r) for r in QUERIES["op11_tokenstore"](spark, folder).collect()} == want
