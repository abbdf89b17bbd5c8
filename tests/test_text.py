"""Sentences and chunks against a plain reading of the packing rules."""

import random
import re

import pytest
from pyspark.sql import functions as F

from corvane.functions import text as tx
from corvane.operators.chunking import chunk_documents, chunk_text_at, chunks_per_document


def tokens(text):
    return max(1, len(text) // 4)


def packed(text, low, high, tokens=tokens):
    """Chunks as lists of sentences: a chunk is left when the next sentence is
    oversized, when it was oversized itself, or when it is full."""
    chunks = []
    for sentence in (s for s in re.split(r"(?<=[.!?])\s+", text.strip()) if s):
        held = sum(map(tokens, chunks[-1])) if chunks else 0
        alone = tokens(sentence) > high
        after_alone = bool(chunks) and tokens(chunks[-1][0]) > high
        full = held >= low and held + tokens(sentence) > high
        if not chunks or alone or after_alone or full:
            chunks.append([])
        chunks[-1].append(sentence)
    return [" ".join(c) for c in chunks]


def random_text(rng):
    size = rng.choice([0, 1, 3, 10, 60])
    gaps = [" ", "  ", "\n", " \t", " ", "\x1f", " "]
    pieces = []
    for _ in range(size):
        pieces.append("é" * rng.randint(1, rng.choice([8, 40, 120])) + rng.choice([".", "!", "?", ",", "?!"]))
        pieces.append(rng.choice(gaps))
    return rng.choice(["", " ", "\n"]) + "".join(pieces)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    return [random_text(rng) for _ in range(400)] + ["", "  \n", "abc", "a. b"]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = list(enumerate(texts)) + [(-1, None)]
    return spark.createDataFrame(rows, "doc int, text string").repartition(4).cache()


@pytest.mark.parametrize("low,high", [(20, 40), (5, 9), (0, 30), (500, 1000)])
def test_chunks_equal_brute_force(docs, texts, low, high):
    rows = chunk_documents(docs, min_tokens=low, max_tokens=high).collect()
    got = {(r.doc, r.chunk_index): (r.chunk_text, r.token_count) for r in rows}
    assert len(got) == len(rows)
    expected = {
        (d, i): (c, tokens(c)) for d, t in enumerate(texts) for i, c in enumerate(packed(t, low, high))
    }
    assert got == expected
    counts = {r.doc: r.chunks_created for r in chunks_per_document(docs, min_tokens=low, max_tokens=high).collect()}
    assert counts == {-1: 0} | {d: len(packed(t, low, high)) for d, t in enumerate(texts)}


def test_one_chunk_by_number(docs, texts):
    numbered = docs.withColumn("chunk_index", F.lit(1))
    rows = chunk_text_at(numbered, min_tokens=5, max_tokens=9).collect()
    for r in rows:
        chunks = packed(texts[r.doc], 5, 9) if r.doc >= 0 else []
        assert r.chunk_text == (chunks[1] if len(chunks) > 1 else None)


def test_known_chunks(spark):
    long, short = "x" * 4400 + ".", "Short one."
    rows = [
        (1, "This is sentence one. " * 400), (2, f"{short} {long} {short}"),
        (3, "y" * 1599 + ". " + "z" * 3599 + "."), (4, "abc"),
    ]
    df = spark.createDataFrame(rows, "doc int, text string")
    got = {}
    for r in chunk_documents(df).orderBy("doc", "chunk_index").collect():
        got.setdefault(r.doc, []).append((len(r.chunk_text), r.token_count))
    assert got == {
        1: [(4399, 1099)] * 2, 2: [(10, 2), (4401, 1100), (10, 2)], 3: [(5201, 1300)], 4: [(3, 1)],
    }


def test_whitespace_set_is_pythons(spark):
    codes = [c for c in range(0x3100) if c != 0]
    df = spark.createDataFrame([(c, chr(c), f"a.{chr(c)}b") for c in codes], "c int, one string, two string")
    blank = {r.c for r in df.filter(F.length(tx.strip(F.col("one"))) == 0).collect()}
    assert blank == {c for c in codes if not chr(c).strip()}
    cut = {r.c for r in df.filter(F.size(tx.split_sentences(F.col("two"))) == 2).collect()}
    assert cut == {c for c in codes if len(re.split(r"(?<=[.!?])\s+", f"a.{chr(c)}b")) == 2}


def test_chunking_plan_stays_in_the_jvm_and_runs_once(docs):
    plan = chunk_documents(docs)._jdf.queryExecution().executedPlan().toString()
    above = plan.split("InMemoryTableScan")[0]
    assert "Python" not in above and "Exchange" not in above
    assert above.count("split(") == 1


def test_lines(spark):
    blocks = "array<struct<BlockType: string, Text: string>>"
    rows = [([("PAGE", None), ("LINE", "a"), ("WORD", "a"), ("LINE", "b c")],), ([("PAGE", "x")],), ([],)]
    df = spark.createDataFrame(rows, f"blocks {blocks}")
    assert [r[0] for r in df.select(tx.assemble_lines(F.col("blocks"))).collect()] == ["a\nb c", "", ""]


def test_chunks_by_an_encoder(docs, texts):
    """Counted in words: each worker loads the encoder, one token per word."""
    rows = chunk_documents(docs, min_tokens=2, max_tokens=3, count=tx.encoder_counts(lambda: str.split)).collect()
    got = {(r.doc, r.chunk_index): (r.chunk_text, r.token_count) for r in rows}

    def words(text):
        return len(text.split())

    assert got == {
        (d, i): (c, words(c)) for d, t in enumerate(texts) for i, c in enumerate(packed(t, 2, 3, words))
    }
