"""Runs of words against a search over all periods and places."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corvane.llm import periodic


def slow(words, least=6, times=4):
    """All runs: for each period the maximal stretches, unless a smaller period explains them."""
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(least, times * q) and (i, length) not in found:
                found[(i, length)] = q
            i = max(j, i + 1) if j > i else i + 1
            while i + q < n and i > 0 and words[i - 1] == words[i - 1 + q]:
                i += 1
    return sorted((s, n_, q) for (s, n_), q in found.items())


def outcome(doc_id, text):
    words = [w for w in (text or "").translate({c: " " for c in range(9, 14)}).split(" ") if w]
    runs = slow(words)
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    return doc_id, len(words), runs, best, " ".join(w for k, w in enumerate(words) if k not in gone)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=40))
def test_every_run_is_found(signs):
    for least, times in ((6, 4), (2, 2), (3, 3)):
        got = periodic.find_runs(np.array(signs, np.int64), least, times)
        assert [tuple(r) for r in got.tolist()] == slow(signs, least, times)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c", b"d"]), max_size=40), max_size=6), st.integers(1, 9))
def test_candidates_lose_nothing(docs, times):
    docs = [d * (times if k % 2 else 1) for k, d in enumerate(docs)]
    got = periodic.runs_of(docs)
    assert [[tuple(r) for r in x.tolist()] for x in got] == [slow(d) for d in docs]


def test_suffix_tree_knows_common_extensions():
    rng = random.Random(1)
    for n in (1, 2, 50, 400):
        signs = [rng.randint(0, 1) for _ in range(n)] + [2]
        tree = periodic.SuffixTree(signs)
        assert tree.tour().tolist() == tree.suffixes().tolist()
        assert tree.suffixes().tolist() == sorted(range(n + 1), key=lambda i: [-1 if s == 2 else s for s in signs[i:]])
        assert tree.suffixes(True).tolist() == sorted(range(n + 1), key=lambda i: [-9 if s == 2 else -s for s in signs[i:]])
        pairs = [(rng.randrange(n + 1), rng.randrange(n + 1)) for _ in range(300)]
        pairs = [(a, b) for a, b in pairs if a != b] or [(0, 1)]
        got = tree.common(*np.array(pairs).T)
        for (a, b), k in zip(pairs, got.tolist(), strict=True):
            assert signs[a : a + k] == signs[b : b + k] and signs[a + k] != signs[b + k]


def texts():
    rng = random.Random(4)
    made = [" ".join(rng.choices("abc", k=rng.randint(0, 60))) for _ in range(60)]
    made += ["la " * 500, "x\ty\x0bx\ny\rx\x0cy x y x y", "a a a a a", "a a a a a a", "", " ", "é é " * 6, "q", "\x1c " * 7]
    made += [" ".join(str(k % 50) for k in range(1000)), "s " + "one two three " * 4 + "one two", "a b " * 4 + "a a a a a a"]
    return made


def test_collapse(spark):
    rows = [*enumerate(texts()), (900, None), (901, "a " * 9), (901, "a " * 9), (None, "b " * 9)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, runs int").repartition(3)
    got = sorted(
        (r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.strongest and tuple(r.strongest), r.collapsed)
        for r in periodic.collapse(docs).collect()
    )
    assert got == sorted(outcome(k, t) for k, t in rows if k is not None)


def test_collapse_of_nothing(spark):
    assert periodic.collapse(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query(spark, folder):
    from corvane.llm.queries import QUERIES

    want = set()
    for key, text in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect():
        words = [w.decode() for w in (text or "").encode().split()]
        n, h = len(words), zlib.crc32(str(key).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        _, _, runs, best, kept = outcome(key, " ".join(words)) if n < 1500 else (0, 0, None, None, None)
        if runs is None:
            found = periodic.runs_of([[w.encode() for w in words]])[0].tolist()
            short = [(int(s), int(m), int(q)) for s, m, q in found]
            gone = {k for s, m, q in short for k in range(s + q, s + m)}
            runs, best = short, min(short, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
            kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        hashes = tuple(hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept))
        want.add((key, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *hashes))
    assert {tuple(r) for r in QUERIES["op13_periodic"](spark, folder).collect()} == want
