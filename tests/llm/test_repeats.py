"""Span removal against brute force over all windows."""

import random
import re

import numpy as np
import pytest

from corvane.llm import anchors, minhash, repeats, substring, suffixes


def brute(sequences, window):
    """Removed places per document, for (doc_id, symbols) pairs with distinct ids."""
    seen, out = set(), {}
    for key, symbols in sorted(sequences):
        gone = np.zeros(len(symbols), bool)
        for p in range(len(symbols) - window + 1):
            own = tuple(symbols[p : p + window])
            if own in seen:
                gone[p : p + window] = True
            seen.add(own)
        out[key] = gone
    return out


def corpus(seed, n=60, vocabulary=200):
    rng = random.Random(seed)
    word = ["".join(rng.choices("abcdéü日", k=rng.randint(1, 6))) for _ in range(vocabulary)]
    passage = [[rng.choice(word) for _ in range(rng.randint(15, 70))] for _ in range(6)]
    docs = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 6)):
            parts += rng.choice(passage) if rng.random() < 0.5 else [rng.choice(word) for _ in range(rng.randint(1, 40))]
        docs.append("".join(w + rng.choice([" ", "\n", "  ", "\t"]) for w in parts))
    docs += [docs[3], docs[3], docs[4][7:], "ab " * 300, "ab " * 200, "a" * 700, "a" * 650, "", " ", "\x0b\x0c", "x y"]
    return list(enumerate(docs))


CASES = [{}, {"hot_least": 1}]


@pytest.fixture(params=[False, True], ids=["cold", "hot"])
def hot(request, monkeypatch):
    if request.param:
        monkeypatch.setattr(repeats, "SAMPLE", 1)
    monkeypatch.setattr(repeats, "BUCKET_DOCS", 16)
    return {"hot_least": 4} if request.param else {}


def frame(spark, rows):
    return spark.createDataFrame([(k, t, None) for k, t in rows], "doc_id long, text string, spans string").repartition(4)


def test_words(spark, hot):
    rows = [*corpus(1), (500, None)]
    want = brute([(k, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for k, t in rows], 20)
    got = substring.remove_repeats(frame(spark, rows), **hot).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id] or "")
        assert r.n_words == len(words)
        assert r.kept == " ".join(w for w, x in zip(words, want[r.doc_id], strict=True) if not x), r.doc_id
        assert r.n_removed == want[r.doc_id].sum()


def test_bytes(spark, hot):
    rows = [*corpus(2), (500, None)]
    raw = {k: (t or "").encode() for k, t in rows}
    want = brute(list(raw.items()), 100)
    got = suffixes.remove_repeats(frame(spark, rows), **hot).collect()
    assert len(got) == len(rows)
    for r in got:
        gone = want[r.doc_id]
        assert bytes(r.kept) == bytes(b for b, x in zip(raw[r.doc_id], gone, strict=True) if not x), r.doc_id
        assert (r.n_bytes, r.n_removed) == (len(gone), gone.sum())
        assert r.n_spans == (np.diff(gone.astype(int), prepend=0) > 0).sum()
        assert len(r.kept) <= len(r.kept_text.encode()) <= r.n_bytes


def test_chunks_of_long_texts(spark, monkeypatch):
    rng = random.Random(9)
    words = [rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(3000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[500:2500])), (3, " ".join(words[100:900] + words[:50]))]
    want = brute([(k, t.split()) for k, t in rows], 20)
    monkeypatch.setattr(repeats, "CHUNK", 137)
    monkeypatch.setattr(substring, "PART", 101)
    kind = repeats.Symbols(20, 6, substring.word_symbols, lambda *x: x)
    cut = repeats.block_runs(kind, [1, 2, 3], [t for _, t in rows])
    assert cut.windows.sum() == sum(len(t.split()) - 19 for _, t in rows)
    found = {r.doc_id: r for r in substring.remove_repeats(frame(spark, rows)).collect()}
    assert {k: r.n_removed for k, r in found.items()} == {k: v.sum() for k, v in want.items()}


def test_repeated_rows_and_nothing(spark):
    long = " ".join(f"w{k}" for k in range(60))
    rows = [(7, long), (7, long), (8, "z " + long), (None, long)]
    docs = frame(spark, [r for r in rows if r[0]])
    got = sorted((r.doc_id, r.n_removed) for r in substring.remove_repeats(docs).collect())
    assert got == [(7, 0), (7, 0), (8, 60)]
    got = sorted((r.doc_id, r.n_removed) for r in suffixes.remove_repeats(docs).collect())
    assert got == [(7, 0), (7, 0), (8, len(long))]
    none = spark.createDataFrame([], "doc_id long, text string")
    assert substring.remove_repeats(none).collect() == suffixes.remove_repeats(none).collect() == []


def test_anchors_depend_on_the_window_alone():
    rng = np.random.default_rng(3)
    values = anchors.mix(rng.integers(0, 3, 4000).astype(np.uint64))
    found = anchors.runs(values, np.array([len(values)]), 20, 6)
    place = {}
    for first, n, at, gram in zip(found.first, found.windows, found.anchor, found.gram, strict=True):
        for p in range(first, first + n):
            place[p] = (at - p, gram)
    assert len(place) == len(values) - 19
    by = {}
    for p, where in place.items():
        assert by.setdefault(values[p : p + 20].tobytes(), where) == where


def test_merge_of_front_coded_runs():
    rng = random.Random(4)
    for count in (1, 2, 3, 7):
        runs = []
        for _ in range(count):
            own = sorted(bytes(rng.choices(b"ab", k=rng.randint(0, 40))) for _ in range(rng.randint(0, 30)))
            runs.append((own, [suffixes.shared(a, b, 0) for a, b in zip([b"", *own], own, strict=False)]))
        order, lcp = suffixes.merge(runs)
        merged = [runs[r][0][k] for r, k in order]
        assert merged == sorted(x for own, _ in runs for x in own)
        assert lcp == [suffixes.shared(a, b, 0) for a, b in zip([b"", *merged], merged, strict=False)]


def test_matching_statistics():
    rng = random.Random(6)
    automaton, added = substring.SuffixAutomaton(), []
    for _ in range(12):
        own = [rng.randint(0, 2) for _ in range(rng.randint(0, 30))]
        got = automaton.matches(own)
        for end in range(len(own)):
            best = max(
                (n for n in range(1, end + 2) for a in added for p in range(len(a) - n + 1) if a[p : p + n] == own[end + 1 - n : end + 1]),
                default=0,
            )
            assert got[end] == best
        automaton.add(own)
        added.append(own)


@pytest.mark.parametrize("n", [10, 11])
def test_regular_words_are_told_apart(spark, n):
    """Words without a sign in common at any place, which a polynomial hash modulo 2**64 takes for one."""
    a, b = "a", "b"
    for _ in range(n):
        a, b = a + b, b + a
    one, other = " ".join([a] * 11 + [b] * 11), " ".join([b] * 11 + [a] * 11)
    docs = spark.createDataFrame([(1, one), (2, other)], "doc_id long, text string")
    assert [r.n_removed for r in substring.remove_repeats(docs).collect()] == [0, 0]
    found = minhash.near_copies(docs).collect()
    assert all(r.kept for r in found)
