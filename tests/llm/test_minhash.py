"""Near copies against all pairs."""

import random
import re

import numpy as np

from corvane.llm import minhash


def brute(rows, size=4):
    sets = {}
    for key, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        grams = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}
        sets[key] = grams or ({tuple(words)} if words else set())
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: (len(sets[k]), find(k), find(k) == k) for k in sets}


def corpus(seed):
    rng = random.Random(seed)
    word = ["".join(rng.choices("abcdeÉz日", k=rng.randint(1, 5))) for _ in range(300)]
    docs = []
    for _ in range(12):
        base = [rng.choice(word) for _ in range(rng.randint(3, 150))]
        docs.append(base)
        for _ in range(rng.randint(0, 8)):
            other = list(rng.choice(docs[-3:]))
            for _ in range(rng.randint(0, 6)):
                other[rng.randrange(len(other))] = rng.choice(word)
            docs.append(other)
    texts = [" ".join(d) for d in docs]
    texts += [texts[0].upper(), texts[0] + "\n", "", None, " ", "x y", "X  y", "x", "a b c d", "a b c d e"]
    return list(enumerate(texts))


def test_components(spark):
    for seed in (1, 2, 3):
        rows = corpus(seed)
        docs = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, n_shingles int")
        got = minhash.near_copies(docs).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute(rows)


def test_blocks_of_clusters(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_CLASSES", 3)
    monkeypatch.setattr(minhash, "COLUMNS", 7)
    rows = corpus(5)
    got = minhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute(rows)


def test_linked_labels(spark):
    rng = random.Random(8)
    base = list(range(60))
    sets = []
    for k in range(40):
        own = set(base)
        for _ in range(rng.randint(0, 9)):
            own.discard(rng.randrange(60))
            own.add(100 + rng.randrange(500))
        sets.append((k, sorted(own)))
    table = spark.createDataFrame(sets, "rep long, members array<long>")
    rest = spark.createDataFrame([(1, k, k) for k in range(40)], "key long, rep long, label long")
    want = {
        (a, b) for a, x in sets for b, y in sets
        if a < b and 100 * len(set(x) & set(y)) >= 80 * len(set(x) | set(y))
    }
    assert want and {(r.a, r.b) for r in minhash.linked_labels(rest, table, 80).collect()} == want


def test_nothing_and_repeated_rows(spark):
    assert minhash.near_copies(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    docs = spark.createDataFrame([(4, "p q r s t"), (4, "p q r s t"), (5, "p q r s t")], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_copies(docs).collect())
    assert got == [(4, 2, 4, True), (4, 2, 4, True), (5, 2, 4, False)]


def test_components_of_chains(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 90), (90, 95), (7, 7)]
    got = minhash.components(spark.createDataFrame(links, "a long, b long")).collect()
    want = {k: 0 for k in range(1, 41)} | {95: 90, 100: 90}
    assert {r.node: r.component for r in got} == want


def test_pairs_within_the_distance_share_a_key():
    rng = np.random.default_rng(1)
    for _ in range(200):
        one = rng.integers(0, 1 << 16, (1, minhash.SLOTS)).astype(np.uint64)
        other = one.copy()
        changed = rng.choice(minhash.SLOTS, 2 * minhash.CHUNKS - 1, replace=False)
        other[0, changed] ^= np.uint64(1)
        assert set(minhash.chunk_keys(one)[0]) & set(minhash.chunk_keys(other)[0])
