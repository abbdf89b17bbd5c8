"""Exact neighbours against brute force, and accuracy on held-out labels."""

import zlib

import numpy as np
import pytest

from corvane.llm import toxicity
from corvane.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter(~toxicity.held_out(toxicity.F.col("doc_id")))
    return toxicity.load(toxicity.fit(docs, labels))


def test_neighbours_are_exact(model):
    dense = np.zeros((len(model.ids), len(model.terms)))
    for k, (t, w) in enumerate(model.rows):
        dense[k, t] = w
    rng = np.random.default_rng(1)
    for _ in range(100):
        terms = np.sort(rng.choice(len(model.terms), rng.integers(1, min(6, len(model.terms)) + 1), replace=False))
        weights = rng.random(len(terms))
        weights /= np.sqrt((weights**2).sum())
        cosine = dense[:, terms] @ weights
        want = sorted(((-round(float(c), 12), k) for k, c in enumerate(cosine) if c > 0))[: toxicity.NEIGHBOURS]
        got = model.nearest(terms, weights)
        assert np.allclose([s for s, _ in got], [-s for s, _ in want])
        assert [k for s, k in got if s > got[-1][0] + 1e-9] == [k for s, k in want if -s > got[-1][0] + 1e-9]


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in QUERIES["op9_toxicity"](spark, SF).collect()}
    truth = dict(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic").collect())
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 5 == 0) for k, r in rows.items())
    own = [(rows[k].predicted, y) for k, y in truth.items() if rows[k].held_out]
    assert np.mean([p == y for p, y in own]) > 0.93
    assert all(0 <= r.score <= 1 for r in rows.values())
    clean = [p for p, y in own if y == 0]
    assert np.mean(clean) < 0.02


def test_without_labels_or_texts(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "some words")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()} == {0.0}
    one = spark.createDataFrame([(3, 1), (3, 1), (None, 1), (2, None)], "doc_id long, toxic int")
    assert len(toxicity.score(docs, toxicity.fit(docs, one)).collect()) == 3
    empty = docs.limit(0)
    assert toxicity.score(empty, toxicity.fit(empty, one)).collect() == []


def test_all_terms_of_all_examples_count(spark):
    """Words that only come along with others, and words of clean text alone, are in the vectors."""
    rows = [(k, f"brask vonder smeel w{k}") for k in range(20)] + [(20 + k, f"calm field river v{k}") for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k < 20)) for k in range(40)], "doc_id long, toxic int")
    model = toxicity.load(toxicity.fit(docs, labels))
    for word in ("brask", "vonder", "smeel", "calm", "field", "river", "w7", "v7"):
        terms, _ = model.vector(word)
        assert len(terms), word
        score, evidence = model.judge(word)
        assert evidence and (score > 0.5) == (word in ("brask", "vonder", "smeel", "w7")), (word, score)
    want = {h for _, t in rows for h in toxicity.term_hashes(t).tolist()}
    assert set(model.terms.tolist()) == want
    one = model.judge_all([t for _, t in rows])
    assert one == [model.judge(t) for _, t in rows]


def plain(model, text, key=None):
    """Cosines with every example and their votes, one by one."""
    terms, weights = model.vector(text)
    if not len(terms):
        return model.empty_score, []
    asked, near = dict(zip(terms.tolist(), weights.tolist(), strict=True)), []
    for k, (own, w) in enumerate(model.rows):
        cosine = round(sum(asked.get(t, 0.0) * x for t, x in zip(own.tolist(), w.tolist(), strict=True)), 12)
        if cosine > 0 and model.ids[k] != key:
            near.append((-cosine, k))
    near = [(-s, k) for s, k in sorted(near)[: toxicity.NEIGHBOURS]]
    votes = [s * model.stands_for[k] for s, k in near]
    toxic = sum(v * model.label[k] for v, (_, k) in zip(votes, near, strict=True))
    return (toxic + toxicity.PRIOR * model.rate) / (sum(votes) + toxicity.PRIOR), near


def test_votes_of_whole_texts_and_an_example_leaves_itself_out(spark, model):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    examples = set(model.ids.tolist())
    assert any(r.doc_id in examples for r in rows)
    judged = model.judge_all([r.text or "" for r in rows], [r.doc_id for r in rows])
    for row, (score, evidence) in list(zip(rows, judged, strict=True))[::7]:
        want, near = plain(model, row.text or "", row.doc_id)
        assert abs(score - want) < 1e-9
        assert np.allclose([s for _, s in evidence], [s for s, _ in near])
        assert row.doc_id not in [k for k, _ in evidence]
    text = "a lone text of its own"
    docs = spark.createDataFrame([(1, text), (2, text), (3, "b")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, toxic int")
    found = {r.doc_id: [e.example for e in r.evidence] for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    assert found[1] == [] and found[2] == [1]


def test_odd_rows_keep_their_columns(spark):
    """Repeated rows, null ids and texts, a long text, further columns of clashing names."""
    rows = [(1, "vile words here", "x"), (1, "vile words here", "x"), (2, "calm words there", "y"), (None, None, "z"), (4, "", None)]
    rows.append((5, "vile " * 200_000, "long"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    out = toxicity.with_score(docs, toxicity.fit(docs, labels)).collect()
    assert sorted(((r.doc_id, r.text, r.score) for r in out), key=str) == sorted(rows, key=str)
    assert all(0 <= r.toxicity_score <= 1 for r in out)
    assert len({r.toxicity_score for r in out if r.doc_id == 1}) == 1


def test_the_power_is_chosen_on_the_examples():
    """Marking words drown in long texts unless weighted; where every word marks, plain cosine does."""
    rng = np.random.default_rng(3)
    n, words = 80, 400
    held = []
    for k in range(n):
        terms = rng.choice(words, 60, replace=False) + 10
        if k % 2:
            terms = np.append(terms, rng.choice(10, 2, replace=False))
        held.append((k, k % 2, np.sort(terms).astype(np.uint64), np.ones(len(terms), np.int64)))
    number = np.arange(words + 10, dtype=np.uint64)
    corpus = np.append(np.full(words + 10, 10), 100)
    totals = {0: 40, 1: 40}
    wrong = [toxicity.misjudged(held, number, corpus, totals, p) for p in toxicity.POWERS]
    assert min(wrong[1:]) < wrong[0]
    assert np.ptp(toxicity.made(held, number, corpus, totals).idf) > 0
    apart = [(k, k % 2, np.arange(5, dtype=np.uint64) + 5 * (k % 2), np.ones(5, np.int64)) for k in range(n)]
    number, corpus = np.arange(10, dtype=np.uint64), np.append(np.full(10, 10), 100)
    assert toxicity.misjudged(apart, number, corpus, totals, 0.0) == 0
    assert np.ptp(toxicity.made(apart, number, corpus, totals).idf) == 0


def test_the_search_moves_postings_in_rows_and_sums_only_common_terms_again(spark, model, monkeypatch):
    rows = spark.read.parquet(f"{SF}/documents.parquet").filter("text is not null").select("text").orderBy("doc_id").limit(200)
    given = list(dict.fromkeys(r.text for r in rows.collect()))
    held = np.where(model.common < 0, np.bincount(model.term, minlength=len(model.terms)), 0)
    moved, real = [], toxicity.ranges
    monkeypatch.setattr(toxicity, "ranges", lambda begin, size: moved.append(int(size.sum())) or real(begin, size))
    judged = model.judge_all(given)
    single = sum(int(held[terms].sum()) for terms, _ in model.vectors(given))
    single += sum(int(model.sizes[model.place[k]]) for _, evidence in judged for k, _ in evidence)
    assert sum(moved) < 0.6 * single


def test_known_hashes_are_found_where_they_stand():
    rng = np.random.default_rng(5)
    crowded = np.arange(300, dtype=np.uint64) + np.uint64(7 << 40)
    for hashes in (np.zeros(0, np.uint64), np.array([2**64 - 1], np.uint64), rng.integers(0, 2**64, 5000, np.uint64), crowded):
        hashes = np.unique(hashes)
        asked = np.concatenate([hashes, hashes + np.uint64(1), np.array([0, 2**64 - 1], np.uint64), rng.integers(0, 2**64, 50, np.uint64)])
        want = {h: k for k, h in enumerate(hashes.tolist())}
        assert toxicity.Known(hashes).places(asked).tolist() == [want.get(h, -1) for h in asked.tolist()]
