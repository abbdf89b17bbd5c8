"""The pipeline's stages against plain Python, and its rows from end to end."""

import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from corvane.llm import toxicity
from tests.llm.test_minhash import brute as near_copies
from tests.llm.test_repeats import brute as late_bytes

SF = "/root/testdata/sf0.001"
NEXT = "/root/testdata/sf0.01"


def characters_kept(text, gone):
    """A text without its late bytes, spans narrowed to whole characters."""
    raw, out, at = text.encode(), [], 0
    edge = np.diff(gone.astype(int), prepend=0, append=0)
    for a, b in zip(np.flatnonzero(edge > 0), np.flatnonzero(edge < 0), strict=True):
        while a < b and raw[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
            b -= 1
        out.append(raw[at:a])
        at = b
    return b"".join([*out, raw[at:]]).decode()


def with_toxic(spark, folder):
    """The small tables with the labelled toxic documents of the next size, which alone hold enough of them."""
    def both(name, more):
        one = spark.read.parquet(f"{SF}/{name}.parquet")
        more = more.withColumn("doc_id", F.col("doc_id") + 10_000)
        one.unionByName(more).coalesce(1).write.parquet(f"{folder}/{name}.parquet")

    labels = spark.read.parquet(f"{NEXT}/labels.parquet").filter("toxic = 1")
    both("labels", labels)
    both("documents", spark.read.parquet(f"{NEXT}/documents.parquet").join(labels, "doc_id", "left_semi"))
    return str(folder)


def test_pipeline(spark, tmp_path):
    sf = with_toxic(spark, tmp_path)
    given = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r.doc_id: r for r in given.collect()}
    model = toxicity.load(toxicity.fit(given, spark.read.parquet(f"{sf}/labels.parquet")))
    docs = given
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        seen.append((name, docs.columns, docs.collect()))
    assert [n for n, *_ in seen] == ["toxicity", "near_dedup", "suffix_dedup", "packing"]
    assert all(set(c) == set(given.columns) for _, c, _ in seen[:3])

    judged = model.judge_all([r.text or "" for r in rows.values()], list(rows))
    clean = {k: r.text or "" for (k, r), (s, _) in zip(rows.items(), judged, strict=True) if s < corpus_pipeline.TOXIC}
    assert {r.doc_id: r for r in seen[0][2]} == {k: rows[k] for k in clean}
    assert 0 < len(clean) < len(rows)

    kept = near_copies(list(clean.items()), corpus_pipeline.SHINGLE)
    first = {k: t for k, t in clean.items() if kept[k][2]}
    assert {r.doc_id: r for r in seen[1][2]} == {k: rows[k] for k in first}

    gone = late_bytes([(k, t.encode()) for k, t in first.items()], 100)
    want = {k: characters_kept(t, gone[k]) for k, t in first.items()}
    assert {r.doc_id: (r.text, r.n_chars, r.lang, r.source) for r in seen[2][2]} == {
        k: (t, len(t), rows[k].lang, rows[k].source) for k, t in want.items()
    }

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = {}
    for r in seen[3][2]:
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == set(want)
    for key, own in pieces.items():
        ids = np.array([*library.encode(want[key], add_special_tokens=False).ids, 1], "<u4")
        own.sort(key=lambda r: r.start)
        assert sum(r.length for r in own) == len(ids)
        for r in own:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())

    packed = {r.sequence_id: np.frombuffer(r.window_ids, "<u4") for r in seen[3][2] if r.window_ids is not None}
    for key, own in pieces.items():
        ids = [*library.encode(want[key], add_special_tokens=False).ids, 1]
        assert [i for r in own for i in packed[r.sequence_id][r.offset : r.offset + r.length].tolist()] == ids

    ran = corpus_pipeline.run(spark, sf).collect()
    key = lambda r: (r.doc_id, r.start)
    assert [r[:5] for r in sorted(ran, key=key)] == [r[:5] for r in sorted(seen[3][2], key=key)]


def test_odd_rows_and_columns(spark, tmp_path):
    """Nulls, repeated rows and further columns, some with names that stages use."""
    long = " ".join(f"word{k}" for k in range(60))
    more = " ".join(f"other{k}" for k in range(60))
    kind = "doc_id long, text string, lang string, source string, n_chars long, kept_text int, toxicity_score int, n_spans int"
    rows = [
        (1, None, None, None, None, 1, 2, 3), (2, "", "en", "s", 0, 1, 2, 3), (3, long, None, "s", 1, 1, None, 3),
        (3, long, None, "s", 1, 1, None, 3), (4, f"{more} {long}", "en", None, 2, None, 2, 3), (None, "y", "en", "s", 1, 1, 2, 3),
    ]
    docs = spark.createDataFrame(rows, kind)
    spark.createDataFrame([(3, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == kind.replace(",", "").split()[::2]
    got = {r.doc_id: r for r in docs.collect()}
    assert sorted(got) == [1, 2, 3, 4] and got[3].text == long
    assert got[4].n_chars == len(got[4].text) < len(more) + 3 and got[4].toxicity_score == 2
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == {1, 2, 3, 4}
    none = spark.createDataFrame([], kind)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, str(tmp_path)).collect() == []
