"""The operators of this package as queries over whole given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm import (
    alignment,
    bpe,
    fingerprints,
    licenses,
    minhash,
    packing,
    periodic,
    quotes,
    substring,
    suffixes,
    tokenstore,
    topk,
    toxicity,
)
from corvane.llm.tables import fresh_folder, read, texts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(plan):
    QUERIES[plan.__name__] = plan
    return plan


@query
def op2_packing(spark, sf_dir):
    docs = texts(read(spark, sf_dir, "documents"))
    cut = packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True)
    return packing.windows(cut, packing.expected_pieces(docs)).drop("window_ids")


@query
def op10_bpe(spark, sf_dir):
    docs = texts(read(spark, sf_dir, "documents"))
    coded = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select(
        "doc_id", "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op3_substring(spark, sf_dir):
    found = substring.remove_repeats(texts(read(spark, sf_dir, "documents")))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query
def op6_suffixes(spark, sf_dir):
    found = suffixes.remove_repeats(texts(read(spark, sf_dir, "documents")))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op8_minhash(spark, sf_dir):
    return minhash.near_copies(texts(read(spark, sf_dir, "documents")))


@query
def op9_toxicity(spark, sf_dir):
    docs = texts(read(spark, sf_dir, "documents"))
    labels = read(spark, sf_dir, "labels").filter(~toxicity.held_out(F.col("doc_id")))
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op7_licenses(spark, sf_dir):
    return licenses.scan(texts(read(spark, sf_dir, "documents"))).drop("found")


@query
def op4_quotes(spark, sf_dir):
    return quotes.link(read(spark, sf_dir, "conversations"))


@query
def op5_fingerprints(spark, sf_dir):
    made = fingerprints.with_neighbours(texts(read(spark, sf_dir, "documents")))
    return made.select(
        "doc_id", "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("lanes")).alias("fingerprint"),
        fingerprints.as_text(F.col("edited_lanes")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("lanes"), F.col("edited_lanes")).alias("near_edited"),
        fingerprints.likeness(F.col("lanes"), F.col("next_lanes")).alias("near_next"),
    )


@query
def op11_tokenstore(spark, sf_dir):
    docs = texts(read(spark, sf_dir, "documents"))
    path = public_tokenizers.path("word_bpe_49k.json")
    store = tokenstore.write(docs, fresh_folder(spark, "tokens"), path, end_id=2)
    found = tokenstore.lookup(store, docs.select("doc_id"))
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op12_alignment(spark, sf_dir):
    a, b = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(read(spark, sf_dir, "documents"), a, b).drop("groups")


@query
def op13_periodic(spark, sf_dir):
    docs = texts(read(spark, sf_dir, "documents")).withColumn("h", F.crc32(F.col("doc_id").cast("string")))
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(0))
    split = docs.withColumn("w", F.when(F.expr("h % 10 = 0"), words))
    planned = split.selectExpr("*", "h div 10 % size(w) AS a").selectExpr("*", "1 + (size(w) - a) div (3 + h div 10 % 8) AS p")
    again = "array_join(transform(w, (x, i) -> IF(i < a, x, w[cast(a + (i - a) % p as int)])), ' ')"
    found = periodic.collapse(planned.selectExpr("doc_id", f"CASE WHEN size(w) > 0 THEN {again} ELSE text END AS text"))
    line = "concat(r.start, ',', r.length, ',', r.period, '\n')"
    return found.selectExpr(
        "doc_id", "cast(size(runs) as long) AS n_runs",
        "strongest.start AS start", "strongest.length AS length", "strongest.period AS period",
        "1000 * strongest.length div strongest.period AS exponent_milli",
        f"sha2(array_join(transform(runs, r -> {line}), ''), 256) AS runs_sha256",
        "sha2(collapsed, 256) AS collapsed_sha256",
    )


@query
def op1_topk(spark, sf_dir):
    vectors = topk.integer_vectors(read(spark, sf_dir, "embeddings"), "embedding")
    return topk.search(vectors.filter(F.col("vec_id") % 50 == 0), vectors)


ORACLES["op1_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


ORACLES["op3_substring"] = r"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents WHERE doc_id IS NOT NULL
), v AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM t)
), late AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM v
  ) WHERE k > 1
), gone AS (
  SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM late)
), word AS (
  SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM t
), kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS k FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
), removed AS (
  SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k, '')) AS kept_sha256
FROM t LEFT JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)
"""

ORACLES["op8_minhash"] = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'
  ) AS w
  FROM documents WHERE doc_id IS NOT NULL
), g AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
  FROM t
), u AS (
  SELECT doc_id, unnest(s) AS x FROM g
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM u a JOIN u b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL
), e AS (
  SELECT a, b FROM p JOIN g ga ON ga.doc_id = a JOIN g gb ON gb.doc_id = b
  WHERE 100 * c >= 80 * (len(ga.s) + len(gb.s) - c)
), linked AS (
  SELECT a, b FROM e UNION ALL SELECT b, a FROM e
), r AS (
  SELECT doc_id, doc_id AS near FROM g UNION SELECT r.doc_id, linked.b FROM r JOIN linked ON r.near = linked.a
), m AS (
  SELECT doc_id, min(near) AS component_id FROM r GROUP BY doc_id
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, component_id = doc_id AS kept
FROM g JOIN m USING (doc_id)
"""
