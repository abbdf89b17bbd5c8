"""Approximate nearest chunks: random projections name buckets, exact scores order what meets in them.

Unit vectors are projected on TABLES * FUNCTIONS random directions by MLlib's ``BucketedRandomProjectionLSH``; a
table's bucket is FUNCTIONS projections taken together. A question meets the rows that share a bucket with it in any
table. Questions and rows travel once for each table, with their vector and all their buckets; those of a bucket are
scored where they meet, by the same rounded cosine as exact search, and a bucket gives k hits a question at most. A
pair is counted in the first table where it meets, so the pairs themselves, which may be most of questions times
rows, are neither moved nor written. The width of a projection's bucket goes with 1 / sqrt(dimension), as the
projections of unit vectors do, so the chance that two vectors meet depends on their cosine alone.

Of equal vectors only the first k by key take part: the others could never be a hit, and a vector that a third of
all rows share costs no more than another.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane import fixed_values as fixed
from corvane.functions import blocks as bl
from corvane.functions.vectors import l2_normalize
from corvane.operators.knn import QUESTION_BYTES, _hit_schema, _usable_index, _usable_questions, rank_hits

TABLES, FUNCTIONS = 24, 4
#: Width of a projection's bucket, in standard deviations of a unit vector's projection.
WIDTH = 2.3
SEED = 5
#: Rows of a bucket that meet its questions in one task, and rows scored at a time.
ROWS_PER_MEETING, ROWS_AT_ONCE = 50_000, 2_048


def _buckets(vectors: DataFrame, column: str, dim: int, tables: int, functions: int, width: float) -> DataFrame:
    """The rows once for each table, with ``buckets``, those they fall in in all tables, and ``bucket``, that table's."""
    spark = vectors.sparkSession
    lsh = BucketedRandomProjectionLSH(
        inputCol="unit", outputCol="hashes", numHashTables=tables * functions, bucketLength=width / dim**0.5, seed=SEED
    )
    unit = array_to_vector(l2_normalize(F.col(column).cast("array<double>"))).alias("unit")
    # the directions depend on the dimension and the seed alone
    model = lsh.fit(spark.range(1).select(array_to_vector(F.array_repeat(F.lit(0.0), dim)).alias("unit")))
    hashed = model.transform(vectors.select("*", unit))
    numbers = F.transform("hashes", lambda h: vector_to_array(h)[0].cast("long"))
    plain = hashed.select(*vectors.columns, numbers.alias("numbers"))
    own = F.transform(
        F.sequence(F.lit(0), F.lit(tables - 1)),
        lambda table: F.xxhash64(table, F.slice("numbers", table * functions + 1, functions)),
    )
    known = plain.select(*vectors.columns, own.alias("buckets"))
    return known.select("*", F.posexplode("buckets").alias("table", "bucket"))


def _dealt(one: DataFrame, key: list[str], most: int, other: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """``one`` in parts of about ``most`` rows a bucket, and ``other`` once for each part of its bucket.

    Only the few buckets with more rows than that are named; the others are one part.
    """
    large = one.groupBy("bucket").count().filter(F.col("count") > most)
    parts = F.broadcast(large.select("bucket", F.ceil(F.col("count") / most).cast("int").alias("parts")))
    own = F.pmod(F.xxhash64(*key), F.coalesce("parts", F.lit(1))).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))
    return (
        one.join(parts, "bucket", "left").withColumn(name, own).drop("parts"),
        other.join(parts, "bucket", "left").withColumn(name, every).drop("parts"),
    )


def meetings(
    questions: DataFrame, index: DataFrame, k: int = fixed.TOP_K, *, dim: int,
    tables: int = TABLES, functions: int = FUNCTIONS, width: float = WIDTH,
) -> DataFrame:
    """(question_id, s3_key, chunk_index, score, met): each question's best k hits in each of its buckets.

    A row without a key has in ``met`` how many rows the question met there and in no table before.
    """
    rows = _usable_index(index, dim)
    alike = Window.partitionBy("embedding").orderBy("s3_key", "chunk_index")
    rows = rows.withColumn("copy", F.row_number().over(alike)).filter(F.col("copy") <= k).drop("copy")
    held = _buckets(rows, "embedding", dim, tables, functions, width)
    asked = _buckets(_usable_questions(questions, dim), "vector", dim, tables, functions, width)
    asked, held = _dealt(asked, ["question_id"], QUESTION_BYTES // (8 * dim), held, "asker")
    held, asked = _dealt(held, ["s3_key", "chunk_index"], ROWS_PER_MEETING, asked, "holder")
    schema = T.StructType([*_hit_schema(questions).fields, T.StructField("met", T.LongType())])

    def score(some: pa.Table, rows: pa.Table) -> pa.Table:
        ids = some["question_id"].combine_chunks()
        if not len(ids) or not len(rows):
            return bl.no_hits(ids).append_column("met", pa.array([], pa.int64()))
        best = bl.BestHits(bl.unit_matrix(some["vector"], dim), k)
        table = some["table"][0].as_py()
        left, right = bl.same_codes(some["buckets"], rows["buckets"], tables, table)
        met = np.zeros(len(ids), dtype=np.int64)
        for at in range(0, len(rows), ROWS_AT_ONCE):
            best.add(rows.slice(at, ROWS_AT_ONCE).select(["s3_key", "chunk_index", "embedding"]))
            met += bl.first_meetings(left, right[:, at : at + ROWS_AT_ONCE])
        hits = best.result(ids)
        hits = hits.append_column("met", pa.nulls(len(hits), pa.int64()))
        counted = pa.table({
            "question_id": ids,
            "s3_key": pa.nulls(len(ids), hits.schema.field("s3_key").type),
            "chunk_index": pa.nulls(len(ids), pa.int32()),
            "score": pa.nulls(len(ids), pa.float64()),
            "met": pa.array(met),
        })
        return pa.concat_tables([hits, counted])

    place = ["bucket", "asker", "holder"]
    met = asked.groupBy(*place).cogroup(held.drop("table").groupBy(*place))
    return met.applyInArrow(score, schema)


def best_met(met: DataFrame, k: int = fixed.TOP_K) -> DataFrame:
    """The best k of each question over its buckets, ranked from one."""
    hits = met.filter(F.col("s3_key").isNotNull())
    return rank_hits(hits.groupBy("question_id", "s3_key", "chunk_index").agg(F.max("score").alias("score")), k)


def approximate_topk(questions: DataFrame, index: DataFrame, k: int = fixed.TOP_K, *, dim: int, **shape) -> DataFrame:
    """Top-k among the rows that share a bucket with a question: (question_id, rank, s3_key, chunk_index, score)."""
    return best_met(meetings(questions, index, k, dim=dim, **shape), k)


def quality(found: DataFrame, exact: DataFrame, met: DataFrame, index: DataFrame) -> DataFrame:
    """For each question the share of its exact hits that were found, and of all rows that were scored."""
    key = ["question_id", "s3_key", "chunk_index"]
    hits = exact.select(*key).join(found.select(*key, F.lit(1).alias("hit")), key, "left")
    recall = hits.groupBy("question_id").agg((F.count("hit") / F.count("*")).alias("recall"))
    scored = met.groupBy("question_id").agg(F.sum("met").alias("scored")).filter(F.col("scored") > 0)
    share = scored.select("question_id", (F.col("scored") / F.lit(index.count())).alias("share_scored"))
    return recall.join(share, "question_id")
