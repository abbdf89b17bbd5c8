"""A corpus from raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as
Parquet and read again as the next stage's documents. All but the last keep the
columns of ``documents``. Rows without ``doc_id`` leave with the first stage; a
repeated id counts once from the second on.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm import minhash, packing, suffixes, toxicity
from corvane.llm.tables import fresh_folder, read, texts

#: Documents with a score of so much or more are rejected.
TOXIC = 0.5
#: Words of a shingle by which near copies are told.
SHINGLE = 5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled examples do not mark as toxic."""
    docs = docs.filter("doc_id is not null")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    name = "toxicity_score"
    while name in docs.columns:
        name += "_"
    return toxicity.with_score(docs, model, name).filter(F.col(name) < TOXIC).drop(name)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of the least id."""
    kept = minhash.near_copies(texts(docs), size=SHINGLE).filter("kept").select("doc_id")
    return docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without long strings that also start earlier; every document stays, if only as an empty text."""
    others = {c: f"carried_{k}" for k, c in enumerate(docs.columns) if c not in ("doc_id", "text", "n_chars")}
    named = docs.select("doc_id", "text", *(F.col(f"`{c}`").alias(n) for c, n in others.items()))
    cut = suffixes.remove_repeats(named, carry=tuple(others.values()))
    made = {"doc_id": F.col("doc_id"), "text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    made |= {c: F.col(n) for c, n in others.items()}
    return cut.select(*(made[c].alias(c) for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token windows of all documents, best fit decreasing: their ids, and the place of every piece."""
    docs = texts(docs)
    cut = packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True)
    return packing.windows(cut, packing.expected_pieces(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("packing", pack),
]

#: SQL cannot express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = fresh_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
