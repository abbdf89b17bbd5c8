"""Documents to sentence-packed chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane import fixed_values as fixed
from corvane.functions import text as tx


def _with_starts(
    documents: DataFrame, text: str, min_tokens: int, max_tokens: int, count: tx.Counter
) -> DataFrame:
    return (
        documents.withColumn("_sentences", tx.split_sentences(F.col(text)))
        .withColumn("_sizes", count(F.col("_sentences")))
        .withColumn("_starts", tx.chunk_starts(F.col("_sizes"), min_tokens, max_tokens))
    )


def chunk_documents(
    documents: DataFrame,
    text: str = "text",
    *,
    min_tokens: int = fixed.CHUNK_MIN_TOKENS,
    max_tokens: int = fixed.CHUNK_MAX_TOKENS,
    count: tx.Counter = tx.heuristic_counts,
    blank: bool = False,
) -> DataFrame:
    """One row per chunk: the other columns, chunk_index, chunk_text, token_count.

    A chunk's token_count is taken on its joined text, so it may exceed
    ``max_tokens``. Documents are independent: no shuffle. The outer ``inline``
    keeps the optimizer from inferring a non-empty filter below it, which would
    evaluate the whole chunking a second time. With ``blank`` a document without
    chunks has one row, whose chunk_index is null.
    """
    keep = [c for c in documents.columns if c != text]
    chunks = tx.join_chunks(F.col("_sentences"), F.col("_starts"))
    made = (
        _with_starts(documents, text, min_tokens, max_tokens, count)
        .withColumn("_chunks", chunks)
        .select(*keep, F.inline_outer("_chunks"))
    )
    if not blank:
        made = made.filter(F.col("chunk_index").isNotNull())
    return made.withColumn("token_count", F.get(count(F.array("chunk_text")), F.lit(0)))


def chunks_per_document(
    documents: DataFrame,
    text: str = "text",
    *,
    min_tokens: int = fixed.CHUNK_MIN_TOKENS,
    max_tokens: int = fixed.CHUNK_MAX_TOKENS,
    count: tx.Counter = tx.heuristic_counts,
) -> DataFrame:
    """The other columns and ``chunks_created``, zero for blank documents.

    The count is the number of chunk starts, so neither chunk texts nor a
    grouping is needed.
    """
    keep = [c for c in documents.columns if c != text]
    return _with_starts(documents, text, min_tokens, max_tokens, count).select(
        *keep, F.size("_starts").alias("chunks_created")
    )


def chunk_text_at(
    documents: DataFrame,
    index: str = "chunk_index",
    text: str = "text",
    *,
    min_tokens: int = fixed.CHUNK_MIN_TOKENS,
    max_tokens: int = fixed.CHUNK_MAX_TOKENS,
    count: tx.Counter = tx.heuristic_counts,
) -> DataFrame:
    """The text of the one chunk each row names, in place of the whole text."""
    keep = [c for c in documents.columns if c != text]
    return _with_starts(documents, text, min_tokens, max_tokens, count).select(
        *keep,
        tx.join_chunk(F.col("_sentences"), F.col("_starts"), F.col(index)).alias("chunk_text"),
    )
