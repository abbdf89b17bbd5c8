"""Text columns: stripping, line assembly, token counts, sentences and chunks.

All of it is built-in expressions, so text never leaves the JVM, unless the
caller counts tokens with an encoder of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from corvane import fixed_values as fixed

# Every character Unicode-aware stripping and "\s" take for space.
WHITESPACE = "".join(
    chr(c)
    for c in [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680]
    + [*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)

# The same set as a pattern: Unicode white space and the four separators it omits.
SENTENCE_GAP = r"(?U)(?<=[.!?])[\s\x1c-\x1f]+"

# From a column of texts, as an array, to their token counts.
Counter = Callable[[Column], Column]


def strip(text: Column) -> Column:
    """Both ends freed of any Unicode whitespace (``trim`` removes spaces only)."""
    return F.btrim(text, F.lit(WHITESPACE))


def assemble_lines(blocks: Column) -> Column:
    """The text of an extraction response: its LINE blocks, one per line."""
    lines = F.filter(blocks, lambda b: b["BlockType"] == "LINE")
    return F.array_join(F.transform(lines, lambda b: b["Text"]), "\n")


def token_count(text: Column) -> Column:
    """Heuristic token count: one per four characters, at least one."""
    whole = F.call_function("div", F.length(text), F.lit(fixed.CHARS_PER_TOKEN))
    return F.greatest(F.lit(1), whole.cast("int"))


def heuristic_counts(texts: Column) -> Column:
    return F.transform(texts, token_count)


def encoder_counts(load: Callable[[], Callable[[str], list]]) -> Counter:
    """Counts by an encoder, such as a BPE one, that each Python worker loads once."""

    @F.pandas_udf("array<int>")
    def counts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = load()
        for texts in batches:
            yield texts.map(lambda row: [len(encode(text)) for text in row])

    return counts


def split_sentences(text: Column) -> Column:
    """Sentences of a text; blank or null text has none.

    Stripped text cannot start or end with a gap and two gaps cannot touch, so
    the only empty piece there could be is the one of an empty text.
    """
    body = strip(text)
    none = F.array().cast("array<string>")
    return F.when(F.length(body) > 0, F.split(body, SENTENCE_GAP, -1)).otherwise(none)


def chunk_starts(sizes: Column, min_tokens: int, max_tokens: int) -> Column:
    """Positions of the sentences that open a chunk, from the sentence sizes.

    The fold carries the size of the open chunk, -1 if none is open. A sentence
    stays in the open chunk if it fits, or if it is not oversized itself and the
    chunk is below the minimum; any other opens a chunk, which an oversized one
    closes again at once. Only chunk starts are appended, so the fold stays
    linear; the commonest case is tested first.
    """
    start = F.struct(
        F.lit(-1).alias("size"),
        F.lit(0).alias("at"),
        F.array().cast("array<int>").alias("starts"),
    )

    def step(state: Column, n: Column) -> Column:
        size, at, starts = state["size"], state["at"], state["starts"]
        fits = size + n <= max_tokens
        stays = (size >= 0) & (fits | ((size < min_tokens) & (n <= max_tokens)))
        return F.struct(
            F.when(stays, size + n).when(n > max_tokens, F.lit(-1)).otherwise(n).alias("size"),
            (at + 1).alias("at"),
            F.when(stays, starts).otherwise(F.array_append(starts, at)).alias("starts"),
        )

    return F.aggregate(sizes, start, step, lambda state: state["starts"])


def join_chunk(sentences: Column, starts: Column, i: Column) -> Column:
    """The text of chunk ``i``, null if there is no such chunk."""
    start = F.get(starts, i)
    stop = F.coalesce(F.get(starts, i + 1), F.size(sentences))
    members = F.slice(sentences, start + 1, stop - start)
    return F.when(start.isNotNull(), F.array_join(members, " "))


def join_chunks(sentences: Column, starts: Column) -> Column:
    """``array<struct<chunk_index, chunk_text>>`` from sentences and chunk starts."""

    def chunk(_: Column, i: Column) -> Column:
        return F.struct(
            i.alias("chunk_index"), join_chunk(sentences, starts, i).alias("chunk_text")
        )

    return F.transform(starts, chunk)
