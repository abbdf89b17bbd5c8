"""Homomorphic multiset fingerprints of documents.

A paragraph is hashed to a wide vector and a document's fingerprint is the sum of
its paragraphs' vectors, lane by lane, modulo a power of two. So the order of
paragraphs does not matter, and a paragraph is inserted or deleted by adding or
subtracting its vector.

The first DENSE lanes (modulo 2**32) get a value from every paragraph and decide
equality. The others (modulo 2**8) are LEVELS levels of WIDTH lanes: a paragraph
falls into one lane of level 0, and with half the chance of one level also into
the next. The last level takes one paragraph in 2**25, so for any text a string can
hold some level holds about as many paragraphs as lanes; the share of its lanes that agree tells how alike two texts are.

Everything is column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm.tables import ranked

DENSE, LEVELS, WIDTH = 8, 26, 32
DENSE_MASK, MASK = (1 << 32) - 1, (1 << 8) - 1
LANES = DENSE + LEVELS * WIDTH
#: A level is read if so many of its lanes or fewer are filled.
FEW = 22
#: Paragraphs end at a line's end.
LINES = r"\n"
#: Also sentences count as paragraphs.
SENTENCES = r"\n|(?<=[.!?]) "


def total(values: Column, term) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + term(x))


def once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def vector(text: Column, separator: str = LINES) -> Column:
    """The fingerprint as an array of LANES lanes; a null text is empty."""
    hashed = F.transform(
        F.split(F.coalesce(text, F.lit("")), separator, -1),
        lambda p: F.struct(F.xxhash64(p).alias("h"), F.xxhash64(p, F.lit(1)).alias("g")),
    )

    def lanes(pieces: Column) -> Column:
        numbers = F.array(*(F.lit(i) for i in range(DENSE)))
        dense = F.transform(
            numbers, lambda i: total(pieces, lambda x: F.xxhash64(x["h"], x["g"], i).bitwiseAND(F.lit(DENSE_MASK)))
        )
        dense = F.transform(dense, lambda x: x.bitwiseAND(F.lit(DENSE_MASK)))
        places = F.array(*(F.lit(j) for j in range(WIDTH)))
        marked = F.transform(
            pieces,
            lambda x: F.struct(
                x["h"].alias("h"),
                x["g"].bitwiseAND(F.lit(WIDTH - 1)).cast("int").alias("lane"),
                F.xxhash64(x["h"], x["g"]).bitwiseAND(F.lit(MASK)).alias("value"),
            ),
        )

        def level(k: int, own: Column) -> Column:
            chosen = F.filter(own, lambda x: x["h"].bitwiseAND(F.lit((1 << k) - 1)) == 0)
            return once(
                chosen,
                lambda own: F.when(F.size(own) == 0, F.array_repeat(F.lit(0).cast("long"), WIDTH)).otherwise(
                    F.transform(
                        places,
                        lambda j: total(
                            F.filter(own, lambda x: x["lane"] == j), lambda x: x["value"]
                        ).bitwiseAND(F.lit(MASK)),
                    )
                ),
            )

        return once(marked, lambda own: F.concat(dense, *(level(k, own) for k in range(LEVELS))))

    return once(hashed, lanes)


def _modulus(i: Column) -> Column:
    return F.when(i < DENSE, F.lit(DENSE_MASK)).otherwise(F.lit(MASK))


def joined(a: Column, b: Column) -> Column:
    """The fingerprint of two multisets together."""
    return F.transform(F.zip_with(a, b, lambda x, y: x + y), lambda x, i: x.bitwiseAND(_modulus(i)))


def without(a: Column, b: Column) -> Column:
    """The fingerprint of a multiset after the paragraphs of ``b`` have been deleted from it."""
    return F.transform(F.zip_with(a, b, lambda x, y: x - y), lambda x, i: x.bitwiseAND(_modulus(i)))


def as_text(lanes: Column) -> Column:
    return F.array_join(
        F.transform(lanes, lambda x, i: F.lpad(F.lower(F.hex(x)), F.when(i < DENSE, 8).otherwise(2), F.lit("0"))), ""
    )


def likeness(a: Column, b: Column) -> Column:
    """1 for equal multisets, else the share of agreeing lanes among the filled ones."""
    # 1000 for each lane that is filled in either, and 1 if both agree
    levels = F.array(
        *(
            F.aggregate(
                F.zip_with(
                    F.slice(a, DENSE + 1 + k * WIDTH, WIDTH),
                    F.slice(b, DENSE + 1 + k * WIDTH, WIDTH),
                    lambda x, y: F.when((x == 0) & (y == 0), 0).when(x == y, 1001).otherwise(1000),
                ),
                F.lit(0),
                lambda s, x: s + x,
            )
            for k in range(LEVELS)
        )
    )

    def share(levels: Column) -> Column:
        few = F.filter(levels, lambda x: F.floor(x / 1000) <= FEW)
        count = F.when(F.size(few) > 0, F.aggregate(few, F.lit(0), lambda s, x: s + x)).otherwise(F.element_at(levels, -1))
        return once(count, lambda c: F.when(c < 1000, 0.0).otherwise((c % 1000) / F.floor(c / 1000)))

    same = F.slice(a, 1, DENSE) == F.slice(b, 1, DENSE)
    return F.when(same, 1.0).otherwise(once(levels, share))


def with_neighbours(docs: DataFrame, separator: str = SENTENCES) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness.

    Takes ``doc_id`` and ``text`` (null: empty). The next document is that of the
    next lower id, after the last the one of the highest; a lone document is its
    own next. In the edited text the last half of the characters, rounded down, has
    made way for as many of the next text's first. Of rows with one id the least
    text is the next of others; each row is edited by itself.

    Returns ``doc_id``, ``n_chars``, ``edited``, ``lanes``, ``edited_lanes`` and
    ``next_lanes``.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    half = F.floor(F.char_length("text") / 2).cast("int")
    ids = ranked(docs.groupBy("doc_id").agg(F.max(half).alias("half")), [F.desc("doc_id")], "rank")
    count = ids.count()
    order = ids.select("doc_id", "half", F.when(F.col("rank") == count, 1).otherwise(F.col("rank") + 1).alias("next_rank"))
    wanted = order.join(ids.select(F.col("rank").alias("next_rank"), F.col("doc_id").alias("next_id")), "next_rank")
    wanted = wanted.select(F.col("next_id").alias("doc_id"), F.col("doc_id").alias("for_id"), "half")
    dealt = docs.repartition("doc_id")
    given = dealt.groupBy("doc_id").agg(F.min("text").alias("text")).join(wanted, "doc_id")
    given = given.select(
        F.col("for_id").alias("doc_id"), F.expr("substring(text, 1, half)").alias("head"),
        vector(F.col("text"), separator).alias("next_lanes"),
    )
    both = dealt.join(given, "doc_id")
    edited = F.expr(
        "concat(substring(text, 1, char_length(text) - cast(floor(char_length(text) / 2) as int)),"
        " substring(head, 1, cast(floor(char_length(text) / 2) as int)))"
    )
    return both.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), "text", edited.alias("edited"), "next_lanes"
    ).select(
        "doc_id", "n_chars", "edited", "next_lanes",
        vector(F.col("text"), separator).alias("lanes"), vector(F.col("edited"), separator).alias("edited_lanes"),
    )
