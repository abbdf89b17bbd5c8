"""Reply structure of conversations from the quotes in their messages.

Lines that begin with ``>`` marks are quotes; the number of marks is the level.
Quoted passages (runs of one level, and their lines) are normalised, hashed and
joined to the messages of the same conversation whose own text has the passage as
a whole, a paragraph or a line. The earliest such message is the original. A
message answers the original of most passages at its lowest quote level; replies
then form threads, and conversations are put in the order thread by thread, the
answers behind what they answer, without the quotes.

Everything is DataFrame operations. Passages are reduced to one original each
before they are joined, so common lines and long conversations multiply nothing;
threads are followed by doubling, in as many joins as the depth has binary digits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm.tables import checkpointed, ranked

MARKS = r"^([ \t]*>)+[ \t]?"


def normal(text: Column) -> Column:
    return F.trim(F.lower(F.regexp_replace(text, r"\s+", " ")))


def lines(text: Column) -> Column:
    """Lines as (level, content): the level is the number of marks, the content what follows them."""
    return F.transform(
        F.split(F.coalesce(text, F.lit("")), r"\r?\n"),
        lambda x: F.struct(
            F.length(F.regexp_replace(F.regexp_extract(x, MARKS, 0), "[^>]", "")).alias("level"),
            F.regexp_replace(x, MARKS, "").alias("content"),
        ),
    )


def body(parsed: Column) -> Column:
    """The text without quotes."""
    return F.trim(F.array_join(F.transform(F.filter(parsed, lambda x: x["level"] == 0), lambda x: x["content"]), "\n"))


def quoted_runs(parsed: Column) -> Column:
    """Runs of consecutive lines of one level above 0, as (level, text)."""
    start = F.array().cast("array<struct<level:int,text:string>>")
    last = F.lit(0)

    def step(held: Column, x: Column) -> Column:
        joins = (F.size(held["runs"]) > 0) & (held["last"] == x["level"])
        longer = F.concat(
            F.slice(held["runs"], 1, F.size(held["runs"]) - 1),
            F.array(
                F.struct(
                    x["level"].alias("level"),
                    F.concat(F.element_at(held["runs"], -1)["text"], F.lit("\n"), x["content"]).alias("text"),
                )
            ),
        )
        more = F.concat(held["runs"], F.array(F.struct(x["level"].alias("level"), x["content"].alias("text"))))
        runs = F.when(x["level"] == 0, held["runs"]).when(joins, longer).otherwise(more)
        return F.struct(x["level"].alias("last"), runs.alias("runs"))

    any_quote = F.exists(parsed, lambda x: x["level"] > 0)
    folded = F.aggregate(parsed, F.struct(last.alias("last"), start.alias("runs")), step, lambda h: h["runs"])
    return F.when(any_quote, folded).otherwise(start)


def hashed(passage: Column) -> list[Column]:
    return [F.xxhash64(passage).alias("hash_a"), F.xxhash64(passage, F.lit(1)).alias("hash_b")]


def link(turns: DataFrame) -> DataFrame:
    """Messages in reply order, without quotes.

    Takes ``conv_id``, ``turn``, ``role`` and ``text`` (null: empty) and returns
    those but the text, and ``body``, ``n_quoted`` (quoted lines), ``n_linked``
    (distinct quoted passages with an original), ``reply_to`` (null: begins a
    thread), ``thread`` (turn of its first message), ``depth`` and ``place`` (from
    1 within the conversation). Rows of one conversation and turn count as one
    message when passages are looked up; messages without conversation or turn are
    kept, unlinked, each as its own thread.
    """
    parsed = turns.select("conv_id", "turn", "role", lines(F.col("text")).alias("lines"))
    own = parsed.select("conv_id", "turn", body(F.col("lines")).alias("body"))
    units = F.concat(
        F.array(F.col("body")), F.split("body", r"\n[ \t]*\n"), F.split("body", r"\n")
    )
    originals = (
        own.select("conv_id", "turn", F.explode(F.array_distinct(F.transform(units, normal))).alias("passage"))
        .filter("passage <> ''")
        .select("conv_id", "turn", *hashed(F.col("passage")))
        .groupBy("conv_id", "hash_a", "hash_b").agg(F.min("turn").alias("origin"))
    )
    runs = parsed.select("conv_id", "turn", F.explode(quoted_runs(F.col("lines"))).alias("run"))
    passages = F.array_distinct(
        F.transform(F.concat(F.array(F.col("run.text")), F.split("run.text", r"\n")), normal)
    )
    quotes = (
        runs.select("conv_id", "turn", "run.level", F.explode(passages).alias("passage"))
        .filter("passage <> ''")
        .select("conv_id", "turn", "level", *hashed(F.col("passage")))
        .groupBy("conv_id", "turn", "hash_a", "hash_b").agg(F.min("level").alias("level"))
    )
    found = quotes.join(originals, ["conv_id", "hash_a", "hash_b"]).filter("origin < turn")
    votes = found.groupBy("conv_id", "turn", "level", "origin").agg(F.count("*").alias("n"))
    best = F.min_by("origin", F.struct("level", -F.col("n"), -F.col("origin")))
    replies = checkpointed(
        votes.groupBy("conv_id", "turn").agg(best.alias("reply_to"), F.sum("n").alias("n_linked"))
    )
    up = checkpointed(replies.select("conv_id", "turn", F.col("reply_to").alias("top"), F.lit(1).alias("depth")))
    while True:
        above = up.select("conv_id", F.col("turn").alias("top"), F.col("top").alias("next_top"), F.col("depth").alias("more"))
        if up.join(above, ["conv_id", "top"], "left_semi").isEmpty():
            break
        up = checkpointed(
            up.join(above, ["conv_id", "top"], "left").select(
                "conv_id", "turn", F.coalesce("next_top", "top").alias("top"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            )
        )
    messages = parsed.select(
        "conv_id", "turn", "role", body(F.col("lines")).alias("body"),
        F.size(F.filter("lines", lambda x: x["level"] > 0)).cast("long").alias("n_quoted"),
    )
    joined = (
        messages.join(replies, ["conv_id", "turn"], "left").join(up, ["conv_id", "turn"], "left")
        .select(
            "conv_id", "turn", "role", "body", "n_quoted", F.coalesce("n_linked", F.lit(0)).alias("n_linked"), "reply_to",
            F.coalesce("top", "turn").alias("thread"), F.coalesce("depth", F.lit(0)).alias("depth"),
        )
    )
    order = [F.col(c) for c in ("conv_id", "thread", "turn", "role", "body")]
    placed = ranked(joined, order, "place")
    begins = placed.groupBy("conv_id").agg(F.min("place").alias("begin"))
    return placed.join(begins, placed["conv_id"].eqNullSafe(begins["conv_id"])).drop(begins["conv_id"]).withColumn(
        "place", (F.col("place") - F.col("begin") + 1).cast("long")
    ).drop("begin")
