"""Writes: appends to registered tables, loads that replace themselves, merged documents and the call log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corvane.functions.text import token_count

def append(df: DataFrame, table: str) -> None:
    """Append by column name; columns the frame lacks take the table's defaults."""
    names = ", ".join(f"`{c}`" for c in df.columns)
    df.sparkSession.sql(f"INSERT INTO {table} ({names}) SELECT {names} FROM {{df}}", df=df)


def load_counted(df: DataFrame, table: str) -> int:
    """Append and return the rows loaded, counted on the way."""
    seen = Observation()
    append(df.observe(seen, F.count(F.lit(1)).alias("rows")), table)
    return seen.get["rows"]


def replace_part(df: DataFrame, path: str, parts: list[str]) -> None:
    """Write rows so that a repeat replaces them: ``parts`` name the batch."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .parquet(path)
    )


def upsert_documents(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming documents merged into the existing ones by ``s3_key``.

    A known document only takes the incoming status and keeps everything else,
    its first ingestion time included. Copies of one key within the incoming
    rows fold to one before the join.
    """
    rest = [c for c in existing.columns if c != "s3_key"]
    fresh = incoming.groupBy("s3_key").agg(F.max(F.struct(*rest)).alias("new"))
    old = existing.select("s3_key", F.struct(*rest).alias("old"))

    def merged(name: str) -> Column:
        new_value, old_value = F.col(f"new.{name}"), F.col(f"old.{name}")
        if name == "status":
            return F.coalesce(new_value, old_value)
        return F.when(F.col("old").isNull(), new_value).otherwise(old_value)

    joined = old.join(fresh, "s3_key", "full_outer")
    columns = [F.col(c) if c == "s3_key" else merged(c).alias(c) for c in existing.columns]
    return joined.select(*columns)


def log_calls(calls: DataFrame, table: str = "call_log") -> None:
    """Append model calls: call_type, input_tokens, output_tokens, maybe latency_ms."""
    append(calls, table)


def calls_from_texts(turns: DataFrame) -> DataFrame:
    """Call records of conversation turns: assistant text is output, other text input."""
    size = token_count(F.col("text")).cast("bigint")
    spoken = F.col("role") == "assistant"
    return turns.select(
        F.col("role").alias("call_type"),
        F.when(spoken, F.lit(0)).otherwise(size).cast("bigint").alias("input_tokens"),
        F.when(spoken, size).otherwise(F.lit(0)).cast("bigint").alias("output_tokens"),
    )


def reset_calls(spark: SparkSession, table: str = "call_log") -> None:
    spark.sql(f"TRUNCATE TABLE {table}")
