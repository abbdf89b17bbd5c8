"""Token use and cost of model calls."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane import fixed_values as fixed
from corvane.functions.costs import dollars, micro_dollars


def _by_type(calls: DataFrame) -> DataFrame:
    cost = micro_dollars(F.col("input_tokens"), F.col("output_tokens"))
    return calls.groupBy("call_type").agg(
        F.count(F.lit(1)).alias("calls"),
        F.coalesce(F.sum("input_tokens"), F.lit(0)).alias("input_tokens"),
        F.coalesce(F.sum("output_tokens"), F.lit(0)).alias("output_tokens"),
        F.coalesce(F.sum(cost), F.lit(0)).alias("micro"),
    )


def call_cost(calls: DataFrame) -> DataFrame:
    cost = micro_dollars(F.col("input_tokens"), F.col("output_tokens"))
    return calls.withColumn("cost_usd", dollars(cost))


def cost_by_type(calls: DataFrame) -> DataFrame:
    return _by_type(calls).select(
        "call_type", "calls", "input_tokens", "output_tokens", dollars(F.col("micro")).alias("cost_usd")
    )


def cost_summary(calls: DataFrame) -> DataFrame:
    """Costs per call type and, where ``is_total``, over all of them.

    The total sums the types, whose shuffle is reused, so the log is read once.
    Unlike a rollup's, it is there for an empty log too, all zeros.
    """
    by_type = _by_type(calls)
    sums = [
        F.coalesce(F.sum(c), F.lit(0)).alias(c)
        for c in ("calls", "input_tokens", "output_tokens", "micro")
    ]
    total = by_type.agg(*sums).select(F.lit(None).cast("string").alias("call_type"), "*")
    rows = by_type.withColumn("is_total", F.lit(False)).unionByName(
        total.withColumn("is_total", F.lit(True))
    )
    average = F.coalesce(
        F.try_divide(dollars(F.col("micro")), F.col("calls").cast("decimal(20,0)")), F.lit(0)
    )
    return rows.select(
        "is_total",
        "call_type",
        "calls",
        "input_tokens",
        "output_tokens",
        dollars(F.col("micro")).alias("cost_usd"),
        F.round(average, 6).cast("decimal(18,6)").alias("avg_cost_per_call_usd"),
        F.lit(float(fixed.INPUT_PRICE)).alias("price_per_million_input_tokens_usd"),
        F.lit(float(fixed.OUTPUT_PRICE)).alias("price_per_million_output_tokens_usd"),
    )


def cost_report(calls: DataFrame) -> DataFrame:
    """The summary as printable lines."""
    # The layout of the lines.
    by_type = "  [%s] calls=%d input_tokens=%d output_tokens=%d cost=$%s"
    total = "  TOTAL: calls=%d input_tokens=%d output_tokens=%d cost=$%s (avg $%s/call)"
    numbers = ["calls", "input_tokens", "output_tokens"]
    cost, average = F.col("cost_usd").cast("string"), F.col("avg_cost_per_call_usd").cast("string")
    line = F.when(
        F.col("is_total"), F.format_string(total, *numbers, cost, average)
    ).otherwise(F.format_string(by_type, F.col("call_type"), *numbers, cost))
    return cost_summary(calls).select("is_total", "call_type", line.alias("line"))
