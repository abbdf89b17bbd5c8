"""Cost and latency columns.

A call costs a whole number of micro-dollars, so sums are exact in long
arithmetic and dollars are a decimal shift.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from corvane import fixed_values as fixed

MICRO = Decimal("0.000001")


def micro_dollars(input_tokens: Column, output_tokens: Column) -> Column:
    return (
        input_tokens.cast("bigint") * fixed.INPUT_PRICE
        + output_tokens.cast("bigint") * fixed.OUTPUT_PRICE
    )


def dollars(micro: Column) -> Column:
    return (micro.cast("decimal(20,0)") * F.lit(MICRO)).cast("decimal(18,6)")


def latency_ms(started: Column, ended: Column) -> Column:
    """Milliseconds between two timestamps, to one place."""
    return F.round((F.unix_micros(ended) - F.unix_micros(started)) / 1000.0, 1)
