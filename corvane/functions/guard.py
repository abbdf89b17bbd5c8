"""The read-only guard as a column of (valid, reason)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from corvane import fixed_values as fixed
from corvane.functions.text import strip


def guard_reason(query: Column) -> Column:
    """Why a statement is refused, or the OK text. Null counts as empty.

    Known limits kept on purpose: literals are scanned like code, WITH is
    refused, and SELECT ... INTO passes.
    """
    body = strip(F.coalesce(query, F.lit("")))
    upper = F.upper(body)
    padded = F.concat(F.lit(" "), upper, F.lit(" "))

    def blocked(keyword: str) -> Column:
        return padded.contains(f" {keyword} ") | upper.startswith(keyword)

    def reason(keyword: str) -> Column:
        return F.lit(fixed.REASON_KEYWORD.format(keyword=keyword))

    first, *rest = fixed.BLOCKED_KEYWORDS
    chain = reduce(
        lambda cases, k: cases.when(blocked(k), reason(k)), rest, F.when(blocked(first), reason(first))
    )
    return (
        chain.when(~upper.startswith("SELECT"), F.lit(fixed.REASON_NOT_SELECT))
        .when(F.rtrim(body, F.lit(";")).contains(";"), F.lit(fixed.REASON_STACKED))
        .otherwise(F.lit(fixed.REASON_OK))
    )


def is_valid(reason: Column) -> Column:
    return reason == fixed.REASON_OK


def refusal(reason: Column) -> Column:
    """The message of a refused statement."""
    head, tail = fixed.REFUSAL.split("{reason}")
    return F.concat(F.lit(head), reason, F.lit(tail))
