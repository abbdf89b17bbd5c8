"""Route labels and model replies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corvane import fixed_values as fixed
from corvane.functions.text import strip

# Words that point to documents and to the warehouse.
DOCUMENT_WORDS = ("policy", "strategy", "governance", "playbook", "document")
WAREHOUSE_WORDS = ("churn", "metric", "catalog", "count", "average", "total", "dataset")


def parse_route(reply: Column) -> Column:
    """The route a one-word reply names; anything unclear is ``both``."""
    letters = F.regexp_replace(F.upper(reply), "[^A-Z]", "")
    (label, route), *others = fixed.ROUTE_LABELS
    found = F.when(letters.contains(label), F.lit(route))
    for label, route in others:
        found = found.when(letters.contains(label), F.lit(route))
    return found.otherwise(F.lit(fixed.ROUTE_BOTH))


def route_by_words(question: Column) -> Column:
    """The default route where no model labels the questions."""
    lowered = F.lower(question)
    documents = lowered.rlike("|".join(DOCUMENT_WORDS))
    warehouse = lowered.rlike("|".join(WAREHOUSE_WORDS))
    return (
        F.when(documents & ~warehouse, F.lit(fixed.ROUTE_DOCUMENTS))
        .when(warehouse & ~documents, F.lit(fixed.ROUTE_WAREHOUSE))
        .otherwise(F.lit(fixed.ROUTE_BOTH))
    )


def strip_fences(reply: Column) -> Column:
    """SQL freed of a surrounding code fence and its language tag."""
    body = strip(reply)
    inner = F.btrim(body, F.lit("`"))
    untagged = F.when(F.lower(inner).startswith("sql"), F.substr(inner, F.lit(4))).otherwise(inner)
    return F.when(body.startswith("```"), strip(untagged)).otherwise(body)
