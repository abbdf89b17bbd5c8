"""Guarded reads of the warehouse tables."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane import fixed_values as fixed
from corvane.functions.guard import guard_reason, refusal

#: Functions that run other code than the engine's.
FOREIGN = frozenset({"reflect", "java_method", "try_reflect"})
#: Parts of a plan that run programs, or name relations and functions only when the statement runs.
UNNAMED = {
    "ScriptTransformation": "a program",
    "PlanWithUnresolvedIdentifier": "a computed name",
    "ExpressionWithUnresolvedIdentifier": "a computed name",
    "UnresolvedTableValuedFunction": "a table function",
}


class RefusedStatement(ValueError):
    """A statement the guard does not let through."""


def own_session(spark: SparkSession) -> SparkSession:
    """A session of the same application and settings, with views, functions and a current database of its own."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    return own


def _nodes(tree: object) -> Iterator[dict]:
    if isinstance(tree, dict):
        if "class" in tree:
            yield tree
        tree = list(tree.values())
    if isinstance(tree, list):
        for part in tree:
            yield from _nodes(part)


def _parts(name: object) -> list[str]:
    return [p.strip() for p in name.strip("[]").split(",")] if isinstance(name, str) else [name["funcName"]]


def plan_reason(spark: SparkSession, sql: str) -> str | None:
    """Why the parsed plan of a statement is refused, or None. Nothing is read, resolved or run for it.

    Every relation, in subqueries too, has to be a table or view that the session knows, so files
    cannot be named in place of one. Functions have to be the engine's own, and none that calls other code.
    """
    parser = spark._jsparkSession.sessionState().sqlParser()
    builtin = None
    for node in _nodes(json.loads(parser.parsePlan(sql).toJSON())):
        kind = node["class"].rsplit(".", 1)[-1]
        if kind in UNNAMED:
            return f"Blocked: {UNNAMED[kind]} not permitted"
        if kind == "UnresolvedRelation":
            name = _parts(node["multipartIdentifier"])
            quoted = ".".join("`" + p.replace("`", "``") + "`" for p in name)
            if len(name) > 2 or not spark.catalog.tableExists(quoted):
                return f"Blocked: {'.'.join(name)} is not a registered table"
        if kind in ("UnresolvedFunction", "UnresolvedGenerator"):
            name = _parts(node["nameParts" if kind == "UnresolvedFunction" else "name"])
            builtin = builtin or {r.function for r in spark.sql("SHOW SYSTEM FUNCTIONS").collect()}
            if len(name) > 1 or name[0].lower() in FOREIGN or name[0].lower() not in builtin:
                return f"Blocked: function {'.'.join(name)} not permitted"
    return None


def run_guarded(spark: SparkSession, sql: str) -> DataFrame:
    """The result of a statement over the registered tables, if the guard allows its text and its plan."""
    checked = guard_reason(F.col("sql"))
    statement = spark.sql("SELECT :sql AS sql", args={"sql": sql})
    reason, message = statement.select(checked, refusal(checked)).collect()[0]
    if reason != fixed.REASON_OK:
        raise RefusedStatement(message)
    sql = sql.strip().rstrip(";")
    reason = plan_reason(spark, sql)
    if reason:
        raise RefusedStatement(fixed.REFUSAL.format(reason=reason))
    return spark.sql(sql)
