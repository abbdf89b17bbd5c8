"""Customer metrics and the named analytics over them."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The step from one period to the next.
PERIODS = {"day": (1, "day"), "week": (7, "day"), "month": (1, "month")}


def _next_period(date: Column, period: str) -> Column:
    count, unit = PERIODS[period]
    if unit == "month":
        return F.add_months(date, count)
    return F.date_add(date, count)


def _before(date: dt.date, period: str) -> dt.date:
    """The first day of the period before the one that holds ``date``."""
    if period == "month":
        return (date.replace(day=1) - dt.timedelta(days=1)).replace(day=1)
    if period == "week":
        date -= dt.timedelta(days=date.weekday())
    return date - dt.timedelta(days=PERIODS[period][0])


def customer_metrics(
    activity: DataFrame,
    *,
    user: str = "user_id",
    time: str = "ts",
    period: str = "day",
    source_file: str | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """Customers, churned customers and churn rate per period.

    A period's customers are the users active in the period before it; those
    not active in it have churned. Only periods with activity of their own and
    before them are reported.

    Every activity marks its user in two periods: here in its own, due in the
    next. The marks of a user and period combine before the shuffle, so a user
    with most of the rows is no hot spot, and no join is needed: who is due and
    not here has churned.

    With ``start`` and ``end`` only periods from the one up to but not including the
    other are reported. The range, widened by the period before it, is a filter on
    the time itself, which reaches the scan.
    """
    if start is not None:
        activity = activity.filter(F.col(time) >= F.lit(dt.datetime.combine(_before(start, period), dt.time())))
    if end is not None:
        activity = activity.filter(F.col(time) < F.lit(dt.datetime.combine(end, dt.time())))
    date = F.to_date(time)
    if period != "day":
        date = F.trunc(date, period)

    def mark(when: Column, here: bool) -> Column:
        return F.struct(
            when.alias("metric_date"), F.lit(here).alias("here"), F.lit(not here).alias("due")
        )

    dated = activity.select(F.col(user).alias("user"), date.alias("period"))
    marks = F.array(mark(F.col("period"), True), mark(_next_period(F.col("period"), period), False))
    seen = dated.select("user", F.inline(marks)).groupBy("metric_date", "user").agg(
        F.max("here").alias("here"), F.max("due").alias("due")
    )
    totals = seen.groupBy("metric_date").agg(
        F.count_if("due").alias("total_customers"),
        F.count_if(F.col("due") & ~F.col("here")).alias("churned_customers"),
        F.max("here").alias("active"),
    )
    rate = F.try_divide(F.col("churned_customers"), F.col("total_customers"))
    if start is not None:
        totals = totals.filter(F.col("metric_date") >= F.lit(start))
    if end is not None:
        totals = totals.filter(F.col("metric_date") < F.lit(end))
    return totals.filter(F.col("active") & (F.col("total_customers") > 0)).select(
        "metric_date",
        "total_customers",
        "churned_customers",
        rate.cast("decimal(6,4)").alias("churn_rate"),
        F.lit(source_file).cast("string").alias("source_file"),
    )


def high_churn(metrics: DataFrame, above: str = "0.1") -> DataFrame:
    """Rows over a rate, given as decimal text so that the comparison reaches the scan."""
    return metrics.filter(F.col("churn_rate") > F.lit(Decimal(above)))


def by_source_file(structured: DataFrame, source_file: str) -> DataFrame:
    return structured.filter(F.col("source_file") == source_file)


def churn_series(metrics: DataFrame) -> DataFrame:
    return metrics.select("metric_date", "churn_rate").orderBy("metric_date")


def average_churn(metrics: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Mean churn rate over dates from ``start`` up to but not including ``end``."""
    inside = (F.col("metric_date") >= F.lit(start)) & (F.col("metric_date") < F.lit(end))
    return metrics.filter(inside).agg(F.avg(F.col("churn_rate").cast("double")).alias("avg_churn"))


def last_churned(metrics: DataFrame) -> DataFrame:
    """Churned customers of the last recorded date, summed if it has several rows."""
    by_date = metrics.groupBy("metric_date").agg(F.sum("churned_customers").alias("churned"))
    return by_date.agg(
        F.max("metric_date").alias("metric_date"),
        F.max_by("churned", "metric_date").alias("churned_customers"),
    )


def total_customers(metrics: DataFrame) -> DataFrame:
    return metrics.agg(F.sum("total_customers").alias("total_customers"))


def churn_trend(metrics: DataFrame) -> DataFrame:
    """Change of the churn rate against the previous recorded date.

    The rows fold to one per date first; what the single window sorts is then
    bounded by the calendar, not by the data.
    """
    dated = metrics.groupBy("metric_date").agg(F.max("churn_rate").alias("churn_rate"))
    previous = F.lag("churn_rate").over(Window.orderBy("metric_date"))
    return dated.select(
        "metric_date",
        "churn_rate",
        previous.alias("previous_rate"),
        (F.col("churn_rate") - previous).cast("decimal(6,4)").alias("change"),
    )


def churn_vs_target(metrics: DataFrame, target: str) -> DataFrame:
    """Each date's rate beside a documented target, and whether it is met."""
    return metrics.select(
        "metric_date",
        "churn_rate",
        F.lit(Decimal(target)).alias("target_rate"),
        (F.col("churn_rate") <= F.lit(Decimal(target))).alias("aligned"),
    )


def embedding_count(embeddings: DataFrame) -> DataFrame:
    return embeddings.agg(F.count(F.lit(1)).alias("embedding_count"))
