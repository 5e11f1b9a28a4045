"""Monthly summary per institution, and monthly series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casewatch.functions.columns import count_status, growth_percent


def monthly_summary(fact: DataFrame) -> DataFrame:
    """Counts, mean days of closed cases and month-on-month growth per institution.

    Growth compares with the previous month that has cases; a first month has 0. The
    window runs over the aggregate: per institution, at most one row per calendar month.
    """
    return with_growth(fact.groupBy("bank_id", "year", "month").agg(
        F.count("*").alias("total_complaints"),
        count_status("Resolved").alias("resolved_count"),
        count_status("Pending").alias("pending_count"),
        count_status("Escalated").alias("escalated_count"),
        F.avg("resolution_days").alias("avg_resolution_days"),
    ))


def with_growth(totals: DataFrame) -> DataFrame:
    """Adds ``complaint_growth_pct`` to one row per institution and month."""
    by_month = Window.partitionBy("bank_id").orderBy("year", "month")
    growth = growth_percent(F.col("total_complaints"), F.lag("total_complaints").over(by_month))
    return totals.withColumn("complaint_growth_pct", F.coalesce(F.bround(growth, 2), F.lit(0.0)))


def high_growth_months(summary: DataFrame, institutions: DataFrame, min_growth: float = 15, k: int = 3) -> DataFrame:
    """The k institution-months with most growth above a threshold, with the name joined to
    the k rows only."""
    top = (
        summary.filter(F.col("complaint_growth_pct") > min_growth)
        .orderBy(F.desc("complaint_growth_pct"), "bank_id", "year", "month")
        .limit(k)
    )
    return top.join(institutions.select("bank_id", "bank_name"), "bank_id").select(
        "bank_name", "year", "month", "total_complaints", "complaint_growth_pct"
    )


def monthly_series(cases: DataFrame, by: str | None = None, drop_partial_months: bool = False) -> DataFrame:
    """``series, month_end, value``: monthly counts without gaps, 0 where a month has no case.

    One series over everything, or one per value of ``by``. Each series spans its own first
    to last month. ``drop_partial_months`` removes the last month of a series whose newest
    case lies before the month's last day.
    """
    series = F.lit("all") if by is None else F.col(by)
    counted = cases.groupBy(series.alias("series"), F.last_day("date").alias("month_end")).agg(
        F.count("*").alias("n"), F.max("date").alias("newest")
    )
    if drop_partial_months:
        last = F.max("month_end").over(Window.partitionBy("series"))
        counted = counted.withColumn("last", last).filter("month_end < last OR newest = month_end")
    step = F.expr("interval 1 month")
    first, last = F.trunc(F.min("month_end"), "MM"), F.trunc(F.max("month_end"), "MM")
    # Counts become one map per series (an entry per calendar month), read by the month spine.
    found = F.map_from_entries(F.collect_list(F.struct("month_end", "n")))
    return (
        counted.groupBy("series")
        .agg(F.sequence(first, last, step).alias("months"), found.alias("found"))
        .select("series", "found", F.explode("months").alias("month"))
        .select("series", F.last_day("month").alias("month_end"), "found")
        .select("series", "month_end", F.coalesce(F.col("found")[F.col("month_end")], F.lit(0)).cast("double").alias("value"))
    )


def series_arrays(series: DataFrame) -> DataFrame:
    """Each series as two aligned arrays in time order; a series has one entry per month."""
    points = F.sort_array(F.collect_list(F.struct("month_end", "value")))
    return series.groupBy("series").agg(points.alias("p")).select(
        "series",
        F.transform("p", lambda x: F.date_format(x["month_end"], "yyyy-MM-dd")).alias("dates"),
        F.transform("p", lambda x: x["value"]).alias("values"),
    )
