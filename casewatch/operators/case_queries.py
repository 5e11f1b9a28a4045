"""Supervision queries over the wide case table.

Each is one filter - group - aggregate pass: counts and means combine before the shuffle,
so an institution with a third of all cases costs no more than any other group.

Results carry no order unless a limit needs one: a global sort is a sampling job and a
shuffle more. ``in_display_order`` sorts a result where it is shown.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewatch.functions.columns import age_days, count_status, growth_percent, percent, quarter_label, resolved_days

ROWS = "*"

# How each result is listed: column, and whether it falls.
DISPLAY_ORDER = {
    "top_banks_yoy": [("total_volume", True), ("bank_name", False)],
    "category_trends": [("quarter_label", False), ("category_name", False)],
    "resolution_efficiency": [("efficiency_rank", False), ("bank_name", False)],
    "state_heatmap": [("state", False), ("complaint_count", True), ("category_name", False)],
    "pendency_aging": [("total_pending", True), ("bank_name", False)],
    "rising_categories": [("qoq_growth_pct", True), ("category_name", False)],
    "monthly_trend": [("month_start", False)],
    "value_counts": [("complaint_count", True), ("value", False)],
    "quarter_category_volumes": [("quarter_label", False), ("category_name", False)],
    "state_volume": [("complaint_count", True), ("state", False)],
    "category_monthly": [("year", False), ("month", False)],
    "mis_bank": [("total_complaints", True), ("bank_name", False)],
    "category_breakdown": [("category_name", False), ("complaint_count", True), ("subcategory_name", False)],
    "mis_geo": [("complaint_count", True), ("state", False)],
    "risk_scores": [("risk_score", True), ("bank_name", False)],
}


def in_display_order(result: DataFrame, name: str) -> DataFrame:
    return result.orderBy(*[F.col(c).desc_nulls_last() if falls else F.col(c).asc_nulls_last() for c, falls in DISPLAY_ORDER[name]])


def top_banks_yoy(wide: DataFrame, prev: int = 2023, curr: int = 2024, k: int = 10) -> DataFrame:
    """The k institutions with most cases, and their change between two years."""
    change = F.when(F.col("count_prev") == 0, 0.0).otherwise(
        F.round(growth_percent(F.col("count_curr"), F.col("count_prev")), 2)
    )
    return (
        wide.groupBy("bank_name", "bank_type")
        .agg(
            F.count_if(F.col("year") == prev).alias("count_prev"),
            F.count_if(F.col("year") == curr).alias("count_curr"),
            F.count(ROWS).alias("total_volume"),
        )
        .withColumn("yoy_change_pct", change)
        .orderBy(F.desc("total_volume"), "bank_name")
        .limit(k)
    )


def category_trends(wide: DataFrame) -> DataFrame:
    return (
        wide.groupBy("category_name", "year", "quarter")
        .agg(F.count(ROWS).alias("complaint_count"))
        .select("category_name", quarter_label().alias("quarter_label"), "complaint_count")
    )


def resolution_efficiency(wide: DataFrame) -> DataFrame:
    """Rate and speed of resolution per institution, ranked by speed.

    An institution with nothing resolved ranks last. The rank runs over the aggregate, one
    row per institution.
    """
    speed = Window.partitionBy(F.lit(0)).orderBy(F.col("avg_days").asc_nulls_last())
    return (
        wide.groupBy("bank_name", "bank_type")
        .agg(
            F.count(ROWS).alias("total_complaints"),
            count_status("Resolved").alias("resolved_count"),
            F.avg(resolved_days()).alias("avg_days"),
        )
        .select(
            "bank_name",
            "bank_type",
            "total_complaints",
            "resolved_count",
            F.round(percent(F.col("resolved_count"), F.col("total_complaints")), 2).alias("resolution_rate_pct"),
            F.round("avg_days", 1).alias("avg_resolution_days"),
            F.rank().over(speed).alias("efficiency_rank"),
        )
    )


def state_heatmap(wide: DataFrame) -> DataFrame:
    return wide.groupBy("state", "category_name").agg(F.count(ROWS).alias("complaint_count"))


def heatmap_pivot(wide: DataFrame, categories: Sequence[str]) -> DataFrame:
    """State by category counts as columns, 0 where there is none; ``other`` counts all further categories.

    The column list is given, so no extra pass is needed to find it.
    """
    named = F.when(F.col("category_name").isin(list(categories)), F.col("category_name")).otherwise(F.lit("other"))
    return wide.withColumn("_named", named).groupBy("state").pivot("_named", [*categories, "other"]).agg(F.count(F.lit(1))).fillna(0)


def pendency_aging(wide: DataFrame, ref_date: str = "2024-12-31", cuts: Sequence[int] = (30, 60, 90)) -> DataFrame:
    """Pending cases per institution, and how many are older than each cut."""
    age = age_days(ref_date)
    return (
        wide.filter(F.col("status") == "Pending")
        .groupBy("bank_name")
        .agg(
            F.count(ROWS).alias("total_pending"),
            *[F.count_if(age > cut).alias(f"pending_{cut}_days") for cut in cuts],
        )
    )


def rising_categories(
    wide: DataFrame,
    prev: tuple[int, int] = (2024, 3),
    curr: tuple[int, int] = (2024, 4),
    min_growth: float = 0.20,
    k: int | None = None,
) -> DataFrame:
    """Categories whose count grew by more than ``min_growth`` between two quarters."""

    def during(period: tuple[int, int]) -> Column:
        return (F.col("year") == period[0]) & (F.col("quarter") == period[1])

    before, now = F.col("previous_quarter_count"), F.col("latest_quarter_count")
    growth = F.try_divide((now - before).cast("double"), before.cast("double"))
    rising = (
        wide.filter(during(prev) | during(curr))
        .groupBy("category_name")
        .agg(
            F.count_if(during(prev)).alias("previous_quarter_count"),
            F.count_if(during(curr)).alias("latest_quarter_count"),
        )
        .filter((before > 0) & (growth > min_growth))
        .withColumn("qoq_growth_pct", F.round(growth * 100, 2))
    )
    return rising if k is None else rising.orderBy(F.desc("qoq_growth_pct"), "category_name").limit(k)


def kpi_cards(wide: DataFrame, years: Sequence[int], bank_types: Sequence[str] | None = None) -> DataFrame:
    """Total, change between the two latest selected years, resolution rate, mean days."""
    chosen = wide.filter(F.col("year").isin(list(years)))
    if bank_types is not None:
        chosen = chosen.filter(F.col("bank_type").isin(list(bank_types)))
    latest = sorted(years)[-2:]
    if len(latest) == 2:
        before, now = (F.count_if(F.col("year") == y) for y in latest)
        yoy = F.bround(F.coalesce(growth_percent(now, before), F.lit(0.0)), 1)
    else:
        yoy = F.lit(None).cast("double")
    return chosen.agg(
        F.count(ROWS).alias("total_complaints"),
        yoy.alias("yoy_growth_pct"),
        F.bround(F.coalesce(percent(count_status("Resolved"), F.count(ROWS)), F.lit(0.0)), 1).alias("resolution_rate_pct"),
        F.bround(F.avg(resolved_days()), 1).alias("avg_resolution_days"),
    )


def monthly_trend(wide: DataFrame) -> DataFrame:
    return wide.groupBy(F.trunc("date", "MM").alias("month_start")).agg(F.count(ROWS).alias("complaint_count"))


def value_counts(wide: DataFrame, column: str, k: int | None = None) -> DataFrame:
    """Counts per value, or the k most frequent ones (value as tie-break)."""
    counts = wide.groupBy(F.col(column).alias("value")).agg(F.count(ROWS).alias("complaint_count"))
    return counts if k is None else counts.orderBy(F.desc("complaint_count"), "value").limit(k)


def value_counts_of_all(wide: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Value counts of several columns as ``column_name, value, complaint_count``, one scan.

    GROUPING SETS over the columns expand before the map-side combine.
    """
    picked = wide.select(*columns)
    counted = picked.groupingSets([[F.col(c)] for c in columns], *[F.col(c) for c in columns]).agg(
        F.grouping_id().alias("gid"), F.count(ROWS).alias("complaint_count")
    )
    # Set number i leaves every bit of the grouping id on except its own.
    full = (1 << len(columns)) - 1
    is_set = [F.col("gid") == (full ^ (1 << (len(columns) - 1 - i))) for i in range(len(columns))]
    name, value = F.when(is_set[0], columns[0]), F.when(is_set[0], F.col(columns[0]).cast("string"))
    for flag, column in zip(is_set[1:], columns[1:]):
        name, value = name.when(flag, column), value.when(flag, F.col(column).cast("string"))
    return counted.select(name.alias("column_name"), value.alias("value"), "complaint_count")


def value_share(wide: DataFrame, column: str = "status") -> DataFrame:
    """Share of each value in percent; the total is taken over the counted values."""
    counts = wide.groupBy(column).agg(F.count(ROWS).alias("complaint_count"))
    total = counts.agg(F.sum("complaint_count")).scalar()
    return counts.select(column, percent(F.col("complaint_count"), total).alias("share_pct"))


def drill_down(
    wide: DataFrame, bank: str | None = None, category: str | None = None, search: str | None = None
) -> DataFrame:
    """Optional equality filters and a case-insensitive regular expression on the text."""
    if bank is not None:
        wide = wide.filter(F.col("bank_name") == bank)
    if category is not None:
        wide = wide.filter(F.col("category_name") == category)
    if search:
        wide = text_search(wide, search, "complaint_text")
    return wide


def text_search(df: DataFrame, pattern: str, column: str = "text", literal: bool = False) -> DataFrame:
    """Rows whose text matches a case-insensitive regular expression (or literal)."""
    if literal:
        return df.filter(F.lower(column).contains(pattern.lower()))
    return df.filter(F.col(column).rlike(f"(?i){pattern}"))


def quarter_category_volumes(wide: DataFrame) -> DataFrame:
    return wide.groupBy(quarter_label().alias("quarter_label"), "category_name").agg(F.count(ROWS).alias("complaint_count"))


def top_subcategories(wide: DataFrame, k: int = 8) -> DataFrame:
    return value_counts(wide, "subcategory_name", k).withColumnRenamed("value", "subcategory_name")


def state_volume(wide: DataFrame) -> DataFrame:
    return value_counts(wide, "state").withColumnRenamed("value", "state")


def top_state_trend(wide: DataFrame, k: int = 5) -> DataFrame:
    """Monthly counts of the k states with most cases.

    Each state's months are kept beside its total as one array (an entry per calendar
    month), so the cases are read once.
    """
    monthly = wide.groupBy("state", "year", "month").agg(F.count(ROWS).alias("complaint_count"))
    months = F.collect_list(F.struct(F.make_date("year", "month", F.lit(1)).alias("month_start"), "complaint_count"))
    top = (
        monthly.groupBy("state")
        .agg(F.sum("complaint_count").alias("total"), months.alias("months"))
        .orderBy(F.desc("total"), "state")
        .limit(k)
    )
    return top.select("state", F.inline("months"))


def top_banks_typed(wide: DataFrame, k: int = 10) -> DataFrame:
    """The k institutions with most cases, with their type (first by name if it varies)."""
    return (
        wide.groupBy("bank_name")
        .agg(F.count(ROWS).alias("complaint_count"), F.min("bank_type").alias("bank_type"))
        .orderBy(F.desc("complaint_count"), "bank_name")
        .limit(k)
    )


def category_monthly(wide: DataFrame, category: str = "Digital Banking Fraud") -> DataFrame:
    """Monthly counts of one category."""
    return (
        wide.filter(F.col("category_name") == category)
        .groupBy("year", "month")
        .agg(F.count(ROWS).alias("complaint_count"))
        .select("year", "month", F.make_date("year", "month", F.lit(1)).alias("month_start"), "complaint_count")
    )


def category_top_states(wide: DataFrame, category: str = "Digital Banking Fraud", k: int = 3) -> DataFrame:
    return (
        wide.filter(F.col("category_name") == category)
        .groupBy("state")
        .agg(F.count(ROWS).alias("complaint_count"))
        .orderBy(F.desc("complaint_count"), "state")
        .limit(k)
    )


def distinct_values(wide: DataFrame, column: str) -> DataFrame:
    """Value list for a filter control."""
    return wide.select(column).distinct()
