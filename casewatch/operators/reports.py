"""Tables of the management and executive reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewatch.fixed_values import SUMMARY_ROW_LABEL
from casewatch.functions.columns import age_days, count_status, percent, resolved_days

def _total() -> Column:
    return F.count("*").alias("total_complaints")


def _rate(total: str = "total_complaints", digits: int = 1) -> Column:
    return F.round(percent(F.col("resolved_count"), F.col(total)), digits)


def mis_bank(wide: DataFrame, high: float = 40, medium: float = 29) -> DataFrame:
    """Institution performance; the risk cut is on the rounded mean, no mean counts as low."""
    days = F.col("avg_resolution_days")
    return (
        wide.groupBy("bank_name", "bank_type")
        .agg(_total(), count_status("Resolved").alias("resolved_count"), F.round(F.avg(resolved_days()), 1).alias("avg_resolution_days"))
        .select(
            "bank_name", "bank_type", "total_complaints", "resolved_count", _rate().alias("resolution_rate_pct"),
            "avg_resolution_days",
            F.when(days > high, "High").when(days > medium, "Medium").otherwise("Low").alias("risk_level"),
        )
    )


def category_breakdown(wide: DataFrame) -> DataFrame:
    return (
        wide.groupBy("category_name", "subcategory_name")
        .agg(F.count("*").alias("complaint_count"), count_status("Resolved").alias("resolved_count"))
        .withColumn("resolution_rate_pct", _rate("complaint_count"))
        .drop("resolved_count")
    )


def mis_geo(wide: DataFrame) -> DataFrame:
    return (
        wide.groupBy("state")
        .agg(F.count("*").alias("complaint_count"), count_status("Resolved").alias("resolved_count"))
        .withColumn("resolution_rate_pct", _rate("complaint_count"))
    )


def with_summary_row(table: DataFrame, label_column: str) -> DataFrame:
    """The table and a last row: sums of counts, unweighted means of rates and days."""

    def last(name: str) -> Column:
        if name == label_column:
            return F.lit(SUMMARY_ROW_LABEL)
        if name.endswith("_count") or name.endswith("_complaints"):
            return F.sum(name)
        if "rate" in name or "days" in name:
            return F.avg(name)
        return F.lit(None).cast(table.schema[name].dataType)

    return table.unionByName(table.agg(*[last(c).alias(c) for c in table.columns]))


# Presentation names of the management tables; fixed values.
MIS_HEADERS = {
    "bank_name": "Bank Name", "bank_type": "Bank Type", "total_complaints": "Total Complaints",
    "resolved_count": "Resolved Count", "resolution_rate_pct": "Resolution Rate (%)",
    "avg_resolution_days": "Avg Resolution Days", "risk_level": "Risk Level", "category_name": "Category",
    "subcategory_name": "Subcategory", "complaint_count": "Complaint Count", "state": "State / UT",
}


def with_headers(table: DataFrame) -> DataFrame:
    return table.withColumnsRenamed({c: MIS_HEADERS[c] for c in table.columns if c in MIS_HEADERS})


def mis_tables(wide: DataFrame) -> dict[str, DataFrame]:
    """The three management tables, each with its summary row."""
    return {
        "bank_performance": with_summary_row(mis_bank(wide), "bank_name"),
        "category_breakdown": with_summary_row(category_breakdown(wide), "category_name"),
        "geographic_analysis": with_summary_row(mis_geo(wide), "state"),
    }


def _month(wide: DataFrame, year: int, month: int) -> DataFrame:
    return wide.filter((F.col("year") == year) & (F.col("month") == month))


def report_headline(wide: DataFrame, year: int = 2024, month: int = 12) -> DataFrame:
    resolved, total = count_status("Resolved"), F.count("*")
    return _month(wide, year, month).agg(
        total.alias("total_complaints"),
        resolved.alias("resolved_count"),
        F.bround(F.avg(resolved_days()), 1).alias("avg_resolution_days"),
        F.bround(F.coalesce(percent(resolved, total), F.lit(0.0)), 1).alias("resolution_rate_pct"),
    )


def report_top_categories(wide: DataFrame, year: int = 2024, month: int = 12, k: int = 3) -> DataFrame:
    return (
        _month(wide, year, month)
        .groupBy("category_name")
        .agg(F.count("*").alias("complaint_count"))
        .orderBy(F.desc("complaint_count"), "category_name")
        .limit(k)
        .withColumn(
            "label", F.concat("category_name", F.lit(" ("), F.col("complaint_count").cast("string"), F.lit(" complaints)"))
        )
    )


def attention_banks(
    wide: DataFrame, ref_date: str = "2024-12-31", aging_days: int = 60, k: int = 5, period: tuple[int, int] | None = None
) -> DataFrame:
    """Institutions with most pending cases older than ``aging_days``.

    ``period`` (year, month) restricts to cases filed in that month; off by default, since
    cases of the reference month cannot be that old.
    """
    chosen = wide if period is None else _month(wide, *period)
    return (
        chosen.filter(F.col("status") == "Pending")
        .groupBy("bank_name")
        .agg(F.count("*").alias("total_pending"), F.count_if(age_days(ref_date) > aging_days).alias("pending_gt_60"))
        .filter("pending_gt_60 > 0")
        .orderBy(F.desc("pending_gt_60"), "bank_name")
        .limit(k)
    )


def next_month_forecast(forecast: DataFrame) -> DataFrame:
    """The first forecast value of each series, as whole cases."""
    return forecast.groupBy("series").agg(
        F.floor(F.min_by("forecast_value", "forecast_date")).alias("next_month"), F.first("status").alias("status")
    )
