"""Weighted risk score per institution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewatch.functions.columns import age_days, count_status, percent, resolved_days


def _capped(value: Column, cap: float) -> Column:
    return F.least(value / cap * 100, F.lit(100.0))


def risk_level(score: Column, red: float, amber: float) -> Column:
    return F.when(score >= red, "Red").when(score >= amber, "Amber").otherwise("Green")


def risk_scores(
    wide: DataFrame,
    ref_date: str = "2024-12-31",
    days_cap: float = 120,
    pend_cap: float = 25,
    aging_cap: float = 50,
    aging_days: int = 60,
    weights: tuple[float, float, float] = (0.40, 0.30, 0.30),
    red: float = 60,
    amber: float = 35,
) -> DataFrame:
    """Speed, backlog and ageing, each capped at 100, weighted and classified.

    Both the base counts and the ageing count come from one conditional aggregate.
    ``no_resolved`` marks institutions whose mean is 0 only because nothing is resolved.
    """
    old = (F.col("status") == "Pending") & (age_days(ref_date) > aging_days)
    base = (
        wide.groupBy("bank_name", "bank_type")
        .agg(
            F.count("*").alias("total_complaints"),
            count_status("Pending").alias("pending_count"),
            F.count_if(old).alias("pending_gt_60"),
            F.avg(resolved_days()).alias("mean_days"),
        )
        .withColumns(
            {"no_resolved": F.col("mean_days").isNull(), "mean_days": F.coalesce("mean_days", F.lit(0.0))}
        )
    )
    pendency = percent(F.col("pending_count"), F.col("total_complaints"))
    ageing = F.coalesce(percent(F.col("pending_gt_60"), F.col("pending_count")), F.lit(0.0))
    parts = (_capped(F.col("mean_days"), days_cap), _capped(pendency, pend_cap), _capped(ageing, aging_cap))
    score = F.bround(parts[0] * weights[0] + parts[1] * weights[1] + parts[2] * weights[2], 2)
    return base.withColumn("risk_score", score).select(
        "bank_name",
        "bank_type",
        "total_complaints",
        "pending_count",
        F.bround("mean_days", 1).alias("avg_resolution_days"),
        "pending_gt_60",
        "risk_score",
        risk_level(F.col("risk_score"), red, amber).alias("risk_level"),
        "no_resolved",
    )
