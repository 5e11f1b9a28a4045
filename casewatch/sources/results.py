"""Result documents (JSON) back to rows, for reports and dashboards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATISTICS = """
    descriptive_statistics MAP<STRING, STRUCT<mean DOUBLE, median DOUBLE, std DOUBLE, skew DOUBLE, count BIGINT>>,
    welch_t_test STRUCT<t_statistic DOUBLE, p_value DOUBLE, reject_null BOOLEAN, interpretation STRING>,
    ols_regression STRUCT<r_squared DOUBLE, adj_r_squared DOUBLE, f_statistic DOUBLE, f_pvalue DOUBLE,
        coefficients MAP<STRING, STRUCT<coefficient DOUBLE, t_statistic DOUBLE, p_value DOUBLE, significant BOOLEAN>>>,
    mann_kendall_trend_test MAP<STRING, STRUCT<trend STRING, tau DOUBLE, s_statistic BIGINT, z_score DOUBLE,
        p_value DOUBLE, reject_null BOOLEAN, interpretation STRING, monthly_counts ARRAY<BIGINT>>>
"""

RISK = """MAP<STRING, STRUCT<bank_type STRING, total_complaints BIGINT, pending_count BIGINT,
    avg_resolution_days DOUBLE, pending_gt_60 BIGINT, risk_score DOUBLE, risk_level STRING>>"""

FORECAST = """status STRING, historical_dates ARRAY<STRING>, historical_values ARRAY<DOUBLE>,
    forecast_dates ARRAY<STRING>, forecast_values ARRAY<DOUBLE>,
    lower_confidence_interval ARRAY<DOUBLE>, upper_confidence_interval ARRAY<DOUBLE>"""


def risk_document(risk: DataFrame) -> DataFrame:
    """One JSON object keyed by institution per type: a document per type stays small and
    no single row has to hold every institution."""
    fields = ["bank_type", "total_complaints", "pending_count", "avg_resolution_days", "pending_gt_60", "risk_score", "risk_level"]
    entries = F.sort_array(F.collect_list(F.struct(F.col("bank_name").alias("key"), F.struct(*fields).alias("value"))))
    return risk.groupBy("bank_type").agg(F.to_json(F.map_from_entries(entries)).alias("document"))


def risk_rows(documents: DataFrame) -> DataFrame:
    parsed = documents.select(F.from_json("document", RISK).alias("d"))
    return parsed.select(F.explode("d").alias("bank_name", "r")).select("bank_name", "r.*")


def statistics_rows(documents: DataFrame) -> DataFrame:
    """``section, item, metric, value`` rows of the numeric results; a document is parsed once."""

    def metrics(section: str, item: Column, source: Column, names: list[str]) -> Column:
        return F.array(
            *[
                F.struct(F.lit(section).alias("section"), item.alias("item"), F.lit(n).alias("metric"),
                         source[n].cast("double").alias("value"))
                for n in names
            ]
        )

    def of_map(section: str, entries: Column, names: list[str]) -> Column:
        return F.flatten(F.transform(F.map_entries(entries), lambda e: metrics(section, e["key"], e["value"], names)))

    fit = ["r_squared", "adj_r_squared", "f_statistic", "f_pvalue"]
    rows = F.concat(
        of_map("descriptive_statistics", F.col("descriptive_statistics"), ["mean", "median", "std", "skew", "count"]),
        metrics("welch_t_test", F.lit("test"), F.col("welch_t_test"), ["t_statistic", "p_value"]),
        metrics("ols_regression", F.lit("model"), F.col("ols_regression"), fit),
        of_map("ols_coefficients", F.col("ols_regression.coefficients"), ["coefficient", "t_statistic", "p_value"]),
        of_map("mann_kendall_trend_test", F.col("mann_kendall_trend_test"), ["tau", "s_statistic", "z_score", "p_value"]),
    )
    return documents.select(F.from_json("document", STATISTICS).alias("d")).select("d.*").select(F.inline(rows))


def forecast_rows(documents: DataFrame) -> DataFrame:
    """``series, kind, date, value, lower, upper`` rows of history and forecast."""
    d = documents.select("series", F.from_json("document", FORECAST).alias("d")).select("series", "d.*")
    missing = F.lit(None).cast("double")
    past = d.select("series", F.inline(F.arrays_zip("historical_dates", "historical_values"))).toDF("series", "date", "value")
    ahead = d.select(
        "series",
        F.inline(F.arrays_zip("forecast_dates", "forecast_values", "lower_confidence_interval", "upper_confidence_interval")),
    ).toDF("series", "date", "value", "lower", "upper")
    return past.select("series", F.lit("history").alias("kind"), "date", "value", missing.alias("lower"), missing.alias("upper")).unionByName(
        ahead.select("series", F.lit("forecast").alias("kind"), "date", "value", "lower", "upper")
    )
