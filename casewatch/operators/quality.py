"""Cleaning, repair, data-quality metrics and constraint checks on case files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casewatch.functions.columns import percent
from casewatch.functions.quantiles import exact_quantiles, weighted_quantiles
from casewatch.schemas import REQUIRED_COLUMNS
from casewatch.sources.files import read_table, stored, write_table

START, END = "2020-01-01", "2024-12-31"


def null_profile(raw: DataFrame, columns: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """``column_name, null_count`` for the required columns, from one aggregate."""
    counts = raw.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "null_count")


def fill_required(raw: DataFrame, fill: str = "Unknown", columns: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Replace nulls by declared type: text gets ``fill``, numbers get 0, dates stay null
    (a row without a date is dropped by the date window either way)."""
    kinds = {f.name: f.dataType for f in raw.schema.fields if f.name in columns}
    texts = [c for c, k in kinds.items() if isinstance(k, T.StringType)]
    numbers = [c for c, k in kinds.items() if isinstance(k, T.NumericType)]
    return raw.fillna(fill, subset=texts).fillna(0, subset=numbers) if numbers else raw.fillna(fill, subset=texts)


def parsed_date(raw: DataFrame, column: str = "date") -> Column:
    """The date, or null where the text is no date."""
    if isinstance(raw.schema[column].dataType, T.StringType):
        return F.try_to_date(column)
    return F.col(column).cast("date")


def in_window(date: Column, start: str, end: str) -> Column:
    """Inclusive on both ends; never null."""
    return F.coalesce(date.between(F.lit(start).cast("date"), F.lit(end).cast("date")), F.lit(False))


def date_window(raw: DataFrame, start: str = START, end: str = END) -> DataFrame:
    """Rows per outcome of the date check: ``kept``, ``unparseable`` or ``out_of_range``."""
    date = parsed_date(raw)
    outcome = F.when(date.isNull(), "unparseable").when(in_window(date, start, end), "kept").otherwise("out_of_range")
    return raw.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("record_count"))


def keep_window(raw: DataFrame, start: str = START, end: str = END) -> DataFrame:
    """Rows with a date inside the window; ``date`` becomes a DATE."""
    return raw.withColumn("date", parsed_date(raw)).filter(
        F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    )


MUST_BE_NULL = "(status = 'Pending' AND resolution_days IS NOT NULL)"
MUST_BE_POSITIVE = "(status = 'Resolved' AND (resolution_days IS NULL OR resolution_days <= 0))"


def _repaired(median: Column) -> Column:
    return F.when(F.expr("status = 'Pending'"), F.lit(None)).when(F.expr(MUST_BE_POSITIVE), median).otherwise(F.col("resolution_days"))


def _usable_days(df: DataFrame) -> DataFrame:
    return df.filter("status <> 'Pending' AND resolution_days > 0")


def _or_fallback(median: DataFrame, fallback_days: float) -> Column:
    return F.coalesce(median.scalar(), F.lit(float(fallback_days)))


def repair_days(cases: DataFrame, fallback_days: float = 30, group_col: str | None = None) -> DataFrame:
    """Pending cases lose their days; resolved cases without positive days get the median.

    The median is the global one over positive days of non-pending cases. It enters the
    row pass as a scalar subquery, so the row pass itself shuffles nothing. With
    ``group_col`` the median of the row's group is used instead; the medians are stored
    first, so that the join knows how few they are and need not shuffle the cases.
    """
    if group_col is None:
        median = exact_quantiles(_usable_days(cases), [], "resolution_days", {"median": 0.5})
        return cases.withColumn("resolution_days", _repaired(_or_fallback(median, fallback_days)))
    medians = stored(exact_quantiles(_usable_days(cases), [group_col], "resolution_days", {"_median": 0.5}), "medians")
    fixed = _repaired(F.coalesce("_median", F.lit(float(fallback_days))))
    return cases.join(medians, group_col, "left").withColumn("resolution_days", fixed).select(*cases.columns)


def clean_cases(
    raw: DataFrame, start: str = START, end: str = END, fallback_days: float = 30, fill: str = "Unknown"
) -> DataFrame:
    """Fill, keep the date window, repair days: the cleaned case file with the input's columns."""
    kept = keep_window(fill_required(raw, fill), start, end)
    return repair_days(kept, fallback_days).select(*raw.columns)


def _null_cells(columns: Sequence[str]) -> Column:
    return sum((F.col(c).isNull().cast("long") for c in columns), F.lit(0).cast("long"))


def dq_report(
    raw: DataFrame, start: str = START, end: str = END, fallback_days: float = 30, fill: str = "Unknown", z: float = 3
) -> DataFrame:
    """One row of data-quality metrics.

    Every figure follows from how often each outcome of the date check, status and number of days occurs, and from
    the null cells there. These counts are gathered in one scan and stored; median, moments and outliers read only them.
    """
    counts = stored(day_counts(raw, start, end, fill), "day-counts")
    return report_of_counts(counts, fallback_days, z)


def day_counts(raw: DataFrame, start: str = START, end: str = END, fill: str = "Unknown") -> DataFrame:
    """How often each outcome of the date check, status and number of days occurs, with the null cells there."""
    days = raw.select(
        in_window(parsed_date(raw), start, end).alias("kept"), F.coalesce("status", F.lit(fill)).alias("status"), "resolution_days",
        _null_cells(REQUIRED_COLUMNS).alias("null_cells"),
    )
    return days.groupBy("kept", "status", "resolution_days").agg(F.count("*").alias("n"), F.sum("null_cells").alias("null_cells"))


def median_of_counts(counts: DataFrame) -> DataFrame:
    """The median that repairs days, from ``day_counts``."""
    return weighted_quantiles(_usable_days(counts.filter("kept")), [], "resolution_days", {"median": 0.5})


def report_of_counts(counts: DataFrame, fallback_days: float = 30, z: float = 3) -> DataFrame:
    """``dq_report`` from ``day_counts``."""
    median = _or_fallback(median_of_counts(counts), fallback_days)
    repaired = counts.withColumn("median", median).withColumn("v", F.expr(
        f"CASE WHEN kept AND {MUST_BE_POSITIVE} THEN median WHEN kept AND status <> 'Pending' THEN resolution_days END"
    ))
    known = repaired.filter("v IS NOT NULL")
    mean = known.agg(F.try_divide(F.sum(F.col("n") * F.col("v")), F.sum("n"))).scalar()
    std = known.withColumn("mean", mean).selectExpr("sqrt(try_divide(sum(n * pow(v - mean, 2)), sum(n) - 1)) AS std").scalar()
    far = F.abs(F.try_divide(F.col("v") - F.col("mean"), F.col("std"))) > z
    total = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))
    measured = repaired.withColumns({"mean": mean, "std": std}).agg(
        total(F.lit(True)).alias("rows"),
        total(F.col("kept")).alias("kept"),
        total(F.expr(f"kept AND ({MUST_BE_NULL} OR {MUST_BE_POSITIVE})")).alias("fixed"),
        F.coalesce(F.sum("null_cells"), F.lit(0)).alias("null_cells"),
        total(far).alias("outliers"),
    )

    def share(part: Column, whole: Column) -> Column:
        return F.bround(F.coalesce(percent(part, whole), F.lit(0.0)), 4)

    dropped = F.col("rows") - F.col("kept")
    return measured.select(
        F.col("rows").alias("total_records_ingested"),
        F.col("kept").alias("total_records_processed"),
        dropped.alias("invalid_dates_dropped"),
        F.col("fixed").alias("invalid_resolution_days_fixed"),
        F.col("outliers").alias("resolution_days_outliers_flagged"),
        share(F.col("null_cells"), F.col("kept") * len(REQUIRED_COLUMNS)).alias("overall_null_percentage"),
        share(F.col("outliers"), F.col("kept")).alias("outlier_percentage"),
        share(dropped + F.col("fixed"), F.col("rows")).alias("invalid_records_percentage"),
    )


@dataclass
class CleanRun:
    """What a cleaning run leaves behind beside the cleaned file."""

    cases: DataFrame
    report: DataFrame
    nulls: DataFrame


def clean_to(
    raw: DataFrame, path: str, start: str = START, end: str = END, fallback_days: float = 30, fill: str = "Unknown", z: float = 3
) -> CleanRun:
    """Write the cleaned case file to ``path``, with the metrics of ``dq_report`` and ``null_profile`` from the same two scans.

    The first scan reads what decides the repair: it gathers ``day_counts``, while an observation counts the nulls of each column on
    the way. The counts give the median, which the second scan, the one that writes, needs as a plain number, and all metrics of the report.
    """
    spark = raw.sparkSession
    seen = Observation("nulls")
    watched = raw.observe(seen, *[F.count_if(F.col(c).isNull()).alias(c) for c in REQUIRED_COLUMNS])
    counts = stored(day_counts(watched, start, end, fill), "day-counts")
    found = median_of_counts(counts).first()
    median = float(fallback_days) if found is None or found[0] is None else found[0]
    kept = keep_window(fill_required(raw, fill), start, end)
    write_table(kept.withColumn("resolution_days", _repaired(F.lit(median))).select(*raw.columns), path)
    schema = T.StructType([T.StructField(f.name, T.DateType() if f.name == "date" else f.dataType) for f in raw.schema.fields])
    seen_nulls = dict.fromkeys(REQUIRED_COLUMNS, 0) if counts.isEmpty() else seen.get  # a plan without rows observes nothing
    nulls = spark.createDataFrame([(c, seen_nulls[c]) for c in REQUIRED_COLUMNS], "column_name string, null_count long")
    return CleanRun(read_table(spark, path, schema), report_of_counts(counts, fallback_days, z), nulls)


def dq_report_text(report: DataFrame) -> DataFrame:
    """The metrics as ``line_no, line`` rows for a text log."""
    labels = {  # fixed values: report labels
        "total_records_ingested": "Total Records Ingested: {}",
        "total_records_processed": "Total Records Processed: {}",
        "invalid_dates_dropped": "Invalid Dates Dropped: {}",
        "invalid_resolution_days_fixed": "Invalid Resolution Days Repaired: {}",
        "resolution_days_outliers_flagged": "Resolution Days Outliers (Z > 3) Flagged: {}",
        "overall_null_percentage": "Overall Null cells %: {}%",
        "outlier_percentage": "Outlier %: {}%",
        "invalid_records_percentage": "Invalid Records %: {}%",
    }
    lines = F.array(
        *[
            F.concat(F.lit(text.split("{}")[0]), F.col(name).cast("string"), F.lit(text.split("{}")[1]))
            for name, text in labels.items()
        ]
    )
    return report.select(F.posexplode(lines).alias("line_no", "line"))


def with_z_scores(cases: DataFrame) -> DataFrame:
    """Adds ``z_score`` (sample deviation over all non-null days; null where that is 0)."""
    moments = cases.agg(
        F.struct(F.avg("resolution_days").alias("mean"), F.stddev_samp("resolution_days").alias("std"))
    ).scalar()
    return cases.withColumn("_m", moments).withColumn(
        "z_score", F.try_divide(F.col("resolution_days") - F.col("_m.mean"), F.col("_m.std"))
    ).drop("_m")


def zscore_outliers(cases: DataFrame, z: float = 3) -> DataFrame:
    return with_z_scores(cases).filter(F.abs("z_score") > z).select("complaint_id", "resolution_days", "z_score")


def flag_outliers(cases: DataFrame, z: float = 3) -> DataFrame:
    """All cases with ``is_outlier``; outliers are marked, never removed."""
    flagged = F.coalesce(F.abs("z_score") > z, F.lit(False))
    return with_z_scores(cases).withColumn("is_outlier", flagged).drop("z_score")


def calendar_parts(df: DataFrame, date: str = "date") -> DataFrame:
    """Adds year, month, quarter, month start, month end, month name."""
    d = F.col(date)
    return df.withColumns(
        {
            "year": F.year(d),
            "month": F.month(d),
            "quarter": F.quarter(d),
            "month_start": F.trunc(d, "MM"),
            "month_end": F.last_day(d),
            "month_name": F.date_format(d, "MMMM"),
        }
    )


# --- constraint checks: violations as tables, instead of an aborted load ------------------


def dup_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("record_count")).filter("record_count > 1")


def domain_violations(df: DataFrame, domains: Mapping[str, Sequence[str]]) -> DataFrame:
    """``column_name, value, record_count`` for values outside their domain, in one pass.

    As in a CHECK constraint, a null value is no violation.
    """
    outside = F.array_compact(
        F.array(
            *[
                F.when(
                    ~F.col(c).isin(list(allowed)),
                    F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")),
                )
                for c, allowed in domains.items()
            ]
        )
    )
    return (
        df.select(F.explode(outside).alias("v"))
        .groupBy("v.column_name", "v.value")
        .agg(F.count("*").alias("record_count"))
    )


def fk_orphans(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Key values of the fact (null included) that the dimension lacks, with their count.

    The fact is counted per key first, so the anti join sees one row per key value.
    """
    dim_key = dim_key or key
    used = fact.groupBy(F.col(key).alias(key)).agg(F.count("*").alias("record_count"))
    return used.join(dim.select(F.col(dim_key).alias(key)), key, "left_anti")


def unique_dimension(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The dimension, or a failing query if a key repeats: a lazy guard against fan-out."""
    rest = [c for c in dim.columns if c not in keys]
    once = F.when(
        F.count("*") > 1,
        F.raise_error(F.lit(f"dimension key ({', '.join(keys)}) is not unique")).cast("long"),
    ).otherwise(F.count("*"))
    return (
        dim.groupBy(*keys)
        .agg(*[F.first(c).alias(c) for c in rest], once.alias("_once"))
        .filter("_once = 1")
        .select(*dim.columns)
    )
