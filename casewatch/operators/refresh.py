"""Summary and flags that follow the cases month by month.

A folder holds the cases by month, partial aggregates of each institution's months, the monthly summary and the flags. New cases
rewrite the partitions of their months, and of the months and quarters whose growth is measured against them; the cases of other months
are not read. Every step can be repeated: partial aggregates are made anew from the cases of the changed months.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casewatch.functions.columns import count_status
from casewatch.operators.flags import flags_of_quarters
from casewatch.operators.summary import with_growth
from casewatch.session import remove, scratch
from casewatch.sources.files import overwrite_partitions, read_table, stored

MONTH, QUARTER = ["year", "month"], ["year", "quarter"]


def month_parts(cases: DataFrame) -> DataFrame:
    """Sums and counts per institution and month, from which months and quarters follow by adding up."""
    return cases.groupBy("bank_id", "year", "quarter", "month").agg(
        F.count("*").alias("total"), *[count_status(s).alias(s.lower()) for s in ("Resolved", "Pending", "Escalated")],
        F.sum("resolution_days").alias("days"), F.count("resolution_days").alias("n_days"),
    )


def _summed(parts: DataFrame, *keys: str) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ("total", "resolved", "pending", "escalated", "days", "n_days")]
    return parts.groupBy("bank_id", *keys).agg(*sums).withColumn("avg_days", F.try_divide("days", "n_days"))


def summary_of_parts(parts: DataFrame) -> DataFrame:
    """``monthly_summary`` from partial aggregates."""
    named = {"total": "total_complaints", "resolved": "resolved_count", "pending": "pending_count", "escalated": "escalated_count", "avg_days": "avg_resolution_days"}
    return with_growth(_summed(parts, *MONTH).drop("days", "n_days").withColumnsRenamed(named))


def flags_of_parts(parts: DataFrame, **rules) -> DataFrame:
    """``policy_flags`` from partial aggregates."""
    return flags_of_quarters(_summed(parts, *QUARTER).select("bank_id", *QUARTER, "total", "escalated", "avg_days"), **rules)


def _among(keys: list[str], values: list[tuple]) -> Column:
    found = F.lit(False)
    for value in values:
        found = found | ((F.col(keys[0]) == value[0]) & (F.col(keys[1]) == value[1]))
    return found


def _periods(df: DataFrame, keys: list[str]) -> list[tuple]:
    """Distinct (year, month) or (year, quarter) pairs: as many as the calendar has."""
    return sorted(tuple(r) for r in df.select(*keys).distinct().collect())


def _touched(known: DataFrame, keys: list[str], changed: list[tuple]) -> list[tuple]:
    """The changed periods and those that follow one of them in an institution's calendar (bank_id and the keys)."""
    before = Window.partitionBy("bank_id").orderBy(*keys)
    rows = known.select("bank_id", *keys).distinct()
    earlier = rows.withColumns({f"_{k}": F.lag(k).over(before) for k in keys})
    after = earlier.filter(_among([f"_{k}" for k in keys], changed))
    return sorted(set(changed) | set(_periods(after, keys)))


def _write(df: DataFrame, path: str, keys: list[str], periods: list[tuple]) -> None:
    """The given periods' partitions as ``df`` has them; a period without rows loses its folder."""
    rows = stored(df.filter(_among(keys, periods)), "periods")
    overwrite_partitions(rows, path, keys)
    for value in set(periods) - set(_periods(rows, keys)):
        remove(df.sparkSession, f"{path}/{keys[0]}={value[0]}/{keys[1]}={value[1]}")


def refresh(new: DataFrame, path: str, replace: bool = False, **flag_rules) -> dict[str, list[tuple]]:
    """Add ``new`` cases (columns of the fact) below ``path``, or put them in the place of their months' cases.

    Returns the periods rewritten, by table. The first call on an empty folder is the full load.
    """
    with scratch(new.sparkSession):
        return _refreshed(stored(new, "new-cases"), path, replace, flag_rules)


def _refreshed(new: DataFrame, path: str, replace: bool, flag_rules: dict) -> dict[str, list[tuple]]:
    spark = new.sparkSession
    months = _periods(new, MONTH)
    if not months:
        return {"complaints": [], "monthly_summary": [], "policy_flags": []}
    known = _existing(spark, f"{path}/month_parts")
    if replace:
        overwrite_partitions(new, f"{path}/complaints", MONTH)
    else:
        new.write.mode("append").partitionBy(*MONTH).parquet(f"{path}/complaints")
    changed = read_table(spark, f"{path}/complaints").filter(_among(MONTH, months))  # only these months' folders
    _write(month_parts(changed), f"{path}/month_parts", MONTH, months)

    parts = read_table(spark, f"{path}/month_parts")
    calendar = parts if known is None else parts.select("bank_id", "year", "quarter", "month").unionByName(known)
    touched = _touched(calendar, MONTH, months)
    quarters = _touched(calendar, QUARTER, sorted({(y, (m + 2) // 3) for y, m in months}))
    _write(summary_of_parts(parts), f"{path}/monthly_summary", MONTH, touched)
    _write(flags_of_parts(parts, **flag_rules), f"{path}/policy_flags", QUARTER, quarters)
    return {"complaints": months, "monthly_summary": touched, "policy_flags": quarters}


def refreshed(spark: SparkSession, path: str, table: str) -> DataFrame:
    """``monthly_summary`` or ``policy_flags`` below ``path``; its columns follow from the partial aggregates, as a table without rows has no files."""
    made = {"monthly_summary": summary_of_parts, "policy_flags": flags_of_parts}[table]
    return read_table(spark, f"{path}/{table}", made(read_table(spark, f"{path}/month_parts")).schema)


def _existing(spark: SparkSession, path: str) -> DataFrame | None:
    """The institutions' months so far, kept apart from the files that are about to be rewritten."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return None
    return stored(read_table(spark, path).select("bank_id", "year", "quarter", "month"), "known-months")
