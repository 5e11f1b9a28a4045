"""Hand-made frames."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession

CASE = dict(
    complaint_id="C1", date="2024-03-15", bank_name="A", bank_type="Public Sector", complaint_category="X", complaint_subcategory="X1",
    complaint_text="text", state="S", channel="Online", status="Resolved", resolution_days=10.0, customer_segment="Retail",
    year=2024, month=3, quarter=1,
)
SCHEMA = (
    "complaint_id string, date string, bank_name string, bank_type string, complaint_category string, complaint_subcategory string, "
    "complaint_text string, state string, channel string, status string, resolution_days double, customer_segment string, "
    "year int, month int, quarter int"
)


def raw(spark: SparkSession, *changes: dict) -> DataFrame:
    rows = [tuple({**CASE, "complaint_id": f"C{i}", **change}.values()) for i, change in enumerate(changes)]
    return spark.createDataFrame(rows, SCHEMA)


FACT = dict(bank_id=1, year=2024, month=1, quarter=1, status="Resolved", resolution_days=10.0)


def fact(spark: SparkSession, *groups: tuple[int, dict]) -> DataFrame:
    """(count, changes) groups of equal rows."""
    rows = [tuple({**FACT, **change}.values()) for n, change in groups for _ in range(n)]
    return spark.createDataFrame(rows, "bank_id int, year int, month int, quarter int, status string, resolution_days double")


WIDE = dict(
    complaint_id=1, date=date(2024, 3, 15), state="S", channel="Online", status="Resolved", resolution_days=10.0,
    year=2024, month=3, quarter=1, bank_name="A", bank_type="Public Sector", category_name="X", subcategory_name="X1",
)


def wide(spark: SparkSession, *groups: tuple[int, dict]) -> DataFrame:
    rows = [tuple({**WIDE, **change}.values()) for n, change in groups for _ in range(n)]
    return spark.createDataFrame(
        rows,
        "complaint_id long, date date, state string, channel string, status string, resolution_days double, year int, month int, "
        "quarter int, bank_name string, bank_type string, category_name string, subcategory_name string",
    )


def series(spark: SparkSession, **values: list) -> DataFrame:
    """Monthly series from 2020-01; None is a missing month."""
    import calendar

    rows = []
    for name, xs in values.items():
        for i, x in enumerate(xs):
            y, m = 2020 + i // 12, i % 12 + 1
            if x is not None:
                rows.append((name, date(y, m, calendar.monthrange(y, m)[1]), float(x)))
    return spark.createDataFrame(rows, "series string, month_end date, value double")
