"""Explicit schemas: nothing in the library infers a type from data."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, null) for name, kind, null in fields])


_S, _I, _L, _D, _DATE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.DateType()

# Raw case file. ``date`` stays text here so that unparseable dates can be counted.
RAW_CASES = _struct(
    ("complaint_id", _S, True),
    ("date", _S, True),
    ("bank_name", _S, True),
    ("bank_type", _S, True),
    ("complaint_category", _S, True),
    ("complaint_subcategory", _S, True),
    ("complaint_text", _S, True),
    ("state", _S, True),
    ("channel", _S, True),
    ("status", _S, True),
    ("resolution_days", _D, True),
    ("customer_segment", _S, True),
    ("year", _I, True),
    ("month", _I, True),
    ("quarter", _I, True),
)

# Columns in which a null is counted and replaced by a default.
REQUIRED_COLUMNS = [
    "complaint_id", "date", "bank_name", "bank_type", "complaint_category", "complaint_subcategory",
    "complaint_text", "state", "channel", "status", "customer_segment",
]

BANKS = _struct(
    ("bank_id", _I, False),
    ("bank_name", _S, False),
    ("bank_type", _S, False),
    ("license_number", _S, False),
    ("headquarters", _S, False),
)

CATEGORIES = _struct(
    ("category_id", _I, False),
    ("category_name", _S, False),
    ("subcategory_id", _I, False),
    ("subcategory_name", _S, False),
)

COMPLAINTS = _struct(
    ("complaint_id", _S, False),
    ("date", _DATE, False),
    ("bank_id", _I, True),
    ("category_id", _I, True),
    ("subcategory_id", _I, True),
    ("complaint_text", _S, False),
    ("state", _S, False),
    ("channel", _S, False),
    ("status", _S, False),
    ("resolution_days", _D, True),
    ("customer_segment", _S, False),
    ("year", _I, False),
    ("month", _I, False),
    ("quarter", _I, False),
)

MONTHLY_SUMMARY = _struct(
    ("bank_id", _I, False),
    ("year", _I, False),
    ("month", _I, False),
    ("total_complaints", _L, False),
    ("resolved_count", _L, False),
    ("pending_count", _L, False),
    ("escalated_count", _L, False),
    ("avg_resolution_days", _D, True),
    ("complaint_growth_pct", _D, False),
)

POLICY_FLAGS = _struct(
    ("bank_id", _I, False),
    ("year", _I, False),
    ("quarter", _I, False),
    ("flag_type", _S, False),
    ("flag_description", _S, False),
    ("severity", _S, False),
)

KEYS = {
    "banks": [["bank_id"], ["bank_name"], ["license_number"]],
    "categories": [["subcategory_id"], ["subcategory_name"]],
    "complaints": [["complaint_id"]],
    "monthly_summary": [["bank_id", "year", "month"]],
    "policy_flags": [["bank_id", "year", "quarter", "flag_type"]],
}
