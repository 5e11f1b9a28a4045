"""The sample tables read as a case file: one case per order.

The mapping is deliberately dirty (missing categories, dates after the window, days on
pending cases, resolved cases without days), so that every cleaning rule fires.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = {"start": "1995-01-01", "end": "2001-06-30"}
REF_DATE = "2001-06-30"


_SCHEMAS: dict[tuple[str, str], T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A sample table. Its schema is read from the file once per session, then reused, so
    that defining a query starts no job."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


_BASE = """
    SELECT o_orderkey AS complaint_id, CAST(o_orderdate AS DATE) AS date, n_name AS bank_name, r_name AS bank_type,
           concat('Order ', o_orderkey, ' of ', c_name) AS complaint_text,
           concat('STATE_', o_custkey % 36) AS state, o_orderpriority AS channel,
           CASE WHEN o_orderkey % 100 < 82 THEN 'Resolved' WHEN o_orderkey % 100 < 92 THEN 'Pending' ELSE 'Escalated' END AS status,
           c_mktsegment AS customer_segment,
           year(o_orderdate) AS year, month(o_orderdate) AS month, quarter(o_orderdate) AS quarter
    FROM {orders}
    JOIN {customer} ON o_custkey = c_custkey
    JOIN {nation} ON c_nationkey = n_nationkey
    JOIN {region} ON n_regionkey = r_regionkey
"""

_LINES = "SELECT l_orderkey, min(l_partkey) AS first_part, max(l_shipdate) AS last_ship FROM {lineitem} GROUP BY l_orderkey"

_CATEGORY = "p_type AS complaint_category, concat(p_type, '/', p_brand) AS complaint_subcategory"

_DAYS = """CASE WHEN status <> 'Pending' OR complaint_id % 3 = 0
    THEN CAST(date_diff(last_ship, date) % 220 + IF(complaint_id % 67 = 0, 400, 0) AS DOUBLE) END AS resolution_days"""

COLUMNS = [
    "complaint_id", "date", "bank_name", "bank_type", "complaint_category", "complaint_subcategory", "complaint_text",
    "state", "channel", "status", "resolution_days", "customer_segment", "year", "month", "quarter",
]


def raw_cases(spark: SparkSession, sf_dir: str, category: bool = True, days: bool = True) -> DataFrame:
    """Raw case file. Category and days come from the order lines; without them the column
    is left out and so is its join. (Catalyst would drop the joins by itself if Parquet
    could declare that ``p_partkey`` is unique.)"""
    dropped = ([] if category else ["complaint_category", "complaint_subcategory"]) + ([] if days else ["resolution_days"])
    derived = ([_CATEGORY] if category else []) + ([_DAYS] if days else [])
    query = f"SELECT base.*{''.join(', ' + d for d in derived)} FROM ({_BASE}) base"
    names = ["orders", "customer", "nation", "region"]
    if category or days:
        query += f" LEFT JOIN ({_LINES}) ON complaint_id = l_orderkey"
        names.append("lineitem")
    if category:
        query += " LEFT JOIN {part} ON first_part = p_partkey"
        names.append("part")
    frames = {name: table(spark, sf_dir, name) for name in names}
    return spark.sql(query, **frames).select(*[c for c in COLUMNS if c not in dropped])


def institutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Institution dimension: one row per nation, typed by its region."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("bank_id"),
        F.col("n_name").alias("bank_name"),
        F.col("r_name").alias("bank_type"),
        F.concat(F.lit("LIC-"), F.col("n_nationkey").cast("string")).alias("license_number"),
        F.col("r_name").alias("headquarters"),
    )


def category_pairs(spark: SparkSession, sf_dir: str, unknown: str = "Unknown") -> DataFrame:
    """Distinct (category, subcategory) names, with the filler pair of cleaned cases."""
    parts = table(spark, sf_dir, "part").select(
        F.col("p_type").alias("category_name"), F.concat("p_type", F.lit("/"), "p_brand").alias("subcategory_name")
    )
    return parts.distinct().unionByName(
        parts.limit(1).select(F.lit(unknown).alias("category_name"), F.lit(unknown).alias("subcategory_name"))
    )
