"""Star schema: dimensions, fact load, pre-joined wide table.

No join here carries a broadcast hint. Dimension size is what Spark measures against
``spark.sql.autoBroadcastJoinThreshold`` at planning and again at run time; beyond it the
join is a shuffled one, whose hot keys AQE splits.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casewatch.fixed_values import CATEGORY_TREE, INSTITUTIONS
from casewatch.operators.quality import unique_dimension
from casewatch.schemas import COMPLAINTS


def institution_dimension(spark: SparkSession, rows: Sequence[tuple] = INSTITUTIONS) -> DataFrame:
    """Institutions from a literal list, numbered from 1 in list order."""
    return spark.createDataFrame(
        [(i, *row) for i, row in enumerate(rows, start=1)],
        "bank_id int, bank_name string, bank_type string, license_number string, headquarters string",
    )


def category_dimension(spark: SparkSession, tree: Mapping[str, Sequence[str]] = CATEGORY_TREE) -> DataFrame:
    """Category rows from a nested literal, at subcategory grain, with running ids."""
    kind = T.StructType([T.StructField("tree", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()), T.StructField("subs", T.ArrayType(T.StringType()))])))])
    nested = spark.createDataFrame([([(name, list(subs)) for name, subs in tree.items()],)], kind)
    categories = nested.select("tree", F.posexplode("tree").alias("at", "node"))
    earlier = F.aggregate(
        F.slice("tree", F.lit(1), F.col("at")), F.lit(0), lambda total, node: total + F.size(node["subs"])
    )
    return categories.select("at", "node.name", earlier.alias("earlier"), F.posexplode("node.subs").alias("sub_at", "sub")).select(
        (F.col("at") + 1).alias("category_id"),
        F.col("name").alias("category_name"),
        (F.col("earlier") + F.col("sub_at") + 1).alias("subcategory_id"),
        F.col("sub").alias("subcategory_name"),
    )


def category_dimension_from(pairs: DataFrame) -> DataFrame:
    """Category rows from distinct (category_name, subcategory_name) pairs, numbered by name.

    Ids are running numbers within a category plus an offset per category, so the only
    ordering over everything is over one row per category.
    """
    sizes = pairs.groupBy("category_name").agg(F.count("*").alias("size"))
    everything = Window.partitionBy(F.lit(0)).orderBy("category_name")
    numbered = sizes.select(
        "category_name",
        F.row_number().over(everything).alias("category_id"),
        (F.sum("size").over(everything) - F.col("size")).alias("offset"),
    )
    inside = Window.partitionBy("category_name").orderBy("subcategory_name")
    return (
        pairs.withColumn("at", F.row_number().over(inside))
        .join(numbered, "category_name")
        .select(
            "category_id", "category_name", (F.col("offset") + F.col("at")).cast("int").alias("subcategory_id"),
            "subcategory_name",
        )
    )


def load_fact(cases: DataFrame, institutions: DataFrame, categories: DataFrame) -> DataFrame:
    """Cleaned cases with names replaced by ids, 14 columns.

    Unknown names give null ids (see ``fk_orphans``) instead of an aborted load.
    """
    banks = unique_dimension(institutions.select("bank_name", "bank_id"), ["bank_name"])
    subs = unique_dimension(
        categories.select(F.col("subcategory_name").alias("complaint_subcategory"), "category_id", "subcategory_id"),
        ["complaint_subcategory"],
    )
    joined = cases.join(banks, "bank_name", "left").join(subs, "complaint_subcategory", "left")
    return joined.select(*[c for c in COMPLAINTS.fieldNames()]).withColumn(
        "resolution_days", F.nanvl("resolution_days", F.lit(None).cast("double"))
    )


def wide_cases(fact: DataFrame, institutions: DataFrame, categories: DataFrame) -> DataFrame:
    """The fact with names from both dimensions, at fact grain (join on subcategory).

    A case whose ids are null or unknown to a dimension keeps its row, with the names "Unknown".
    """
    banks = unique_dimension(institutions.select("bank_id", "bank_name", "bank_type"), ["bank_id"])
    subs = unique_dimension(categories.select("subcategory_id", "category_name", "subcategory_name"), ["subcategory_id"])
    named = fact.join(banks, "bank_id", "left").join(subs, "subcategory_id", "left")
    return named.fillna("Unknown", ["bank_name", "bank_type", "category_name", "subcategory_name"]).select(
        "complaint_id", "date", "complaint_text", "state", "channel", "status", "resolution_days",
        "customer_segment", "year", "month", "quarter", "bank_name", "bank_type", "category_name", "subcategory_name",
    )


def as_wide(cases: DataFrame) -> DataFrame:
    """A cleaned case file, which already carries names, under the wide table's column names."""
    return cases.withColumnsRenamed(
        {"complaint_category": "category_name", "complaint_subcategory": "subcategory_name"}
    )
