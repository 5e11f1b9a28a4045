"""The star in bucketed tables: the category join needs no exchange of the fact.

Fact and category dimension are bucketed and sorted by category and salt. The salt of a case follows from its id, and the
dimension, at category grain, has a row for each salt; so a category with a third of all cases lies in ``SALTS`` buckets, and each
case still meets exactly one row. A folder holds the tables and what is needed to open them in another session.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casewatch.operators.quality import unique_dimension
from casewatch.sources.files import read_documents_json, write_documents_json

BUCKETS, SALTS = 64, 16
JOIN_KEYS = ["category_id", "_salt"]


@dataclass
class StarTables:
    spark: SparkSession
    fact: str
    categories: str


def category_grain(categories: DataFrame) -> DataFrame:
    """One row per category of the dimension, which is at subcategory grain; a category with two names is an error."""
    return unique_dimension(categories.select("category_id", "category_name").distinct(), ["category_id"])


def _save(df: DataFrame, path: str, buckets: int) -> None:
    """Rows are dealt out as the buckets are, so each bucket is one sorted file."""
    name = f"star_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *JOIN_KEYS)
    dealt.write.format("parquet").mode("overwrite").bucketBy(buckets, *JOIN_KEYS).sortBy(*JOIN_KEYS).option("path", path).saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE {name}")  # an external table: its files stay


def save_star(fact: DataFrame, categories: DataFrame, path: str, buckets: int = BUCKETS, salts: int = SALTS) -> None:
    """Write both tables below ``path``."""
    spark = fact.sparkSession
    salted = fact.withColumn("_salt", F.pmod(F.xxhash64("complaint_id"), F.lit(salts)).cast("int"))
    every = category_grain(categories).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    spec = {"buckets": buckets, "fact": salted.schema.jsonValue(), "categories": every.schema.jsonValue()}
    _save(salted, f"{path}/fact", buckets)
    _save(every, f"{path}/categories", buckets)
    write_documents_json(spark.createDataFrame([(json.dumps(spec),)], "document string"), f"{path}/spec")


def open_star(spark: SparkSession, path: str) -> StarTables:
    """Tables over the files of a saved star, known to this session."""
    spec = json.loads(read_documents_json(spark, f"{path}/spec").first()[0])

    def table(kind: str) -> str:
        name = f"star_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromJson(spec[kind]).fields)
        keys = ", ".join(JOIN_KEYS)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {spec['buckets']} BUCKETS LOCATION '{path}/{kind}'")
        return name

    return StarTables(spark, table("fact"), table("categories"))


def category_cases(star: StarTables) -> DataFrame:
    """The fact with ``category_name``, at fact grain; ids that are null or unknown to the dimension are named "Unknown".

    The operators of ``case_queries`` and ``reports`` that read categories take it as their wide table.
    """
    fact, categories = star.spark.table(star.fact), star.spark.table(star.categories)
    return fact.join(categories, JOIN_KEYS, "left").fillna("Unknown", ["category_name"]).drop("_salt")
