"""Reading and writing case files and tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casewatch.schemas import RAW_CASES
from casewatch.session import new_table_path

CORRUPT = "_corrupt_record"
#: Rows up to which an intermediate table is small, and the files that a small one gets.
SMALL, FILES = 1 << 19, 8


def read_cases_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_CASES, multi_line: bool = False) -> DataFrame:
    """Case file with a header; a malformed record keeps its text in ``_corrupt_record``.

    Quotes inside quoted texts are doubled. The records are parsed with all their columns and landed once as
    Parquet, so that what counts as malformed does not depend on the columns a later query reads.

    Texts with line breaks need ``multi_line``: each file is then read by one task, so such data should come in
    many files. Without it a line whose quotes are not closed is malformed, as is one with too few or too many fields.
    A missing path fails when the frame is defined, as a file scan in Spark does.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "quote": '"', "escape": '"'}
    if multi_line:
        parsed = spark.read.schema(with_corrupt).options(header=True, multiLine=True, **options).csv(path)
        return stored(parsed, "landed-csv")
    header = ",".join(schema.fieldNames())
    lines = spark.read.text(path).filter((F.trim("value") != "") & (F.replace("value", F.lit('"'), F.lit("")) != header))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    parsed = lines.select("value", (quotes % 2 == 1).alias("open"), F.from_csv("value", with_corrupt.simpleString()[7:-1].replace(":", " "), options).alias("r"))
    fields = [F.when(~F.col("open"), F.col("r")[f.name]).alias(f.name) for f in schema.fields]
    return stored(parsed.select(*fields, F.when(F.col("open"), F.col("value")).otherwise(F.col("r")[CORRUPT]).alias(CORRUPT)), "landed-csv")


def split_corrupt(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(well-formed rows, text of malformed lines)."""
    good = raw.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, raw.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def write_cases_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """With a header; a text with a comma, quote or line break is quoted, its quotes doubled."""
    df.write.mode(mode).options(header=True, quote='"', escape='"').csv(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Parquet sink: ``overwrite`` for a full refresh, ``append`` for added rows.

    With partition columns, rows are dealt out by them first, and Spark splits what is large and joins what is
    small by size: each partition folder gets a few files, and a hot one is written by as many tasks as its size asks for.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode(mode).partitionBy(*partition_by).parquet(path) if partition_by else df.write.mode(mode).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace the partitions that ``df`` has rows of, and leave the others."""
    dealt = df.hint("rebalance", *partition_by)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def write_sorted(
    df: DataFrame, path: str, by: Sequence[str], spread: Sequence[str] = (), mode: str = "overwrite", partitions: int | None = None,
    group_bytes: int = 8 << 20,
) -> None:
    """Parquet files in the order of ``by`` from file to file and within each: readers skip files, row groups and pages by their extremes.

    Rows are dealt out by ranges of ``by`` and then ``spread``, so that one frequent value may fill several files. Small row groups
    (``group_bytes``) let a narrow filter read little.
    """
    order = [*by, *spread]
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).write.mode(mode).option("parquet.block.size", str(group_bytes)).parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def gathered(df: DataFrame, rows: int | None) -> DataFrame:
    """The frame, dealt out for writing to few files if it has no more than ``rows`` rows and these make a small table.

    The tasks that make the rows stay as many as they are. On a local or mounted file system Hadoop starts processes for
    each file, to set its permissions and those of its folder, and each of them begins as a copy of the executor.
    """
    return df if rows is None or rows > SMALL else df.repartition(FILES)


def stored(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """The frame written below the shared folder and read back; ``rows``: how many it has at most, if known.

    Runs the plan now, cuts the lineage, and gives Spark the true size: a join with the
    result is a broadcast one if it fits ``autoBroadcastJoinThreshold`` and a shuffled one
    with skew handling if not.
    """
    path = new_table_path(df.sparkSession, name)
    write_table(gathered(df, rows), path)
    return read_table(df.sparkSession, path, df.schema)


def write_documents_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Sink for frames with a ``document`` column of JSON text: one document per line."""
    df.select("document").write.mode(mode).text(path)


def read_documents_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", "document")
