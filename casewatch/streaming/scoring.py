"""Scoring texts as they arrive: the batch model on a file stream."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from casewatch.operators.text_classes import score


def read_text_stream(spark: SparkSession, folder: str, schema: T.StructType, glob: str = "*.parquet", files_per_batch: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def read_table_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1000) -> DataFrame:
    """A table as a stream, be it a single file or a folder of part files.

    A file is named by a pattern that only it fits: Spark then lists nothing else, while a folder given
    in its place is listed with all that lies beside the file, such as the partitions of other tables.
    """
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).isDirectory():
        path = f"{path[:-1]}[{path[-1]}]"
    return read_text_stream(spark, path, schema, "*", files_per_batch)


def score_stream(model: PipelineModel, texts: DataFrame) -> DataFrame:
    """Row by row, without state, so no watermark is needed."""
    return score(model, texts)


def write_scores(scored: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Parquet sink with exactly-once files; handles what is there and then stops."""
    return (
        scored.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
