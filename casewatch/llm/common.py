"""Shared helpers: tables, folds, written intermediate results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casewatch.session import BATCH_BYTES, BATCH_SETTING, new_table_path, small_batches  # noqa: F401
from casewatch.sources.files import gathered, read_table, stored, write_table

__all__ = ["drop_table", "fold", "materialised", "most_frequent", "read_table", "small_batches", "spread_sample", "stored", "table", "text_of", "trimmed", "write_table"]

#: Java form of "runs of characters other than ASCII white space".
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo ``n``; a null key has fold null."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(n)).cast("int")


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def materialised(df: DataFrame, name: str, rows: int | None = None) -> tuple[DataFrame, str]:
    """The frame written below the shared folder and read back, and where it lies; ``rows`` as for ``stored``."""
    path = new_table_path(df.sparkSession, name)
    write_table(gathered(df, rows), path)
    return read_table(df.sparkSession, path, df.schema), path


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table of one's own that nothing reads any more."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """Rows with the highest ``n``, down to a level at which there are not more than ``most``.

    Levels are sixteenths of powers of two, so the driver sees a small histogram and no task sorts all rows.
    """
    level = F.floor(F.log2("n") * 16)
    at, total = None, 0
    for r in counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("level")).collect():
        total += r["k"]
        if total > most:
            break
        at = r["level"]
    return counts.filter(F.lit(False) if at is None else level >= at)


def spread_sample(rows: DataFrame, key: Column, n: int, most: int) -> DataFrame:
    """About ``most`` of ``n`` rows, chosen by a hash of ``key``; all rows if there are not more."""
    return rows if n <= most else rows.filter(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < F.lit(int(most / n * (1 << 30))))


def trimmed(work):
    """The batch function, giving its memory back to the system when a task ends.

    Python workers serve many tasks of different stages; what one has freed would else stay with the worker.
    """

    def run(batches):
        import contextlib
        import ctypes
        import gc

        import pyarrow as pa

        yield from work(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # only some C libraries have it
            ctypes.CDLL(None).malloc_trim(0)

    return run
