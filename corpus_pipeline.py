"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; its result is written
and read again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewatch.llm import decontam, langid, line_dedup, ngram_join, packing
from casewatch.llm.common import WORD, table
from casewatch.session import discard, new_table_path, recorded, remove, scratch
from casewatch.sources.files import read_table, write_table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the language models reject; their languages stay as they are given."""
    model, rule = langid.train(langid.labelled(docs))
    return langid.identify(docs, model, rule).filter("accepted").select(*COLUMNS)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines are cut; a document that loses all its lines goes."""
    cut = line_dedup.dedup_lines(docs.select(*COLUMNS)).filter("n_deleted < n_lines")
    n_chars = F.when(F.col("n_deleted") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", n_chars).select(*COLUMNS)


def _keyed(docs: DataFrame) -> DataFrame:
    """Id and text hash as plain join keys, so that rows without id join as well."""
    return docs.withColumns({"_id": F.coalesce("doc_id", F.lit(-(2**63))), "_text": F.xxhash64(F.coalesce("text", F.lit("")))})


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays, that of the smallest id; texts without words all stay."""
    found = ngram_join.near_duplicates(docs).filter("component is not null")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("d"), F.col("text_key").alias("t")))
    chosen = found.groupBy("component").agg(first.alias("r")).select(F.coalesce("r.d", F.lit(-(2**63))).alias("_id"), F.col("r.t").alias("_text"))
    docs = docs.select(*COLUMNS)
    words = F.coalesce(F.rlike("text", F.lit(WORD)), F.lit(False))
    kept = _keyed(docs.filter(words)).join(chosen, ["_id", "_text"], "left_semi").dropDuplicates(["_id", "_text"])
    return docs.filter(~words).unionByName(kept.select(*COLUMNS))


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without contaminated documents."""
    judged = decontam.contamination(docs, table(spark, sf_dir, "benchmark"))
    bad = judged.filter("contaminated").select(F.coalesce("doc_id", F.lit(-(2**63))).alias("_id"), F.col("text_key").alias("_text")).distinct()
    return _keyed(docs.select(*COLUMNS)).join(bad, ["_id", "_text"], "left_anti").select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


_LEFT: dict[str, list[str]] = {}


def _tidy(stage):
    """The stage, which begins by deleting the tables that the stage before made on its way.

    The result of that one is written and read again by then. If the given documents still read such a table, it stays.
    """

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        session = spark.sparkContext.applicationId
        left = _LEFT.get(session, [])
        files = docs.inputFiles() if left else []
        if not any(path in file for path in left for file in files):
            discard(spark, left)
        with recorded() as made:
            result = stage(spark, docs, sf_dir)
        _LEFT[session] = made
        return result

    return run_stage


STAGES = [
    ("language_id", _tidy(language_id)),
    ("line_dedup", _tidy(without_repeated_lines)),
    ("ngram_join", _tidy(one_of_near_duplicates)),
    ("decontamination", _tidy(without_benchmarks)),
    ("packing", _tidy(packed)),
]

#: Language models and tokens are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in their order. What a stage made on its way, and what it read from the stage before, goes when its result is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = new_table_path(spark, f"stage-{name}")
        with scratch(spark):
            made = stage(spark, docs, sf_dir)
            write_table(made, path)
            docs = read_table(spark, path, made.schema)
            del made
        if before:
            remove(spark, before)
        before = path
    return docs
