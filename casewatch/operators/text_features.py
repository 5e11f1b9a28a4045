"""TF-IDF features with a deterministic vocabulary."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    Normalizer,
    RegexTokenizer,
    StopWordsRemover,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: a token is a run of two or more letters, digits or underscores.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"


def stop_words() -> list[str]:
    return StopWordsRemover.loadDefaultStopWords("english")


def token_array(text: str) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({TOKEN_PATTERN})"), F.lit(1))


def term_statistics(docs: DataFrame, text: str = "text", stop: Sequence[str] | None = None) -> DataFrame:
    """``term, term_count, doc_count`` over all documents, in one pass.

    Occurrences and per-document first occurrences are exploded side by side and combine on
    the map side, so a term that is in every document is no hot key. A text that repeats no token gives one entry a token for both.
    """
    def entries(array: Column, term: int, doc: int) -> Column:
        return F.transform(
            array,
            lambda w: F.struct(w.alias("term"), F.lit(term).alias("term_n"), F.lit(doc).alias("doc_n")),
        )

    tokens = docs.select(token_array(text).alias("t")).select("t", F.array_distinct("t").alias("d"))
    apart = F.concat(entries(F.col("t"), 1, 0), entries(F.col("d"), 0, 1))
    both = F.when(F.size("t") == F.size("d"), entries(F.col("d"), 1, 1)).otherwise(apart)
    return (
        tokens.select(F.inline(both))
        .filter(~F.col("term").isin(list(stop_words() if stop is None else stop)))
        .groupBy("term")
        .agg(F.sum("term_n").alias("term_count"), F.sum("doc_n").alias("doc_count"))
    )


def fit_tfidf(
    docs: DataFrame, text: str = "text", size: int = 500, output: str = "tfidf", stop: Sequence[str] | None = None
) -> PipelineModel:
    """Fit counts x (ln((1 + n) / (1 + df)) + 1), scaled to unit length, over the ``size``
    most frequent terms (alphabetical on ties).

    Only those ``size`` rows come to the driver, as any fitted vocabulary does.
    """
    stop = list(stop_words() if stop is None else stop)
    top = term_statistics(docs, text, stop).orderBy(F.desc("term_count"), "term").limit(size)
    rows = sorted(top.withColumn("n", docs.agg(F.count("*")).scalar()).collect(), key=lambda r: r["term"])
    if not rows:
        raise ValueError("no terms to build a vocabulary from")
    vocabulary = [r["term"] for r in rows]
    weights = [math.log((1 + r["n"]) / (1 + r["doc_count"])) + 1.0 for r in rows]
    tokenizer = RegexTokenizer(inputCol=text, outputCol=f"{output}_tokens", pattern=TOKEN_PATTERN, gaps=False)
    remover = StopWordsRemover(inputCol=f"{output}_tokens", outputCol=f"{output}_terms", stopWords=stop)
    counter = CountVectorizerModel.from_vocabulary(vocabulary, inputCol=f"{output}_terms", outputCol=f"{output}_counts")
    weighting = ElementwiseProduct(scalingVec=Vectors.dense(weights), inputCol=f"{output}_counts", outputCol=f"{output}_raw")
    normalizer = Normalizer(p=2.0, inputCol=f"{output}_raw", outputCol=output)
    return PipelineModel([tokenizer, remover, counter, weighting, normalizer])


def vocabulary_of(model: PipelineModel) -> list[str]:
    return next(stage.vocabulary for stage in model.stages if isinstance(stage, CountVectorizerModel))


def embed(model: PipelineModel, df: DataFrame, output: str = "tfidf", column: str = "embedding") -> DataFrame:
    """The input with ``embedding`` ARRAY<DOUBLE>; a text without known terms is all zeros."""
    made = [c for stage in model.stages for c in [stage.getOutputCol()]]
    return model.transform(df).withColumn(column, vector_to_array(output)).drop(*made)


def tfidf_weights(model: PipelineModel, df: DataFrame, key: str, output: str = "tfidf") -> DataFrame:
    """``key, term, weight`` for the non-zero entries."""
    names = F.array(*[F.lit(t) for t in vocabulary_of(model)])
    return (
        embed(model, df, output, "_v")
        .select(key, F.inline(F.filter(F.arrays_zip(names.alias("term"), F.col("_v").alias("weight")), lambda e: e["weight"] > 0)))
        .toDF(key, "term", "weight")
    )
