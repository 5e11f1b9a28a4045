"""Narrative texts, vector search over them, and assembled contexts."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casewatch.fixed_values import (
    ANSWER_CLOSING,
    ANSWER_HEADER,
    ANSWER_INTRO,
    FLAG_NARRATIVE_TEXT,
    MISSING_NUMBER,
    QUESTION_DEFAULT,
    QUESTION_ROUTES,
    ROUTE_LINES,
    SUMMARY_TEXT,
)
from casewatch.functions.columns import contains_any, fill_template, first_match, number_text, percent
from casewatch.sources.files import stored

# --- narratives -------------------------------------------------------------------------------


def _metadata(**entries: Column) -> Column:
    pairs = [x for key, value in entries.items() for x in (F.lit(key), value.cast("string"))]
    return F.create_map(*pairs)


def summary_narratives(summary: DataFrame, institutions: DataFrame) -> DataFrame:
    """``doc_id, page_content, metadata`` for each institution-month."""
    rate = F.coalesce(F.bround(percent(F.col("resolved_count"), F.col("total_complaints")), 1), F.lit(0.0))
    rows = summary.join(institutions.select("bank_id", "bank_name", "bank_type"), "bank_id")
    places = {c: F.col(c) for c in ("year", "bank_name", "bank_type", "total_complaints", "resolved_count", "pending_count", "escalated_count")}
    text = fill_template(
        SUMMARY_TEXT,
        {
            **places,
            "month_name": F.date_format(F.make_date("year", "month", F.lit(1)), "MMMM"),
            "res_rate": number_text(rate),
            "avg_resolution_days": F.coalesce(number_text(F.col("avg_resolution_days")), F.lit(MISSING_NUMBER)),
            "complaint_growth_pct": number_text(F.col("complaint_growth_pct")),
        },
    )
    return rows.select(
        F.concat_ws("-", F.lit("summary"), "bank_id", "year", "month").alias("doc_id"),
        text.alias("page_content"),
        _metadata(
            source=F.lit("monthly_summary"), bank_name=F.col("bank_name"), year=F.col("year"), month=F.col("month"), type=F.lit("summary")
        ).alias("metadata"),
    )


def flag_narratives(flags: DataFrame, institutions: DataFrame) -> DataFrame:
    """``doc_id, page_content, metadata`` for each flag."""
    rows = flags.join(institutions.select("bank_id", "bank_name"), "bank_id")
    names = ("year", "quarter", "bank_name", "flag_type", "severity", "flag_description")
    return rows.select(
        F.concat_ws("-", F.lit("flag"), "bank_id", "year", "quarter", F.replace("flag_type", F.lit(" "), F.lit("_"))).alias("doc_id"),
        fill_template(FLAG_NARRATIVE_TEXT, {c: F.col(c) for c in names}).alias("page_content"),
        _metadata(
            source=F.lit("policy_flags"), bank_name=F.col("bank_name"), year=F.col("year"), quarter=F.col("quarter"), type=F.lit("flag")
        ).alias("metadata"),
    )


def narrative_corpus(summary: DataFrame, flags: DataFrame, institutions: DataFrame) -> DataFrame:
    return summary_narratives(summary, institutions).unionByName(flag_narratives(flags, institutions))


# --- nearest neighbours -------------------------------------------------------------------------

QUESTIONS_PER_BLOCK = 4096
DOCS_PER_BLOCK = 20_000
TOGETHER = 256  # questions multiplied with a block of documents at a time
MEASURED = 8192  # pairs whose distance is measured again at a time


def _best(question_ids: np.ndarray, questions: np.ndarray, doc_ids: np.ndarray, docs: np.ndarray, k: int, same: bool,
          questions_together: int = TOGETHER, docs_together: int = DOCS_PER_BLOCK) -> pd.DataFrame:
    """The k nearest of these documents for each question, exact, ties by id.

    Squared distances come from matrix products of a group of questions and a group of documents; the k least so far of a question
    bound what a later group may add. What is left within rounding of the k-th is measured again directly. Vectors with a value that is
    not finite have no distance.
    """
    fine_docs, fine = np.isfinite(docs).all(axis=1), np.isfinite(questions).all(axis=1)
    doc_ids, docs, question_ids, questions = doc_ids[fine_docs], docs[fine_docs], question_ids[fine], questions[fine]
    out: list[tuple] = []
    size = np.einsum("ij,ij->i", docs, docs)
    for begin in range(0, len(questions) if len(docs) else 0, questions_together):
        part = questions[begin : begin + questions_together]
        part_ids = question_ids[begin : begin + questions_together]
        own = np.einsum("ij,ij->i", part, part)
        slack = 1e-12 * docs.shape[1] * (own + size.max())
        least = np.full((len(part), k), np.inf)
        found: list[tuple] = []
        for at in range(0, len(docs), docs_together):
            to = at + docs_together
            square = own[:, None] + size[at:to] - 2 * part @ docs[at:to].T
            square[~np.isfinite(square)] = np.inf
            if same:
                square[doc_ids[at:to] == part_ids[:, None]] = np.inf
            nearer = np.flatnonzero(square.min(axis=1) <= np.minimum(least.max(axis=1) + slack, np.finfo(np.float64).max))
            if not len(nearer):
                continue
            square = square[nearer]
            least[nearer] = np.partition(np.concatenate([least[nearer], square], axis=1), k - 1, axis=1)[:, :k]
            row, col = np.nonzero((square <= (least.max(axis=1) + slack)[nearer, None]) & (square < np.inf))
            found.append((nearer[row], col + at, square[row, col]))
        if not found:
            continue
        row, col, square = map(np.concatenate, zip(*found))
        near = square <= (least.max(axis=1) + slack)[row]
        row, col = row[near], col[near]
        distance = np.zeros(len(row))
        for i in range(0, len(row), MEASURED):
            gap = docs[col[i : i + MEASURED]] - part[row[i : i + MEASURED]]
            distance[i : i + MEASURED] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
        order = np.lexsort((doc_ids[col], distance, row))
        row, col, distance = row[order], col[order], distance[order]
        first = np.arange(len(row)) - np.searchsorted(row, row) < k
        out.append((part_ids[row[first]], doc_ids[col[first]], distance[first]))
    if not out:
        return pd.DataFrame({"question_id": question_ids[:0], "doc_id": doc_ids[:0], "distance": np.zeros(0)})
    ids, hits, distances = map(np.concatenate, zip(*out))
    return pd.DataFrame({"question_id": ids, "doc_id": hits, "distance": distances})


def knn_topk(questions: DataFrame, corpus: DataFrame, k: int = 5, exclude_self: bool = False,
             questions_per_block: int = QUESTIONS_PER_BLOCK, docs_per_block: int = DOCS_PER_BLOCK) -> DataFrame:
    """The k nearest documents (L2) of every question: ``question_id, doc_id, rank, distance``.

    ``questions`` has ``question_id, embedding``; ``corpus`` has ``doc_id, embedding``. The
    result is exact. Questions and documents are cut into tiles of a bounded size, at every number of them, and each tile of
    questions meets each tile of documents in one task: at most k hits of a question leave such a pair. ``questions_per_block`` and
    ``docs_per_block`` are what is multiplied at a time; a tile holds as many blocks as make up the default sizes, or one larger block,
    so that small blocks do not multiply the copies of a vector.
    Vectors that are null or hold a value that is not finite are neighbours of nothing.
    """
    known, docs = _vectors(questions, "question_id"), _vectors(corpus, "doc_id")
    schema = T.StructType(
        [
            T.StructField("question_id", known.schema["question_id"].dataType),
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("distance", T.DoubleType()),
        ]
    )
    return _rank_hits(_knn_by_tiles(known, docs, k, exclude_self, questions_per_block, docs_per_block, schema), k)


def _vectors(frame: DataFrame, key: str) -> DataFrame:
    """``key, embedding`` of rows with a vector; single precision is widened in the tasks, other numbers here."""
    single = frame.schema["embedding"].dataType in (T.ArrayType(T.FloatType()), T.ArrayType(T.FloatType(), False))
    vector = F.col("embedding") if single else F.col("embedding").cast("array<double>")
    return frame.select(key, vector.alias("embedding")).filter(F.col("embedding").isNotNull())


def _tile(key: str, per_tile: int, frame: DataFrame) -> tuple[Column, Column]:
    """(tile number of a row, number of tiles) for tiles of about ``per_tile`` rows."""
    tiles = F.greatest(F.ceil(frame.agg(F.count("*")).scalar() / per_tile), F.lit(1)).cast("int")
    return F.pmod(F.xxhash64(key), tiles).cast("int"), tiles


def _knn_by_tiles(questions, docs, k, exclude_self, per_question_block, per_doc_block, schema) -> DataFrame:
    question_tile, question_tiles = _tile("question_id", max(per_question_block, QUESTIONS_PER_BLOCK), questions)
    doc_tile, doc_tiles = _tile("doc_id", max(per_doc_block, DOCS_PER_BLOCK), docs)
    together = min(per_question_block, TOGETHER)

    def every(count: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), count - 1))

    left = questions.withColumn("qt", question_tile).select("*", every(doc_tiles).alias("dt"))
    right = docs.withColumn("dt", doc_tile).select("*", every(question_tiles).alias("qt"))

    def match(q: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
        if q.empty or d.empty:
            return pd.DataFrame({"question_id": q["question_id"].iloc[:0], "doc_id": d["doc_id"].iloc[:0], "distance": np.zeros(0)})
        wide = [np.vstack(x["embedding"]).astype(np.float64, copy=False) for x in (q, d)]
        return _best(q["question_id"].to_numpy(), wide[0], d["doc_id"].to_numpy(), wide[1], k, exclude_self, together, per_doc_block)

    return left.groupBy("qt", "dt").cogroup(right.groupBy("qt", "dt")).applyInPandas(match, schema)


def _rank_hits(local: DataFrame, k: int) -> DataFrame:
    """The k best of all tasks' candidates per question, in rank order."""
    near_first = Window.partitionBy("question_id").orderBy("distance", "doc_id")
    return (
        local.withColumn("rank", F.row_number().over(near_first))
        .filter(F.col("rank") <= k)
        .select("question_id", "doc_id", "rank", "distance")
    )


# --- contexts and answers -------------------------------------------------------------------------


def retrieval_context(hits: DataFrame, corpus: DataFrame, separator: str = "\n\n") -> DataFrame:
    """``question_id, context, sources``: the hit texts in rank order (k rows per question).

    The hits are stored first, so that picking their texts reads the corpus in place if the
    hits are few, instead of shuffling it.
    """

    def known(key: str) -> Column:
        return F.coalesce(F.col("metadata")[key], F.lit("N/A")).alias(key)

    source = F.struct(F.col("page_content").alias("content"), known("bank_name"), known("year"), known("source"))
    ranked = F.array_sort(F.collect_list(F.struct("rank", source.alias("hit"))))
    few = stored(hits.select("question_id", "doc_id", "rank"), "hits")
    gathered = few.join(corpus.select("doc_id", "page_content", "metadata"), "doc_id").groupBy("question_id").agg(ranked.alias("r"))
    return gathered.select(
        "question_id",
        F.array_join(F.transform("r", lambda x: x["hit"]["content"]), separator).alias("context"),
        F.transform("r", lambda x: x["hit"]).alias("sources"),
    )


def template_answers(questions: DataFrame, contexts: DataFrame, k: int = 5) -> DataFrame:
    """``question_id, answer``: the fixed answer text around the hits of each question."""
    points = F.array_join(F.transform("sources", lambda s: F.concat(F.lit("- "), s["content"])), "\n")
    intro = fill_template(ANSWER_INTRO, {"header": F.lit(ANSWER_HEADER), "k": F.lit(k), "question": F.col("question")})
    return questions.join(contexts, "question_id").select("question_id", F.concat(intro, points, F.lit(ANSWER_CLOSING)).alias("answer"))


def route_questions(questions: DataFrame, text: str = "question") -> DataFrame:
    """The input with ``route``: which canned query answers a question."""
    lowered = F.lower(text)
    return questions.withColumn("route", first_match([(r, contains_any(lowered, words)) for r, words in QUESTION_ROUTES], QUESTION_DEFAULT))


def route_lines(route: str, result: DataFrame) -> DataFrame:
    """``route, line``: a canned query's rows as text."""
    text = fill_template(ROUTE_LINES[route], {c: F.col(c) for c in result.columns})
    return result.select(F.lit(route).alias("route"), text.alias("line"))
