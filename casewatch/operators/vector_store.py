"""A vector corpus in a folder, cut into lists around centroids, and searches that probe lists or hash buckets.

Folder: ``centroids`` (list_id, centroid), ``schema``, ``docs`` (the corpus with ``embedding`` and ``centre_distance``, one partition folder
per list) and, if the corpus was embedded by a fitted pipeline, ``embedder``. Documents are added to it by the same centroids. A
vector that is null or holds a value that is not finite keeps its row in list -1, which no search probes.

Searches compare questions and documents in cells of bounded size: a list or bucket that holds a third of all documents is cut in
many. At most k hits of a question leave a cell. The exact search goes on with blocks of questions and blocks of documents, which are
written once and meet by being read; a question is never written once for each list it has to go to.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casewatch.operators.retrieval import DOCS_PER_BLOCK, MEASURED, QUESTIONS_PER_BLOCK, _best, _rank_hits
from casewatch.operators.text_features import embed
from casewatch.session import new_table_path, scratch, small_batches
from casewatch.sources.files import read_documents_json, read_table, stored, write_documents_json, write_table

#: Lists at most, vectors that centroids are fitted to, and lists that a search probes at first.
LISTS, SAMPLE, PROBES = 1024, 65_536, 8
NO_LIST = -1
ASKED = 1024  # vectors whose distances to all centroids are held at a time
#: Bytes of vectors in a block of documents and in one of questions, and of a row group of such blocks.
DOC_BYTES, QUESTION_BYTES, GROUP_BYTES = 8 << 20, 2 << 20, 16 << 20
MANY = 32  # documents near a question in one product, on average, from which the k-th best of these is looked for first


@dataclass
class Store:
    docs: DataFrame
    centroids: np.ndarray  # row i is the centroid of list i
    embedder: PipelineModel | None = None


def _vector(column: str = "embedding") -> Column:
    """The vector as doubles; null if a value is not finite."""
    v = F.col(column).cast("array<double>")
    infinite = F.array(*[F.lit(x) for x in (float("inf"), float("-inf"), float("nan"))])
    return F.when(F.exists(v, lambda x: x.isNull()) | F.arrays_overlap(v, infinite), F.lit(None)).otherwise(v)


def bounded_sample(docs: DataFrame, most: int) -> DataFrame:
    """All distinct vectors, or about ``most`` of them by their hash, so that many copies of one weigh as one."""
    vectors = docs.select(_vector().alias("embedding")).filter("embedding is not null").distinct()
    key = F.pmod(F.xxhash64("embedding"), F.lit(1 << 30))
    share = F.lit(float(most)) / F.greatest(vectors.agg(F.count(F.lit(1))).scalar(), F.lit(1))
    return vectors.filter(key < share * (1 << 30))


def fit_centroids(docs: DataFrame, lists: int | None = None, sample: int = SAMPLE, seed: int = 7) -> np.ndarray:
    """k-means centroids of a bounded sample; as many as the root of the number of vectors, ``LISTS`` at most."""
    vectors = stored(bounded_sample(docs, sample), "centroid-sample")
    n = vectors.count()
    if n == 0:
        return np.zeros((0, 0))
    k = min(n, lists or max(1, min(LISTS, round(docs.count() ** 0.5))))
    if k == 1:
        return np.array([vectors.select(F.array(*[F.avg(F.col("embedding")[i]) for i in range(len(vectors.first()[0]))])).first()[0]])
    model = KMeans(featuresCol="v", k=k, maxIter=10, seed=seed).fit(vectors.select(array_to_vector("embedding").alias("v")))
    return np.vstack(model.clusterCenters())


def _distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    square = np.einsum("ij,ij->i", vectors, vectors)[:, None] + np.einsum("ij,ij->i", centroids, centroids) - 2 * vectors @ centroids.T
    return np.sqrt(np.maximum(square, 0))


def with_lists(docs: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds ``list_id`` and ``centre_distance`` of the nearest centroid."""

    @F.pandas_udf("list_id int, centre_distance double")
    def nearest(vectors: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame({"list_id": np.full(len(vectors), NO_LIST, np.int32), "centre_distance": np.zeros(len(vectors))})
        known = vectors.notna().to_numpy()
        if known.any() and len(centroids):
            part = np.vstack(vectors[known].to_list())
            best = np.concatenate([_distances(part[at : at + ASKED], centroids).argmin(axis=1) for at in range(0, len(part), ASKED)])
            out.loc[known, "list_id"] = best.astype(np.int32)
            out.loc[known, "centre_distance"] = np.sqrt(((part - centroids[best]) ** 2).sum(axis=1))
        return out

    return docs.withColumn("embedding", _vector()).withColumn("_near", nearest("embedding")).select("*", "_near.*").drop("_near")


def create_store(docs: DataFrame, path: str, embedder: PipelineModel | None = None, output: str = "tfidf", lists: int | None = None) -> None:
    """Write ``docs`` (doc_id, embedding and any columns) anew; with an ``embedder`` the embedding is made from its text column.

    ``output`` names the vector column that the embedder's last stage makes.
    """
    with scratch(docs.sparkSession):
        if embedder is not None:
            embedder.write().overwrite().save(f"{path}/embedder")
            docs = stored(embed(embedder, docs, output), "embedded")
        _write_store(docs, path, lists)


def _write_store(docs: DataFrame, path: str, lists: int | None) -> None:
    centroids = fit_centroids(docs, lists)
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(centroids)]
    write_table(docs.sparkSession.createDataFrame(rows, "list_id int, centroid array<double>"), f"{path}/centroids")
    placed = with_lists(docs, centroids)
    schema = docs.sparkSession.createDataFrame([(placed.schema.json(),)], "document string")
    write_documents_json(schema, f"{path}/schema")
    write_table(placed, f"{path}/docs", partition_by=["list_id"])


def append_docs(docs: DataFrame, path: str, output: str = "tfidf") -> None:
    """Add documents to the lists that are there."""
    store = open_store(docs.sparkSession, path)
    if "embedding" not in docs.columns:
        docs = embed(store.embedder, docs, output)
    write_table(with_lists(docs, store.centroids), f"{path}/docs", mode="append", partition_by=["list_id"])


def open_store(spark: SparkSession, path: str) -> Store:
    rows = read_table(spark, f"{path}/centroids").collect()  # LISTS rows at most
    centroids = np.array([r["centroid"] for r in sorted(rows, key=lambda r: r["list_id"])]) if rows else np.zeros((0, 0))
    model = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/embedder")
    there = model.getFileSystem(spark._jsc.hadoopConfiguration()).exists(model)
    schema = T.StructType.fromJson(json.loads(read_documents_json(spark, f"{path}/schema").first()[0]))
    return Store(read_table(spark, f"{path}/docs", schema), centroids, PipelineModel.load(f"{path}/embedder") if there else None)


def _within_cells(
    questions: DataFrame, docs: DataFrame, k: int, exclude_self: bool, docs_per_cell: int, questions_per_cell: int, once: bool = False,
) -> DataFrame:
    """The best k of each question (cell, question_id, embedding) among the documents (cell, doc_id, embedding) of each of its cells.

    ``once``: among those of one part of each of its cells, so that a question has no more copies than cells.
    """
    sizes = lambda df, n, name: df.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / n).cast("int").alias(name))
    parts = sizes(questions, questions_per_cell, "qs").join(sizes(docs, docs_per_cell, "ds"), "cell")
    parts = stored(parts.withColumn("qs", F.ceil(F.col("qs") / F.col("ds")).cast("int")) if once else parts, "cells")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    part = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    one = F.pmod(F.xxhash64("question_id", F.lit(1)), F.col("ds")).cast("int")
    left = questions.join(parts, "cell").withColumn("qp", part("question_id", "qs")).withColumn("dp", one if once else every("ds")).drop("qs", "ds")
    right = docs.join(parts, "cell").withColumn("dp", part("doc_id", "ds")).withColumn("qp", every("qs")).drop("qs", "ds")
    schema = T.StructType([
        T.StructField("question_id", questions.schema["question_id"].dataType), T.StructField("doc_id", docs.schema["doc_id"].dataType),
        T.StructField("distance", T.DoubleType()),
    ])

    def match(q: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
        if q.empty or d.empty:
            return pd.DataFrame({"question_id": q["question_id"].iloc[:0], "doc_id": d["doc_id"].iloc[:0], "distance": np.zeros(0)})
        return _best(q["question_id"].to_numpy(), np.vstack(q["embedding"]), d["doc_id"].to_numpy(), np.vstack(d["embedding"]), k, exclude_self)

    keys = ["cell", "qp", "dp"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(match, schema)

# --- blocks that meet -----------------------------------------------------------------------------


def _nearby_in_turn(centroids: np.ndarray) -> np.ndarray:
    """A place for each list, such that neighbours in place are near: from each centroid on to the nearest of those left."""
    place, left, at = np.zeros(len(centroids), np.int32), np.arange(len(centroids)), 0
    for i in range(len(centroids)):
        here, left = left[at], np.delete(left, at)
        place[here] = i
        at = int(((centroids[left] - centroids[here]) ** 2).sum(axis=1).argmin()) if len(left) else 0
    return place


def _cut(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """The rows in their order, ``most`` at a time."""
    held, n = [], 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, most - n)
            held, n, at = [*held, part], n + part.num_rows, at + part.num_rows
            if n == most:
                yield pa.Table.from_batches(held)
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    rows = column.combine_chunks()
    lengths = rows.value_lengths().to_numpy(zero_copy_only=False)
    if (lengths != lengths[0]).any():
        raise ValueError("vectors differ in length")
    return rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)


def _one_row(**columns: pa.Array | list | bytes | int) -> pa.RecordBatch:
    """A row whose columns are arrays, bytes or a number."""
    whole = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) if isinstance(x, pa.Array) else pa.array([x])
    return pa.RecordBatch.from_arrays([whole(x) for x in columns.values()], names=[*columns])


def _keep_few_copies(ids: np.ndarray, vectors: np.ndarray, k: int) -> np.ndarray:
    """Places of documents that may be among a question's k: of those with one and the same vector the first 2k by id, k of one id.

    So k are left whichever id the question itself has, and more of them cannot be among the k.
    """
    whole = np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.itemsize * vectors.shape[1]))).ravel()
    _, same, copies = np.unique(whole, return_inverse=True, return_counts=True)
    if copies.max() <= 2 * k or pd.isna(ids).any():
        return np.arange(len(ids))
    in_turn = lambda new: np.arange(len(new)) - np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    order = np.lexsort((ids, same))
    other = np.r_[True, same[order][1:] != same[order][:-1]]
    order = order[in_turn(other | np.r_[True, ids[order][1:] != ids[order][:-1]]) < k]
    other = np.r_[True, same[order][1:] != same[order][:-1]]
    return np.sort(order[in_turn(other) < 2 * k])


def _within_reach(vectors: np.ndarray, worst: np.ndarray, centroids: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """For each vector, which lists may hold a document that is not farther than ``worst``, whatever the rounding."""
    with np.errstate(over="ignore", invalid="ignore"):
        size = np.einsum("ij,ij->i", vectors, vectors)[:, None] + np.einsum("ij,ij->i", centroids, centroids)
        least = np.sqrt(np.maximum(size - 2 * vectors @ centroids.T - 1e-15 * (vectors.shape[1] + 8) * size, 0))
        return ~(least - radius * (1 + 1e-9) > worst[:, None] * (1 + 1e-9) + 1e-9)


class _Found:
    """The k nearest documents so far of the questions of a block; ``worst``: how far they may be."""

    def __init__(self, ids: pa.Array, worst: np.ndarray, k: int):
        self.ids, self.worst, self.k = ids.take(pa.array(np.arange(len(ids)))), worst.copy(), k
        self.names = self.ids.to_pandas().to_numpy()
        self.distance = np.full((len(worst), k), np.inf)
        self.docs: np.ndarray | None = None

    def bound(self) -> np.ndarray:
        return np.minimum(self.worst, self.distance[:, -1])

    def offer(self, rows: np.ndarray, vectors: np.ndarray, doc_ids: np.ndarray, docs: np.ndarray, same: bool, together: int = 512, docs_together: int = 2048) -> None:
        """Take what is nearer, for the questions at ``rows`` with these ``vectors``; distances are measured directly, ties go by id."""
        size = np.einsum("ij,ij->i", docs, docs)
        known = np.isfinite(size)
        if not known.all():
            doc_ids, docs, size = doc_ids[known], docs[known], size[known]
        if not len(docs):
            return
        wide = np.column_stack([docs, size / -2])
        for begin in range(0, len(rows), together):
            part, at = vectors[begin : begin + together], rows[begin : begin + together]
            own = np.einsum("ij,ij->i", part, part)
            if not (fine := np.isfinite(own)).all():
                part, at, own = part[fine], at[fine], own[fine]
            slack = 1e-12 * docs.shape[1] * (own + size.max())
            one = np.column_stack([part, np.ones(len(part))])
            for i in range(0, len(docs), docs_together):
                near = one @ wide[i : i + docs_together].T  # half of what a square of a distance is less than the question's own
                least = (own - self.bound()[at] ** 2 * (1 + 1e-9) - slack) / 2
                taken = near >= least[:, None]
                if np.count_nonzero(taken) > MANY * len(part):
                    if same:
                        near[doc_ids[i : i + docs_together] == self.names[at][:, None]] = -np.inf
                    last = near.shape[1] - self.k
                    if last > 0:
                        least = np.maximum(least, np.partition(near, last, axis=1)[:, last] - slack)
                    taken = (near >= least[:, None]) & (near > -np.inf)
                row, col = np.nonzero(taken)
                col += i
                if same:
                    other = doc_ids[col] != self.names[at[row]]
                    row, col = row[other], col[other]
                if len(row):
                    self._take(at[row], doc_ids[col], _measured(part, docs, row, col))

    def _take(self, row: np.ndarray, doc: np.ndarray, distance: np.ndarray) -> None:
        kind = np.promote_types(self.docs.dtype, doc.dtype) if self.docs is not None else doc.dtype
        if self.docs is None:
            self.docs = np.empty(self.distance.shape, kind)
        self.docs = self.docs.astype(kind, copy=False)
        who = np.unique(row)
        row = np.concatenate([row, np.repeat(who, self.k)])
        doc, distance = np.concatenate([doc.astype(kind), self.docs[who].ravel()]), np.concatenate([distance, self.distance[who].ravel()])
        known = np.isfinite(distance)
        row, doc, distance = row[known], doc[known], distance[known]
        order = np.lexsort((doc, distance, row))
        row, doc, distance = row[order], doc[order], distance[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        first = rank < self.k
        self.distance[who] = np.inf
        self.distance[row[first], rank[first]], self.docs[row[first], rank[first]] = distance[first], doc[first]

    def hits(self, kind: pa.DataType) -> pa.RecordBatch | None:
        row, rank = np.nonzero(np.isfinite(self.distance))
        if not len(row):
            return None
        docs = pa.array(self.docs[row, rank], kind, from_pandas=True)
        return pa.RecordBatch.from_arrays([self.ids.take(pa.array(row)), docs, pa.array(self.distance[row, rank])], names=["question_id", "doc_id", "distance"])


def _measured(questions: np.ndarray, docs: np.ndarray, row: np.ndarray, col: np.ndarray) -> np.ndarray:
    distance = np.zeros(len(row))
    for i in range(0, len(row), MEASURED):
        gap = docs[col[i : i + MEASURED]] - questions[row[i : i + MEASURED]]
        distance[i : i + MEASURED] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
    return distance


def _stored_blocks(blocks: DataFrame, name: str) -> DataFrame:
    """As ``stored``, but as large on disk as in memory and in small row groups: a task holds as many blocks as one split of the files has."""
    path = new_table_path(blocks.sparkSession, name)
    blocks.write.options(**{
        "compression": "uncompressed", "parquet.block.size": str(GROUP_BYTES), "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1",
    }).parquet(path)
    return read_table(blocks.sparkSession, path, blocks.schema)


def _by_blocks(
    questions: DataFrame, docs: DataFrame, centroids: np.ndarray, radius: np.ndarray, k: int, exclude_self: bool,
    docs_per_cell: int, questions_per_cell: int,
) -> DataFrame:
    """The k nearest of the documents (list_id, doc_id, embedding) to each question (list_id, question_id, embedding, worst), per task.

    ``list_id`` of a question is its nearest list; ``worst`` is how far its k nearest documents may be, null if that is not known.
    ``radius`` has an entry for each centroid. Blocks hold what lies in neighbouring lists. A block of questions names the lists
    within reach of one of them, and meets the blocks of documents that hold such a list in a product of the two tables: its
    tasks read both, and neither is shuffled or copied for it. Within a pair of blocks, a question is compared with the lists in its own reach.
    """
    spark, width = docs.sparkSession, 8 * centroids.shape[1]
    place = F.get(F.lit([int(x) for x in _nearby_in_turn(centroids)]), F.col("list_id"))
    in_turn = lambda df, key: df.withColumn("place", place).withColumn("mix", F.xxhash64(key)).repartitionByRange("place", "mix").sortWithinPartitions("place", "mix")
    docs_at_once = max(1, min(docs_per_cell, DOC_BYTES // width))
    questions_at_once = max(1, min(questions_per_cell, QUESTION_BYTES // width))
    question_type, doc_type = questions.schema["question_id"].dataType, docs.schema["doc_id"].dataType

    def doc_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _cut(batches, docs_at_once):
            vectors, ids = _matrix(block["embedding"]), block["doc_id"].combine_chunks()
            kept = _keep_few_copies(ids.to_pandas().to_numpy(), vectors, k)
            lists = block["list_id"].to_numpy()[kept]
            first = np.flatnonzero(np.r_[True, lists[1:] != lists[:-1]])
            counts = np.diff(np.r_[first, len(lists)])
            yield _one_row(lists=pa.array(lists[first], pa.int32()), counts=pa.array(counts, pa.int32()), doc_ids=ids.take(pa.array(kept)), docs=vectors[kept].tobytes())

    def question_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for n, block in enumerate(_cut(batches, questions_at_once)):
            vectors, worst = _matrix(block["embedding"]), block["worst"].to_pandas().fillna(np.inf).to_numpy(np.float64)
            wanted = np.zeros(len(centroids), bool)
            for at in range(0, len(vectors), ASKED):
                wanted |= _within_reach(vectors[at : at + ASKED], worst[at : at + ASKED], centroids, radius).any(axis=0)
            number = (TaskContext.get().partitionId() << 32) + n
            wanted = pa.array(np.flatnonzero(wanted), pa.int32())
            yield _one_row(block=number, wanted=wanted, question_ids=block["question_id"].combine_chunks(), questions=vectors.tobytes(), worst=worst.tobytes())

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, _Found] = {}
        kind = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                block, kind = row["block"].as_py(), row["doc_ids"].values.type
                if block not in found:
                    found[block] = _Found(row["question_ids"].values, np.frombuffer(row["worst"].as_buffer()), k)
                _meet(found[block], np.frombuffer(row["questions"].as_buffer()).reshape(-1, centroids.shape[1]), row)
        for each in found.values():
            if (hits := each.hits(kind)) is not None:
                yield hits

    def _meet(found: _Found, vectors: np.ndarray, row: dict) -> None:
        docs = np.frombuffer(row["docs"].as_buffer()).reshape(-1, centroids.shape[1])
        ids, lists = row["doc_ids"].values.to_pandas().to_numpy(), row["lists"].values.to_numpy()
        ends = np.cumsum(row["counts"].values.to_numpy())
        reach = _within_reach(vectors, found.bound(), centroids[lists], radius[lists])
        asking, asked = reach.any(axis=1), reach.any(axis=0)
        if 2 * np.count_nonzero(reach) >= np.count_nonzero(asking) * np.count_nonzero(asked):  # most compare with most: all at once
            wanted = np.repeat(asked, np.diff(np.r_[0, ends]))
            parts = [(asking, wanted if not wanted.all() else slice(None))]
        else:
            parts = [(reach[:, i], slice(end - count, end)) for i, (end, count) in enumerate(zip(ends, np.diff(np.r_[0, ends]))) if asked[i]]
        for who, which in parts:
            found.offer(np.flatnonzero(who), vectors if who.all() else vectors[who], ids[which], docs[which], exclude_self)

    with small_batches(spark):
        packed = in_turn(docs, "doc_id").select("list_id", "doc_id", "embedding").mapInArrow(
            doc_blocks, T.StructType([
                T.StructField("lists", T.ArrayType(T.IntegerType())), T.StructField("counts", T.ArrayType(T.IntegerType())),
                T.StructField("doc_ids", T.ArrayType(doc_type)), T.StructField("docs", T.BinaryType()),
            ])
        )
        left = _stored_blocks(packed, "doc-blocks")
        packed = in_turn(questions, "question_id").select("question_id", "embedding", "worst").mapInArrow(
            question_blocks, T.StructType([
                T.StructField("block", T.LongType()), T.StructField("wanted", T.ArrayType(T.IntegerType())),
                T.StructField("question_ids", T.ArrayType(question_type)), T.StructField("questions", T.BinaryType()), T.StructField("worst", T.BinaryType()),
            ])
        )
        right = _stored_blocks(packed, "question-blocks")
        pairs = left.hint("shuffle_replicate_nl").join(right, F.arrays_overlap("lists", "wanted")).drop("wanted")
        schema = T.StructType([T.StructField("question_id", question_type), T.StructField("doc_id", doc_type), T.StructField("distance", T.DoubleType())])
        return stored(pairs.mapInArrow(match, schema), "hits")


def search(
    store: Store, questions: DataFrame, k: int = 5, probes: int = PROBES, exact: bool = False, exclude_self: bool = False,
    docs_per_cell: int = DOCS_PER_BLOCK, questions_per_cell: int = QUESTIONS_PER_BLOCK,
) -> DataFrame:
    """The k nearest documents (L2) of each question (question_id, embedding): ``question_id, doc_id, rank, distance``.

    Each question probes the lists of its ``probes`` nearest centroids; only these lists' folders are read. With ``exact`` the k-th hit
    there only tells how far the search has to go: to every list that may hold a nearer document, as no document of a list is
    nearer than the centroid's distance less the list's radius. Equal distances rank by id.
    """
    centroids = store.centroids
    asked = questions.select("question_id", _vector().alias("embedding")).filter("embedding is not null")
    docs = store.docs.filter(F.col("list_id") != NO_LIST)
    filled = {r["list_id"]: r["radius"] for r in docs.groupBy("list_id").agg(F.max("centre_distance").alias("radius")).collect()}
    there = np.array(sorted(filled), np.int32)

    @F.pandas_udf("array<int>")
    def nearest(vectors: pd.Series) -> pd.Series:
        out: list[np.ndarray] = []
        for at in range(0, len(vectors), ASKED):
            part = vectors.iloc[at : at + ASKED]
            d = _distances(np.vstack(part.to_list()), centroids[there]) if len(there) else np.zeros((len(part), 0))
            out += [there[row] for row in np.argsort(d, axis=1, kind="stable")[:, :probes]]
        return pd.Series(out, dtype=object)

    asked = stored(asked, "asked")
    probing = stored(asked.withColumn("cells", nearest("embedding")), "probes")
    rows = probing.select("question_id", "embedding", F.explode("cells").alias("cell"))
    wanted = [r[0] for r in rows.select("cell").distinct().collect()]  # LISTS at most
    read = docs.select("list_id", "doc_id", "embedding")
    probed = read.filter(F.col("list_id").isin(wanted)).withColumnRenamed("list_id", "cell")
    if not exact or not len(there):
        return _rank_hits(stored(_within_cells(rows, probed, k, exclude_self, docs_per_cell, questions_per_cell), "hits"), k)
    # Any k documents tell how far to go, so each question meets one part of a hot list: smaller parts, for more questions.
    hits = _within_cells(rows, probed, k, exclude_self, min(docs_per_cell, questions_per_cell), max(docs_per_cell, questions_per_cell), once=True)
    worst = hits.withColumn("rank", F.row_number().over(Window.partitionBy("question_id").orderBy("distance"))).filter(F.col("rank") == k)
    worst = worst.select("question_id", F.col("distance").alias("worst"))
    far = probing.withColumn("list_id", F.get("cells", F.lit(0))).drop("cells").join(worst, "question_id", "left")
    radius = np.zeros(len(centroids))
    radius[there] = [filled[i] for i in there.tolist()]
    return _rank_hits(_by_blocks(far, read, centroids, radius, k, exclude_self, docs_per_cell, questions_per_cell), k)


def ask(store: Store, questions: DataFrame, text: str, output: str = "tfidf", **options) -> DataFrame:
    """``search`` for questions whose text the store's embedder turns into vectors."""
    asked = embed(store.embedder, questions.withColumnRenamed("question", text), output)
    return search(store, asked.select("question_id", "embedding"), **options)


# --- hash buckets ---------------------------------------------------------------------------------

TABLES, BITS = 12, 10


def _buckets(docs: DataFrame, planes: np.ndarray, middles: np.ndarray) -> Column:
    """Bucket of a vector in each table: which side of each plane it lies on."""
    tables, bits = middles.shape

    @F.pandas_udf("array<long>")
    def sides(vectors: pd.Series) -> pd.Series:
        above = np.vstack(vectors.to_list()) @ planes > middles.reshape(-1)
        number = above.reshape(len(vectors), tables, bits) @ (1 << np.arange(bits)) + (np.arange(tables) << bits)
        return pd.Series(list(number))

    return sides("embedding")


def hash_planes(docs: DataFrame, tables: int = TABLES, bits: int = BITS, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Random directions, and the middle value along each in a bounded sample, so that planes halve the data wherever it lies."""
    sample = bounded_sample(docs, SAMPLE).toPandas()["embedding"]
    vectors = np.vstack(sample.to_list()) if len(sample) else np.zeros((1, 1))
    planes = np.random.default_rng(seed).standard_normal((vectors.shape[1], tables * bits))
    return planes, np.median(vectors @ planes, axis=0).reshape(tables, bits)


def bucket_topk(
    questions: DataFrame, corpus: DataFrame, k: int = 5, exclude_self: bool = False, tables: int = TABLES, bits: int = BITS,
    docs_per_cell: int = DOCS_PER_BLOCK, questions_per_cell: int = QUESTIONS_PER_BLOCK,
) -> DataFrame:
    """As ``knn_topk``, among the documents that share a question's bucket in one of several tables of random projections.

    Approximate: a near document that shares no bucket is missed; distances are exact. More tables find more, more
    bits compare less. The exact ways are ``knn_topk`` and ``search(exact=True)``.
    """
    docs = corpus.select("doc_id", _vector().alias("embedding")).filter("embedding is not null")
    asked = questions.select("question_id", _vector().alias("embedding")).filter("embedding is not null")
    planes, middles = hash_planes(docs, tables, bits)
    in_cells = lambda df, key: stored(df.withColumn("cells", _buckets(df, planes, middles)).select(key, "embedding", F.explode("cells").alias("cell")), "cells")
    local = _within_cells(in_cells(asked, "question_id"), in_cells(docs, "doc_id"), k, exclude_self, docs_per_cell, questions_per_cell)
    return _rank_hits(local.distinct(), k)

