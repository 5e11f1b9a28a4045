import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import HashingTF, RegexTokenizer
from pyspark.sql import functions as F

from casewatch.operators import retrieval as N
from casewatch.operators import vector_store as VS
from casewatch.operators.text_features import fit_tfidf
from casewatch.session import new_table_path, recorded

VECTORS = "doc_id long, embedding array<double>"


def clustered(n, groups=60, dim=16, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((groups, dim)) * 3
    return centres[rng.integers(groups, size=n)] + rng.standard_normal((n, dim)) * 0.3


def frame(spark, vectors, start=0):
    return spark.createDataFrame([(start + i, [float(x) for x in v]) for i, v in enumerate(vectors)], VECTORS)


def hits(df):
    return sorted((r.question_id, r["rank"], r.doc_id, round(r.distance, 9)) for r in df.collect())


def recall(found, wanted):
    pairs = {(q, d) for q, _, d, _ in wanted}
    return len(pairs & {(q, d) for q, _, d, _ in found}) / len(pairs)


@pytest.fixture(scope="module")
def data(spark):
    docs, questions = frame(spark, clustered(3000)), frame(spark, clustered(200, seed=1)[:150] + 0.05, 10_000)
    questions = questions.withColumnRenamed("doc_id", "question_id")
    return docs, questions, hits(N.knn_topk(questions, docs))


def written(spark, docs, **options):
    path = new_table_path(spark, "store")
    VS.create_store(docs, path, **options)
    return path


def test_probing_a_reopened_store_finds_the_neighbours_in_few_lists(spark, data):
    docs, questions, wanted = data
    path = written(spark, docs)
    assert VS.open_store(spark.newSession(), path).docs.count() == 3000  # a session that knows nothing but the path
    store = VS.open_store(spark, path)
    found = hits(VS.search(store, questions, probes=4))
    assert recall(found, wanted) >= 0.9
    sizes = {r["list_id"]: r["n"] for r in store.docs.groupBy("list_id").agg(F.count("*").alias("n")).collect()}
    assert sum(sorted(sizes.values())[-4:]) < 0.3 * 3000  # what four lists hold at most


def test_exact_search_equals_comparing_all(spark, data):
    docs, questions, wanted = data
    store = VS.open_store(spark, written(spark, docs, lists=20))
    assert hits(VS.search(store, questions, probes=1, exact=True)) == wanted
    assert hits(VS.search(store, questions, probes=2, exact=True, docs_per_cell=50, questions_per_cell=30)) == wanted


def test_no_question_carries_an_entry_for_every_list(spark, data, monkeypatch):
    docs, questions, wanted = data
    store, kept, real = VS.open_store(spark, written(spark, docs, lists=20)), {}, VS.stored
    monkeypatch.setattr(VS, "stored", lambda df, name: kept.setdefault(name, real(df, name)) if name == "asked" else real(df, name))
    assert hits(VS.search(store, questions, exact=True)) == wanted
    assert kept["asked"].columns == ["question_id", "embedding"]


def test_exact_search_on_vectors_without_structure(spark):
    rng = np.random.default_rng(4)
    docs = frame(spark, rng.standard_normal((400, 8)))
    questions = docs.withColumnRenamed("doc_id", "question_id")
    store = VS.open_store(spark, written(spark, docs))
    assert hits(VS.search(store, questions, exact=True, exclude_self=True)) == hits(N.knn_topk(questions, docs, exclude_self=True))


def test_exact_search_writes_no_question_for_each_list_it_has_to_go_to(spark):
    rng = np.random.default_rng(6)
    docs = frame(spark, rng.standard_normal((600, 24)))  # no list can be ruled out
    questions = docs.withColumnRenamed("doc_id", "question_id")
    store = VS.open_store(spark, written(spark, docs, lists=30))
    with recorded() as made:
        found = hits(VS.search(store, questions, exact=True, exclude_self=True, docs_per_cell=64, questions_per_cell=100))
    tables = [spark.read.parquet(path) for path in made]
    assert sum(t.count() for t in tables if "embedding" in t.columns) <= 2 * 600
    blocks = {t.columns[0]: t for t in tables if "embedding" not in t.columns}
    assert blocks["lists"].agg(F.sum(F.octet_length("docs"))).first()[0] == blocks["block"].agg(F.sum(F.octet_length("questions"))).first()[0] == 600 * 24 * 8
    assert blocks["lists"].agg(F.max(F.size("doc_ids"))).first()[0] <= 64 and blocks["block"].agg(F.max(F.size("question_ids"))).first()[0] <= 100
    assert found == hits(N.knn_topk(questions, docs, exclude_self=True))


@pytest.mark.parametrize("kind", ["long", "string"])
def test_exact_search_with_copies_repeated_and_null_ids(spark, kind):
    rng = np.random.default_rng(8)
    near = clustered(150, groups=5, dim=6)
    rows = [(i, near[i]) for i in range(150)] + [(200 + i, near[0]) for i in range(90)] + [(200, near[0])] * 7 + [(3, near[3])] * 2
    rows += [(None, near[7])] * (kind == "long") + [(1000 + i, x) for i, x in enumerate(rng.standard_normal((20, 6)) * 1e8)] + [(2000, near[0] * 1e200)]
    docs = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], VECTORS).selectExpr(f"cast(doc_id AS {kind}) AS doc_id", "embedding")
    questions = docs.withColumnRenamed("doc_id", "question_id").unionByName(spark.createDataFrame([(None, [0.0] * 6)], "question_id long, embedding array<double>").selectExpr(f"cast(question_id AS {kind}) AS question_id", "embedding"))
    store = VS.open_store(spark, written(spark, docs, lists=12))
    rows = lambda df: sorted(str((r.question_id, r["rank"], r.doc_id, round(r.distance, 9))) for r in df.collect())
    for same in (True, False):
        found = VS.search(store, questions, k=4, probes=2, exact=True, exclude_self=same, docs_per_cell=40, questions_per_cell=30)
        assert rows(found) == rows(N.knn_topk(questions, docs, k=4, exclude_self=same))


def test_copies_left_out_are_nobodys_neighbours():
    vectors = np.array([[1.0, 0.0]] * 12 + [[0.0, 1.0]] * 3)
    ids = np.array([9, 1, 1, 1, 2, 3, 4, 5, 6, 7, 8, 0, 1, 1, 1])
    assert VS._keep_few_copies(ids, vectors, 2).tolist() == [1, 2, 4, 11, 12, 13]
    assert VS._keep_few_copies(ids, vectors, 6).tolist() == list(range(15))


def test_a_list_around_the_vector_itself_is_within_reach():
    vectors = np.random.default_rng(2).standard_normal((200, 64)) * 1000
    assert VS._within_reach(vectors, np.zeros(200), vectors, np.zeros(200)).diagonal().all()
    far = VS._within_reach(vectors, np.ones(200), vectors, np.ones(200))
    assert far.diagonal().all() and far.sum() == 200


def test_only_probed_lists_are_read(spark, data):
    docs, questions, _ = data
    store = VS.open_store(spark, written(spark, docs, lists=30))
    assert len({f.split("list_id=")[1].split("/")[0] for f in store.docs.inputFiles()}) == 30
    plan = store.docs.filter(F.col("list_id").isin([3, 5]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [list_id#" in plan and " IN (3,5)]" in plan


def test_added_documents_are_found(spark, data):
    docs, questions, _ = data
    path = written(spark, docs)
    more = frame(spark, clustered(300, seed=9), 50_000)
    VS.append_docs(more, path)
    everything = docs.unionByName(more)
    assert hits(VS.search(VS.open_store(spark, path), questions, exact=True)) == hits(N.knn_topk(questions, everything))


def test_hash_buckets_find_neighbours_and_compare_few_pairs(spark, data):
    docs, questions, wanted = data
    assert recall(hits(VS.bucket_topk(questions, docs, bits=6)), wanted) >= 0.9
    planes, middles = VS.hash_planes(docs, bits=6)
    cells = lambda df: df.select(F.explode(VS._buckets(df, planes, middles)).alias("cell")).groupBy("cell").count().collect()
    d = {r["cell"]: r["count"] for r in cells(docs)}
    pairs = sum(r["count"] * d.get(r["cell"], 0) for r in cells(questions))
    assert pairs < 0.5 * 150 * 3000
    small = hits(VS.bucket_topk(questions, docs, bits=6, docs_per_cell=40, questions_per_cell=25))
    assert small == hits(VS.bucket_topk(questions, docs, bits=6))


def test_hot_vector_nulls_infinite_values_and_extra_columns(spark):
    rows = [(i, [1.0, 0.0]) for i in range(300)] + [(900, None), (901, [math.inf, 0.0]), (902, [math.nan, 1.0]), (903, [0.0, None]), (904, [5.0, 5.0])]
    docs = spark.createDataFrame(rows, VECTORS).selectExpr("*", "'text' as page_content", "7 as cell", "8 as near")
    path = written(spark, docs)
    store = VS.open_store(spark, path)
    assert store.docs.count() == 305 and {"page_content", "cell", "near"} <= set(store.docs.columns)
    questions = spark.createDataFrame([(1, [1.0, 0.1]), (2, None), (3, [6.0, 5.0])], "question_id long, embedding array<double>")
    found = hits(VS.search(store, questions, exact=True, docs_per_cell=20))
    assert [(q, d) for q, _, d, _ in found] == [(1, i) for i in range(5)] + [(3, 904)] + [(3, i) for i in range(4)]
    buckets = hits(VS.bucket_topk(questions, docs, docs_per_cell=20))
    assert [(q, d) for q, _, d, _ in buckets if q == 1] == [(1, i) for i in range(5)]


def test_empty_corpus(spark):
    docs = spark.createDataFrame([], VECTORS)
    store = VS.open_store(spark, written(spark, docs))
    questions = spark.createDataFrame([(1, [1.0])], "question_id long, embedding array<double>")
    assert VS.search(store, questions, exact=True).count() == 0
    assert VS.bucket_topk(questions, docs).count() == 0


TEXTS = [(i, f"bank{i % 20} had complaints{i // 20} about cards in a month") for i in range(200)]


@pytest.mark.parametrize("kind", ["tfidf", "hashed"])
def test_any_fitted_embedder_travels_with_the_store(spark, kind):
    docs = spark.createDataFrame(TEXTS, "doc_id long, page_content string")
    if kind == "tfidf":
        model = fit_tfidf(docs, "page_content", 64)
    else:
        model = PipelineModel([RegexTokenizer(inputCol="page_content", outputCol="words", pattern="\\W+"), HashingTF(inputCol="words", outputCol="tfidf", numFeatures=4096)])
    path = written(spark, docs, embedder=model)
    questions = spark.createDataFrame([(1, TEXTS[7][1]), (2, TEXTS[100][1])], "question_id long, question string")
    store = VS.open_store(spark, path)
    found = hits(VS.ask(store, questions, "page_content", k=1))
    assert [(q, d) for q, _, d, _ in found] == [(1, 7), (2, 100)]
    VS.append_docs(spark.createDataFrame([(999, TEXTS[7][1])], "doc_id long, page_content string"), path)
    again = hits(VS.ask(VS.open_store(spark, path), questions, "page_content", k=2))
    assert [d for q, _, d, _ in again if q == 1] == [7, 999]
