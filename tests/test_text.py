import hashlib
import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from casewatch.fixed_values import ANSWER_HEADER, ANSWER_INTRO
from casewatch.operators import retrieval as N
from casewatch.operators import text_classes as M
from casewatch.operators.text_features import embed, fit_tfidf, term_statistics, tfidf_weights, vocabulary_of
from casewatch.session import new_table_path
from verification.oracle import STOP_WORDS


def test_stop_words_of_the_oracle_are_sparks(spark):
    spark_words = StopWordsRemover.loadDefaultStopWords("english")
    assert set(STOP_WORDS) == {w for w in spark_words if "'" not in w}


@pytest.mark.parametrize("test", [0.2, 0.5])
def test_split_is_exact_per_class_with_a_hot_class(spark, test):
    rows = [(i, "hot" if i % 3 else f"c{i % 7}") for i in range(3000)] + [(3000, None), (3001, "single")]
    df = spark.createDataFrame(rows, "id long, label string").repartition(8)
    got = M.stratified_split(df, "label", "id", test=test).collect()
    assert len(got) == len(rows)
    by_class = {}
    for r in got:
        by_class.setdefault(r.label, []).append(r)
    for members in by_class.values():
        train = math.floor(len(members) * (1 - test) + 1e-9)
        assert sum(r.is_train for r in members) == train
        ordered = sorted(members, key=lambda r: (hashlib.md5(f"{r.id}-42".encode()).hexdigest(), str(r.id)))
        assert [r.is_train for r in ordered] == [False] * (len(members) - train) + [True] * train
    again = M.stratified_split(df.repartition(3), "label", "id", test=test).collect()
    assert sorted((r.id, r.is_train) for r in again) == sorted((r.id, r.is_train) for r in got)


DOCS = [(1, "The cat sat, the CAT ran"), (2, "A dog sat"), (3, "dog dog über-dog x"), (4, "the of and")]


def test_tfidf_against_formula(spark):
    df = spark.createDataFrame(DOCS, "doc_id int, text string")
    stats = {r.term: (r.term_count, r.doc_count) for r in term_statistics(df).collect()}
    assert stats == {"cat": (2, 1), "sat": (2, 2), "ran": (1, 1), "dog": (4, 2), "über": (1, 1)}
    model = fit_tfidf(df, size=3)
    assert vocabulary_of(model) == ["cat", "dog", "sat"]  # cat before sat on a tie, x is no token
    idf = {t: math.log(5 / (1 + n)) + 1 for t, n in (("cat", 1), ("dog", 2), ("sat", 2))}
    got = {(r.doc_id, r.term): r.weight for r in tfidf_weights(model, df, "doc_id").collect()}
    norm = math.hypot(2 * idf["cat"], idf["sat"])
    assert got[(1, "cat")] == pytest.approx(2 * idf["cat"] / norm) and got[(1, "sat")] == pytest.approx(idf["sat"] / norm)
    assert got[(3, "dog")] == pytest.approx(1.0) and not any(k[0] == 4 for k in got)
    zero = embed(model, spark.createDataFrame([(9, "nothing known")], "doc_id int, text string")).first()
    assert zero.embedding == [0.0, 0.0, 0.0]


@pytest.fixture(scope="module")
def trained(spark):
    words = {"fraud": "upi phishing otp stolen", "loan": "interest emi sanction delay", "card": "billing annual fee charged"}
    rows = [
        (i, " ".join(np.random.default_rng(i).choice((words[label] + " bank account money").split(), 6)), ["Online", "Branch"][i % 2], label)
        for i, label in enumerate(list(words) * 40)
    ]
    df = spark.createDataFrame(rows, "id int, complaint_text string, channel string, complaint_category string")
    split = M.stratified_split(df, "complaint_category", "id").cache()
    return split, M.train_classifier(split.filter("is_train"), vocab=50)


def test_classifier_learns_saves_and_scores_unseen_channels(spark, trained):
    split, model = trained
    path = new_table_path(spark, "model")
    model.write().save(path)
    loaded = PipelineModel.load(path)
    held_out = split.filter("NOT is_train").drop("complaint_category")
    scored = M.score(loaded, held_out).join(split.select("id", F.col("complaint_category").alias("label")), "id")
    report = {r.label: r for r in M.classification_report(scored).collect()}
    assert report["accuracy"].f1 > 0.8 and report["accuracy"].support == 24
    odd = spark.createDataFrame([(1, "upi phishing stolen otp", "Carrier pigeon"), (2, "", "Online")], "id int, complaint_text string, channel string")
    rows = {r.id: r for r in M.score(loaded, odd).collect()}
    assert rows[1].predicted_category == "fraud" and rows[1].confidence > 50
    assert rows[1].asDict().keys() == {"id", "complaint_text", "channel", "predicted_category", "confidence"}
    p = M.class_probabilities(loaded, odd, "id").groupBy("id").agg(F.sum("probability").alias("s"), F.count("*").alias("n")).collect()
    assert all(r.n == 3 and r.s == pytest.approx(1.0) for r in p)


def test_report_against_hand_count(spark):
    pairs = [("a", "a")] * 3 + [("a", "b")] + [("b", "b")] * 2 + [("c", "a")] + [("a", "z")]
    df = spark.createDataFrame(pairs, "label string, predicted_category string")
    r = {x.label: x for x in M.classification_report(df).collect()}
    assert (r["a"].precision, r["a"].recall, r["a"].support) == (0.75, 0.6, 5)
    assert (r["c"].precision, r["c"].recall, r["c"].f1) == (0.0, 0.0, 0.0) and r["z"].support == 0
    assert r["accuracy"].f1 == 5 / 8 and r["weighted avg"].recall == pytest.approx(5 / 8)
    assert r["macro avg"].recall == pytest.approx((0.6 + 1 + 0 + 0) / 4)
    m = {x.label: x for x in M.confusion_matrix(df, ["a", "b"]).collect()}
    assert (m["a"]["a"], m["a"]["b"], m["a"]["other"], m["b"]["a"]) == (3, 1, 1, 0)


def test_keyword_rules_first_match_wins(spark):
    texts = ["UPI loan", "Cash lost", "my Credit Card", "EMI", "KYC", "hello", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = [r.predicted_category for r in M.keyword_classify(df, "id", "text").orderBy("id").collect()]
    assert got == ["Digital Banking Fraud", "ATM/Debit Card Issues", "Credit Card Complaints", "Loan & EMI Disputes", "Account Operations", "Other", "Other"]


# --- retrieval ---------------------------------------------------------------------------------


def brute_force(questions, docs, k, same):
    out = set()
    for q, qv in questions:
        ranked = sorted((math.dist(qv, dv), d) for d, dv in docs if not (same and d == q))[:k]
        out |= {(q, d, i + 1) for i, (_, d) in enumerate(ranked)}
    return out


@pytest.mark.parametrize("options", [{}, {"questions_per_block": 7, "docs_per_block": 11}])
@pytest.mark.parametrize("same", [False, True])
def test_knn_is_exact_with_many_equal_distances(spark, options, same):
    rng = np.random.default_rng(5)
    vectors = [tuple(map(float, v)) for v in rng.integers(0, 3, (120, 4))]  # a third are equal copies
    vectors[40:80] = [vectors[0]] * 40
    rows = list(enumerate(vectors))
    docs = spark.createDataFrame([(i, list(v)) for i, v in rows], "doc_id long, embedding array<double>").repartition(5)
    questions = docs.select(F.col("doc_id").alias("question_id"), "embedding")
    hits = N.knn_topk(questions, docs, k=5, exclude_self=same, **options).collect()
    assert {(r.question_id, r.doc_id, r["rank"]) for r in hits} == brute_force(rows, rows, 5, same)
    if not same:
        assert all(r.distance == 0 for r in hits if r["rank"] == 1)


def test_small_blocks_do_not_multiply_copies_or_hits(spark, monkeypatch):
    docs = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(np.random.default_rng(3).standard_normal((200, 4)))], "doc_id long, embedding array<float>")
    questions, local, rank = docs.withColumnRenamed("doc_id", "question_id"), [], N._rank_hits
    wanted = sorted(map(tuple, N.knn_topk(questions, docs, exclude_self=True).collect()))
    monkeypatch.setattr(N, "_rank_hits", lambda found, k: local.append(found) or rank(found, k))
    small = N.knn_topk(questions, docs, exclude_self=True, questions_per_block=20, docs_per_block=30)
    assert sorted(map(tuple, small.collect())) == wanted
    assert local[0].count() == 200 * 5  # not as many again for each block of documents


def test_knn_passes_over_values_that_are_not_finite(spark):
    nan = float("nan")
    docs = spark.createDataFrame([(1, [1.0, 0.0])] + [(i, [nan, 0.0]) for i in range(2, 6)] + [(7, [float("inf"), 0.0])], "doc_id long, embedding array<double>")
    questions = spark.createDataFrame([(9, [0.0, 0.0]), (10, [nan, 0.0])], "question_id long, embedding array<double>")
    assert [(r.question_id, r.doc_id) for r in N.knn_topk(questions, docs, k=2).collect()] == [(9, 1)]


def test_knn_smaller_than_k_and_missing_vectors(spark):
    docs = spark.createDataFrame([(1, [0.0, 1.0]), (2, [3.0, 1.0]), (3, None)], "doc_id long, embedding array<double>")
    questions = spark.createDataFrame([(9, [0.0, 0.0])], "question_id long, embedding array<double>")
    assert [(r.doc_id, r["rank"], r.distance) for r in N.knn_topk(questions, docs).orderBy("rank").collect()] == [(1, 1, 1.0), (2, 2, math.sqrt(10))]


def test_zero_question_ranks_by_id_among_unit_vectors(spark):
    docs = spark.createDataFrame([(i, [1.0, 0.0] if i % 2 else [0.0, 1.0]) for i in range(9)], "doc_id long, embedding array<double>")
    questions = spark.createDataFrame([(0, [0.0, 0.0])], "question_id long, embedding array<double>")
    assert [r.doc_id for r in N.knn_topk(questions, docs, k=3).orderBy("rank").collect()] == [0, 1, 2]


def test_context_and_answer(spark):
    corpus = spark.createDataFrame(
        [("a", "text a", {"bank_name": "A", "year": "2024", "source": "monthly_summary"}), ("b", "text b", {"source": "policy_flags"})],
        "doc_id string, page_content string, metadata map<string,string>",
    )
    hits = spark.createDataFrame([(1, "b", 2), (1, "a", 1)], "question_id int, doc_id string, rank int")
    context = N.retrieval_context(hits, corpus)
    row = context.first()
    assert row.context == "text a\n\ntext b"
    assert [tuple(s) for s in row.sources] == [("text a", "A", "2024", "monthly_summary"), ("text b", "N/A", "N/A", "policy_flags")]
    questions = spark.createDataFrame([(1, "Why {so}?")], "question_id int, question string")
    answer = N.template_answers(questions, context).first().answer
    intro = ANSWER_INTRO.format(header=ANSWER_HEADER, k=5, question="Why {so}?")
    assert answer.startswith(intro) and "\n- text a\n- text b\n" in answer


def test_routes_and_lines(spark):
    df = spark.createDataFrame([("Highest?",), ("digital",), ("fraud growth",), ("x",), (None,)], "question string")
    assert [r.route for r in N.route_questions(df).collect()] == ["growth", "fraud_states", "growth", "flags", "flags"]
    states = spark.createDataFrame([("Goa", 3)], "state string, complaint_count long")
    assert N.route_lines("fraud_states", states).first().line == "- Goa recorded 3 digital fraud complaints."


def test_narrative_without_mean(spark):
    summary = spark.createDataFrame([(1, 2024, 2, 4, 0, 4, 0, None, 33.33)],
        "bank_id int, year int, month int, total_complaints long, resolved_count long, pending_count long, escalated_count long, avg_resolution_days double, complaint_growth_pct double")
    banks = spark.createDataFrame([(1, "A", "Public Sector")], "bank_id int, bank_name string, bank_type string")
    row = N.summary_narratives(summary, banks).first()
    assert row.page_content == (
        "In February 2024, A (Public Sector) received a total of 4 consumer complaints. Out of these, 0 were resolved (resolution rate of 0.0%), "
        "4 remain pending, and 0 were escalated. The average resolution time for resolved complaints was nan days. "
        "The month-over-month complaint volume growth for this bank was 33.33%."
    )
    assert row.metadata == {"source": "monthly_summary", "bank_name": "A", "year": "2024", "month": "2", "type": "summary"}


@pytest.mark.parametrize("rows_in_a_task", [1, 30, 100_000])
def test_split_is_the_same_whatever_one_task_may_order(spark, monkeypatch, rows_in_a_task):
    monkeypatch.setattr(M, "EDGE_ROWS", rows_in_a_task)
    df = spark.range(3000).selectExpr("id AS key", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL ELSE 'rest' END AS label")
    split = M.stratified_split(df, "label", "key").collect()
    order = lambda r: hashlib.md5(f"{r['key']}-42".encode()).hexdigest() + f"/{r['key']}"
    for label in ("hot", "rest", None):
        mine = sorted((r for r in split if r["label"] == label), key=order)
        n_test = len(mine) - math.floor(len(mine) * 0.8 + 1e-9)
        assert [r["is_train"] for r in mine] == [False] * n_test + [True] * (len(mine) - n_test)


def test_a_text_that_repeats_no_token_gives_one_entry_a_token(spark):
    docs = spark.createDataFrame([("red green blue",), ("red red blue the",), ("", ), (None,), ("the and",)], "text string")
    found = term_statistics(docs)
    assert {tuple(r) for r in found.collect()} == {("red", 3, 2), ("green", 1, 1), ("blue", 2, 2)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN (size(" in plan
