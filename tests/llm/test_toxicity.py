import math
import random

import numpy as np
import pytest

from casewatch.llm import toxicity as T

DOCS = "doc_id long, text string, lang string"


def features_by_hand(text):
    words = "".join(c if c.isalnum() and c.isascii() or not c.isascii() else " " for c in text).split()
    words = ["".join(c.lower() if c.isascii() else c for c in w) for w in words]
    found = {(0, w, "") for w in words}
    for gap in (1, 2, 3):
        found |= {(gap, a, b) for a, b in zip(words, words[gap:])}
    return found


def sample(n, seed, share=0.3):
    """Texts of common words; toxic ones hold one of a few bad words or a bad pair with a word between."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [f"w{rng.randrange(150)}" for _ in range(rng.randrange(5, 60))]
        toxic = rng.random() < share
        if toxic:
            at = rng.randrange(len(words))
            words[at:at] = rng.choice([["Nasty!"], ["rotten,"], ["foul", f"w{rng.randrange(150)}", "creature"]])
        elif rng.random() < 0.3:
            words += [rng.choice(["foul", "creature"])]
        rows.append((i, " ".join(words), "en", int(toxic)))
    return rows


def frames(spark, rows):
    docs = spark.createDataFrame([r[:3] for r in rows], DOCS).selectExpr("*", "1 as label", "2 as `order`", "3 as score", "'x' as features").repartition(3)
    labels = spark.createDataFrame([(r[0], 1, r[3]) for r in rows], "doc_id long, quality int, toxic int")
    return docs, labels


def test_features_are_words_pairs_and_skipped_pairs():
    texts = ["One two, THREE four-five two", "", "ü one", "a a a a a a"]
    whose, found = T.Reader().features(texts)
    for i, text in enumerate(texts):
        assert len(set(found[whose == i].tolist())) == len(features_by_hand(text))
    assert set(found[whose == 0]) & set(found[whose == 2]) == {T.Reader().features(["one"])[1][0]}


def test_slices_change_nothing(monkeypatch):
    text = " ".join(f"word{i * i % 97}" for i in range(500))
    whole = set(T.Reader().features([text])[1].tolist())
    monkeypatch.setattr(T, "SLICE", 30)
    assert set(T.Reader().features([text])[1].tolist()) == whole


def ftrl_by_hand(rows, n, passes):
    z, squares = [0.0] * (n + 1), [0.0] * (n + 1)
    l1 = T.L1 * passes * math.sqrt(len(rows))

    def weight(i):
        penalty = l1 if i < n else 0.0
        return 0.0 if abs(z[i]) <= penalty else -(z[i] - math.copysign(penalty, z[i])) * T.ALPHA / (T.BETA + math.sqrt(squares[i]))

    for _ in range(passes):
        for label, at in rows:
            at = [*at, n]
            w = [weight(i) for i in at]
            g = 1 / (1 + math.exp(-sum(w))) - label
            for i, v in zip(at, w):
                rate = (math.sqrt(squares[i] + g * g) - math.sqrt(squares[i])) / T.ALPHA
                z[i] += g - rate * v
                squares[i] += g * g
    return [weight(i) for i in range(n + 1)]


def test_ftrl_equals_the_plain_recursion():
    rng = random.Random(3)
    rows = [(rng.randrange(2), np.array(sorted(rng.sample(range(12), rng.randrange(6))), np.int64)) for _ in range(80)]
    weights, intercept = T.ftrl(rows, 12, 3)
    assert np.allclose([*weights, intercept], ftrl_by_hand([(y, a.tolist()) for y, a in rows], 12, 3), atol=1e-9)


def test_held_out_documents_are_told_apart(spark):
    docs, labels = frames(spark, sample(1500, 1))
    model = T.train(docs, labels)
    assert 3 <= len(model.features) < 200  # sparse
    new = sample(400, 2)
    got = {r["doc_id"]: r["score"] for r in T.score(frames(spark, new)[0], model).collect()}
    right = sum((got[r[0]] >= T.TOXIC_FROM) == (r[3] == 1) for r in new)
    assert right >= 390
    assert not [r for r in new if r[3] == 0 and got[r[0]] >= T.TOXIC_FROM]


def test_rare_label_is_kept_by_the_sample_and_the_intercept_corrected(spark):
    docs, labels = frames(spark, sample(3000, 3, share=0.05))
    model = T.train(docs, labels, rows=200)
    plain = [r["score"] for r in T.score(spark.createDataFrame([(1, "w1 w2", "en"), (2, None, None)], DOCS), model).collect()]
    assert all(s < 0.2 for s in plain)
    bad = T.score(spark.createDataFrame([(1, "w1 nasty w2", "en")], DOCS), model).first()["score"]
    assert bad > 3 * plain[0]


def test_same_result_from_other_partitions(spark):
    docs, labels = frames(spark, sample(300, 4))
    a, b = T.train(docs, labels), T.train(docs.repartition(7), labels.repartition(2))
    assert a.features.tolist() == b.features.tolist() and np.array_equal(a.weights, b.weights) and a.intercept == b.intercept


def test_nulls_repeats_empty_tables_and_missing_labels(spark):
    docs, labels = frames(spark, sample(100, 5))
    empty_labels = labels.limit(0)
    assert {r["score"] for r in T.score(docs, T.train(docs, empty_labels)).collect()} == {0.0}
    model = T.train(docs.unionByName(docs), labels.unionByName(labels))
    assert model.features.tolist() == T.train(docs, labels).features.tolist()
    odd = spark.createDataFrame([(None, None, None), (None, "nasty", None), (7, "", "x"), (7, "", "x"), (8, "nasty " * 200_000, "x")], DOCS)
    got = T.score(odd, model).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
    assert T.score(docs.limit(0), model).count() == 0
    one_kind = labels.selectExpr("doc_id", "1 as toxic")
    assert all(r["score"] > 0.9 for r in T.score(docs, T.train(docs, one_kind)).collect())


def test_query_reads_no_label_of_the_held_out_fold(spark, sf_dir):
    rows = T.op12(spark, sf_dir).collect()
    assert {r["predicted"] for r in rows} <= {0, 1} and all((r["score"] >= 0.7) == (r["predicted"] == 1) for r in rows)
    assert {r["held_out"] for r in rows} == {True, False}
