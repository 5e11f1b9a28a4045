import itertools
import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from casewatch.llm import hmm as H

SCHEMA = "doc_id long, text string, score double"


def brute_likelihood(classes, start, step, emit):
    """Sum over all paths of hidden states."""
    total = 0.0
    for path in itertools.product(range(len(start)), repeat=len(classes)):
        p = start[path[0]] * emit[classes[0], path[0]]
        for a, b, c in zip(path, path[1:], classes[1:]):
            p *= step[a, b] * emit[c, b]
        total += p
    return math.log10(total)


def random_model(states, classes, seed=0):
    rng = np.random.default_rng(seed)
    normal = lambda x, axis: x / x.sum(axis=axis, keepdims=True)
    return normal(rng.random((2, states)), 1), normal(rng.random((states, states)), 1), normal(rng.random((classes, states)), 0)


def test_forward_is_the_sum_over_all_paths():
    starts, step, emit = random_model(3, 5)
    sequences = [[0], [4, 1, 2], [3, 3, 3, 0, 1, 2], [2, 2]]
    got = H.forward(np.concatenate(sequences), np.array([len(s) for s in sequences]), starts[1], step, emit)
    assert np.allclose(got, [brute_likelihood(s, starts[1], step, emit) for s in sequences])


def test_expected_counts_and_growing_likelihood(monkeypatch):
    monkeypatch.setattr(H, "CLASSES", 6)
    monkeypatch.setattr(H, "CHUNK", 7)
    rng = np.random.default_rng(1)
    sequences = [rng.integers(0, 6, n).astype(np.uint16) // (1 + i % 2) for i, n in enumerate((1, 5, 7, 8, 30, 15))]
    starts, step, emit = random_model(3, 6)
    model = {"starts": starts, "step": step, "emit": emit}
    flat, lengths, first = H.chunked(sequences)
    assert lengths.sum() == len(flat) == sum(map(len, sequences)) and first.sum() == len(sequences) and lengths.max() <= 7

    def likelihood(m):
        return sum(H.forward(flat[b : b + n], np.array([n]), m["starts"][int(f)], m["step"], m["emit"])[0] for b, n, f in zip(np.cumsum(lengths) - lengths, lengths, first))

    last = likelihood(model)
    for _ in range(8):
        emissions, steps, opening = H.expected(flat, lengths, first, model["starts"], model["step"], model["emit"])
        assert np.isclose(emissions.sum(), len(flat)) and np.isclose(steps.sum(), len(flat) - len(lengths)) and np.allclose(opening.sum(1), [(~first).sum(), first.sum()])
        assert np.allclose(emissions.sum(1), np.bincount(flat, minlength=6))
        model = {"emit": emissions / emissions.sum(0), "step": steps / steps.sum(1, keepdims=True), "starts": opening / opening.sum(1, keepdims=True)}
        now = likelihood(model)
        assert now >= last - 1e-9
        last = now


def scored(spark, rows):
    frame = spark.createDataFrame([(i, t, 1.0) for i, t in rows], SCHEMA)
    return {r["doc_id"]: r for r in H.score(frame, F.col("doc_id") % 5 == 0).collect()}


def test_base_scores_by_hand_with_rare_words(spark, monkeypatch):
    monkeypatch.setattr(H, "DICTIONARY", 20)
    monkeypatch.setattr(H, "OWN", 5)
    monkeypatch.setattr(H, "END", 5)
    monkeypatch.setattr(H, "CLASSES", 6 + H.SHAPES)
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(rng.choice(words, rng.integers(1, 40)) if i % 2 else rng.choice(words[:9], 12))) for i in range(1, 60)]
    rows += [(100, None), (101, ""), (105, "ÜBER never\tSeen w1"), (110, "W1 w1")]
    got = scored(spark, rows)
    tokens = {i: [*H.words_of(t or ""), b""] for i, t in rows}
    c = Counter(w for i, ws in tokens.items() if i % 5 for w in ws)
    n, v = sum(c.values()), len(c)
    for i, ws in tokens.items():
        assert math.isclose(got[i]["base_score"], sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
        assert (got[i]["n_tokens"], got[i]["n_known"], got[i]["train_tokens"]) == (len(ws), sum(w in c for w in ws), n)
        assert got[i]["held_out"] == (i % 5 == 0) and math.isfinite(got[i]["score"]) and got[i]["score"] < 0


def test_words_and_one_unknown_per_class_sum_to_one(spark):
    counts = H.count_tokens(spark.createDataFrame([("a a b c d e zz yy",), ("a b",)], "text string"))
    words = H.Words(counts)
    own = [w for w, i in words.index.items() if words.classes[i] <= H.END]
    assert set(own) == set(words.index) and words.n_tokens == 12 and words.n_words == 8
    assert np.allclose(words.log_total, 0.0)  # every word is a class of its own, so a shape holds its unknown word only


def test_empty_table_and_no_training_rows(spark):
    assert scored(spark, []) == {}
    got = scored(spark, [(5, "some words"), (10, None)])
    assert got[5]["n_known"] == 0 and got[5]["train_tokens"] == 0 and got[10]["n_tokens"] == 1 and math.isfinite(got[5]["score"])
