import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from casewatch.llm import langid as L

SYLLABLES = {"xx": "ba be bi bo bu da de di".split(), "yy": "ka ke ki ko ku ta te ti".split(), "zz": "ñå ßø üü öä çé łó ya ba".split()}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def trained(spark):
    rng = random.Random(4)
    rows = [(lang, i % 4 == 0, text(rng, lang, rng.randint(1, 60))) for lang in SYLLABLES for i in range(80)] + [(None, False, "ignored"), ("xx", False, None)]
    return L.train(spark.createDataFrame(rows, "lang string, held boolean, text string"))


def test_probabilities_of_the_next_character_sum_to_one(spark):
    counts = L.count_ngrams(spark.createDataFrame([("xx", False, "abac abad ba cab")] * 2, "lang string, held boolean, text string"))
    model = L.build_model(counts.drop("held"))
    chars = np.array([ord(c) for c in " abcd"], np.uint64)
    for context in ("aba", "cab", "zzz", " ab", "\0\0\0"):
        a, b, c = (np.uint64(0 if x == "\0" else ord(x)) for x in context)
        keys = (a << np.uint64(48)) | (b << np.uint64(32)) | (c << np.uint64(16)) | chars
        p = 2.0 ** L.log_probabilities(model, keys)[:, 0]
        unseen = 2.0 ** L.log_probabilities(model, keys[:1] - chars[0] + np.uint64(ord("q")))[0, 0]
        assert p.sum() + unseen == pytest.approx(1, abs=1e-5)  # the unseen character stands for all others


def test_ngrams_begin_anew_with_each_text():
    keys, starts = L.ngrams(["Ab  c", "", "1!", "d"], L.letter_table())
    unpacked = lambda k: "".join(chr(int(k) >> s & 0xFFFF or 95) for s in (48, 32, 16, 0))
    assert starts.tolist() == [0, 4, 4, 4]
    assert [unpacked(k) for k in keys] == ["___a", "__ab", "_ab ", "ab c", "___d"]


def test_held_out_accuracy_rejection_and_defined_cases(spark, trained):
    rng = random.Random(11)
    rows = [(i, text(rng, lang, 8), lang) for i, lang in enumerate(sorted(SYLLABLES) * 30)]
    rows += [(900, None, None), (901, "", None), (902, "12 %% 34", None), (903, "qwxzvjh " * 30, None), (904, "ba" * 30_000, None), (0, rows[0][1], "xx")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, score string").repartition(3)
    got = {r["doc_id"]: r for r in L.identify(frame, *trained).collect()}
    assert L.identify(frame, *trained).count() == len(rows)
    right = [got[i]["lang_pred"] == lang for i, _, lang in rows[:90]]
    assert np.mean(right) > 0.97 and np.mean([got[i]["accepted"] for i in range(90)]) > 0.95
    for i in (900, 901, 902):
        assert (got[i]["lang_pred"], got[i]["score"], got[i]["accepted"]) == ("und", 0.0, False)
    assert not got[903]["accepted"] and got[904]["lang_pred"] == "xx"
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_empty_tables(spark):
    model, rule = L.train(spark.createDataFrame([], "lang string, held boolean, text string"))
    got = L.identify(spark.createDataFrame([(1, "some text")], "doc_id long, text string"), model, rule).collect()
    assert [(r["lang_pred"], r["score"], r["accepted"]) for r in got] == [("und", 0.0, False)]


def test_counts_follow_the_rows(spark):
    texts = ["abc abc", "abd", None]
    counts = L.count_ngrams(spark.createDataFrame([("xx", False, t) for t in texts if t], "lang string, held boolean, text string"))
    assert counts.agg(F.sum("n")).first()[0] == sum(Counter(map(len, filter(None, texts))).elements())


def noisy(rng, wrong, n=20_000):
    """Cells of texts that are all recognised, with scores as a good model gives them and a share of wrong labels."""
    cells = {}
    for _ in range(n):
        cell = int(1000 * (1 - rng.random() ** 4 / 2))
        k, r = cells.get(cell, (0, 0))
        cells[cell] = k + 1, r + (rng.random() >= wrong)
    return [(cell, k, r) for cell, (k, r) in cells.items()]


@pytest.mark.parametrize("wrong", [0.0, 0.02, 0.05, 0.33])
def test_wrong_labels_at_every_score_reject_nothing(wrong):
    for seed in range(5):
        cells = noisy(random.Random(seed), wrong)
        least = L.least_score(cells)
        assert sum(k for cell, k, _ in cells if cell / 1000 >= least) >= 0.99 * 20_000


def test_low_scores_that_are_wrong_more_often_are_rejected():
    for wrong in (0.0, 0.03):
        cells = [(cell, 100, round(100 * (1 - wrong) * (0.4 if cell < 700 else 1.0))) for cell in range(500, 1000)]
        assert 0.6 < L.least_score(cells) <= 0.7
    assert L.least_score([(400, 1000, 300), (999, 600, 600)]) == 0.999 and L.least_score([(999, 5, 3)]) == 0.0 and L.least_score([]) == 0.0


def test_clean_documents_stay_when_labels_are_wrong(spark):
    rng = random.Random(21)
    langs = sorted(SYLLABLES)
    rows = []
    for i in range(1200):
        true = langs[i % 3]
        lang = rng.choice([x for x in langs if x != true]) if rng.random() < 0.04 else true
        rows.append((lang, i % 4 == 0, text(rng, true, rng.randint(4, 40))))
    model, rule = L.train(spark.createDataFrame(rows, "lang string, held boolean, text string"))
    clean = spark.createDataFrame([(i, text(rng, langs[i % 3], 12)) for i in range(150)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in L.identify(clean, model, rule).collect()}
    assert np.mean([r["accepted"] and r["lang_pred"] == langs[i % 3] for i, r in got.items()]) > 0.95


def test_unseen_ngrams_are_not_found_in_a_large_model():
    rng = np.random.default_rng(5)
    have = np.unique(rng.integers(0, 1 << 63, 1_500_000, dtype=np.uint64))
    model = {"langs": ["xx", "yy"], "none": np.zeros(2, np.float32), (4, "p"): [(have[::2], np.zeros(len(have[::2]), np.float32)), (have[:0], np.zeros(0, np.float32))]}
    got = L.found(model, 4, "p", np.concatenate([have[1:20_001:2], have[0:20_000:2]]))
    assert np.isnan(got[:10_000, 0]).all() and (got[10_000:, 0] == 0).all() and np.isnan(got[:, 1]).all()


def test_the_model_holds_every_ngram_whole(spark):
    counts = L.count_ngrams(spark.createDataFrame([("xx", False, "abac abad"), ("yy", False, "kaka")], "lang string, held boolean, text string")).drop("held")
    model = L.build_model(counts)
    for i, lang in enumerate(model["langs"]):
        want = sorted(r["key"] for r in counts.filter(F.col("lang") == lang).collect())
        assert model[4, "p"][i][0].tolist() == want


def test_letters_above_the_basic_plane_differ():
    letters = L.letter_table()
    a, _ = L.ngrams(["\U00020000"], letters)
    b, _ = L.ngrams(["\U00020001"], letters)
    assert a.tolist() != b.tolist() and len(a) == len(b) == 2
    upper, starts = L.ngrams(["\U00010400x", "", "y\U00010428"], letters)
    lower, _ = L.ngrams(["\U00010428X", "", "y\U00010400"], letters)
    assert upper.tolist() == lower.tolist() and starts.tolist() == [0, 3, 3]
