from collections import Counter
from math import comb

import pytest

from casewatch.llm import quality as Q

DOCS = "doc_id long, lang string, text string, stratum int"


def plain(text):
    words = (text or "").encode().split()
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    repeated = {j for i, w in enumerate(windows) if w in twice for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\r\x0b\x0c")]
    return len(words), sum(len(w.decode()) for w in words), sum((text or "").count(c) for c in Q.SYMBOLS), len(lines) - len(set(lines)), len(repeated)


def test_counts_by_hand(spark):
    texts = ["", None, "a b c d e a b c d e", "a b c d e f\na b c d e f\n\n \nx", "ü # € $ %\u00a0& | <tag> *", "one\r\none\r\ntwo", "w " * 40_000, "a b a b a b a b", "a b c d"]
    frame = spark.createDataFrame([(i, "en", t, 0) for i, t in enumerate(texts)] + [(None, None, "x", 0)], DOCS).coalesce(1)
    got = {r["doc_id"]: r for r in Q.features(frame).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == plain(t), t
    assert got[None]["stratum"] == "/0"


def test_binomial_tail_is_exact():
    for n in (1, 5, 40, 200):
        for k in range(n + 1):
            want = sum(comb(n, i) * 0.05**i * 0.95 ** (n - i) for i in range(k + 1)) if k < 0.05 * n else 1.0
            assert Q.binomial_tail(k, n, 0.05) == pytest.approx(want, rel=1e-9)
    assert Q.binomial_tail(0, 10**7, 0.02) == 0.0 and Q.binomial_tail(0, 0, 0.02) == 1.0


def test_cutoffs_need_enough_labels_and_keep_good_documents(spark):
    good = " ".join(f"w{i}" for i in range(30))
    bad = " ".join(f"w{i}#" for i in range(30))
    rows = [(i, "en", good, 0) for i in range(1500)] + [(2000 + i, "en", bad, 0) for i in range(60)] + [(3000 + i, "fr", bad if i % 2 else good, 0) for i in range(40)]
    rows += [(4000, "en", None, 0), (4001, "en", "few words", 0), (4001, "en", "few words", 0)]
    labels = [(i, 1 if t == good else 0) for i, _, t, _ in rows if i < 4000] + [(1, 1), (2, None), (None, 1)]
    judged = Q.features(spark.createDataFrame(rows, DOCS))
    chosen = Q.cutoffs(judged, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert {(r["stratum"], r["rule"]) for r in chosen.collect()} == {("en/0", "symbols")}
    kept = {r["doc_id"]: r["kept"] for r in Q.judge(judged, chosen).collect()}
    assert all(kept[i] for i in range(1500)) and not any(kept[2000 + i] for i in range(60))
    assert all(kept[3000 + i] for i in range(40))  # too few labels to rule out a harm
    assert not kept[4000] and not kept[4001]


def test_rules_keep_the_limit_together(spark):
    shapes = {"plain": "w{}", "symbols": "w{}#", "long_words": "longlonglong{}", "capitals": "A{}B"}
    texts = {k: " ".join(v.format(i) for i in range(30)) for k, v in shapes.items()}
    made = [("plain", 1)] * 2925 + [(k, 1) for k in shapes if k != "plain" for _ in range(25)] + [(k, 0) for j, k in enumerate(shapes) if k != "plain" for _ in range(300 + 10 * j)]
    judged = Q.features(spark.createDataFrame([(i, "en", texts[k], 0) for i, (k, _) in enumerate(made)], DOCS))
    chosen = Q.cutoffs(judged, spark.createDataFrame([(i, q) for i, (_, q) in enumerate(made)], "doc_id long, quality int"))
    assert [r["rule"] for r in chosen.collect()] == ["capitals"]  # each of three rules keeps the limit alone
    kept = {r["doc_id"]: r["kept"] for r in Q.judge(judged, chosen).collect()}
    assert sum(not kept[i] for i in range(3000)) < Q.LIMIT * 3000


def test_empty_tables(spark):
    judged = Q.features(spark.createDataFrame([], DOCS))
    assert Q.judge(judged, Q.cutoffs(judged, spark.createDataFrame([], "doc_id long, quality int"))).count() == 0
