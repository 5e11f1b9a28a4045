import random

import pytest

from casewatch.llm.line_dedup import MIN_WORDS, dedup_lines, later_copies


def brute_force(texts, min_words):
    """Lines deleted by the longest run from each line that also begins at an earlier line."""
    docs = [t.split("\n") for t in texts]
    places = [(d, i) for d, lines in enumerate(docs) for i in range(len(lines))]
    gone = set()
    for d, i in places:
        best = 0
        for e, j in places:
            if (e, j) >= (d, i):
                break
            n = 0
            while i + n < len(docs[d]) and j + n < len(docs[e]) and docs[d][i + n] == docs[e][j + n]:
                n += 1
            best = max(best, n)
        if sum(len(x.split()) for x in docs[d][i : i + best]) >= min_words and best:
            gone |= {(d, k) for k in range(i, i + best)}
    return ["\n".join(x for k, x in enumerate(lines) if (d, k) not in gone) for d, lines in enumerate(docs)]


def cleaned(spark, rows, min_words):
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, uid string")
    return [(r["doc_id"], r["text"], r["n_deleted"]) for r in dedup_lines(frame, min_words).collect()]


@pytest.mark.parametrize("seed, min_words", [(1, 3), (2, 5), (3, 8), (4, 1)])
def test_deletions_are_those_of_maximal_runs(spark, seed, min_words):
    rng = random.Random(seed)
    lines = ["", "a", "b b", "c c c", "d", "e e", " "]
    texts = ["\n".join(rng.choice(lines[: rng.randint(2, 7)]) for _ in range(rng.randint(1, 14))) for _ in range(25)]
    texts += [texts[3], texts[5] + "\n" + texts[6], "a\n" * 20]
    got = dict((i, t) for i, t, _ in cleaned(spark, list(enumerate(texts)), min_words))
    assert [got[i] for i in range(len(texts))] == brute_force(texts, min_words)


def test_nulls_repeats_missing_ids_and_clashing_names(spark):
    passage = "\n".join(f"line {i} of a passage" for i in range(20))
    rows = [(1, None), (2, ""), (3, passage), (3, passage), (None, passage), (4, "own\n" + passage + "\ntail"), (5, "short")]
    got = sorted(cleaned(spark, rows, MIN_WORDS), key=str)
    want = [(1, None, 0), (2, "", 0), (3, "", 20), (3, "", 20), (None, passage, 0), (4, "own\ntail", 20), (5, "short", 0)]
    assert got == sorted(want, key=str)


def test_fifty_words_stay_and_fifty_one_go(spark):
    for n, deleted in ((50, 0), (51, 1)):
        line = " ".join(f"w{i}" for i in range(n))
        assert sum(d for _, _, d in cleaned(spark, [(1, line), (2, line + "\nmore")], MIN_WORDS)) == deleted


def test_empty_table_and_very_long_text(spark):
    assert dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    long = "\n".join(f"line {i % 700} {i // 700} and some words" for i in range(20_000))
    assert sorted(cleaned(spark, [(1, long), (2, long)], MIN_WORDS))[1] == (2, "", 20_000)


def test_nothing_repeated(spark):
    frame = spark.createDataFrame([(0, 1, "a\nb"), (1, 2, "c\nd")], "uid long, doc_id long, text string")
    assert later_copies(frame, 1).count() == 0
