import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from casewatch.llm import collocations as C

SCHEMA = "doc_id long, text string, lang string"


def brute_force(rows, least, covered, most):
    f, total = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for n in (1, 2, 3):
                f[lang].update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, counts in f.items():
        chosen = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in chosen.items():
            if len(p) == 3:
                for part in (p[:2], p[1:]):
                    longer[part] = max(longer[part], a)
        scored = []
        for p, a in chosen.items():
            if len(p) == 3 or 100 * longer[p] < covered * a:
                score, _, l, r = min((1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(scored)[:most], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -s))
    return sorted(out)


def found(spark, rows, least=10, covered=50, most=2000):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3).selectExpr("*", "1 as phrase", "2 as size", "3 as a", "4 as part")
    return sorted(tuple(r) for r in C.collocations(frame, least, covered, most).collect())


def sample(seed, n, words=2):
    rng = random.Random(seed)
    made = []
    for i in range(n):
        parts = [rng.choice(["", "W", "ü", "x-"]) + str(rng.randrange(words)) + rng.choice(["", "", "", ".", ",", " ;", "\n", "\t", "!?", "\x0b"]) for _ in range(rng.randrange(60))]
        made.append((i, " ".join(parts), rng.choice(["en", "en", "de", None, "und"])))
    return made + [(None, None, None), (1, "", "en"), (1, "a b a b a b a b", "en"), (1, "a b a b a b a b", "en"), (5, " .,; ", "xx")]


@pytest.mark.parametrize("least,covered,most", [(10, 50, 2000), (3, 50, 7), (2, 90, 2000)])
def test_equal_to_brute_force(spark, least, covered, most):
    rows = sample(least, 300)
    got = found(spark, rows, least, covered, most)
    assert got == brute_force(rows, least, covered, most) and got


def test_many_partitions_small_slices_and_a_full_filter(spark, monkeypatch):
    monkeypatch.setattr(C, "MASS", 256)
    monkeypatch.setattr(C, "HELD", 50)
    monkeypatch.setattr(C, "SLICE", 16)
    monkeypatch.setattr(C, "FILTER_BITS", 6)
    monkeypatch.setattr(C, "HOT", 20)
    rows = sample(4, 300, words=3)
    assert found(spark, rows, 4) == brute_force(rows, 4, 50, 2000)


def test_hot_phrase_and_one_very_long_text(spark):
    rows = [(i, "very common phrase here", "en") for i in range(400)] + [(999, "long text, " * 60_000 + "very common end", "en")]
    assert found(spark, rows) == brute_force(rows, 10, 50, 2000)


def test_empty_table(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None, "en")]) == []


def test_scores_are_exact_beyond_64_bits(spark):
    a, l, r = 3_000_000_019, 3_000_000_021, 3_000_000_077
    counts = spark.createDataFrame([("x", 0, "", 10**10), ("x", 1, "p", l), ("x", 1, "q", r), ("x", 2, "p q", a)], "lang string, size int, phrase string, a long")
    row = C.with_parts(C.uncovered(counts), counts).first()
    assert (row["l"], row["r"], row["score"]) == (l, r, 1000000 * a * a // (l * r))


@pytest.mark.parametrize("seed", range(5))
def test_every_frequent_key_keeps_a_counter(seed):
    rng = np.random.default_rng(seed)
    least = 10
    values = np.concatenate([rng.integers(0, 50_000, 40_000), rng.zipf(1.3, 20_000) % 3000]).astype(np.uint32)
    rng.shuffle(values)
    summary = C.Summary(len(values) // least + 1)
    for part in np.array_split(values, 37):
        keys, counts = np.unique(part, return_counts=True)
        summary.add(keys, counts)
    kept = set(summary.frequent(least).tolist())
    keys, counts = np.unique(values, return_counts=True)
    assert set(keys[counts >= least].tolist()) <= kept
    assert len(summary.keys) <= summary.capacity and summary.lost < least


def test_slices_of_any_size_give_the_same_tokens():
    text = "One two,three. four\tfive\n six;;seven" * 5
    whole = next(C.slices(text, 1 << 20))
    for most in (1, 2, 7, 40):
        assert [w for part in C.slices(text, most) for w in part] == whole
