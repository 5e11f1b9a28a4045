import random

import pytest

from casewatch.llm import ngram_join as J
from casewatch.llm.components import components


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_force(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least.setdefault(find(i), []).append(doc_id)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [x for x in least[find(i)] if x is not None]
        out.append((doc_id, len(sets[i]), min(ids) if ids else None))
    return sorted(out, key=str)


def joined(spark, rows):
    frame = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, uid int")
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in J.near_duplicates(frame).collect()), key=str)


def changed(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"x{rng.randrange(1000)}"
    return " ".join(words)


@pytest.mark.parametrize("seed", [1, 2])
def test_components_are_those_of_all_links(spark, seed):
    rng = random.Random(seed)
    texts = []
    for size in (3, 5, 6, 8, 9, 10, 12, 14, 18, 25, 40, 120):
        base = [f"w{rng.randrange(400)}" for _ in range(size)]
        texts += [changed(rng, base, k) for k in (0, 0, 1, 1, 1, 2)] + [" ".join(base[1:]), " ".join(base + ["end"]), " ".join(base).upper()]
    common = " ".join(f"c{i}" for i in range(30))
    texts += [f"{common} own{i} a{i} b{i}" for i in range(30)]
    # A chain whose ends are not similar.
    chain = [f"k{i}" for i in range(60)]
    texts += [" ".join(chain[i : i + 40]) for i in range(0, 20, 2)]
    rng.shuffle(texts)
    rows = list(enumerate(texts)) + [(900, None), (901, ""), (902, " \n"), (5, texts[5]), (5, "another text of this id"), (None, texts[7]), (None, "alone without id")]
    assert joined(spark, rows) == brute_force(rows)


def test_near_copies_of_a_text_that_is_not_the_smallest(spark):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    rows = [(i, changed(rng, base, 3)) for i in range(60)] + [(99, " ".join(base))]
    assert joined(spark, rows) == brute_force(rows)


def test_empty_table_and_one_long_text(spark):
    assert J.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert joined(spark, [(1, "many words " * 100_000), (2, "few")]) == [(1, 2, 1), (2, 1, 2)]


def test_boundary_is_the_cheapest():
    assert J.choose_boundary({}) == 0
    assert J.choose_boundary({3: 1000, 200: 10}) >= 3
    for n in range(1, 300):
        assert J.least_overlap(n) == min(k for k in range(n + 1) if 100 * k >= 80 * n)
    for boundary in range(2, 12):
        for n in range(1, boundary + 1):
            for m in range(n, boundary + 1):
                if 100 * n >= 80 * m:  # similar sets of these sizes share a set of the larger one's least overlap
                    assert J.least_overlap(m) in J.subset_sizes(n, boundary) and J.least_overlap(m) in J.subset_sizes(m, boundary)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}


@pytest.mark.parametrize("size", [1, 2, 3, 5, 100])
def test_rows_with_a_neighbour_are_found_across_batches(size):
    import pyarrow as pa

    rng = random.Random(size)
    for _ in range(50):
        values = sorted(rng.randrange(12) for _ in range(rng.randrange(20)))
        batches = [pa.RecordBatch.from_arrays([pa.array(values[i : i + size], pa.int64())], ["h"]) for i in range(0, len(values), size)]
        got = [x for b in J._repeated(iter(batches)) for x in b.column(0).to_pylist()]
        assert got == [v for v in values if values.count(v) > 1]


def test_links_when_shingles_are_known_as_frequent(spark, monkeypatch):
    monkeypatch.setattr(J, "OFTEN", 2)
    rng = random.Random(9)
    base, other = [f"w{i}" for i in range(90)], [f"v{i}" for i in range(90)]
    rows = [(i, changed(rng, base, rng.randrange(4))) for i in range(25)] + [(50 + i, " ".join(base[:45] + other[i : i + 45])) for i in range(25)]
    assert joined(spark, rows) == brute_force(rows)


@pytest.mark.parametrize("spread", [40, 1 << 40])
def test_sets_in_brief_lose_no_link(spread):
    import numpy as np

    rng = random.Random(spread)
    sets = []
    for uid in range(12):  # the same last 16 bits for many elements, or for few
        base = rng.sample(range(spread), 30) if uid % 3 == 0 else base
        high = [b + (rng.choice([0, 0, 0, 0, 0, 0, 0, 0, 1, 2]) << 45) for b in base]
        sets.append((uid, uid, np.unique(np.array(high + [1 << 16, 1 << 17], np.uint64))))
    brief = [(len(s), root, J.in_brief(s)) for _, root, s in sets]
    maybe = J.possible_links(brief, brief)
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            both = len(np.intersect1d(x[2], y[2]))
            assert maybe[i, j] or i == j or 100 * both < 80 * (len(x[2]) + len(y[2]) - both)


def test_only_sets_that_may_be_linked_move_whole(spark):
    rng = random.Random(3)
    text = " ".join(f"w{i}" for i in range(150))
    texts = [text, text + " end"] + [" ".join(f"w{i}" for i in range(60)) + " " + " ".join(f"v{rng.randrange(9999)}" for _ in range(90)) for _ in range(20)]
    frame = spark.createDataFrame(list(enumerate(texts)), "uid long, text string")
    whole = frame.mapInArrow(J._whole, "uid long, items binary, n int, brief binary")
    cells = spark.createDataFrame([(7, 0, 0, J.BOTH if i else 1, i, i) for i in range(22)], "bucket long, p int, q int, side int, uid long, root long")
    assert sorted(r["uid"] for r in J.possible_cells(cells, whole).collect()) == [0, 1]
    assert [tuple(sorted(r)) for r in J.compared(cells, whole).collect()] == [(0, 1)]
