import random
import re

import pytest

from casewatch.llm import decontam as D


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def brute_force(docs, items, size=13):
    phrases = {}
    for item_id, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            phrases.setdefault(tuple(w[i : i + size]), set()).add("" if item_id is None else str(item_id))
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for i in range(len(w)):
            for n in {len(p) for p in phrases}:
                if tuple(w[i : i + n]) in phrases and i + n <= len(w):
                    hit |= set(range(i, i + n))
                    found |= phrases[tuple(w[i : i + n])]
        out.append((doc_id, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def judged(spark, docs, items):
    d = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, segment int").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], list(r["items"]), r["contaminated"]) for r in D.contamination(d, b).collect()), key=str)


@pytest.mark.parametrize("segment, block", [(1 << 21, 1 << 18), (60, 40)])
def test_hits_are_those_of_all_windows(spark, monkeypatch, segment, block):
    rng = random.Random(3)
    monkeypatch.setattr(D, "BLOCK", block)
    monkeypatch.setattr(D.blocks, "__defaults__", (block,))
    monkeypatch.setattr(D.build_index, "__defaults__", (segment,))
    vocabulary = ["the", "of", "a", "Ünd", "x1"] * 4 + [f"w{i}" for i in range(12)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate((20, 13, 5, 1, 30))] + [(None, "only here"), (7, None), (8, "!?"), (1, text(15))]
    docs = [(i, text(rng.randint(0, 60))) for i in range(25)]
    docs += [(100, text(40) + ", " + items[0][1].upper() + "." + text(30)), (101, items[4][1].replace(" ", "-")), (102, None), (102, ""), (None, "only, HERE"), (103, items[1][1]), (103, items[1][1])]
    assert judged(spark, docs, items) == brute_force(docs, items)


def test_phrases_do_not_reach_across_documents_and_slop_finds_loose_quotes(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, "three four five"), (3, "one x two three"), (4, "two one three")], "doc_id long, text string").coalesce(1)
    index = D.build_index(docs)
    phrase = [("p", (b"one", b"two", b"three"))]
    place = lambda slop: sorted({r["doc"] for r in D.search(index, iter(phrase), slop).collect()})
    assert place(0) == []
    assert place(1) == [2, 3]
    with pytest.raises(ValueError):
        D.search(index, iter(phrase), D.GAP)


def test_empty_tables(spark):
    docs, items = [(1, "a b")], [(1, "a")]
    assert judged(spark, [], items) == []
    assert judged(spark, docs, []) == [(1, 2, 0, [], False)]


def test_very_long_text(spark):
    docs = [(1, "word " * 300_000 + "rare phrase")]
    assert judged(spark, docs, [(1, "rare phrase")]) == [(1, 300_002, 2, ["1"], False)]
