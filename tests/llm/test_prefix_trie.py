import hashlib
import random
import zlib

import pytest

from casewatch.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute_force(rows):
    given = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            given.setdefault(conv_id, []).append((turn is not None, turn or 0, role or "", text or ""))
    given = {c: [t[2:] for t in sorted(turns)] for c, turns in given.items()}
    built = {}
    for c in given:
        h = zlib.crc32(str(c).encode()) % 9
        source = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        built[c] = tuple(given.get(source, [])[:h] + given[c][h:])
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    out = []
    for p, cs in members.items():
        under = [q for q in members if q[: len(p)] == p]
        ends = sorted(c for c in cs if built[c] == p)
        out.append((
            min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), sum(len(q) == len(p) + 1 for q in under),
            sum(not any(len(r) > len(q) and r[: len(q)] == q for r in under) for q in under),
            sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in under if q),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def found(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3).selectExpr("*", "1 as node", "2 as depth", "'x' as parent", "true as upper")
    return sorted((tuple(r[c] for c in COLUMNS) for r in T.prefix_nodes(frame, **options).collect()), key=str)


def sample(seed, n):
    rng = random.Random(seed)
    rows = [(c, k, rng.choice(["user", "user", None]), rng.choice(["a", "a", "a", "bü", None])) for c in range(-12, n) for k in range(rng.randrange(1, 12))]
    rows += [(500 + i, k, "user", f"same {k}") for i in range(60) for k in range(12)]  # copies
    rows += [(700 + i, k, "user", f"same {k}" if k < 11 else f"own {i % 7}") for i in range(40) for k in range(13)]  # a common start
    rows += [(10**15, k, "user", "long") for k in range(200)]
    rows += [(3, 1, "user", "tie"), (3, 1, "user", "tie"), (3, 1, "agent", "tie"), (4, None, "user", "first"), (None, 1, "user", "of none"), (-7, None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard", [T.SHARD, 300, 40, 1])
def test_equal_to_brute_force(spark, shard):
    rows = sample(shard, 30)
    assert found(spark, rows, shard=shard) == brute_force(rows)


def test_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(T, "SHARD", 20)
    monkeypatch.setattr(T, "BLOCK", 21)
    rows = sample(8, 25)
    assert found(spark, rows, shard=20) == brute_force(rows)


def test_empty_table_and_conversations_without_turns_of_their_own(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "user", "x")]) == []
    # conv_id 2: h is at least one, its source 0 is absent, so its first turns vanish.
    assert zlib.crc32(b"2") % 9 > 0
    rows = [(2, 0, "user", "gone")]
    assert found(spark, rows) == brute_force(rows)
    assert found(spark, rows)[0][:4] == (2, 0, None, 1)


def test_role_and_text_are_kept_apart(spark):
    rows = [(5, 20, "ab", "c"), (5, 0, "a", "bc")] + [(10, k, "x", "") for k in range(9)] + [(11, k, "", "x") for k in range(9)]
    assert found(spark, rows) == brute_force(rows)


def test_very_long_texts(spark):
    rows = [(c, k, "user", "ü" * 400_000) for c in (1, 6) for k in range(9)]
    assert found(spark, rows) == brute_force(rows)


@pytest.mark.parametrize("seed", range(6))
def test_double_array_holds_its_paths_and_no_others(seed):
    rng = random.Random(seed)
    paths = [tuple(rng.randrange(1, 9) for _ in range(rng.randrange(7))) for _ in range(rng.randrange(60))] + [tuple(range(1, 300))]
    trie = T.DoubleArray(paths)
    prefixes = {p[:k] for p in paths for k in range(len(p) + 1)}
    state = {p: (trie.states(p) or [0])[-1] for p in prefixes}
    assert len(set(state.values())) == len(prefixes) == len(trie.order)
    assert all(len(trie.states(p)) == len(p) for p in prefixes)
    for p in prefixes:
        for c in range(1, 12):
            assert (len(trie.states((*p, c))) == len(p) + 1) == ((*p, c) in prefixes)
