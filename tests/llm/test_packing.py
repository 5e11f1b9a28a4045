import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from casewatch.llm.packing import CAPACITY, WordTokenizer, assign, pack

PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)
WORDS = WordTokenizer(PATH)


def plain_ids(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab é\n\t .,'s1İß  😀<|endoftext|>"), max_size=40), max_size=4))
def test_ids_by_words_are_those_of_whole_texts(texts):
    assert [np.frombuffer(x, "<u4").tolist() for x in WORDS.encode(texts)] == [plain_ids(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=60))
def test_assignment_is_the_lowest_cost_sequence_with_room(lengths):
    lengths = sorted(lengths, reverse=True)
    sequences, offsets = assign(lengths, 100)
    n = -(-sum(lengths) // 100)
    used, cost = [0] * n, [0.0] * n
    for length, sequence, offset in zip(lengths, sequences, offsets):
        room = [i for i in range(len(used)) if 100 - used[i] >= length]
        if not room:
            used.append(0)
            cost.append(0.0)
            room = [len(used) - 1]
        assert sequence == min(room, key=lambda i: (cost[i], i)) and offset == used[sequence]
        used[sequence] += length
        cost[sequence] += length + length * length / 1024


@pytest.mark.parametrize("partitions", [1, 3])
def test_pieces_cover_every_document_once(spark, partitions):
    texts = ["", None, "word " * 3000 + "end", "short one", "short one", "ü" * 5000, *("some words %d" % i * (i % 40) for i in range(200))]
    rows = [(i if i != 4 else 3, t, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string").repartition(partitions)
    got = [r.asDict() for r in pack(docs, with_ids=True).collect()]
    pieces = {}
    for r in got:
        ids = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert len(ids) == r["length"] and zlib.crc32(bytes(r["ids"])) == r["ids_crc32"]
        pieces.setdefault(r["doc_id"], []).append((r["start"], ids, r["doc_tokens"]))
    for i, t in enumerate(texts):
        want = plain_ids(t) + [0]
        have = sorted(pieces[i if i != 4 else 3])
        times = 2 if i in (3, 4) else 1
        assert all(p[2] == len(want) for p in have)
        assert sum((p[1] for p in have), []) == want * times if times == 1 else sorted(p[1] for p in have) == [want] * times
    rooms = {}
    for r in got:
        rooms.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for placed in rooms.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= CAPACITY


def test_empty_table(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_the_end_tokens_string_is_the_end_token(spark):
    text = "before <|endoftext|> after<|endoftext|>"
    assert np.frombuffer(WORDS.encode(["x", text, "y z"])[1], "<u4").tolist() == plain_ids(text)
    assert WordTokenizer(PATH).whole.token_to_id("<|endoftext|>") in plain_ids(text)


def test_sequences_do_not_depend_on_the_order_of_rows(spark, monkeypatch):
    from casewatch.llm import packing

    monkeypatch.setattr(packing, "SHARD", 60)
    rows = [(i % 150, "some words %d " % (i % 150) * (i % 37), "x") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    results = [sorted(map(tuple, pack(docs.orderBy(order).repartition(n)).collect())) for order, n in (("doc_id", 2), ("text", 5), ("source", 3))]
    assert results[0] == results[1] == results[2]


def test_new_words_are_encoded_together(monkeypatch):
    words, calls = WordTokenizer(PATH), []
    for name in ("encode_ordinary", "encode_to_numpy"):
        method = getattr(words.fast, name)
        monkeypatch.setattr(words.fast, name, lambda *a, method=method, **k: calls.append(a) or method(*a, **k))
    text = " ".join(["one", *(f"word{i}" for i in range(50)), "it's 's ... a\nb\tc d\n\ne \u00e9t\u00e9 \u4e2d\u6587 ß&&& 12,5 x\x1c! <tag>", "end"])
    for _ in range(2):
        assert np.frombuffer(words.encode([text, "x"])[0], "<u4").tolist() == plain_ids(text)
    assert len(calls) == 1
