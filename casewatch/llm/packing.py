"""Cost-balanced packing of tokenised documents into sequences of a fixed capacity.

A document's tokens are cut at multiples of the capacity: each full piece is a sequence of
its own. The remainders, longest first, go to the sequence of lowest estimated cost that has
room for them. The cost of a piece is linear plus quadratic in its length, as attention within
it is. Tokenising needs no shuffle; only one small row per piece is dealt out to shards of
bounded size, which are packed independently of each other.

Cases: a null or empty text is one end token; repeated rows are packed once each; rows without
``doc_id`` are packed too; an empty table gives no pieces; further columns are ignored.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator
from itertools import compress, count, islice

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewatch.llm.common import materialised, small_batches, text_of, trimmed

CAPACITY = 1024
END_ID = 0
#: Remainders that are packed together at most; bounds a task's memory.
SHARD = 32768
#: Different words whose ids a task remembers at a time.
REMEMBERED = 200_000
#: Cost of a piece of n tokens: LINEAR * n + QUADRATIC * n * n.
LINEAR, QUADRATIC = 1.0, 1.0 / 1024

#: Fixed value: the pre-tokeniser's pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LATIN_END = "\u0250"

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class WordTokenizer:
    """Ids of whole texts, remembering those of words after a space.

    The byte-level pre-tokeniser never joins what stands before a single space between two
    other visible characters with what follows it, so a text may be cut there. Texts with
    longer runs of white space, or with the string of an added token, are encoded whole. Words of Latin letters, for which all versions of Unicode
    agree, are encoded by tiktoken, all new ones of a batch at once; it runs the same merges on the same vocabulary faster.
    """

    def __init__(self, path: str):
        import json
        import re

        import numpy as np
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)  # as the file has it: strings of added tokens become these tokens
        self.added = re.compile("|".join(re.escape(t.content) for t in self.whole.get_added_tokens_decoder().values()) or r"(?!)")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # a piece of a text may look like one
        self._forget()
        self.irregular = re.compile(r" \s|\s ")
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        byte = {chr(b if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174 else 256 + i): b for i, b in _shown()}
        ranks = {bytes(map(byte.__getitem__, token)): i for token, i in vocabulary.items() if all(map(byte.__contains__, token)) and token != "<|endoftext|>"}
        self.spaced = np.zeros(max(vocabulary.values()) + 1, bool)
        self.spaced[[i for token, i in ranks.items() if token.startswith(b" ")]] = True
        self.fast = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    @staticmethod
    def _ids(tokenizer, texts: list[str]) -> list[bytes]:
        import numpy as np

        return [np.array(e.ids, dtype="<u4").tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode(self, texts: list[str]) -> list[bytes]:
        return self._ids(self.tokenizer, texts)

    def _forget(self) -> None:
        """Number of each known word, in their order; where its ids begin, and how many they are."""
        import numpy as np

        self.known = defaultdict(count().__next__)  # a new word gets the next number
        self.ids, self.begins, self.sizes = np.empty(0, "<u4"), np.empty(0, np.int64), np.empty(0, np.int64)

    def _learn(self) -> None:
        """Ids of new words after a space: many together, as only the first token of each begins with a space."""
        import numpy as np

        words = list(islice(self.known, len(self.sizes), None))
        is_latin = np.array([w.isascii() or max(w) < LATIN_END for w in words], bool)
        latin, other = list(compress(words, is_latin)), list(compress(words, ~is_latin))
        ids = self.fast.encode_to_numpy(" " + " ".join(latin)).astype("<u4") if latin else self.ids[:0]
        begins, sizes = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        begins[is_latin] = first = np.flatnonzero(self.spaced[ids])
        sizes[is_latin] = np.diff(first, append=len(ids))
        rest = [np.frombuffer(x, "<u4") for x in self._encode([" " + w for w in other])]
        sizes[~is_latin] = [len(x) for x in rest]
        begins[~is_latin] = len(ids) + np.cumsum(sizes[~is_latin]) - sizes[~is_latin]
        self.begins, self.sizes = np.concatenate([self.begins, len(self.ids) + begins]), np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, ids, *rest])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        import numpy as np

        if len(self.known) > REMEMBERED:
            self._forget()
        heads, rests = [], []
        special = {i: text for i, text in enumerate(texts) if self.added.search(text)}
        encoded = dict(zip(special, self._ids(self.whole, list(special.values()))))
        number = self.known.__getitem__
        for i, text in enumerate(texts):
            if i in special:
                head, rest = "", ()
            elif self.irregular.search(text) or text[:1].isspace() or text[-1:].isspace():
                head, rest = text, ()
            else:
                head, *rest = text.split(" ")
            heads.append(head)
            rests.append(np.fromiter(map(number, rest), np.int64, len(rest)))
        self._learn()
        out = []
        for i, (head, rest) in enumerate(zip(self._encode(heads), rests)):
            sizes = self.sizes[rest]
            ends = np.cumsum(sizes)
            at = np.repeat(self.begins[rest] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
            out.append(encoded.get(i) or head + self.ids[at].tobytes())
        return out


def _shown() -> list[tuple[int, int]]:
    """Each byte, with its place among those that the vocabulary writes as characters from 256 on."""
    hidden = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
    return [(hidden.index(b) if b in hidden else 0, b) for b in range(256)]


def _batches(texts: list[str], most: int = 1 << 21) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about ``most`` characters together."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= most or i == len(texts) - 1:
            yield begin, texts[begin : i + 1]
            begin, size = i + 1, 0


def _tokenised(tokenizer_path: str | None, capacity: int, with_ids: bool):
    def run(batches):
        import os
        import zlib

        import pyarrow as pa

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if tokenizer_path is None:
            import public_tokenizers

            path = public_tokenizers.path("byte_bpe_50k.json")
        else:
            path = tokenizer_path
        words, end = WordTokenizer(path), END_ID.to_bytes(4, "little")
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for begin, part in _batches(texts):
                rows = []
                for doc_id, ids in zip(doc_ids[begin:], words.encode(part)):
                    ids += end
                    n = len(ids) // 4
                    for start in range(0, n, capacity):
                        piece = ids[4 * start : 4 * (start + capacity)]
                        rows.append((doc_id, start, len(piece) // 4, zlib.crc32(piece), n, *((piece,) if with_ids else ())))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 5 + [pa.binary()])]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][: len(columns)])

    return run


def assign(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Sequence and offset of each piece; ``lengths`` descend.

    Each piece goes to the sequence of lowest cost with room for it, lowest number first; if none
    has room, to a new one. As lengths descend, a sequence without room waits until pieces are short enough.
    """
    n = -(-sum(lengths) // capacity)
    by_cost = [(0.0, i) for i in range(n)]
    waiting: list[tuple[int, int]] = []
    used, cost = [0] * n, [0.0] * n
    sequences, offsets = [], []
    for length in lengths:
        while waiting and -waiting[0][0] >= length:
            i = heapq.heappop(waiting)[1]
            heapq.heappush(by_cost, (cost[i], i))
        while by_cost:
            i = heapq.heappop(by_cost)[1]
            if capacity - used[i] >= length:
                break
            heapq.heappush(waiting, (used[i] - capacity, i))
        else:
            i = len(used)
            used.append(0)
            cost.append(0.0)
        sequences.append(i)
        offsets.append(used[i])
        used[i] += length
        cost[i] += LINEAR * length + QUADRATIC * length * length
        if used[i] < capacity:
            heapq.heappush(by_cost, (cost[i], i))
    return sequences, offsets


def _packed(capacity: int):
    def run(frames):
        import pandas as pd
        from pyspark import TaskContext

        base, taken, held, n = TaskContext.get().partitionId() << 33, 0, [], 0

        def placed(frame):
            nonlocal taken
            frame = frame.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
            sequences, offsets = assign(frame["length"].tolist(), capacity)
            frame = frame.assign(sequence_id=[base + taken + s for s in sequences], offset=offsets)
            taken += max(sequences, default=-1) + 1
            return frame

        for frame in frames:
            full = frame["length"] == capacity
            if full.any():
                yield placed(frame[full])
            held.append(frame[~full])
            n += len(held[-1])
            if n >= SHARD:
                yield placed(pd.concat(held))
                held, n = [], 0
        if n:
            yield placed(pd.concat(held))

    return run


def pack(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece: its document, place in the document, digest, and place in a sequence.

    ``with_ids`` adds the piece's ids as little-endian 32-bit numbers. Sequence ids are unique, not dense.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    schema = PIECE + (", ids binary" if with_ids else "")
    with small_batches(docs.sparkSession):
        pieces, _ = materialised(texts.mapInArrow(trimmed(_tokenised(tokenizer_path, capacity, with_ids)), schema), "pieces")
    shards = max(1, pieces.filter(F.col("length") < capacity).count() // SHARD)
    dealt = pieces.repartition(shards, F.xxhash64("doc_id", "start", "ids_crc32"))
    # In a fixed order, so that a repeated task places its pieces as the first one did.
    dealt = dealt.sortWithinPartitions(F.desc("length"), "doc_id", "start", "ids_crc32")
    return dealt.mapInPandas(_packed(capacity), schema + ", sequence_id long, offset long")


def op9(spark, sf_dir: str) -> DataFrame:
    from casewatch.llm.common import table

    return pack(table(spark, sf_dir, "documents"))
