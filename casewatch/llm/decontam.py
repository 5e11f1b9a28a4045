"""Benchmark decontamination by a positional inverted index.

``build_index`` stores the postings of all corpus tokens as a table: documents are laid one after
the other in segments of bounded size, and each row has the offsets of one term in one segment.
A frequent term thus has many bounded rows. ``search`` takes the phrases in blocks; in each
segment it starts from the rarest term of a phrase, shifts its offsets by the term's place, and
intersects with the shifted lists of the next rarest ones until none is left.

Cases: null and empty texts have no words and match nothing; a phrase without words matches
nothing; repeated rows of documents are matched each, repeated phrases of an item count once; items
without an id count as item "". Empty tables give empty or unmatched results; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewatch.llm.common import materialised, small_batches, table, text_of, trimmed

WINDOW = 13
#: Tokens laid out in one segment, unless a single text is longer.
SEGMENT = 1 << 20
#: Words of phrases that go to the tasks at a time.
BLOCK = 1 << 18
#: Between two documents of a segment; a phrase never reaches across.
GAP = 64

INDEX = "segment long, term binary, offsets binary, doc_ids array<long>, text_keys array<long>, lengths array<int>"
FOUND = "segment long, doc int, item_id string, start int, stop int"


def _word_table() -> bytes:
    """Lower-cases A-Z and turns every other ASCII character than letters and digits into a space."""
    keep = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
    return bytes(i if i in keep else i + 32 if 0x41 <= i <= 0x5A else 0x20 for i in range(256))


def words_of(text: str) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()


_WORDS = _word_table()


def _postings(segment_tokens: int):
    def run(batches):
        from collections import defaultdict
        from itertools import count

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        schema = pa.schema([
            ("segment", pa.int64()), ("term", pa.binary()), ("offsets", pa.binary()),
            ("doc_ids", pa.list_(pa.int64())), ("text_keys", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())),
        ])
        number = TaskContext.get().partitionId() << 32

        def flush():
            """One row for the documents of the segment, then one for each term."""
            nonlocal number
            yield pa.RecordBatch.from_arrays([
                pa.array([number]), pa.array([None], pa.binary()), pa.array([None], pa.binary()),
                pa.array([doc_ids], schema[3].type), pa.array([keys], schema[4].type), pa.array([lengths], schema[5].type),
            ], schema=schema)
            if terms:
                flat = np.concatenate(ids)
                ids.clear()
                ends = np.concatenate([[0], np.cumsum(np.bincount(flat, minlength=len(terms)))]) * 4
                order = np.argsort(flat, kind="stable")
                del flat
                places = np.arange(sum(lengths), dtype="<i4") + np.repeat(GAP * np.arange(len(lengths), dtype="<i4"), lengths)
                data = places[order].data.cast("B")
                del places, order
                names, step = list(terms), 50_000
                for a in range(0, len(names), step):
                    b = min(len(names), a + step)
                    lists = pa.array([bytes(data[x:y]) for x, y in zip(ends[a:b].tolist(), ends[a + 1 : b + 1].tolist())], pa.binary())
                    nothing = [pa.nulls(b - a, t.type) for t in list(schema)[3:]]
                    yield pa.RecordBatch.from_arrays([pa.array([number] * (b - a)), pa.array(names[a:b], pa.binary()), lists, *nothing], schema=schema)
            number += 1

        terms = defaultdict(count().__next__)
        ids, doc_ids, keys, lengths, size = [], [], [], [], 0
        for batch in batches:
            for doc_id, key, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = words_of(text)
                ids.append(np.fromiter(map(terms.__getitem__, words), np.int32, len(words)))
                doc_ids.append(doc_id)
                keys.append(key)
                lengths.append(len(words))
                size += len(words) + GAP
                if size >= segment_tokens:
                    yield from flush()
                    terms = defaultdict(count().__next__)
                    ids, doc_ids, keys, lengths, size = [], [], [], [], 0
        if doc_ids:
            yield from flush()

    return run


def build_index(docs: DataFrame, segment_tokens: int = SEGMENT) -> DataFrame:
    """Stored postings of all tokens of ``docs``; a row without term lists a segment's documents."""
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("text_key"), text_of().alias("text")
    )
    with small_batches(docs.sparkSession):
        return materialised(texts.mapInArrow(trimmed(_postings(segment_tokens)), INDEX), "postings")[0]


def windows(items: DataFrame, size: int = WINDOW) -> Iterator[tuple[str, tuple[bytes, ...]]]:
    """(item, phrase) for all runs of ``size`` words of each item; a shorter item is one phrase."""
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), text_of().alias("text"))
    for item_id, text in rows.toLocalIterator():
        words = words_of(text)
        for i in range(max(1, len(words) - size + 1) if words else 0):
            yield item_id, tuple(words[i : i + size])


def blocks(phrases: Iterator[tuple[str, tuple[bytes, ...]]], most: int = BLOCK) -> Iterator[dict[tuple[bytes, ...], set[str]]]:
    """Phrases with the items that have them, in blocks of about ``most`` words."""
    block: dict[tuple[bytes, ...], set[str]] = {}
    size = 0
    for item_id, phrase in phrases:
        block.setdefault(phrase, set()).add(item_id)
        size += len(phrase)
        if size >= most:
            yield block
            block, size = {}, 0
    if block:
        yield block


def occurrences(lists: dict, phrase: tuple[bytes, ...], slop: int):
    """Offsets at which the phrase begins; each term may be ``slop`` words off its place."""
    import numpy as np

    terms = sorted(enumerate(phrase), key=lambda x: len(lists[x[1]]))
    at = np.unique(lists[terms[0][1]] - terms[0][0]) if not slop else None
    if slop:
        first = lists[terms[0][1]] - terms[0][0]
        at = np.unique((first[:, None] + np.arange(-slop, slop + 1)).ravel())
    for place, term in terms[0 if slop else 1 :]:
        if not len(at):
            break
        have, low = lists[term], at + place - slop
        i = np.searchsorted(have, low)
        at = at[(i < len(have)) & (have[np.minimum(i, len(have) - 1)] <= low + 2 * slop)]
    return at


def _matched(block, slop: int):
    def run(rows):
        import numpy as np
        import pandas as pd

        directory = rows["lengths"].notna()
        lengths = np.asarray(rows.loc[directory, "lengths"].iloc[0], dtype=np.int64)
        starts = np.cumsum(lengths) - lengths + GAP * np.arange(len(lengths))
        postings = rows[~directory]
        lists = {bytes(t): np.frombuffer(o, "<i4").astype(np.int64) for t, o in zip(postings["term"], postings["offsets"])}
        found: dict[str, list] = {}
        for phrase, items in block.items():
            if all(map(lists.__contains__, phrase)):
                at = occurrences(lists, phrase, slop)
                if len(at):
                    for item in items:
                        found.setdefault(item, []).append(np.stack([at, at + len(phrase)], 1))
        out = []
        for item, parts in found.items():
            spans = np.concatenate(parts)
            spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
            doc = np.searchsorted(starts, spans[:, 0] + (slop if slop else 0), side="right") - 1
            begin = np.maximum(spans[:, 0] - starts[doc], 0)
            end = np.minimum(spans[:, 1] - starts[doc], lengths[doc])
            reach = np.maximum.accumulate(end + doc * (1 << 40))
            new = np.ones(len(doc), bool)
            new[1:] = begin[1:] + doc[1:] * (1 << 40) > reach[:-1]
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(doc)) - 1
            out.append((doc[first], np.full(len(first), item, object), begin[first], reach[last] - doc[last] * (1 << 40)))
        doc, item_ids, start, stop = map(np.concatenate, zip((np.zeros(0, int), np.zeros(0, object), np.zeros(0, int), np.zeros(0, int)), *out))
        segment = np.full(len(doc), rows["segment"].iloc[0])
        return pd.DataFrame({"segment": segment, "doc": doc, "item_id": pd.Series(item_ids, dtype=object), "start": start, "stop": stop})

    return run


def search(index: DataFrame, phrases: Iterator[tuple[str, tuple[bytes, ...]]], slop: int = 0) -> DataFrame:
    """Where phrases occur: merged word spans for each document and item.

    ``slop`` 0 finds exact phrases; otherwise each term may be so many words off its place (fewer than the gap
    between documents), which finds reordered and loosely quoted passages.
    """
    import pyarrow as pa

    if not 0 <= slop < GAP // 2:
        raise ValueError("slop must be smaller than half the gap between documents")
    spark, found = index.sparkSession, None
    for block in blocks(phrases):
        # An Arrow table is read in the JVM; rows in a list would start Python workers of their own on the executors.
        vocabulary = spark.createDataFrame(pa.table({"term": pa.array(sorted({t for p in block for t in p}), pa.binary())}))
        # A block has a bounded number of words, so its vocabulary may go to every task.
        needed = index.join(F.broadcast(vocabulary), "term", "left_semi").unionByName(index.filter(F.col("term").isNull()))
        needed = needed.select("segment", "term", "offsets", "lengths")
        part = needed.groupBy("segment").applyInPandas(_matched(block, slop), FOUND)
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], FOUND) if found is None else found


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """One row per document: words, words inside matched windows, matched items, verdict.

    A document is contaminated if at least a twentieth of its words is hit.
    """
    index = build_index(docs)
    found = search(index, windows(items, window), slop)
    per_doc = found.groupBy("segment", "doc").agg(
        F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"), F.sort_array(F.collect_set("item_id")).alias("items")
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0), s["stop"] - F.greatest(acc["to"], s["start"]))).alias("n"),
            F.greatest(acc["to"], s["stop"]).alias("to"),
        ),
    )["n"]
    directory = index.filter(F.col("term").isNull()).select(
        "segment", F.posexplode(F.arrays_zip("doc_ids", "text_keys", "lengths")).alias("doc", "d")
    )
    joined = directory.join(per_doc.withColumn("n_hit", covered).drop("spans"), ["segment", "doc"], "left")
    n_words, n_hit = F.col("d.lengths").cast("long"), F.coalesce("n_hit", F.lit(0)).cast("long")
    return joined.select(
        F.col("d.doc_ids").alias("doc_id"),
        F.col("d.text_keys").alias("text_key"),
        n_words.alias("n_words"),
        n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (20 * n_hit >= n_words)).alias("contaminated"),
    )


def op4(spark, sf_dir: str) -> DataFrame:
    judged = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


OP4_SQL = f"""
with d as (
    select row_number() over () as r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
    from documents
), b as (
    select coalesce(cast(item_id as varchar), '') as item_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
    from benchmark
), windows as (
    select distinct item_id, len, array_to_string(w[i : i + len - 1], ' ') as phrase from (
        select item_id, w, least(len(w), {WINDOW}) as len, unnest(generate_series(1, len(w) - least(len(w), {WINDOW}) + 1)) as i from b where len(w) > 0)
), runs as (
    select r, i, s.len, array_to_string(w[i : i + s.len - 1], ' ') as phrase
    from (select r, w, unnest(generate_series(1, len(w))) as i from d) cross join (select distinct len from windows) s
    where i + s.len - 1 <= len(w)
), found as (
    select r, i, len, item_id from runs join windows using (len, phrase)
), hits as (
    select r, count(distinct p) as n_hit from (select r, unnest(generate_series(i, i + len - 1)) as p from found) group by r
), items as (
    select r, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids from (select distinct r, item_id from found) group by r
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join hits using (r) left join items using (r)
"""
