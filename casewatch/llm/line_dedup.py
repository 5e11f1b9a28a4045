"""Deletion of repeated line runs by a suffix array over sequences of line ids.

Each line has a 128-bit id. A line that occurs once ends every repeated run, so suffixes are kept for stretches of
repeated lines only, and only for stretches with enough words. Prefix doubling sorts them: after k rounds a suffix's
rank orders it by its first 2**k lines. Ranks come from a distributed sort of the distinct pairs of ranks, and a
suffix whose prefix is unique drops out of the further rounds.

Suffixes that share their first L lines form a longest-common-prefix interval of the suffix array. The ranks of its first and last
2**k lines (2**k <= L < 2**(k+1)) identify it. In each interval of a run of at least ``MIN_WORDS`` words the first occurrence
stays and the run is deleted at all later ones. It is enough to look at the runs that just reach so many words: from each
line on, and up to each line. Any longer maximal run is the union of such runs inside it, so the lines deleted are
exactly those of all maximal repeated runs with an earlier occurrence.

Order is by doc_id, then text hash, then row. Cases: a null text is empty and stays; repeated rows are copies of the
first; lines are equal if all characters are; rows without id come first; an empty table gives no rows. A run may overlap its
earlier occurrence. Other columns are kept, except those named n_lines and n_deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casewatch.llm.common import drop_table, materialised, small_batches, stored, table, trimmed

#: Words of a run from which on its later copies are deleted.
MIN_WORDS = 51

LINE = "uid long, line int, high long, low long, words int"


def _lines(batches):
    import numpy as np
    import pyarrow as pa
    import xxhash

    for batch in batches:
        uids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        begin, size = 0, 0
        for i, text in enumerate(texts):
            size += len(text)
            if size < 1 << 22 and i < len(texts) - 1:
                continue
            rows = [(u, t.encode("utf-8", "surrogatepass").split(b"\n")) for u, t in zip(uids[begin : i + 1], texts[begin : i + 1])]
            flat = [x for _, lines in rows for x in lines]
            ids = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, flat)), "<i8").reshape(-1, 2)
            n = [len(lines) for _, lines in rows]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat([u for u, _ in rows], n), pa.int64()), pa.array(np.concatenate([np.arange(k) for k in n]).astype(np.int32)),
                pa.array(ids[:, 0]), pa.array(ids[:, 1]), pa.array([len(x.split()) for x in flat], pa.int32()),
            ], ["uid", "line", "high", "low", "words"])
            begin, size = i + 1, 0


def ranked(pairs: DataFrame, *keys: str, rows: int | None = None) -> DataFrame:
    """Distinct keys that occur twice or more, with a rank in their order: numbers of a sorted table ascend.

    ``rows``: how many pairs there are at most, if known.
    """
    repeated = pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select(*keys)
    return stored(repeated.orderBy(*keys).withColumn("rank", F.monotonically_increasing_id()), "ranks", rows and rows // 2)


def stretches(rows: DataFrame, min_words: int) -> DataFrame:
    """Stored (uid, start, ranks, words): runs of lines that all occur twice or more, with enough words."""
    with small_batches(rows.sparkSession):
        lines = stored(rows.mapInArrow(trimmed(_lines), LINE), "lines")
    n = lines.count()
    known = lines.join(ranked(lines, "high", "low", rows=n), ["high", "low"]).select("uid", "line", "rank", "words")
    per_text = known.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("line", "rank", "words"))).alias("lines"))
    breaks = F.filter(
        F.sequence(F.lit(0), F.size("lines")),
        lambda i: (i == 0) | (i == F.size("lines")) | (F.get("lines", i)["line"] != F.get("lines", i - 1)["line"] + 1),
    )
    cut = F.transform(F.slice("breaks", F.lit(1), F.size("breaks") - 1), lambda b, j: F.slice("lines", b + 1, F.get("breaks", j + 1) - b))
    each = per_text.withColumn("breaks", breaks).select("uid", F.explode(cut).alias("part"))
    each = each.select("uid", F.get("part", F.lit(0))["line"].alias("start"), F.transform("part", lambda x: x["rank"]).alias("ranks"), F.transform("part", lambda x: x["words"]).alias("words"))
    return stored(each.filter(F.aggregate("words", F.lit(0), lambda a, x: a + x) >= min_words), "stretches", n)


def _windows(min_words: int):
    """First line and number of lines of each run that just reaches ``min_words`` words, from or up to some line."""

    run = T.StructType([T.StructField("first", T.IntegerType()), T.StructField("size", T.IntegerType())])

    @F.pandas_udf(T.ArrayType(run))
    def windows(words):
        import numpy as np
        import pandas as pd

        def of(row):
            total = np.concatenate([[0], np.cumsum(row)])
            first = np.arange(len(row))
            stop = np.searchsorted(total, total[:-1] + min_words, side="left")
            ahead = {(int(p), int(e - p)) for p, e in zip(first, stop) if e <= len(row)}
            begin = np.searchsorted(total, total[1:] - min_words, side="right") - 1
            back = {(int(p), int(e + 1 - p)) for p, e in zip(begin, first) if p >= 0}
            return [{"first": p, "size": n} for p, n in sorted(ahead | back)]

        return pd.Series([of(np.asarray(row)) for row in words])

    return windows


def doubled(levels: DataFrame, step: int, rows: int | None = None) -> DataFrame:
    """(uid, start, i, rank) of the runs of twice ``step`` lines that occur twice or more; ``rows``: lines in all stretches."""
    pairs = levels.select("uid", "start", F.posexplode(F.zip_with(
        "ranks", F.slice("ranks", step + 1, F.size("ranks")), lambda a, b: F.struct(a.alias("a"), b.alias("b"))
    )).alias("i", "p")).filter("p.a is not null and p.b is not null").select("uid", "start", "i", "p.a", "p.b")
    return pairs.join(ranked(pairs, "a", "b", rows=rows), ["a", "b"]).select("uid", "start", "i", "rank")


def later_copies(rows: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(uid, first, size): runs of lines that occur earlier, for rows of (uid, doc_id, text)."""
    parts = stretches(rows.select("uid", "text"), min_words)
    parts = stored(parts.withColumn("windows", _windows(min_words)("words")), "windows")
    longest, n = (x or 0 for x in parts.agg(F.max(F.array_max(F.transform("windows", lambda w: w["size"]))), F.sum(F.size("ranks"))).first())
    spark, found, k = rows.sparkSession, None, 0
    levels, path = materialised(parts.select("uid", "start", "ranks"), "level0", n)
    while longest >> k:
        # The interval of a run of 2**k to 2**(k+1) - 1 lines: ranks of its first and its last 2**k lines.
        at = parts.select("uid", "start", "windows").join(levels, ["uid", "start"])
        runs = at.select("uid", "start", "ranks", F.explode(F.filter("windows", lambda w: F.shiftright(w["size"], k) == 1)).alias("w"))
        runs = runs.select(
            "uid", (F.col("start") + F.col("w.first")).alias("first"), F.col("w.size").alias("size"),
            F.get("ranks", F.col("w.first")).alias("a"), F.get("ranks", F.col("w.first") + F.col("w.size") - (1 << k)).alias("b"),
        ).filter("a is not null and b is not null")
        runs = stored(runs, "runs")
        found = runs if found is None else found.unionByName(runs.withColumns({"a": F.col("a"), "b": F.col("b")}))
        k += 1
        if not longest >> k:
            break
        up = doubled(levels, 1 << (k - 1), n).groupBy("uid", "start").agg(F.max("i").alias("last"), F.map_from_entries(F.collect_list(F.struct("i", "rank"))).alias("by"))
        up = up.select("uid", "start", F.transform(F.sequence(F.lit(0), F.col("last")), lambda i: F.try_element_at("by", i)).alias("ranks"))
        levels, new_path = materialised(up, f"level{k}", n)
        drop_table(spark, path)
        path = new_path
    if found is None:
        return spark.createDataFrame([], "uid long, first int, size int")
    order = rows.select("uid", F.struct("doc_id", F.xxhash64("text").alias("hash"), "uid").alias("place"))
    placed = found.join(order, "uid").withColumn("place", F.struct("place", "first"))
    earliest = placed.groupBy("size", "a", "b").agg(F.min("place").alias("earliest"), F.count(F.lit(1)).alias("k")).filter("k > 1")
    return placed.join(earliest, ["size", "a", "b"]).filter("place > earliest").select("uid", "first", "size")


@F.pandas_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("n_deleted", T.IntegerType())]))
def _without(texts, spans):
    import pandas as pd

    out, counts = [], []
    for text, deleted in zip(texts, spans):
        lines = text.split("\n")
        keep = bytearray(b"\1" * len(lines))
        for s in deleted if deleted is not None else ():
            keep[s["first"] : s["first"] + s["size"]] = bytes(s["size"])
        out.append("\n".join(x for x, k in zip(lines, keep) if k))
        counts.append(len(lines) - sum(keep))
    return pd.DataFrame({"text": out, "n_deleted": counts})


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the later copies of repeated runs cut from their texts, n_lines (before) and n_deleted."""
    kept = [f for f in docs.schema.fields if f.name not in ("n_lines", "n_deleted")]
    names = [f"c{i}" for i in range(len(kept))]  # so that kept columns may have any names
    plain = docs.select(*[F.col(f"`{f.name}`").alias(n) for f, n in zip(kept, names)])
    text = names[[f.name for f in kept].index("text")]
    doc_id = names[[f.name for f in kept].index("doc_id")]
    numbered = stored(plain.withColumn("uid", F.monotonically_increasing_id()), "numbered")
    rows = numbered.select("uid", F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    spans = later_copies(rows, min_words).groupBy("uid").agg(F.collect_list(F.struct("first", "size")).alias("spans"))
    joined = numbered.join(spans, "uid", "left")
    # Texts without a copy stay in the JVM.
    cut = F.when(F.col("spans").isNotNull(), _without(F.when(F.col("spans").isNotNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(F.lit("")), "spans"))
    joined = joined.withColumn("_cut", cut)
    out = [F.when(F.col("spans").isNotNull(), F.col("_cut.text")).otherwise(F.col(text)).alias("text") if n == text else F.col(n).alias(f.name) for f, n in zip(kept, names)]
    n_lines = F.length(F.coalesce(F.col(text), F.lit(""))) - F.length(F.replace(F.coalesce(F.col(text), F.lit("")), F.lit("\n"), F.lit(""))) + 1
    return joined.select(*out, n_lines.cast("long").alias("n_lines"), F.coalesce("_cut.n_deleted", F.lit(0)).cast("long").alias("n_deleted"))


def op1(spark, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def sql(source: str = "documents", min_words: int = MIN_WORDS) -> str:
    """DuckDB common table expressions that end in ``cleaned`` (doc_id, text, n_lines, n_deleted) by row r of ``source``."""
    return f"""
numbered as materialized (
    select row_number() over () as r, doc_id, text, string_split(coalesce(text, ''), chr(10)) as lines from {source}
), line as materialized (
    select r, doc_id, i, sum(n) over (partition by r order by i) as upto, sum(n) over (partition by r order by i) - n as before from (
        select r, doc_id, i, len(regexp_extract_all(lines[i], '[^\\x20\\x09-\\x0D]+')) as n
        from (select r, doc_id, lines, unnest(generate_series(1, len(lines))) as i from numbered))
), run as (
    select a.r, a.i as p, min(b.i) as e from line a join line b on a.r = b.r and b.i >= a.i and b.upto - a.before >= {min_words} group by a.r, a.i
    union
    select b.r, max(a.i) as p, b.i as e from line a join line b on a.r = b.r and b.i >= a.i and b.upto - a.before >= {min_words} group by b.r, b.i
), written as (
    select r, doc_id, p, e, array_to_string(lines[p : e], chr(10)) as content from run join numbered using (r)
), later as (
    select r, p, e from (select *, row_number() over (partition by content, e - p order by doc_id, r, p) as k from written) where k > 1
), deleted as (
    select distinct r, unnest(generate_series(p, e)) as i from later
), cleaned as (
    select n.r, n.doc_id, case when count(x.i) = 0 then any_value(n.text) else coalesce(string_agg(n.lines[l.i], chr(10) order by l.i) filter (x.i is null), '') end as text,
        count(*) as n_lines, count(x.i) as n_deleted
    from numbered n join line l using (r) left join deleted x on x.r = l.r and x.i = l.i group by n.r, n.doc_id
)"""


OP1_SQL = f"with {sql()} select doc_id, text, n_lines, n_deleted from cleaned"
