"""Phrase collocations from mergeable Misra-Gries summaries, counted exactly in a second pass.

Texts are cut into pieces at punctuation and line breaks and pieces into words. Everything is counted per language.

First pass: tasks count the hashes of all phrases of up to three words of some texts (a summary without error) and
hand them on by hash partition. The number of partitions follows the size of the input, so that each has about
``MASS`` occurrences. A partition merges its summaries in one with more counters than its mass divided by ``least``:
whatever is taken off a counter is then less than ``least``, so every phrase that occurs as often keeps a counter. Phrases with
equal hashes share one, which can only keep more of them.

Second pass: phrases whose hash may have a counter, by a bit filter of fixed size that tasks hold, are counted exactly, with
their words. What the filter lets through beyond that costs work, not correctness: only exact counts decide.

A phrase's score is that of its worst cut in two parts. Parts that hold a ``HOT``-th of all words or more are few, so they
are sent to all tasks; the others meet their phrases by a shuffled join. The first ranks of a language are chosen among
those of ``SALTS`` parts of its phrases, so that no task sorts all.

Cases: a null text is empty; a null language is ``und``, together with texts so marked; repeated rows count each; equal scores
rank by count, then by phrase in the order of bytes; an empty table gives no rows; a text may have any length, and is read in
slices; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewatch.llm.common import drop_table, materialised, stored, table, text_of, trimmed

#: A candidate's least count; percentage of it that a longer phrase needs to cover it; ranks of a language.
LEAST, COVERED, MOST = 10, 50, 2000
#: Phrase occurrences that a hash partition has, about; words that a task holds at a time; bytes of a text cut at a time.
MASS, HELD, SLICE = 1 << 21, 1 << 19, 1 << 18
#: Bits of the filter of the second pass, as a power of two.
FILTER_BITS = 27
HOT, SALTS = 4096, 64

SEPARATORS = b".,;:!?\n\x0b\x0c\r"
_ALIKE = bytes.maketrans(SEPARATORS + b"\t", b"." * len(SEPARATORS) + b" ")


def slices(text: str, most: int):
    """Tokens of a text, slice by slice: its words, and b"." where a piece ends."""
    data = text.encode("utf-8", "surrogatepass").lower().translate(_ALIKE)
    begin = 0
    while begin < len(data):
        end = data.find(b" ", begin + most)
        end = len(data) if end < 0 else end
        yield data[begin:end].replace(b".", b" . ").split()
        begin = end


class Held:
    """Texts as word numbers, by language; 0 stands between pieces and texts."""

    def __init__(self):
        self.numbers = {b".": 0}
        self.by_lang: dict[str, list] = {}
        self.old: dict[str, int] = {}
        self.size = 0

    def add(self, lang: str, text: str, most: int):
        """Takes a text; yields after each slice."""
        import numpy as np

        self.by_lang.setdefault(lang, []).append(np.zeros(1, np.int64))
        for words in slices(text, most):
            numbers = self.numbers  # another one after ``taken``
            for w in words:
                if w not in numbers:
                    numbers[w] = len(numbers)
            self.by_lang[lang].append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
            self.size += len(words)
            yield

    def is_full(self) -> bool:
        return self.size >= HELD or len(self.numbers) > 1 << 18

    def taken(self, open_lang: str | None):
        """(language, words as numbers, how many of them are new, hashes of words) of each language; starts anew.

        Of the language whose text goes on, the last two words stay, as phrases may begin with them.
        """
        import numpy as np
        import xxhash

        words = list(self.numbers)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        held = {lang: np.concatenate(parts) for lang, parts in self.by_lang.items()}
        old = self.old
        self.numbers, self.by_lang, self.size, self.old = {b".": 0}, {}, 0, {}
        if open_lang is not None:
            tail = held[open_lang][-2:]
            for i in tail[tail > 0].tolist():
                self.numbers.setdefault(words[i], len(self.numbers))
            self.by_lang[open_lang] = [np.array([self.numbers[words[i]] for i in tail.tolist()], np.int64)]
            self.old[open_lang] = len(tail)
        for lang, ids in held.items():
            yield lang, ids, old.get(lang, 0), words, hashes


def mixed(h):
    import numpy as np

    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def phrases(lang: str, ids, old: int, hashes):
    """(number of words, first places, hashes) of the phrases that end after the ``old`` first words."""
    import numpy as np
    import xxhash

    h = mixed(hashes[ids] ^ np.uint64(xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"))))
    whole, rolled = ids > 0, h
    for n in (1, 2, 3):
        if n > 1:
            whole = whole[:-1] & (ids[n - 1 :] > 0)
            rolled = mixed(rolled[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[n - 1 :])
        at = np.flatnonzero(whole)
        at = at[at + n > old]
        yield n, at, rolled[at]


def _read(work):
    """A batch function over (lang, text) that hands what is held to ``work`` whenever it is enough."""

    def run(batches):
        held = Held()
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                lang = lang.as_py()
                for _ in held.add(lang, text.as_py(), SLICE):
                    if held.is_full():
                        yield from work(held.taken(lang))
        yield from work(held.taken(None))

    return run


def _summaries(bits: int):
    """Counts of phrase hashes, one row per hash partition: its number, its mass, 32 further bits of each hash, their counts."""

    def work(taken):
        import numpy as np
        import pyarrow as pa

        found = [h >> np.uint64(32 - bits) for lang, ids, old, _, hashes in taken for _, _, h in phrases(lang, ids, old, hashes)]
        keys, counts = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        if not len(keys):
            return
        parts = (keys >> np.uint64(32)).astype(np.int64)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(parts)) + 1, [len(keys)]])
        low, counts = keys.astype("<u4"), counts.astype("<u4")
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(parts[cuts[:-1]]), pa.array(np.add.reduceat(counts, cuts[:-1], dtype=np.int64)),
                pa.array([low[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                pa.array([counts[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
            ],
            ["part", "mass", "keys", "counts"],
        )

    return _read(work)


class Summary:
    """Misra-Gries counters; what was taken off any counter is at most ``lost``."""

    def __init__(self, capacity: int):
        import numpy as np

        self.capacity, self.lost = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.pending, self.n_pending = [], 0

    def add(self, keys, counts) -> None:
        self.pending.append((keys, counts))
        self.n_pending += len(keys)
        if self.n_pending > self.capacity:
            self.merge()

    def merge(self) -> None:
        """Counters of equal keys are added; then the first count beyond the capacity is taken off all."""
        import numpy as np

        keys = np.concatenate([self.keys, *(k for k, _ in self.pending)])
        counts = np.concatenate([self.counts, *(c.astype(np.int64) for _, c in self.pending)])
        self.pending, self.n_pending = [], 0
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        keys, counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts
        if len(keys) > self.capacity:
            beyond = len(keys) - self.capacity - 1
            off = int(np.partition(counts, beyond)[beyond])
            self.lost += off
            keys, counts = keys[counts > off], counts[counts > off] - off
        self.keys, self.counts = keys, counts

    def frequent(self, least: int):
        """Keys that may have occurred ``least`` times: all that did, and perhaps others."""
        self.merge()
        return self.keys[self.counts + self.lost >= least]


def _survivors(bits: int, least: int):
    """Of rows sorted by partition, each partition's slice of the filter."""
    filter_bits = max(FILTER_BITS, bits + 3)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        part = summary = None

        def done():
            keys = summary.frequent(least)
            flags = np.zeros(1 << (filter_bits - bits), bool)
            flags[keys >> np.uint32(max(0, 32 - filter_bits + bits))] = True
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([len(keys)], pa.int64()), pa.array([np.packbits(flags).tobytes()], pa.binary())], ["part", "n", "flags"])

        for batch in batches:
            for p, mass, keys, counts in zip(*(batch.column(i) for i in range(4))):
                if p.as_py() != part:
                    if summary is not None:
                        yield done()
                    part, summary = p.as_py(), Summary(mass.as_py() // least + 1)
                summary.add(np.frombuffer(keys.as_buffer(), "<u4"), np.frombuffer(counts.as_buffer(), "<u4"))
        if summary is not None:
            yield done()

    return run


def frequent_filter(texts: DataFrame, least: int):
    """Bits by the first bits of a phrase's hash: 0 where no phrase occurs ``least`` times."""
    import numpy as np

    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(0, (int(size) // 2 // MASS).bit_length())  # a phrase occurrence takes about two bytes of text
    summaries, path = materialised(texts.mapInArrow(trimmed(_summaries(bits)), "part long, mass long, keys binary, counts binary"), "summaries")
    mass = stored(summaries.groupBy("part").agg(F.sum("mass").alias("mass")), "mass")
    dealt = summaries.drop("mass").join(mass, "part").select("part", "mass", "keys", "counts").repartition(1 << bits, "part").sortWithinPartitions("part")
    rows = dealt.mapInArrow(trimmed(_survivors(bits, least)), "part long, n long, flags binary").collect()
    drop_table(texts.sparkSession, path)
    flags = np.zeros(1 << (max(FILTER_BITS, bits + 3) - 3), np.uint8)
    width = len(flags) >> bits
    for r in rows:
        flags[r["part"] * width : (r["part"] + 1) * width] = np.frombuffer(r["flags"], np.uint8)
    return flags


def _counted(shared):
    """Exact counts of the phrases that the filter lets through, and of all words (size 0)."""

    def work(taken):
        import numpy as np

        flags = shared.value
        shift = np.uint64(64 - (len(flags).bit_length() + 2))
        for lang, ids, old, words, hashes in taken:
            for n, at, h in phrases(lang, ids, old, hashes):
                if n == 1:
                    yield _rows(lang, 0, [b""], [len(at)])
                h = h >> shift
                at = at[(flags[h >> np.uint64(3)] >> (np.uint8(7) - (h & np.uint64(7)).astype(np.uint8))) & 1 > 0]
                packed = np.zeros(len(at), np.int64)
                for k in range(n):
                    packed = packed << 21 | ids[at + k]
                packed, counts = np.unique(packed, return_counts=True)
                columns = [(packed >> (21 * (n - 1 - k)) & (1 << 21) - 1).tolist() for k in range(n)]
                made = [b" ".join(words[i] for i in p) for p in zip(*columns)]
                for a in range(0, len(made), 50_000):
                    yield _rows(lang, n, made[a : a + 50_000], counts[a : a + 50_000])

    def _rows(lang, size, made, counts):
        import pyarrow as pa

        k = len(made)
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * k, pa.string()), pa.array([size] * k, pa.int32()), pa.array(made, pa.binary()), pa.array(counts, pa.int64())],
            ["lang", "size", "phrase", "a"],
        )

    return _read(work)


def phrase_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Stored (lang, size, phrase, a): all phrases of one to three words that occur ``least`` times; size 0: words in all."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_of().alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(frequent_filter(texts, least))
    parts = texts.mapInArrow(trimmed(_counted(shared)), "lang string, size int, phrase binary, a long")
    counts = parts.groupBy("lang", "size", "phrase").agg(F.sum("a").alias("a")).filter(f"size = 0 or a >= {least}")
    return stored(counts.withColumn("phrase", F.col("phrase").cast("string")), "phrases")


def _score(a: Column, left: Column, right: Column) -> Column:
    wide = lambda c: c.cast("decimal(19,0)")
    return F.call_function("div", F.lit(1000000).cast("decimal(7,0)") * wide(a) * wide(a), wide(left) * wide(right))


def with_parts(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """Adds l, r, score of the cut with the lowest score, the first one of equals."""
    words = F.split("phrase", " ")
    joined = lambda begin, n: F.array_join(F.slice(words, begin, n), " ")
    part = lambda k, left, text: F.struct(F.lit(k).alias("k"), F.lit(left).alias("left"), text.alias("part"))
    cut = lambda k: [part(k, True, joined(1, k)), part(k, False, joined(k + 1, F.col("size") - k))]
    cuts = candidates.select("lang", "phrase", "size", "a", F.inline(F.when(F.col("size") == 2, F.array(*cut(1))).otherwise(F.array(*cut(1), *cut(2)))))
    known = counts.filter("size in (1, 2)").select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))
    total = counts.filter("size = 0").agg(F.sum("a")).first()[0] or 0
    hot = known.filter(F.col("f") * HOT >= total)  # at most 2 * HOT, as words and pairs are each no more than all words
    with_hot = cuts.join(F.broadcast(hot), ["lang", "part"], "left")
    rest = with_hot.filter("f is null").drop("f").join(known, ["lang", "part"])
    found = with_hot.filter("f is not null").unionByName(rest)
    at = lambda k, left: F.max(F.when((F.col("k") == k) & (F.col("left") == left), F.col("f"))).alias(f"{'l' if left else 'r'}{k}")
    wide = found.groupBy("lang", "phrase").agg(F.first("size").alias("size"), F.first("a").alias("a"), at(1, True), at(1, False), at(2, True), at(2, False))
    cut_score = lambda k: _score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}"))
    wide = wide.withColumns({"s1": cut_score(1), "s2": cut_score(2)})
    best = lambda name: F.when(F.col("s2") < F.col("s1"), F.col(f"{name}2")).otherwise(F.col(f"{name}1"))
    return wide.select("lang", "phrase", "a", best("l").alias("l"), best("r").alias("r"), best("s").alias("score"))


def uncovered(counts: DataFrame, covered: int = COVERED) -> DataFrame:
    """Candidates (phrases of two or three words) without those that a longer one holds nearly as often."""
    candidates = counts.filter("size >= 2")
    words = F.split("phrase", " ")
    inside = F.explode(F.array(F.array_join(F.slice(words, 1, 2), " "), F.array_join(F.slice(words, 2, 2), " ")))
    longer = candidates.filter("size = 3").select("lang", inside.alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    pairs = candidates.filter("size = 2").join(longer, ["lang", "phrase"], "left").filter(f"longer is null or 100 * longer < {covered} * a")
    return pairs.select(*candidates.columns).unionByName(candidates.filter("size = 3"))


def collocations(docs: DataFrame, least: int = LEAST, covered: int = COVERED, most: int = MOST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``most`` phrases of each language."""
    counts = phrase_counts(docs, least)
    scored = with_parts(uncovered(counts, covered), counts)
    order = [F.desc("score"), F.desc("a"), "phrase"]
    salted = scored.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).filter(F.col("rank") <= most)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= most)
    totals = counts.filter("size = 0").select("lang", F.col("a").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11(spark, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP11_SQL = f"""
with pieces as (
    select coalesce(lang, 'und') as lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) as piece
    from documents
), worded as (
    select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from pieces
), placed as (
    select lang, w, unnest(generate_series(1, len(w))) as i from worded where len(w) > 0
), f as materialized (
    select lang, size, phrase, count(*) as a from (
        select lang, 1 as size, w[i] as phrase from placed
        union all select lang, 2, w[i] || ' ' || w[i + 1] from placed where i < len(w)
        union all select lang, 3, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] from placed where i + 1 < len(w)
    ) group by lang, size, phrase
), n as (select lang, cast(sum(a) as bigint) as n from f where size = 1 group by lang),
candidate as materialized (select *, string_split(phrase, ' ') as w from f where size >= 2 and a >= {LEAST}),
longer as (
    select lang, phrase, max(a) as longer from (
        select lang, w[1] || ' ' || w[2] as phrase, a from candidate where size = 3
        union all select lang, w[2] || ' ' || w[3], a from candidate where size = 3
    ) group by lang, phrase
), cut as (
    select c.lang, c.phrase, c.a, 1 as k, w[1] as x, array_to_string(w[2:], ' ') as y from candidate c left join longer using (lang, phrase)
    where c.size = 3 or longer is null or 100 * longer < {COVERED} * c.a
    union all select lang, phrase, a, 2, w[1] || ' ' || w[2], w[3] from candidate where size = 3
), scored as (
    select cut.lang, cut.phrase, cut.a, cut.k, l.a as l, r.a as r,
        cast((1000000::hugeint * cut.a * cut.a) // (l.a::hugeint * r.a) as bigint) as score
    from cut join f l on l.lang = cut.lang and l.phrase = cut.x join f r on r.lang = cut.lang and r.phrase = cut.y
), worst as (
    select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1
), ranked as (
    select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from worst
)
select ranked.lang, rank, phrase, a, l, r, n, score from ranked join n using (lang) where rank <= {MOST}
"""
