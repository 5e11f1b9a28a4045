"""Toxicity of documents: logistic regression by FTRL-proximal over hashed word n-grams and skip-grams.

A document's features are the hashes of its distinct words, pairs of neighbours, and pairs with one or two words between them; a
feature counts once, however often it occurs. Words are runs of letters and digits, and of all characters beyond ASCII.

Training takes a bounded sample of the labelled documents, each label on its own: all rows or about ``ROWS`` of them by a hash of
id and text; the intercept is corrected for the two shares. Features in fewer than ``SEEN`` sample documents are left out. One task
takes the sample's features in hash order and learns by FTRL-proximal: each coordinate has its own rate, and L1 leaves most weights at
exactly zero. What remains is sent to all tasks as two arrays; its size is bounded by that of the sample. Scoring reads all texts once and
shuffles nothing.

Cases: a null or empty text has no features and gets the intercept's score; a text may have any length, and is cut in slices
that overlap by a feature's width; repeated rows are learned once and scored each; an id with several labels counts as toxic if one says so; a null
id has no label and is in no fold; without labels every score is 0; with one label only, that one is likely everywhere; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewatch.llm.common import fold, stored, table, text_of, trimmed

#: Sample documents of each label, about; documents that a feature needs there.
ROWS, SEEN = 8192, 5
#: FTRL-proximal: rate, its offset, passes over the sample, L1 penalty of a pass in roots of the number of documents (chance
#: sums of gradients grow with that root, so the penalty outweighs them at every size of the sample).
ALPHA, BETA, PASSES, L1 = 4.0, 1.0, 8, 0.044
#: Words skipped between the two of a pair at most; characters of a slice of a long text; of texts handled together.
SKIP, SLICE, TOGETHER = 2, 1 << 20, 1 << 21
TOXIC_FROM = 0.7
#: Bits of a feature's hash.
BITS = 32

_WORDS = bytes(c if chr(c).isalnum() and c < 128 or c >= 128 else 32 for c in range(256))


class Reader:
    """Features of texts."""

    def __init__(self):
        import xxhash

        class Hashes(dict):
            def __missing__(self, word):
                self[word] = h = xxhash.xxh64_intdigest(word)
                return h

        self.hashes = Hashes()

    def features(self, texts: list[str]):
        """(text number, feature) arrays; a feature may stand there more than once."""
        import numpy as np

        if len(self.hashes) > 500_000:
            self.hashes.clear()
        parts, owners = [], []
        for i, text in enumerate(texts):
            data = text.encode("utf-8", "surrogatepass").lower().translate(_WORDS)
            begin, tail = 0, []
            while begin < len(data):
                end = data.find(b" ", begin + SLICE)
                end = len(data) if end < 0 else end
                words = tail + data[begin:end].split()
                parts.append(words)
                owners.append(i)
                begin, tail = end, words[-SKIP - 1 :]
        lengths = np.array([len(p) for p in parts], np.int64)
        flat = np.fromiter((h for p in parts for h in map(self.hashes.__getitem__, p)), np.uint64, int(lengths.sum()))
        part = np.repeat(np.arange(len(parts)), lengths)
        owner = np.array(owners, np.int64)[part] if len(parts) else part
        found, whose = [mixed(flat, 0)], [owner]
        for gap in range(1, SKIP + 2):
            same = part[gap:] == part[:-gap]
            found.append(mixed(flat[:-gap][same] * np.uint64(0x9E3779B97F4A7C15) + flat[gap:][same], gap))
            whose.append(owner[gap:][same])
        return np.concatenate(whose), np.concatenate(found)


def mixed(h, kind: int):
    import numpy as np

    h = (h ^ (h >> np.uint64(31)) ^ np.uint64(kind)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return (h >> np.uint64(64 - BITS)).astype(np.uint32)


def runs(texts: list[str]):
    begin, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= TOGETHER or i == len(texts) - 1:
            yield begin, texts[begin : i + 1]
            begin, size = i + 1, 0


def _featured(batches):
    """(label, order, text) as (label, order, sorted distinct features)."""
    import numpy as np
    import pyarrow as pa

    reader = Reader()
    for batch in batches:
        labels, order, texts = batch.column(0), batch.column(1), batch.column(2).to_pylist()
        for begin, part in runs(texts):
            whose, found = reader.features(part)
            own = [np.unique(found[whose == i]).tobytes() for i in range(len(part))] if len(part) < 8 else _by_owner(whose, found, len(part))
            yield pa.RecordBatch.from_arrays([labels.slice(begin, len(part)), order.slice(begin, len(part)), pa.array(own, pa.binary())], ["label", "order", "features"])


def _by_owner(whose, found, n: int) -> list[bytes]:
    import numpy as np

    pairs = np.unique(whose.astype(np.uint64) << np.uint64(BITS) | found)
    cuts = np.searchsorted(pairs, np.arange(n + 1, dtype=np.uint64) << np.uint64(BITS))
    low = pairs.astype(np.uint32)
    return [low[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]


def _document_counts(batches):
    import numpy as np
    import pyarrow as pa

    held, size = [], 0

    def done():
        values, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(values.astype(np.int64)), pa.array(n, pa.int64())], ["f", "n"])

    for batch in batches:
        for f in batch.column(0):
            held.append(np.frombuffer(f.as_buffer(), np.uint32))
            size += len(held[-1])
            if size >= 1 << 22:
                yield done()
                held, size = [], 0
    if size:
        yield done()


def ftrl(rows, n: int, passes: int = PASSES):
    """Weights and intercept learned from (label, feature numbers) rows, ``passes`` times in their order."""
    import math

    import numpy as np

    z, root = np.zeros(n + 1), np.zeros(n + 1)  # root: of the sum of squared gradients; the last one is the intercept's
    l1 = np.full(n + 1, L1 * passes * math.sqrt(len(rows)))
    l1[n] = 0.0

    def weights(at):
        s = z[at]
        shrunk = np.sign(s) * np.maximum(np.abs(s) - l1[at], 0.0)
        return -shrunk * ALPHA / (BETA + root[at])

    for _ in range(passes):
        for label, at in rows:
            at = np.append(at, n)
            w = weights(at)
            total = float(w.sum())
            g = 1.0 / (1.0 + math.exp(-max(-35.0, min(35.0, total)))) - label
            grown = np.sqrt(root[at] ** 2 + g * g)
            z[at] += g - (grown - root[at]) / ALPHA * w
            root[at] = grown
    w = weights(np.arange(n + 1))
    return w[:n], float(w[n])


def _learned(shared):
    """All rows of a bounded sample as nonzero (feature, weight) rows; feature -1 is the intercept."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        known, rows = shared.value, []
        for batch in batches:
            for label, f in zip(batch.column(0).to_pylist(), batch.column(1)):
                f = np.frombuffer(f.as_buffer(), np.uint32)
                at = np.minimum(np.searchsorted(known, f), max(0, len(known) - 1))
                rows.append((label, at[known[at] == f] if len(known) else at[:0]))
        if rows:
            weights, intercept = ftrl(rows, len(known))
            keep = np.flatnonzero(weights)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(known[keep].astype(np.int64), -1)), pa.array(np.append(weights[keep], intercept))], ["f", "weight"]
            )

    return run


class Weights:
    """Sorted features, their weights, and the intercept (None: nothing was learned)."""

    def __init__(self, features, weights, intercept):
        self.features, self.weights, self.intercept = features, weights, intercept


def train(docs: DataFrame, labels: DataFrame, rows: int = ROWS, seen: int = SEEN) -> Weights:
    """Learned from documents whose id has a label in ``labels`` (doc_id, toxic)."""
    import math

    import numpy as np

    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("label"))
    texts = docs.select("doc_id", text_of().alias("text"))
    keyed = texts.select("doc_id", F.xxhash64("doc_id", "text").alias("order")).join(known, "doc_id").select("label", "doc_id", "order").distinct()
    keyed = stored(keyed, "labelled")
    n = {r["label"]: r["n"] for r in keyed.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n:
        return Weights(np.zeros(0, np.uint32), np.zeros(0), None)
    share = {label: min(1.0, rows / k) for label, k in n.items()}
    part = F.shiftright(F.xxhash64("order", F.lit(12)), 33) + (1 << 30)  # 0 .. 2^31
    bound = F.when(F.col("label") == 1, F.lit(int(share.get(1, 0.0) * 2**31))).otherwise(F.lit(int(share.get(0, 0.0) * 2**31)))
    chosen = stored(keyed.filter(part < bound), "chosen")
    sample = texts.withColumn("order", F.xxhash64("doc_id", "text")).join(chosen, ["doc_id", "order"]).select("label", "order", "text").dropDuplicates(["label", "order"])
    sample = stored(sample.mapInArrow(trimmed(_featured), "label int, order long, features binary"), "features")
    counts = sample.select("features").mapInArrow(trimmed(_document_counts), "f long, n long").groupBy("f").agg(F.sum("n").alias("n")).filter(F.col("n") >= seen)
    features = np.sort(counts.select("f").toPandas()["f"].to_numpy(np.uint32))
    shared = docs.sparkSession.sparkContext.broadcast(features)
    inputs = sample.repartition(1).sortWithinPartitions(F.xxhash64("order"), "label").select("label", "features")
    learned = inputs.mapInArrow(trimmed(_learned(shared)), "f long, weight double").toPandas().sort_values("f")
    intercept = float(learned["weight"].iloc[0]) + math.log(share.get(0, 1.0)) - math.log(share.get(1, 1.0))
    return Weights(learned["f"].to_numpy()[1:].astype(np.uint32), learned["weight"].to_numpy()[1:], intercept)


def _scored(shared):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        reader, (features, weights, intercept) = Reader(), shared.value
        first = np.zeros(1 << 20, bool)
        first[features >> np.uint32(BITS - 20)] = True
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for begin, part in runs(texts):
                total = np.full(len(part), -np.inf if intercept is None else intercept)
                whose, found = reader.features(part)
                at = np.flatnonzero(first[found >> np.uint32(BITS - 20)])
                if len(at) and len(features):
                    whose, found = whose[at], found[at]
                    place = np.minimum(np.searchsorted(features, found), len(features) - 1)
                    there = features[place] == found
                    pairs = np.unique(whose[there] * len(features) + place[there])
                    total += np.bincount(pairs // len(features), weights[pairs % len(features)], len(part))
                score = 1 / (1 + np.exp(-np.clip(total, -700, 700))) if intercept is not None else np.zeros(len(part))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, len(part)), pa.array(score)], ["doc_id", "score"])

    return run


def score(docs: DataFrame, model: Weights) -> DataFrame:
    """doc_id, score (0 to 1) of each row."""
    shared = docs.sparkSession.sparkContext.broadcast((model.features, model.weights, model.intercept))  # plain arrays, as tasks may lack this package
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return texts.mapInArrow(trimmed(_scored(shared)), "doc_id long, score double")


def op12(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False))
    model = train(docs.filter(~held_out), labels.filter(~held_out))
    return score(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))
