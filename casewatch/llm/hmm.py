"""Hidden Markov language model over words.

A hidden state emits a class of words. The ``OWN`` most frequent words are classes of their own, the
end of a text is one, and all other words fall into ``SHAPES`` classes by their last bytes; within such a class
a word has its smoothed share of the class's training tokens. Probabilities sum to one over the known words and
one unknown word per class.

Token counts are gathered from all training texts. Words beyond the ``DICTIONARY`` most frequent, which are
all that tasks hold, get their counts by a join. Baum-Welch steps add up expected counts over partitions; the first
ones, over a bounded sample, only give the place to start from. Texts are cut into chunks for training, so that
many are handled at a time; scores are exact, by the scaled forward recursion over whole texts.

Cases: a null or empty text is one end token; repeated rows are counted and scored each; without
training texts every class is equally likely; a null doc_id is a training row. Further columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewatch.llm.common import fold, most_frequent, spread_sample, stored, table, text_of

STATES, OWN, SHAPES, DICTIONARY = 8, 8192, 256, 131072
CLASSES = OWN + 1 + SHAPES
END = OWN
#: Training: whole passes, passes over the sample, about how many texts it has, tokens in a chunk.
PASSES, FIRST_PASSES, SAMPLE, CHUNK = 3, 20, 512, 512
#: Tokens handled together by a task.
BATCH = 1 << 19
#: Words counted by a task before it hands them on.
HELD = 300_000

SEQUENCE = (
    "uid long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, inner double, "
    "classes binary, rare array<binary>, times array<int>"
)


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


def shape(word: bytes) -> int:
    from zlib import crc32

    return crc32(word[-2:]) % SHAPES


def _counted(batches):
    from collections import Counter

    import pyarrow as pa

    counts: Counter = Counter()

    def flush():
        words = list(counts)
        for a in range(0, len(words), 50_000):
            part = words[a : a + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.binary()), pa.array([shape(w) for w in part], pa.int32()), pa.array([counts[w] for w in part], pa.int64())],
                ["token", "shape", "n"],
            )
        counts.clear()

    for batch in batches:
        for text in batch.column(0).to_pylist():
            counts.update(words_of(text))
            counts[b""] += 1  # the end of the text
            if len(counts) > HELD:
                yield from flush()
    yield from flush()


def count_tokens(texts: DataFrame) -> DataFrame:
    """Stored (token, shape, n) over a column of texts; the empty token is the end of a text."""
    parts = texts.mapInArrow(_counted, "token binary, shape int, n long")
    return stored(parts.groupBy("token", "shape").agg(F.sum("n").alias("n")), "tokens")


class Words:
    """What tasks know of words: the most frequent ones and the totals of the classes."""

    def __init__(self, counts: DataFrame):
        import numpy as np

        top = most_frequent(counts, DICTIONARY).toPandas().sort_values(["n", "token"], ascending=[False, True], ignore_index=True)
        totals = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
        self.n_tokens, self.n_words = int(totals[0] or 0), int(totals[1])
        per_shape = counts.filter(F.length("token") > 0).groupBy("shape").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()
        size, kinds = np.zeros(SHAPES), np.zeros(SHAPES)
        for r in per_shape:
            size[r["shape"]], kinds[r["shape"]] = r["n"], r["v"]
        words = [bytes(t) for t in top["token"]]
        self.index = {w: i for i, w in enumerate(words)}
        n = top["n"].to_numpy(dtype=np.float64)
        self.classes = np.zeros(len(words) + 1, np.uint16)
        own = 0
        for i, w in enumerate(words):
            if w == b"":
                self.classes[i] = END
            elif own < OWN:
                self.classes[i] = own
                size[top["shape"][i]] -= n[i]
                kinds[top["shape"][i]] -= 1
                own += 1
            else:
                self.classes[i] = OWN + 1 + top["shape"][i]
        self.log_total = np.log10(size + kinds + 1)
        self.base = np.append(np.log10(n + 1), 0.0)
        shared = self.classes > END
        self.inner = np.where(shared, self.base - self.log_total[np.maximum(self.classes.astype(int) - OWN - 1, 0)], 0.0)
        self.inner[-1] = 0.0
        if b"" not in self.index:
            self.index[b""] = len(words)
            self.classes[-1] = END


def _sequences(shared):
    def run(batches):
        from collections import Counter

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        known = shared.value

        class Index(dict):
            def __missing__(self, word):
                return -1

        find = Index(known.index).__getitem__
        uid = TaskContext.get().partitionId() << 33
        names = [f.split()[0] for f in SEQUENCE.split(", ")]
        types = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int32())]
        unknown_end = known.n_tokens == 0
        for batch in batches:
            rows = []
            for doc_id, held, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = words_of(text)
                words.append(b"")
                ids = np.fromiter(map(find, words), np.int64, len(words))
                there = ids >= 0
                classes = known.classes[ids]
                at = np.flatnonzero(~there).tolist()
                rare = Counter(words[i] for i in at)
                ids, inner = ids[there], 0.0
                if at:
                    shapes = [shape(words[i]) for i in at]
                    classes[at] = np.array(shapes) + OWN + 1
                    inner = -known.log_total[shapes].sum()  # the other half of a rare word's share comes with its count
                rows.append((
                    uid, doc_id, held, len(words), len(ids) - unknown_end, float(known.base[ids].sum()), float(known.inner[ids].sum() + inner),
                    classes.astype("<u2").tobytes(), list(rare), list(rare.values()),
                ))
                uid += 1
                if len(rows) == 500:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return run


def layout(lengths):
    """Longest first: order of the sequences, and how many of them are longer than 0, 1, ..."""
    import numpy as np

    order = np.argsort(-lengths, kind="stable")
    longer = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(lengths.max(initial=0)), side="right")
    return order, longer


def forward(flat, lengths, start, step, emit):
    """log10 likelihood of each class sequence, exactly, scaled at every place."""
    import numpy as np

    order, longer = layout(lengths)
    starts = (np.cumsum(lengths) - lengths)[order]
    total = np.zeros(len(lengths))
    for t, k in enumerate(longer):
        e = emit[flat[starts[:k] + t]]
        a = start * e if t == 0 else (a[:k] @ step) * e
        s = a.sum(axis=1)
        a /= s[:, None]
        total[:k] += np.log10(s)
    out = np.zeros(len(lengths))
    out[order] = total
    return out


def expected(flat, lengths, first, starts_by, step, emit):
    """Baum-Welch counts: emissions by class, steps, starts of texts and of later chunks."""
    import numpy as np

    order, longer = layout(lengths)
    begin = (np.cumsum(lengths) - lengths)[order]
    states = step.shape[0]
    alpha, scale = np.empty((len(flat), states)), np.empty(len(flat))
    for t, k in enumerate(longer):
        at = begin[:k] + t
        e = emit[flat[at]]
        a = starts_by[first[order].astype(int)] * e if t == 0 else (a[:k] @ step) * e
        s = a.sum(axis=1)
        a /= s[:, None]
        alpha[at], scale[at] = a, s
    steps = np.zeros((states, states))
    beta = np.ones((len(lengths), states))
    for t in range(len(longer) - 2, -1, -1):
        k = longer[t + 1]
        at = begin[:k] + t
        b = emit[flat[at + 1]] * beta[:k] / scale[at + 1][:, None]
        steps += alpha[at].T @ b
        beta[:k] = b @ step.T
        alpha[at] *= beta[:k]
    gamma = alpha
    emissions = np.stack([np.bincount(flat, gamma[:, s], CLASSES) for s in range(states)], 1)
    opening = gamma[begin]
    return emissions, steps * step, np.stack([opening[~first[order]].sum(0), opening[first[order]].sum(0)])


def chunked(sequences: list):
    """Chunks of sequences: all classes, lengths of chunks, whether each begins its text."""
    import numpy as np

    lengths, first = [], []
    for s in sequences:
        n = -(-len(s) // CHUNK)
        lengths += [CHUNK] * (n - 1) + [len(s) - CHUNK * (n - 1)]
        first += [True] + [False] * (n - 1)
    return np.concatenate(sequences).astype(np.int64), np.array(lengths), np.array(first)


def maximised(emissions, steps, starts) -> dict:
    """Smoothed model from expected counts; ``starts``: of later chunks, of texts."""
    emissions = emissions + 0.01
    steps, starts = steps + 0.1, starts + 0.1
    return {"emit": emissions / emissions.sum(0), "step": steps / steps.sum(1, keepdims=True), "starts": starts / starts.sum(1, keepdims=True)}


def beginning(sequences: list) -> dict:
    """Model after the first passes over a sample, from a fixed random start."""
    import numpy as np

    rng = np.random.default_rng(0)
    shared = np.bincount(np.concatenate(sequences), minlength=CLASSES) if sequences else np.zeros(CLASSES)
    model = maximised((shared + 0.01)[:, None] * rng.uniform(0.5, 1.5, (CLASSES, STATES)), np.ones((STATES, STATES)) + 5 * np.eye(STATES), np.ones((2, STATES)))
    for _ in range(FIRST_PASSES if sequences else 0):
        model = maximised(*expected(*chunked(sequences), model["starts"], model["step"], model["emit"]))
    return model


def grouped(batches, *columns: int):
    """Rows of record batches in lists of about ``BATCH`` tokens; the first column holds classes."""
    import numpy as np

    rows, size = [], 0
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in columns)):
            classes = np.frombuffer(row[0], "<u2")
            rows.append((classes, *row[1:]))
            size += len(classes)
            if size >= BATCH:
                yield rows
                rows, size = [], 0
    if rows:
        yield rows


def _expected(shared):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        m = shared.value
        total = None
        for rows in grouped(batches, 0):
            found = expected(*chunked([r[0] for r in rows]), m["starts"], m["step"], m["emit"])
            total = found if total is None else tuple(a + b for a, b in zip(total, found))
        if total is not None:
            table = np.concatenate(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(table), dtype=np.int32)), *map(pa.array, table.T)], ["place", *(f"s{i}" for i in range(STATES))])

    return run


def train(sequences: DataFrame) -> dict:
    """Model from the rows that are not held out; all of them take part in each whole pass."""
    import numpy as np

    spark = sequences.sparkSession
    rows = sequences.filter(~F.col("held_out"))
    sample = spread_sample(rows, F.col("uid"), rows.count(), SAMPLE).select("classes").toPandas()["classes"]
    model = beginning([np.frombuffer(bytes(s), "<u2") for s in sample])
    columns = [f"s{i}" for i in range(STATES)]
    tasks = 2 * spark.sparkContext.defaultParallelism  # each hands on one table of counts, however many rows it has
    for _ in range(PASSES):
        parts = rows.select("classes").coalesce(tasks).mapInArrow(
            _expected(spark.sparkContext.broadcast(model)), "place int, " + ", ".join(f"{c} double" for c in columns)
        )
        found = parts.groupBy("place").agg(*[F.sum(c).alias(c) for c in columns]).orderBy("place").toPandas()[columns].to_numpy()
        if not len(found):
            break
        model = maximised(found[:CLASSES], found[CLASSES : CLASSES + STATES], found[CLASSES + STATES :])
    return model


LOCAL = "uid long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, inner double"


def _forward(shared):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        m = shared.value
        types = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        for rows in grouped(batches, *range(8)):
            classes, *rest = zip(*rows)
            path = forward(np.concatenate(classes).astype(np.int64), np.array([len(c) for c in classes]), m["starts"][1], m["step"], m["emit"])
            columns = [pa.array(c, t) for c, t in zip(rest, types)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(path)], [*(f.split()[0] for f in LOCAL.split(", ")), "path"])

    return run


def score(docs: DataFrame, held_out) -> DataFrame:
    """log10 probability of each text by the model of the texts that are not held out, and by their word counts alone."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), text_of().alias("text"))
    counts = count_tokens(texts.filter(~F.col("held_out")).select("text"))
    words = Words(counts)
    sequences = stored(texts.mapInArrow(_sequences(spark.sparkContext.broadcast(words)), SEQUENCE), "sequences")
    model = train(sequences)
    local = sequences.select("classes", *(f.split()[0] for f in LOCAL.split(", "))).mapInArrow(
        _forward(spark.sparkContext.broadcast(model)), LOCAL + ", path double"
    )
    rare = sequences.select("uid", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("uid", F.col("r.rare").alias("token"), F.col("r.times").alias("times"))
    count, times = F.coalesce("n", F.lit(0)), F.col("times")
    per_text = (
        rare.join(counts.select("token", "n"), "token", "left")
        .groupBy("uid").agg(F.sum(times * F.log10(count + 1)).alias("rare_base"), F.sum(F.when(count > 0, times).otherwise(0)).alias("rare_known"))
    )
    done = local.join(per_text, "uid", "left")
    known, base = F.coalesce("rare_known", F.lit(0)), F.coalesce("rare_base", F.lit(0.0))
    return done.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + known).cast("long").alias("n_known"),
        F.lit(words.n_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + base - F.col("n_tokens") * math.log10(words.n_tokens + words.n_words + 1)).alias("base_score"),
        (F.col("path") + F.col("inner") + base).alias("score"),
    )


def op2(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fold(F.col("doc_id"), 7) == 2)
