"""Size-aware heavy-light join of documents by the Jaccard similarity of their n-gram sets.

A document's set are the hashes of its distinct 5-word shingles; equal sets form a class, and one
representative of each goes on. Small (light) sets put down all subsets of the fixed sizes that two
similar ones must share. Large (heavy) sets put down their prefix in one order of all shingles,
frequent ones last: similar sets share one of its elements, so the inverted lists of these are scanned. The prefix is a
twentieth longer than that needs, so that similar sets share that many of its elements, and a set with fewer elements
that occur elsewhere is out. The size boundary is where the two costs, summed over all sets, are least. Sets just below it do both.

A list is not turned into pairs. In star rounds each member is compared with one member of its list, its centre; what
is linked by then is one component. At last, the members of lists with one centre that lie outside their largest component are compared
with all others: cells of two blocks of bounded size are dealt out, and a task counts the elements that their whole sets share
by products of matrices. Only links leave a cell, no more than there are components in it. Thus every component is that of all links.
Cells first get the sets in brief, two bytes an element: from these a task knows how much two sets can share at most,
and whole sets move only to cells in which that allows a link.

Cases: null texts and texts without words have empty sets and link with nothing; a text of fewer words
than a shingle has one element; repeated rows are one class; rows without id have a null component unless
they reach an id; an empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

from functools import cache
from math import comb

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewatch.llm.common import materialised, most_frequent, small_batches, stored, table, text_of, trimmed
from casewatch.llm.components import components
from casewatch.session import discard, recorded

WORDS, PERCENT = 5, 80
#: Most elements of a light set.
LIGHT = 16
#: Shingles known as frequent at most, and how often one is found within a run of ``RUN`` shingles to be one.
FREQUENT, OFTEN, RUN = 1 << 18, 6, 1 << 21
#: Sets on a side of a cell, and elements in them, about; characters of texts cut at a time.
CELL_SETS, CELL_ELEMENTS, TOGETHER = 512, 1 << 20, 1 << 20
#: Letters of words hashed at a time, about; words longer than ``LONG_WORD`` bytes are hashed one by one.
LETTERS, LONG_WORD = 1 << 16, 512
#: Rows of ids that are sent to all tasks at most (24 bytes each; half as many rows of cells, 48 bytes each).
SENT = 1 << 21
#: Cost of scanning a list entry, in entries put down.
SCAN = 2.0


def least_overlap(n: int) -> int:
    """Elements that a set of n shares at least with any similar one."""
    return -(-PERCENT * n // 100)


def prefix_length(n: int) -> int:
    return n - least_overlap(n) + 1


def surplus(n: int) -> int:
    """Elements that the longer prefixes of two similar sets share at least, if the smaller one has n elements."""
    return n // 20 + 1


def subset_sizes(n: int, boundary: int) -> list[int]:
    """Sizes of the subsets that a light set of n puts down: for each size of partner, the larger set's least overlap."""
    return sorted({least_overlap(m) for m in range(n, min(boundary, 100 * n // PERCENT) + 1)})


def light_cost(n: int, boundary: int) -> int:
    return sum(comb(n, c) for c in subset_sizes(n, boundary))


def choose_boundary(sizes: dict[int, int]) -> int:
    """The size up to which subsets are put down, by the total cost over all sets."""

    def cost(boundary: int) -> float:
        low = least_overlap(boundary + 1)
        return sum(
            k * ((light_cost(n, boundary) if n <= boundary else 0) + (SCAN * prefix_length(n) if n >= low else 0)) for n, k in sizes.items() if n
        )

    return min(range(LIGHT + 1), key=lambda b: (cost(b), b))


@cache
def _letters():
    """Codes of bytes (A-Z as a-z), which bytes are white space, and powers of an odd number."""
    import numpy as np
    import xxhash

    codes = np.array([xxhash.xxh64_intdigest(bytes([b]).lower()) for b in range(256)], np.uint64)
    white = np.isin(np.arange(256), [32, *range(9, 14)])
    powers = np.cumprod(np.array([1] + [0x9E3779B97F4A7C15] * (LONG_WORD - 1), np.uint64))
    return codes, white, powers


def word_hashes(data) -> tuple:
    """Where the words of the bytes begin, and their hashes: sums of codes of bytes times powers by place."""
    import numpy as np
    import xxhash

    codes, white, powers = _letters()
    edges = np.flatnonzero(np.diff(white[data], prepend=True, append=True))
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    hashes = np.empty(len(starts), np.uint64)
    at, last = 0, np.cumsum(np.minimum(lengths, LONG_WORD))
    while at < len(starts):
        end = max(at + 1, int(np.searchsorted(last, (last[at - 1] if at else 0) + LETTERS, "right")))
        n = np.minimum(lengths[at:end], LONG_WORD)
        first = np.cumsum(n) - n
        place = np.arange(int(n.sum())) - np.repeat(first, n)
        hashes[at:end] = np.add.reduceat(codes[data[np.repeat(starts[at:end], n) + place]] * powers[place], first)
        at = end
    for i in np.flatnonzero(lengths > LONG_WORD).tolist():
        hashes[i] = xxhash.xxh64_intdigest(data[starts[i] : starts[i] + lengths[i]].tobytes().lower())
    return starts, hashes


def shingle_sets(texts: list[str]) -> list:
    """Sorted distinct shingle hashes of each text."""
    import numpy as np

    encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
    starts, flat = word_hashes(np.frombuffer(b"\n".join(encoded), np.uint8))
    begins = np.searchsorted(starts, np.cumsum([0] + [len(e) + 1 for e in encoded])).tolist()
    m = max(0, len(flat) - WORDS + 1)
    rolled = _combined([flat[k : k + m] for k in range(WORDS)], WORDS) if m else flat[:0]
    out = []
    for begin, end in zip(begins, begins[1:]):
        n = end - begin
        if n >= WORDS:
            one = np.sort(rolled[begin : end - WORDS + 1])
            out.append(one[np.concatenate(([True], one[1:] != one[:-1]))])
        elif n:
            out.append(_combined([flat[begin + k : begin + k + 1] for k in range(n)], n))
        else:
            out.append(flat[:0])
    return out


def _combined(columns: list, n: int):
    """One hash of several, dependent on their order and number."""
    import numpy as np

    h = np.full(len(columns[0]), n, np.uint64)
    for c in columns:
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15) + c
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def runs(texts: list[str], most: int = TOGETHER):
    begin, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= most or i == len(texts) - 1:
            yield begin, texts[begin : i + 1]
            begin, size = i + 1, 0


def _frequent(batches):
    import numpy as np
    import pyarrow as pa

    held, size = [], 0

    def flush():
        values, n = np.unique(np.concatenate(held), return_counts=True)
        often = n >= OFTEN
        return pa.RecordBatch.from_arrays([pa.array(values[often].view(np.int64)), pa.array(n[often].astype(np.int64))], ["h", "n"])

    for batch in batches:
        for _, texts in runs(batch.column(0).to_pylist()):
            for s in shingle_sets(texts):
                held.append(s)
                size += len(s)
            if size >= RUN:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


def frequent_shingles(texts: DataFrame):
    """Hashes of frequent shingles, the rarer first: no more than ``FREQUENT``.

    They only decide the order of shingles, and any order gives the same links.
    """
    found = texts.select("text").mapInArrow(trimmed(_frequent), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    with small_batches(texts.sparkSession):
        found = stored(found, "frequent")
    top = most_frequent(found, FREQUENT).toPandas().sort_values(["n", "h"])
    return top["h"].to_numpy(dtype="int64").copy()


SETS = "uid long, doc_id long, text_key long, n int, f1 long, f2 long, common_from int, head binary"


def _sets(shared):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        common = shared.value.view(np.uint64)
        by_hash = np.argsort(common)
        ordered = common[by_hash]
        uid = TaskContext.get().partitionId() << 33
        for batch in batches:
            ids, keys, texts = (c.to_pylist() for c in batch.columns)
            for begin, part in runs(texts):
                rows = []
                for s in shingle_sets(part):
                    n = len(s)
                    head, own = s, n
                    if n and len(ordered):
                        i = np.minimum(np.searchsorted(ordered, s), len(ordered) - 1)
                        known = ordered[i] == s
                        if known.any():
                            head = np.concatenate([s[~known], s[known][np.argsort(by_hash[i[known]])]])
                            own = n - int(known.sum())
                    if n > LIGHT:
                        head = head[: prefix_length(n) + surplus(n) - 1]
                    common_from = min(own, len(head))
                    rows.append((uid, n, int(s.sum(dtype=np.uint64).view(np.int64)), int(np.bitwise_xor.reduce(s * np.uint64(0x94D049BB133111EB)).view(np.int64)) if n else 0, common_from, head.tobytes()))
                    uid += 1
                uids, n, f1, f2, common_from, heads = zip(*rows)
                end = begin + len(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(uids, pa.int64()), pa.array(ids[begin:end], pa.int64()), pa.array(keys[begin:end], pa.int64()), pa.array(n, pa.int32()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()), pa.array(common_from, pa.int32()), pa.array(heads, pa.binary())],
                    ["uid", "doc_id", "text_key", "n", "f1", "f2", "common_from", "head"],
                )

    return run


#: ``size`` holds n and room in one number, n above 32 bits.
ENTRIES = "h long, uid long, size long, common boolean"


def _postings(boundary: int):
    """Entries of the lists; ``common``: of a frequent shingle, which is known to occur elsewhere."""

    def run(batches):
        from itertools import combinations

        import numpy as np
        import pyarrow as pa

        low = least_overlap(boundary + 1)
        for batch in batches:
            hashes, uids, sizes, common = [], [], [], []

            def put(h, uid, n, room, known):
                hashes.append(h)
                uids.append(np.full(len(h), uid))
                sizes.append(room.astype(np.int64) | n << 32)
                common.append(known)

            for uid, n, common_from, head in zip(*(batch.column(i).to_pylist() for i in range(4))):
                values = np.frombuffer(head, np.uint64)
                if n <= boundary:
                    inside = np.sort(values)
                    for c in subset_sizes(n, boundary):
                        chosen = np.array(list(combinations(range(n), c)))
                        h = _combined([inside[chosen[:, k]] for k in range(c)], c + 1000)
                        put(h, uid, n, np.full(len(h), n), np.zeros(len(h), bool))
                if n >= low:
                    h = values[: prefix_length(n) + surplus(n) - 1]
                    at = np.arange(len(h))
                    put(h, uid, n, n - at, at >= common_from)
            if hashes:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(hashes).view(np.int64)), pa.array(np.concatenate(uids), pa.int64()), pa.array(np.concatenate(sizes)), pa.array(np.concatenate(common))],
                    ["h", "uid", "size", "common"],
                )

    return run


def _repeated(batches):
    """Of rows sorted by their first column, those whose value the row before or after has too."""
    import numpy as np
    import pyarrow as pa

    held = before = None  # the last row so far, and the value before it
    for batch in batches:
        if not len(batch):
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        h = batch.column(0).to_numpy()
        keep = np.zeros(len(h), bool)
        keep[0] = before is not None and h[0] == before
        keep[1:] = h[1:] == h[:-1]
        keep[:-1] |= h[1:] == h[:-1]
        yield batch.slice(0, len(h) - 1).filter(pa.array(keep[:-1]))
        held = batch.slice(len(h) - 1)
        before = h[-2] if len(h) > 1 else before
    if held is not None and before is not None and held.column(0)[0].as_py() == before:
        yield held


def shared_lists(sets: DataFrame, boundary: int) -> DataFrame:
    """Stored inverted lists (h, uid, n, room) without sets that share too little; room: overlap left from the element on.

    Entries of frequent shingles need no look at others; the rest are dealt out and sorted by shingle, and a scan that
    holds two rows finds those with a neighbour.
    """
    entries = sets.select("uid", "n", "common_from", "head").mapInArrow(trimmed(_postings(boundary)), ENTRIES)
    columns = ["h", "uid", "size"]
    alone = entries.filter("not common").select(*columns).repartition("h").sortWithinPartitions("h")
    found = alone.mapInArrow(_repeated, "h long, uid long, size long").unionByName(entries.filter("common").select(*columns))
    n, room = F.shiftright("size", 32).cast("int").alias("n"), F.col("size").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("room")
    found, path = materialised(found.select("h", "uid", n, room), "shared")
    discard(found.sparkSession, [])  # the sorted entries
    needed = F.when(F.max("n") <= boundary, 1).otherwise(F.floor(F.ceil(F.max("n") * PERCENT / 100) / 20) + 1)
    fit = found.groupBy("uid").agg(F.count(F.lit(1)).alias("k"), needed.alias("needed")).filter("k >= needed").select("uid")
    first = F.col("room") >= F.ceil(F.col("n") * PERCENT / 100)  # one common element among the first is enough to meet
    lists = stored(found.filter(first).join(fit, "uid", "left_semi"), "lists", found.count())
    discard(found.sparkSession, [path])
    return lists


def _fits() -> Column:
    """Whether sizes and places in the order still allow an entry and its list's centre to be similar."""
    n, m = F.col("n"), F.col("centre.n")
    return (100 * F.least(n, m) >= PERCENT * F.greatest(n, m)) & ((100 + PERCENT) * F.least("room", "centre.room") >= PERCENT * (n + m))


def mixed_lists(lists: DataFrame, turn: int) -> DataFrame:
    """Entries of the lists that hold several components, with the list's centre: a member chosen anew each turn.

    Entries are left out if no other one of the list has a size that allows the two to be similar.
    """
    centre = F.min_by(F.struct("uid", "root", "n", "room"), F.xxhash64("uid", F.lit(turn))).alias("centre")
    lists = lists.repartition("h")  # once, for the groups and for the join with them
    several = lists.groupBy("h").agg(centre, F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    mixed = lists.join(several.select("h", "centre"), "h")
    by_size = Window.partitionBy("h").orderBy("n")
    close = (100 * F.lag("n").over(by_size) >= PERCENT * F.col("n")) | (100 * F.col("n") >= PERCENT * F.lead("n").over(by_size))
    return mixed.withColumn("close", close).filter("close").drop("close")


def _cuts(count: Column, elements: Column) -> Column:
    """Number of parts for as many sets with as many elements in all."""
    return F.ceil(F.greatest(count / CELL_SETS, elements / CELL_ELEMENTS)).cast("int")


def _part(parts: Column) -> Column:
    return F.pmod(F.xxhash64("uid"), parts).cast("int")


def _every(parts: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), parts - 1))


CELL = ("bucket", "p", "q", "side", "uid", "root")
#: Side of a row that stands on both.
BOTH = 2


def star_cells(mixed: DataFrame) -> DataFrame:
    """Cells in which the centre (side 0) meets the members of its lists (side 1) that lie in other components."""
    met = mixed.filter((F.col("root") != F.col("centre.root")) & _fits())
    met = met.select(F.col("centre.uid").alias("bucket"), F.col("centre.root").alias("own"), "uid", "root", "n").distinct()
    sizes = met.groupBy("bucket", "own").agg(_cuts(F.count(F.lit(1)), F.sum("n")).alias("parts"))
    members = met.join(sizes.drop("own"), "bucket").select("bucket", F.lit(0).alias("p"), _part(F.col("parts")).alias("q"), F.lit(1).alias("side"), "uid", "root")
    centres = sizes.select("bucket", F.lit(0).alias("p"), _every(F.col("parts")).alias("q"), F.lit(0).alias("side"), F.col("bucket").alias("uid"), F.col("own").alias("root"))
    return members.unionByName(centres)


def block_cells(mixed: DataFrame) -> DataFrame:
    """Cells in which the members of lists with one centre that lie outside their largest component meet all members.

    Lists with the same centre have mostly the same members, so these come together once and not once for each list.
    """
    members = stored(mixed.select(F.col("centre.uid").alias("bucket"), "uid", "root", "n").distinct(), "members", mixed.count())
    sizes = members.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("m"))
    largest = F.max(F.struct("k", "root", "m"))
    parts = sizes.groupBy("bucket").agg(largest["root"].alias("main"), F.sum("k").alias("k"), F.sum("m").alias("m"), largest["k"].alias("k1"), largest["m"].alias("m1"))
    parts = stored(parts.filter("k > k1").select("bucket", "main", _cuts(F.col("k") - F.col("k1"), F.col("m") - F.col("m1")).alias("ps"), _cuts(F.col("k"), F.col("m")).alias("qs")), "parts", members.count())
    every = members.join(parts, "bucket")
    alone = (F.col("ps") == 1) & (F.col("qs") == 1)  # one cell: those outside are sent once, for both sides
    outside = every.filter((F.col("root") != F.col("main")) & ~alone).select("bucket", _part(F.col("ps")).alias("p"), _every(F.col("qs")).alias("q"), F.lit(0).alias("side"), "uid", "root")
    side = F.when(alone & (F.col("root") != F.col("main")), F.lit(BOTH)).otherwise(F.lit(1)).alias("side")
    return outside.unionByName(every.select("bucket", _every(F.col("ps")).alias("p"), _part(F.col("qs")).alias("q"), side, "uid", "root"))


def _whole(batches):
    import pyarrow as pa

    for batch in batches:
        uids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for begin, part in runs(texts):
            sets = shingle_sets(part)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(uids[begin : begin + len(part)], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int32()), pa.array([in_brief(s).tobytes() for s in sets], pa.binary()),
                ],
                ["uid", "items", "n", "brief"],
            )


def in_brief(items):
    """The distinct values of the elements' last 16 bits, sorted."""
    import numpy as np

    there = np.zeros(1 << 16, bool)
    there[items & np.uint64(0xFFFF)] = True
    return np.flatnonzero(there).astype(np.uint16)


def shared_elements(xs: list, ys: list):
    """Matrix of the numbers of elements that the sorted sets xs and ys share."""
    import numpy as np

    lengths = np.array([len(y) for y in ys])
    flat, rows = np.concatenate(ys), np.repeat(np.arange(len(ys)), lengths)
    both = np.zeros((len(xs), len(ys)), np.float32)
    if len(xs) <= 4:
        for i, x in enumerate(xs):
            at = np.minimum(np.searchsorted(x, flat), len(x) - 1)
            both[i] = np.bincount(rows[x[at] == flat], minlength=len(ys))
        return both
    own, own_rows = np.concatenate(xs), np.repeat(np.arange(len(xs)), [len(x) for x in xs])
    common = np.intersect1d(own, flat)

    def places(values, owners):
        at = np.minimum(np.searchsorted(common, values), max(0, len(common) - 1))
        there = np.flatnonzero(common[at] == values) if len(common) else at[:0]
        order = there[np.argsort(at[there], kind="stable")]
        return at[order], owners[order]

    (x_at, x_rows), (y_at, y_rows) = places(own, own_rows), places(flat, rows)
    for begin in range(0, len(common), 4096):
        def dense(at, owners, n):
            a, b = np.searchsorted(at, [begin, begin + 4096])
            out = np.zeros((n, min(4096, len(common) - begin)), np.float32)
            out[owners[a:b], at[a:b] - begin] = 1
            return out

        both += dense(x_at, x_rows, len(xs)) @ dense(y_at, y_rows, len(ys)).T
    return both


def cell_links(xs: list[tuple], ys: list[tuple]) -> list[tuple[int, int]]:
    """Links between sets (uid, root, elements) of two sides: enough to join all components that links join."""
    import numpy as np

    both = shared_elements([x[2] for x in xs], [y[2] for y in ys])
    total = np.array([len(x[2]) for x in xs])[:, None] + np.array([len(y[2]) for y in ys])[None]
    x_roots, y_roots = np.array([x[1] for x in xs]), np.array([y[1] for y in ys])
    similar = (100 * both >= PERCENT * (total - both)) & (x_roots[:, None] != y_roots[None])
    above: dict[int, int] = {}

    def top(r):
        while r in above:
            r = above[r]
        return r

    found = []
    for i in np.flatnonzero(similar.any(axis=1)).tolist():
        at = np.flatnonzero(similar[i])
        for j in at[np.unique(y_roots[at], return_index=True)[1]].tolist():
            a, b = top(xs[i][1]), top(ys[j][1])
            if a != b:
                above[a] = b
                found.append((xs[i][0], ys[j][0]))
    return found


def possible_links(xs: list[tuple], ys: list[tuple]):
    """Matrix of the pairs of sets (n, root, elements in brief) of two sides that may be links.

    Two sets share no more elements than values in brief, and those that one of them loses there because values coincide.
    """
    import numpy as np

    sizes = [np.array([x[0] for x in side]) for side in (xs, ys)]
    lost = [n - np.array([len(x[2]) for x in side]) for n, side in zip(sizes, (xs, ys))]
    both = shared_elements([x[2] for x in xs], [y[2] for y in ys]) + np.minimum(lost[0][:, None], lost[1][None])
    total = sizes[0][:, None] + sizes[1][None]
    roots = [np.array([x[1] for x in side]) for side in (xs, ys)]
    return (100 * both >= PERCENT * (total - both)) & (roots[0][:, None] != roots[1][None])


def _each_cell(batches):
    """Of rows in the order of cells: the rows of each cell, as lists of their values."""
    cell, held = None, []
    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in range(len(CELL))]
        for row in zip(*columns, *batch.columns[len(CELL) :]):
            if row[:3] != cell and held:
                yield held
                held = []
            cell = row[:3]
            held.append(row)
    if held:
        yield held


def _on_sides(rows: list[tuple], ones: list) -> tuple[list, list]:
    """What stands for the rows of a cell, on side 0 and on side 1."""
    return tuple([one for row, one in zip(rows, ones) if row[3] in (side, BOTH)] for side in (0, 1))


def _possible(batches):
    """The rows of cells that may have a link there."""
    import numpy as np
    import pyarrow as pa

    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    for rows in _each_cell(batches):
        xs, ys = _on_sides(rows, [(r[6].as_py(), r[5], np.frombuffer(r[7].as_buffer(), np.uint16)) for r in rows])
        if xs and ys:
            maybe = possible_links(xs, ys)
            places = _on_sides(rows, list(range(len(rows))))
            kept = sorted({places[0][i] for i in np.flatnonzero(maybe.any(axis=1))} | {places[1][j] for j in np.flatnonzero(maybe.any(axis=0))})
            if kept:
                yield pa.RecordBatch.from_arrays([pa.array([rows[i][k] for i in kept], kind) for k, kind in enumerate(kinds)], list(CELL))


def _compared(batches):
    """Of rows in the order of cells: the links of each cell."""
    import numpy as np
    import pyarrow as pa

    for rows in _each_cell(batches):
        sides = _on_sides(rows, [(r[4], r[5], np.frombuffer(r[6].as_buffer(), np.uint64)) for r in rows])
        found = cell_links(*sides) if sides[0] and sides[1] else []
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["a", "b"])


def _sent(ids: DataFrame, most: int = SENT) -> DataFrame:
    """Ids for a join: sent to all tasks if they are no more than ``most``, shuffled beyond that."""
    return F.broadcast(ids) if ids.count() <= most else ids


def _in_cells(cells: DataFrame, sets: DataFrame) -> DataFrame:
    """The sets of each cell, in the order of cells."""
    rows = sets.join(_sent(cells, SENT // 2), "uid").select(*CELL, *[c for c in sets.columns if c != "uid"])
    return rows.repartition("bucket", "p", "q").sortWithinPartitions("bucket", "p", "q")


def possible_cells(cells: DataFrame, whole: DataFrame) -> DataFrame:
    """Stored rows of the cells whose sets may be linked there, as far as sets in brief tell."""
    schema = "bucket long, p int, q int, side int, uid long, root long"
    return stored(_in_cells(cells, whole.select("uid", "n", "brief")).mapInArrow(trimmed(_possible), schema), "possible", cells.count())


def compared(cells: DataFrame, whole: DataFrame) -> DataFrame:
    """Links (a, b) found in cells, on whole sets: no more than rows of cells."""
    return _in_cells(possible_cells(cells, whole), whole.select("uid", "items")).mapInArrow(trimmed(_compared), "a long, b long")


def links(lists: DataFrame, whole: DataFrame) -> DataFrame:
    """(node, root) of all documents that links reach.

    Star rounds go on as long as they tie together a quarter of what lies in mixed lists; then blocks compare the rest.
    """
    spark = lists.sparkSession
    found = roots = None
    turn, last, n_lists, n_found = 0, False, lists.count(), 0
    while True:
        now = lists.withColumn("root", F.col("uid")) if roots is None else (
            lists.join(roots.withColumnRenamed("node", "uid"), "uid", "left").withColumn("root", F.coalesce("root", "uid"))
        )
        mixed, path = materialised(mixed_lists(now, turn), "mixed", n_lists)
        with recorded() as made:  # stored before the join, so that whole sets need not move to meet few cells
            cells = stored(block_cells(mixed), "cells") if last else stored(star_cells(mixed), "cells", 2 * mixed.count())
            met = compared(cells, whole)
        new = stored(met, "links", cells.count())
        found = new if found is None else found.unionByName(new)
        n_new = new.count()
        n_found += n_new
        if n_new:
            roots = stored(components(found, n_found), "roots", 2 * n_found)
        n_mixed = mixed.select("uid").distinct().count()
        discard(spark, [path, *made])
        if last or not n_mixed:
            return roots
        turn, last = turn + 1, 4 * n_new < n_mixed


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, n_shingles, class_id (smallest id of equal sets), component_id, component, for each row of ``docs``.

    ``component`` numbers the components, also those without an id; null for empty sets.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("text_key"), text_of().alias("text"))
    common = spark.sparkContext.broadcast(frequent_shingles(texts))
    with small_batches(spark):
        heads, heads_path = materialised(texts.mapInArrow(trimmed(_sets(common)), SETS), "sets")
    sets = stored(heads.drop("head", "common_from"), "keys")
    classes = stored(
        sets.filter("n > 0").groupBy("n", "f1", "f2").agg(F.min(F.struct("uid", "text_key", F.col("doc_id").alias("own"))).alias("r"), F.min("doc_id").alias("class_id")),
        "classes", sets.count(),
    )
    boundary = choose_boundary({r["n"]: r["k"] for r in classes.groupBy("n").agg(F.count(F.lit(1)).alias("k")).collect()})
    n_classes = classes.count()
    first = stored(classes.select("r.uid"), "representatives", n_classes)
    lists = shared_lists(heads.join(_sent(first), "uid", "left_semi"), boundary)
    discard(spark, [heads_path])
    each = classes.select(F.col("r.uid").alias("uid"), F.col("r.text_key").alias("t"), F.col("r.own").alias("d"))
    wanted = stored(each.join(lists.select("uid").distinct(), "uid", "left_semi"), "wanted", n_classes)
    # Texts stay where they are while the ids can be sent; beyond that they are shuffled.
    rows = texts.join(_sent(wanted), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t"))).select("uid", "text")
    with small_batches(spark):
        whole = stored(rows.mapInArrow(trimmed(_whole), "uid long, items binary, n int, brief binary"), "whole")
    if whole.count() > wanted.count():  # rows that repeat an id and its text
        whole = stored(whole.dropDuplicates(["uid"]), "whole")
    with small_batches(spark):
        roots = links(lists, whole)
    if roots is None:
        roots = spark.createDataFrame([], "node long, root long")
    ids = classes.select("n", "f1", "f2", "class_id", F.col("r.uid").alias("rep")).join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    ids = ids.withColumn("root", F.coalesce("root", "rep"))
    least = ids.groupBy("root").agg(F.min("class_id").alias("component_id"))
    ids = stored(ids.join(least, "root").select("n", "f1", "f2", F.col("root").alias("component"), "class_id", "component_id"), "components", n_classes)
    joined = sets.join(ids, ["n", "f1", "f2"], "left")
    own = F.col("n") == 0
    return joined.select(
        "doc_id", "text_key", F.col("n").cast("long").alias("n_shingles"),
        F.when(own, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(own, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "component",
    )


def op3(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_key", "component")


OP3_SQL = f"""
with recursive d as (
    select row_number() over () as r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w
    from documents
), s as materialized (
    select distinct r, doc_id, array_to_string(w[i : i + {WORDS - 1}], ' ') as g
    from (select r, doc_id, w, unnest(generate_series(1, greatest(1, len(w) - {WORDS - 1}))) as i from d where len(w) > 0)
), n as materialized (
    select r, any_value(doc_id) as doc_id, count(*) as n, md5(string_agg(g, chr(10) order by g)) as f from s group by r
), reps as materialized (
    select f, min(r) as r, min(doc_id) as class_id, any_value(n) as n from n group by f
), shared as (
    select x.r as a, y.r as b, count(*) as k from s x join s y on x.g = y.g and x.r < y.r
    where x.r in (select r from reps) and y.r in (select r from reps) group by x.r, y.r
), link as materialized (
    select a, b from shared join n x on x.r = a join n y on y.r = b where 100 * k >= {PERCENT} * (x.n + y.n - k)
), reach as (
    select r as a, r as b from reps
    union
    select reach.a, l.b from reach join (select a, b from link union all select b, a from link) l on l.a = reach.b
), component as (
    select reach.a as r, min(reps.class_id) as component_id from reach join reps on reps.r = reach.b group by reach.a
)
select d.doc_id, coalesce(n.n, 0) as n_shingles,
    case when n.r is null then d.doc_id else reps.class_id end as class_id,
    case when n.r is null then d.doc_id else component.component_id end as component_id
from d left join n using (r) left join reps using (f) left join component on component.r = reps.r
"""
