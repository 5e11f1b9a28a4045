"""Prefix trie of rebuilt conversations, packed as double arrays per prefix shard.

A turn is known by a digest of its role and text, a prefix by the chained digest of its turns, a node by its prefix.
Conversations that end at the same node are one path, with their number and their smallest id; only the paths go on.

A node is *upper* if more than ``SHARD`` turns lie in its subtree, which is found by one count. Below an upper node, a first node
that is not upper is the root of a prefix shard, so a hot first turn is cut where it branches, and a very long
conversation leaves no more than ``SHARD`` turns to one shard. Tasks take whole shards, number the distinct turns of some of them
densely, pack their paths into arrays BASE and CHECK, and traverse these to find the nodes and what lies below them.

Upper nodes are shared by shards. Each carries what its own and the shards below report, once, at the path of its smallest
conversation; running sums from the path's end to its start and a grouping by node merge them globally.

Cases: a null role or text is empty; null turns come first; rows of equal turn are ordered by role, then text; repeated rows are
turns of their own; rows without ``conv_id`` belong to no conversation and are left out; a conversation without rebuilt turns
belongs to the root; an empty table has no nodes; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewatch.llm.common import materialised, stored, table, trimmed

#: Turns taken from the other conversation at most, less one; conversations that share one.
HEADS, GROUP = 9, 5
#: Turns below a node from which on it is an upper one; turns that a task packs together.
SHARD, BLOCK = 1 << 16, 1 << 17

PREFIX = "conv_id long, depth long, node binary, parent binary, turn binary, bytes long, last boolean"


def head_length(conv_id: Column) -> Column:
    return F.pmod(F.crc32(conv_id.cast("string").cast("binary")), F.lit(HEADS)).cast("int")


def rebuilt(turns: DataFrame) -> DataFrame:
    """conv_id, own, place, turn, bytes: the turns of rebuilt conversations, in the order of (own, place).

    Each conversation has one row more, the first one, without turn, which stands for the root.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    digest = F.substring(F.unhex(F.sha2(F.concat_ws(":", F.octet_length(role).cast("string"), F.concat(role, text)).cast("binary"), 256)), 1, 16)
    given = turns.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("at"), role.alias("role"), text.alias("text"), digest.alias("turn"))
    order = Window.partitionBy("conv_id").orderBy(F.col("at").asc_nulls_first(), "role", "text")
    placed = given.withColumn("place", F.row_number().over(order)).select("conv_id", "place", "turn", F.octet_length("text").cast("long").alias("bytes"))
    placed, _ = materialised(placed, "turns")
    every = placed.filter("place = 1").select("conv_id")
    heads = placed.filter(F.col("place") < HEADS).withColumnRenamed("conv_id", "source")
    taken = every.withColumn("source", F.col("conv_id") - F.col("conv_id") % GROUP).join(heads, "source").filter(F.col("place") <= head_length(F.col("conv_id")))
    own = placed.filter(F.col("place") > head_length(F.col("conv_id")))
    columns = lambda rows, k: rows.select("conv_id", F.lit(k).alias("own"), "place", "turn", "bytes")
    root = every.withColumns({"place": F.lit(0), "turn": F.lit(None).cast("binary"), "bytes": F.lit(0).cast("long")})
    return columns(root, 0).unionByName(columns(taken, 1)).unionByName(columns(own, 2))


def _chained(batches):
    """Of rows in the order of conversations and turns: the prefix that ends at each."""
    from hashlib import blake2b

    import pyarrow as pa

    held, node, depth = None, b"", 0
    names = [f.split()[0] for f in PREFIX.split(", ")]
    types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.bool_()]
    for batch in batches:
        rows = []
        for conv_id, turn, size in zip(*(c.to_pylist() for c in batch.columns)):
            if turn is None:
                now = (conv_id, 0, b"", None, None, 0)
                node, depth = b"", 0
            else:
                parent, depth = node, depth + 1
                node = blake2b(parent + turn, digest_size=16).digest()
                now = (conv_id, depth, node, parent, turn, size)
            if held is not None:
                rows.append((*held, turn is None))
            held = now
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*held, True), types)], names)


def _digested(batches):
    """Of (node, conv_id) rows in order: each node's conversations as number, smallest id and digest of the list."""
    from hashlib import sha256

    import pyarrow as pa

    now = first = digest = None
    n, rows = 0, []
    for batch in batches:
        for node, conv_id in zip(*(c.to_pylist() for c in batch.columns)):
            if node != now or digest is None:
                if digest is not None:
                    rows.append((now, first, n, digest.hexdigest()))
                now, first, n, digest = node, conv_id, 0, sha256()
            digest.update(b"%d" % conv_id if n == 0 else b",%d" % conv_id)
            n += 1
        if len(rows) >= 10_000:
            yield _ends(rows)
            rows = []
    if digest is not None:
        rows.append((now, first, n, digest.hexdigest()))
    if rows:
        yield _ends(rows)


def _ends(rows):
    import pyarrow as pa

    types = [pa.binary(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["end", "conv_id", "n", "ends_sha256"])


class DoubleArray:
    """Trie of paths of dense ids (from 1 on): the child of state s by id c is t = base[s] + c, if check[t] = s. State 0 is the root."""

    def __init__(self, paths: list[tuple[int, ...]]):
        self.base, self.check, self.order = [0], [-1], [0]
        self.used = bytearray(b"\x01")
        self.free = 1  # no place before it is free
        paths = sorted(set(paths))
        waiting = [(0, 0, 0, len(paths))] if paths else []
        for state, depth, begin, end in waiting:  # grows as states are found
            while begin < end and len(paths[begin]) == depth:
                begin += 1
            if begin == end:
                continue
            ids, bounds = [], []
            for i in range(begin, end):
                c = paths[i][depth]
                if not ids or ids[-1] != c:
                    ids.append(c)
                    bounds.append(i)
            bounds.append(end)
            base = self._place(ids)
            self.base[state] = base
            for c, a, b in zip(ids, bounds, bounds[1:]):
                t = base + c
                self.check[t] = state
                self.order.append(t)
                waiting.append((t, depth + 1, a, b))

    def _place(self, ids: list[int]) -> int:
        """The first base at which all children find a free place; takes these places."""
        used, first = self.used, ids[0]
        at = self.free = self._next_free(self.free)
        while True:
            base = at - first
            need = base + ids[-1] + 1
            if need > len(used):
                more = max(need, 2 * len(used)) - len(used)
                used.extend(bytes(more))
                self.base.extend([0] * more)
                self.check.extend([-1] * more)
            if base > -first and not any(used[base + c] for c in ids):
                for c in ids:
                    used[base + c] = 1
                return base
            at = self._next_free(at + 1)

    def _next_free(self, at: int) -> int:
        found = self.used.find(0, at)
        return found if found >= 0 else len(self.used) if at <= len(self.used) else at

    def states(self, path) -> list[int]:
        """The states along a path, without the root; stops where it leaves the trie."""
        state, found = 0, []
        for c in path:
            t = self.base[state] + c
            if not 0 < t < len(self.check) or self.check[t] != state:
                break
            found.append(t)
            state = t
        return found


NODES = (
    "node binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string, top boolean"
)


def packed_nodes(paths: list[list[tuple]]) -> list[tuple]:
    """Rows of ``NODES`` of whole shards; a path is a list of (shard, conv_id, depth, node, parent, turn, bytes, n, ends or None).

    A shard's root hangs below the array's root by its node; ``top`` marks it, and its parent is known to others only.
    """
    turns = sorted({r[5] or b"" for p in paths for r in p[1:]} | {p[0][3] for p in paths})
    dense = {t: i for i, t in enumerate(turns, 1)}
    coded = [(dense[p[0][3]], *(dense[r[5]] for r in p[1:])) for p in paths]
    trie = DoubleArray(coded)
    size = len(trie.check)
    conv, n, children, leaves, saved, row, ends = ([None] * size, [0] * size, [0] * size, [0] * size, [0] * size, [None] * size, [None] * size)
    for path, codes in sorted(zip(paths, coded), key=lambda x: x[0][0][1]):
        states = trie.states(codes)
        for s, r in zip(states, path):
            if conv[s] is None:
                conv[s], row[s] = r[1], r
            n[s] += r[7]
        ends[states[-1]] = path[-1][8]
    for s in reversed(trie.order[1:]):
        parent = trie.check[s]
        leaves[s] = leaves[s] or 1
        saved[s] += (n[s] - 1) * row[s][6]
        children[parent] += 1
        leaves[parent] += leaves[s]
        saved[parent] += saved[s]
    none = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"  # of the empty string
    return [
        (row[s][3], row[s][4], conv[s], row[s][2], conv[trie.check[s]], n[s], children[s], leaves[s], saved[s], ends[s] or none, trie.check[s] == 0)
        for s in trie.order[1:]
    ]


def _packed(batches):
    """Of rows in the order of (shard, conv_id, depth): the nodes, some whole shards at a time."""
    import pyarrow as pa

    names = [f.split()[0] for f in NODES.split(", ")]
    types = [pa.binary(), pa.binary(), *[pa.int64()] * 7, pa.string(), pa.bool_()]

    def done():
        rows = packed_nodes(paths)
        for a in range(0, len(rows), 20_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[a : a + 20_000]), types)], names)

    paths, size, shard = [], 0, None
    for batch in batches:
        for r in zip(*(c.to_pylist() for c in batch.columns)):
            if r[0] != shard:
                if size >= BLOCK - SHARD:
                    yield from done()
                    paths, size = [], 0
                shard = r[0]
                paths.append([r])
            elif r[1] != paths[-1][-1][1]:
                paths.append([r])
            else:
                paths[-1].append(r)
            size += 1
    if paths:
        yield from done()


def prefix_nodes(turns: DataFrame, shard: int = SHARD) -> DataFrame:
    """One row per node of the trie, with the columns of ``op13`` and its ``node`` digest."""
    rows = rebuilt(turns).repartition("conv_id").sortWithinPartitions("conv_id", "own", "place").select("conv_id", "turn", "bytes")
    prefixes, _ = materialised(rows.mapInArrow(trimmed(_chained), PREFIX), "prefixes")
    last = prefixes.filter("last").select("node", "conv_id").repartition("node").sortWithinPartitions("node", "conv_id")
    ends = stored(last.mapInArrow(trimmed(_digested), "end binary, conv_id long, n long, ends_sha256 string"), "ends")
    lengths = prefixes.filter("last").select("conv_id", F.col("depth").alias("length"))
    paths = prefixes.join(ends.join(lengths, "conv_id"), "conv_id")
    paths = stored(paths.select("conv_id", "depth", "node", "parent", "turn", "bytes", "n", "length", F.when(F.col("last"), F.col("ends_sha256")).alias("ends")), "paths")

    below = paths.groupBy("node").agg(F.sum(F.col("length") - F.col("depth") + 1).alias("below"))
    upper = stored(below.filter(F.col("below") > shard).select("node"), "upper")
    marked = paths.join(upper.withColumn("upper", F.lit(True)), "node", "left").withColumn("upper", F.col("upper").isNotNull())
    along = Window.partitionBy("conv_id", "upper").orderBy("depth")
    marked = stored(marked.withColumn("shard", F.when(~F.col("upper"), F.first("node").over(along))), "marked")

    lower = marked.filter("not upper").select("shard", "conv_id", "depth", "node", "parent", "turn", "bytes", "n", "ends")
    dealt = lower.repartition("shard").sortWithinPartitions("shard", "conv_id", "depth")
    nodes = stored(dealt.mapInArrow(trimmed(_packed), NODES), "nodes")
    return _merged(marked.filter("upper"), nodes)


def _merged(paths: DataFrame, nodes: DataFrame) -> DataFrame:
    """The nodes of shards and, by the paths through them, the upper nodes."""
    first = paths.groupBy("node").agg(
        F.first("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.sum("n").alias("n_convs"),
        F.first("bytes").alias("bytes"), F.coalesce(F.max("ends"), F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
    first = stored(first, "upper-nodes")
    tops = nodes.filter("top and parent is not null")
    own = first.select("conv_id", "node", ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"), F.lit(0).cast("long").alias("leaves"))
    reported = own.unionByName(tops.select("conv_id", F.col("parent").alias("node"), F.col("saved_tokens").alias("saved"), F.col("n_leaves").alias("leaves")))
    reported = reported.groupBy("conv_id", "node").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    upwards = Window.partitionBy("conv_id").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = paths.select("conv_id", "depth", "node").join(reported, ["conv_id", "node"], "left").fillna(0, ["saved", "leaves"])
    sums = sums.withColumns({"saved": F.sum("saved").over(upwards), "leaves": F.sum("leaves").over(upwards)})
    sums = sums.groupBy("node").agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"))
    children = first.select("parent").unionByName(tops.select("parent")).filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    merged = first.join(sums, "node").join(children, "node", "left").withColumns({"n_children": F.coalesce("n_children", F.lit(0)), "parent_conv_id": F.lit(None).cast("long"), "top": F.lit(True)})
    every = merged.select(*nodes.columns).unionByName(nodes)
    named = first.select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    return every.join(named, "parent", "left").withColumn("parent_conv_id", F.when(F.col("top"), F.col("above")).otherwise(F.col("parent_conv_id"))).drop("top", "above", "parent")


def op13(spark, sf_dir: str) -> DataFrame:
    return prefix_nodes(table(spark, sf_dir, "conversations")).drop("node")


#: CRC-32 of a decimal number's text: eight shifts for each character.
_CRC = """xor(4294967295, list_reduce(
    list_prepend(4294967295::bigint, list_transform(string_split(c::varchar, ''), lambda x: ascii(x)::bigint)),
    lambda s, b: list_reduce(list_prepend(xor(s, b), [0::bigint, 0, 0, 0, 0, 0, 0, 0]), lambda y, i: xor(y >> 1, 3988292384::bigint * (y & 1)))))"""

OP13_SQL = f"""
with turns as (
    select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text,
        row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as place
    from conversations where conv_id is not null
), heads as materialized (
    select c, c - c % {GROUP} as source, {_CRC} % {HEADS} as h from (select distinct c from turns)
), whole as (
    select heads.c, 1 as own, place, role, text from heads join turns on turns.c = heads.source and place <= h
    union all select heads.c, 2, place, role, text from heads join turns on turns.c = heads.c and place > h
), placed as (
    select c, row_number() over w as d, strlen(text) as bytes,
        sha256(string_agg(strlen(role) || ':' || role || strlen(text) || ':' || text, '|') over w) as node
    from whole window w as (partition by c order by own, place)
), path as materialized (
    select *, lag(node) over (partition by c order by d) as parent, d = max(d) over (partition by c) as last
    from (select c, d, bytes, node from placed union all select c, 0, 0, '' from heads)
), node as materialized (
    select node, min(c) as c, any_value(d) as d, any_value(parent) as parent, any_value(bytes) as bytes, count(*) as n,
        sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (last), '')) as ends_sha256
    from path group by node
), child as materialized (
    select parent as node, count(*) as n_children from node where parent is not null group by parent
), valued as (
    select node.c, node.d, (n - 1) * bytes as saved, case when n_children is null then 1 else 0 end as leaf from node left join child using (node)
), below as (
    select path.node, cast(sum(saved) as bigint) as saved_tokens, cast(sum(leaf) as bigint) as n_leaves
    from path join valued on valued.c = path.c and path.d <= valued.d group by path.node
)
select node.c as conv_id, cast(node.d as bigint) as depth, up.c as parent_conv_id, node.n as n_convs, coalesce(n_children, 0) as n_children,
    n_leaves, saved_tokens, node.ends_sha256
from node join below using (node) left join child using (node) left join node up on up.node = node.parent
"""
