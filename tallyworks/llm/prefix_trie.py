"""The trie of conversations by their turns, from a merge sort that carries longest common prefixes.

A turn is a unit of 24 bytes, 128 bits of the SHA-256 of its role and text and the text's length, so that no text is shuffled;
a conversation's key is its units in a row. Batches of keys are sorted into runs that carry each key's common prefix (lcp) with the
one before it. The runs are dealt to ranges of keys, ties by id, so that a range is of bounded size however many conversations
are equal. There a loser tree merges them: it compares two keys only behind the prefix that both are known to share. From the
merged stream with its lcps a stack of open nodes gives each node when the stream has left it.

Nodes on the path of a range's first or last key may go on in the next range. These edges (two paths a range) pass through the
same stack once more, in the order of the ranges; everything else is final within its range.
"""

from __future__ import annotations

import hashlib
from operator import itemgetter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_tables, materialize

UNIT, HEX = 24, 48
SHARED, MODULO, GROUP = 5, 6, 100
#: turns of a range, and bytes of ids that one row of an edge holds
RANGE, PIECE = 100_000, 1 << 16
NODE = "depth bigint, conv_id bigint, parent bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved bigint, sha string"


def unit(role: Column, text: Column) -> Column:
    """A turn as HEX hexadecimal digits."""
    digest = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, HEX - 16)
    return F.concat(digest, F.lpad(F.hex(F.length(text).cast("bigint")), 16, "0"))


def sequences(turns: DataFrame) -> DataFrame:
    """(c, units) of each conv_id, its turns by number, nulls first, then by unit. Rows without a conv_id belong to none."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    df = turns.where("conv_id is not null").select(F.col("conv_id").cast("bigint").alias("c"), F.col("turn").cast("bigint").alias("t"), unit(role, text).alias("u"))
    by_group = df.withColumn("b", F.col("c") - F.col("c") % GROUP).repartition("b")
    return by_group.groupBy("b", "c").agg(F.sort_array(F.collect_list(F.struct("t", "u"))).alias("s")).select("b", "c", F.col("s.u").alias("units"))


def rebuilt(df: DataFrame) -> DataFrame:
    """(c, key): the first crc32(c) % MODULO turns are those of the conversation that c's hundred begins with."""
    first = df.where("c = b").select(F.col("c").alias("_b"), F.slice("units", 1, SHARED).alias("_first"))
    h = (F.crc32(F.col("c").cast("string")) % MODULO).cast("int")
    taken = F.slice(F.coalesce("_first", F.array().cast("array<string>")), F.lit(1), h)
    own = F.slice("units", h + 1, F.size("units"))
    return df.join(first, F.col("b") == F.col("_b"), "left").select("c", F.unhex(F.array_join(F.concat(taken, own), "")).alias("key"))


def plain(df: DataFrame) -> DataFrame:
    return df.select("c", F.unhex(F.array_join("units", "")).alias("key"))


def common(a: bytes, b: bytes, at: int = 0) -> int:
    """Units that a and b share at the start; `at` of them are known."""
    n, i = min(len(a), len(b)), at * UNIT
    while i < n and a[i : i + UNIT] == b[i : i + UNIT]:
        i += UNIT
    return i // UNIT


def sorted_runs(batches):
    """Each batch of (c, key) as a sorted run with lcps."""
    task = TaskContext.get().partitionId() << 32
    for number, batch in enumerate(batches):
        rows = sorted(zip(batch.column(1).to_pylist(), batch.column(0).to_pylist(), strict=True))
        if rows:
            keys = [k for k, _ in rows]
            lcps = [0, *map(common, keys, keys[1:])]
            yield pa.RecordBatch.from_arrays([pa.array([c for _, c in rows], pa.int64()), pa.array(keys, pa.binary()), pa.array([task + number] * len(rows), pa.int64()), pa.array(range(len(rows)), pa.int64()), pa.array(lcps, pa.int32())], ["c", "key", "run", "pos", "lcp"])


def merged(runs: list[list[tuple[bytes, int, int]]]):
    """(key, c, lcp with the key before) of all runs in order, by a loser tree. Runs hold (key, c, lcp with the key before it)."""
    size = 1 << max(0, len(runs) - 1).bit_length()
    at = [0] * len(runs)
    now: list = [r[0][:2] for r in runs] + [None] * (size - len(runs))
    # of each run's key, the prefix that it shares with the last key that came out
    lcp = [0] * size
    losers = [0] * size

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's lcp becomes that with the winner."""
        if now[a] is None:
            return b, a
        if now[b] is None:
            return a, b
        if lcp[a] != lcp[b]:
            return (a, b) if lcp[a] > lcp[b] else (b, a)
        (ka, ca), (kb, cb) = now[a], now[b]
        same = common(ka, kb, lcp[a])
        i = same * UNIT
        first = (ka[i : i + UNIT], ca) < (kb[i : i + UNIT], cb)
        won, lost = (a, b) if first else (b, a)
        lcp[lost] = same
        return won, lost

    winners = [0] * size + list(range(size))
    for i in range(size - 1, 0, -1):
        winners[i], losers[i] = play(winners[2 * i], winners[2 * i + 1])
    top = winners[1]
    while now[top] is not None:
        yield (*now[top], lcp[top])
        at[top] += 1
        if at[top] < len(runs[top]):
            key, c, lcp[top] = runs[top][at[top]]
            now[top] = (key, c)
        else:
            now[top] = None
        i = (top + size) // 2
        while i:
            top, losers[i] = play(losers[i], top)
            i //= 2


class Open:
    """A node on the open path."""

    __slots__ = ("ends", "index", "leaves", "least", "n", "children", "ord", "saved", "unit")

    def __init__(self, unit: bytes, ord: int | None = None):
        self.unit, self.ord = unit, ord
        self.n = self.children = self.leaves = self.saved = 0
        self.least, self.ends, self.index = None, [], -1

    def take(self, n: int, least: int | None) -> None:
        self.n += n
        if least is not None:
            self.least = least if self.least is None else min(self.least, least)

    def close(self) -> None:
        self.leaves = self.leaves if self.children else 1
        self.saved += (self.n - 1) * int.from_bytes(self.unit[16:], "big")

    def under(self, parent: Open) -> None:
        parent.take(self.n, self.least)
        parent.children += 1
        parent.leaves += self.leaves
        parent.saved += self.saved


def _frame(rows: list[tuple], fields: list[tuple[str, pa.DataType]]):
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, (_, t) in zip(columns, fields, strict=True)], [n for n, _ in fields])


_I, _S = pa.int64(), pa.string()
_RANGE_FIELDS = [("kind", _S), ("part", _I), ("ord", _I), ("seq", _I), ("depth", _I), ("conv_id", _I), ("parent", _I), ("n_convs", _I), ("n_children", _I), ("n_leaves", _I), ("saved", _I), ("sha", _S), ("unit", pa.binary())]
RANGE_SCHEMA = "kind string, part bigint, ord bigint, seq bigint, " + NODE + ", unit binary"


def range_nodes(batches):
    """Final nodes and edges of one range of keys. A node's parent is an id, or the ord of the edge that it hangs from."""
    part, rows = TaskContext.get().partitionId(), []
    for batch in batches:
        rows += zip(*(batch.column(i).to_pylist() for i in (2, 3, 1, 0, 4)), strict=True)
    if not rows:
        return
    rows.sort(key=itemgetter(0, 1))
    runs: list = []
    last = None
    for run, _, key, c, lcp in rows:
        if run != last:
            runs.append([])
            last, lcp = run, 0
        runs[-1].append((key, c, lcp))
    del rows

    nodes, parents, edges = [], [], []  # parents: index of a final node, or -1 - ord of an edge
    path: list[Open] = []
    waiting: list[list[int]] = []  # by depth, final nodes whose parent at the depth is open

    def edge(node: Open, depth: int) -> None:
        ids, pieces, size = [], [], 0
        for c in node.ends:
            ids.append(str(c))
            size += len(ids[-1]) + 1
            if size > PIECE:
                pieces.append(",".join(ids))
                ids, size = [], 0
        if ids or not pieces:
            pieces.append(",".join(ids))
        for seq, text in enumerate(pieces):
            own = (node.least, None, node.n, node.children, node.leaves, node.saved) if not seq else (None, None, 0, 0, 0, 0)
            edges.append(("edge", part, node.ord, seq, depth, *own, text, node.unit))

    def pop() -> None:
        node = path.pop()
        depth = len(path)
        below = waiting.pop()
        if node.ord is not None:
            edge(node, depth)
            for i in below:
                parents[i] = -1 - node.ord
            return
        node.close()
        for i in below:
            parents[i] = len(nodes)
        waiting[-1].append(len(nodes))
        nodes.append((depth, node.least, node.n, node.children, node.leaves, node.saved, hashlib.sha256(",".join(map(str, node.ends)).encode()).hexdigest()))
        parents.append(None)
        node.under(path[-1])

    path.append(Open(bytes(UNIT), 0))
    waiting.append([])
    first = True
    for key, c, lcp in merged(runs):
        while len(path) - 1 > lcp:
            pop()
        for i in range(len(path) - 1, len(key) // UNIT):
            path.append(Open(key[i * UNIT : (i + 1) * UNIT], i + 1 if first else None))
            waiting.append([])
        path[-1].take(1, c)
        path[-1].ends.append(c)
        if first:
            first, after = False, len(path)
    for i, node in enumerate(path):
        # what is open at the end may go on in the next range
        node.ord = after + i if node.ord is None else node.ord
    while path:
        pop()
    out = edges
    for (depth, least, *counts, sha), p in zip(nodes, parents, strict=True):
        known = p >= 0
        out.append(("node" if known else "hung", part, None if known else -1 - p, 0, depth, least, nodes[p][1] if known else None, *counts, sha, None))
    for i in range(0, len(out), 10_000):
        yield _frame(out[i : i + 10_000], _RANGE_FIELDS)


_EDGE_FIELDS = [("kind", _S), ("part", _I), ("ord", _I), ("id", _I), ("up", _I), *[f for f in _RANGE_FIELDS[4:-1]]]
EDGE_SCHEMA = "kind string, part bigint, ord bigint, id bigint, up bigint, " + NODE


def joined_edges(batches):
    """Edges in order of ranges: kind link has the id of the node that an edge is part of, kind node that node with its parent's id."""
    path: list[Open] = []
    out: list[tuple] = []
    made = 0

    def pop() -> None:
        node = path.pop()
        depth = len(path)
        node.close()
        out.append(("node", None, None, node.index, path[-1].index if path else None, depth, node.least, None, node.n, node.children, node.leaves, node.saved, node.ends[0].hexdigest()))
        if path:
            node.under(path[-1])

    for batch in batches:
        for r in batch.to_pylist():
            depth = r["depth"]
            if not (len(path) > depth and path[depth].unit == r["unit"]):
                while len(path) > depth:
                    pop()
                node = Open(r["unit"])
                node.index, made = made, made + 1
                node.ends = [hashlib.sha256(), False]
                path.append(node)
            node = path[depth]
            if not r["seq"]:
                out.append(("link", r["part"], r["ord"], node.index, None, depth, None, None, 0, 0, 0, 0, None))
                node.take(r["n_convs"], r["conv_id"])
                node.children += r["n_children"]
                node.leaves += r["n_leaves"]
                node.saved += r["saved"]
            if r["sha"]:
                node.ends[0].update(("," * node.ends[1] + r["sha"]).encode())
                node.ends[1] = True
        if len(out) > 10_000:
            yield _frame(out, _EDGE_FIELDS)
            out.clear()
    while path:
        pop()
    if out:
        yield _frame(out, _EDGE_FIELDS)


def nodes(keys: DataFrame, turns_a_range: int = RANGE) -> DataFrame:
    """(depth, conv_id, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of the trie over (c, key).

    No rows give no nodes. A key is one value, UNIT bytes a turn: the longest conversation must fit a task.
    """
    spark = keys.sparkSession
    runs = materialize(keys.mapInArrow(sorted_runs, "c bigint, key binary, run bigint, pos bigint, lcp int"), "trie-runs")
    turns = runs.agg(F.sum(F.octet_length("key"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), turns // UNIT // turns_a_range + 1)
    ranged = materialize(runs.repartitionByRange(parts, "key", "c").mapInArrow(range_nodes, RANGE_SCHEMA), "trie-ranges", by="kind")
    of = lambda kind: ranged.where(F.col("kind") == kind)
    ordered = of("edge").drop("kind").repartition(1).sortWithinPartitions("part", "ord", "seq")
    edges = materialize(ordered.mapInArrow(joined_edges, EDGE_SCHEMA), "trie-edges", by="kind")
    final = edges.where("kind = 'node'")
    convs = final.select(F.col("id").alias("_id"), F.col("conv_id").alias("_conv"))
    own = final.join(convs, F.col("up") == F.col("_id"), "left").withColumn("parent", F.col("_conv"))
    link = edges.where("kind = 'link'").join(convs, F.col("id") == F.col("_id")).select(F.col("part").alias("_part"), F.col("ord").alias("_ord"), "_conv")
    hung = of("hung").join(link, (F.col("part") == F.col("_part")) & (F.col("ord") == F.col("_ord"))).withColumn("parent", F.col("_conv"))
    shown = ("depth", "conv_id", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.col("sha").alias("ends_sha256"))
    out = materialize(of("node").select(*shown).unionByName(hung.select(*shown)).unionByName(own.select(*shown)), "trie")
    drop_tables(runs, ranged, edges)
    return out


def trie(conversations: DataFrame, rebuild: bool = True) -> DataFrame:
    """The trie of conversations (conv_id, turn, role, text), rebuilt first or as they are, see nodes() and rebuilt().

    Null role or text is empty; turns of equal number are ordered by their units, repeated rows are turns of their own; rows
    without a conv_id are left out; other columns are not read; an empty table gives no rows.
    """
    return nodes((rebuilt if rebuild else plain)(sequences(conversations)))


def op13_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


# crc32 bit by bit: SQL has no function for it
_CRC = "xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))), lambda a, x: list_reduce(list_prepend(xor(a, x), range(8)), lambda y, i: xor(y >> 1, CASE WHEN y % 2 = 1 THEN 3988292384 ELSE 0 END))), 4294967295)"
OP13_SQL = f"""WITH t AS (SELECT conv_id AS c, turn AS n, length(coalesce(text, '')) AS size, substr(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) || lpad(lower(hex(length(coalesce(text, '')))), 16, '0') AS u FROM conversations WHERE conv_id IS NOT NULL),
 own AS (SELECT c, {_CRC} % 6 AS h, list(u ORDER BY n NULLS FIRST, u) AS us FROM t GROUP BY c),
 built AS (SELECT a.c, coalesce(b.us, [])[1:a.h] || a.us[a.h + 1:] AS us FROM own a LEFT JOIN own b ON b.c = a.c - a.c % 100),
 step AS (SELECT c, len(us) AS size, d, array_to_string(us[1:d], '') AS k FROM built, unnest(range(len(us) + 1)) x(d)),
 node AS (SELECT d, k, min(c) AS conv_id, count(*) AS n, sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE size = d), '')) AS ends FROM step GROUP BY 1, 2),
 kids AS (SELECT d - 1 AS d, left(k, length(k) - 48) AS k, count(*) AS n FROM node WHERE d > 0 GROUP BY 1, 2),
 up AS (SELECT node.*, coalesce(kids.n, 0) AS kids, coalesce(w.size, 0) AS size FROM node LEFT JOIN kids USING (d, k) LEFT JOIN (SELECT u, min(size) AS size FROM t GROUP BY 1) w ON w.u = right(k, 48)),
 tree AS (SELECT a AS d, left(k, 48 * a) AS k, count(*) FILTER (WHERE kids = 0) AS leaves, sum((n - 1) * size) AS saved FROM up, unnest(range(d + 1)) x(a) GROUP BY 1, 2)
 SELECT up.conv_id, up.d AS depth, p.conv_id AS parent_conv_id, up.n AS n_convs, up.kids AS n_children, leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, up.ends AS ends_sha256
 FROM up JOIN tree USING (d, k) LEFT JOIN node p ON up.d > 0 AND p.d = up.d - 1 AND p.k = left(up.k, length(up.k) - 48)"""
