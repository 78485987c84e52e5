"""Approximate nearest neighbours: a graph by NN-descent, queried by greedy graph search.

Equal vectors are one node. Each node starts with the nearest of a few random blocks (dealt by a hash of its id), which hold next to
none of its true neighbours. Then rounds of Spark joins follow: every node v gathers its neighbours and reverse neighbours with their
vectors, compares them with each other, and tells each of them the others that beat its worst neighbour; so neighbours of
neighbours meet. A pair meets only while one of its two edges to v is new. Rounds end when fewer than DELTA of all edges are new.

Queries walk the graph: a beam of nodes, all that are new in it being expanded at once, hop by hop until fewer than DELTA of its nodes are
new. Expansions are grouped by the node expanded, so that its neighbours' vectors are read once for all queries there. What a
search ends with is scored again in double precision on the original vectors.

Vectors travel in 8-bit steps. K (neighbours of a node) and the beam, which widens with the logarithm of the table's size, are the
widths that any graph search has; recall is measured in tests/llm/test_nndescent.py and stated in the README by size and by rounds.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import batches_of, drop_tables, materialize
from .vectors import matrix, usable

K = 32
BLOCK = 512
DEALS = 2
#: rounds and hops end when a smaller share of edges (of beam places) is new
DELTA = 0.02
#: neither takes anything near this many; it ends what would go round in circles
MOST_ROUNDS = 40
#: queries whose expansions of one node meet in one row, at most
MEET = 16384
EVERY = 20
TOP = 20

_PAIRS = "u long, w long, sim float"


def beam_width(n: int) -> int:
    """192 places for 10,000 nodes, and 48 more for each doubling."""
    return max(64, round(192 + 48 * math.log2(max(n, 1) / 10_000)))


def _pack(rows: DataFrame) -> DataFrame:
    """(id, q binary): vectors scaled to 8 bits, with the scale in eight leading bytes."""

    def run(batches):
        for batch in batches:
            x = matrix(batch.column(1)).astype(np.float64)
            if not len(x):
                continue
            scale = np.abs(x).max(axis=1, keepdims=True) / 127
            q = np.rint(x / scale).astype(np.int8)
            data = np.hstack([scale.astype("<f8").view(np.uint8), q.view(np.uint8)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in data], pa.binary())], names=["id", "q"])

    return rows.select("id", "vec").mapInArrow(run, "id long, q binary")


def _unpack(column: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """(whole numbers, scales) of packed vectors of one length; products of the numbers are exact in single precision."""
    n = len(column)
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int32)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].reshape(n, -1)
    return raw[:, 8:].view(np.int8).astype(np.float32), raw[:, :8].copy().view("<f8")[:, 0]


def _top(u: np.ndarray, w: np.ndarray, sim: np.ndarray, k: int) -> pa.RecordBatch:
    """The k best different partners of each u: what is left out cannot be among its k best of all."""
    order = np.lexsort((w, -sim, u))
    u, w, sim = u[order], w[order], sim[order]
    new = np.append(True, (u[1:] != u[:-1]) | (w[1:] != w[:-1]))[: len(u)]
    u, w, sim = u[new], w[new], sim[new]
    starts = np.nonzero(np.append(True, u[1:] != u[:-1])[: len(u)])[0]
    place = np.arange(len(u)) - np.repeat(starts, np.diff(np.append(starts, len(u))))
    keep = place < k
    return pa.RecordBatch.from_arrays([pa.array(u[keep]), pa.array(w[keep]), pa.array(sim[keep].astype(np.float32))], names=["u", "w", "sim"])


def _lists(column: pa.ListArray) -> tuple[np.ndarray, pa.StructArray]:
    """(sizes, flat entries) of a list column."""
    return np.diff(column.offsets.to_numpy()), column.flatten()


def _seeds(packed: DataFrame, n: int, k: int, block: int, deals: int) -> DataFrame:
    """The best k of each node within `deals` random blocks."""
    blocks = -(-n // block)
    deal = F.explode(F.sequence(F.lit(0), F.lit(deals - 1 if blocks > 1 else 0)))
    met = packed.withColumn("deal", deal).groupBy("deal", F.pmod(F.xxhash64("id", "deal"), F.lit(blocks)).alias("block")).agg(F.collect_list(F.struct("id", "q")).alias("met"))

    def run(batches):
        for batch in batches:
            sizes, flat = _lists(batch.column(0))
            ids, start = flat.field("id").to_numpy(), 0
            x, scale = _unpack(flat.field("q"))
            for size in sizes:
                own = slice(start, start + size)
                start += size
                s = (x[own] @ x[own].T * (scale[own, None] * scale[None, own])).astype(np.float32)
                np.fill_diagonal(s, -np.inf)
                m = min(k, size - 1)
                if m > 0:
                    top = np.argpartition(-s, m - 1, axis=1)[:, :m]
                    yield _top(np.repeat(ids[own], m), ids[own][top.ravel()], np.take_along_axis(s, top, 1).ravel(), k)

    return met.select("met").mapInArrow(run, _PAIRS)


def _merge(pairs: DataFrame, k: int) -> DataFrame:
    """(u, near array of (w, sim, fresh), worst): the k best of each u from pairs (u, w, sim, fresh), each w once; what was
    there before is not fresh. worst is what a further one must beat."""
    once = pairs.repartition("u").groupBy("u", "w").agg(F.max("sim").alias("sim"), F.bool_and("fresh").alias("fresh"))
    rank = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("sim"), "w"))
    rows = once.withColumn("r", rank).where(F.col("r") <= k).groupBy("u")
    worst = F.when(F.count("*") < k, F.lit(-math.inf)).otherwise(F.min("sim")).cast("float")
    return rows.agg(F.collect_list(F.struct("w", "sim", "fresh")).alias("near"), worst.alias("worst"))


def _edges(nodes: DataFrame) -> DataFrame:
    return nodes.select("u", F.inline("near"))


def _news(nodes: DataFrame) -> float:
    """The share of fresh edges."""
    fresh, every = nodes.agg(F.sum(F.size(F.filter("near", lambda x: x["fresh"]))), F.sum(F.size("near"))).first()
    return fresh / every if every else 0.0


def _around(nodes: DataFrame, k: int) -> DataFrame:
    """(v, m, fresh): each node's neighbours and its k best reverse ones; some come twice."""
    edges = _edges(nodes)
    rank = F.row_number().over(Window.partitionBy("w").orderBy(F.desc("sim"), "u"))
    back = edges.withColumn("r", rank).where(F.col("r") <= k)
    return edges.select(F.col("u").alias("v"), F.col("w").alias("m"), "fresh").unionByName(back.select(F.col("w").alias("v"), F.col("u").alias("m"), "fresh"))


def _meet(nodes: DataFrame, packed: DataFrame, k: int) -> DataFrame:
    """Pairs (u, w, sim) that met at a node around which both are, one of them newly, and that beat u's worst neighbour."""
    known = packed.join(nodes.select(F.col("u").alias("id"), "worst"), "id", "left").select(F.col("id").alias("m"), "q", F.coalesce("worst", F.lit(-math.inf).cast("float")).alias("worst"))
    groups = _around(nodes, k).join(known, "m").groupBy("v").agg(F.collect_list(F.struct("m", "q", "worst", "fresh")).alias("met"), F.bool_or("fresh").alias("any"))

    def run(batches):
        for batch in batches:
            sizes, flat = _lists(batch.column(0))
            m, worst, fresh = flat.field("m").to_numpy(), flat.field("worst").to_numpy(), flat.field("fresh").to_numpy(zero_copy_only=False)
            x, scale = _unpack(flat.field("q"))
            owner = np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((~fresh, m, owner))
            once = order[np.append(True, (owner[order][1:] != owner[order][:-1]) | (m[order][1:] != m[order][:-1]))[: len(order)]]
            sizes = np.bincount(owner[once], minlength=len(sizes))
            starts = np.cumsum(sizes) - sizes
            us, ws, sims = [], [], []
            for at in range(0, len(sizes), 128):
                size = sizes[at : at + 128]
                real = np.arange(size.max())[None] < size[:, None]
                place = once[np.where(real, starts[at : at + 128, None] + np.arange(size.max())[None], 0)]
                part, by = x[place], scale[place]
                s = (part @ part.transpose(0, 2, 1) * (by[:, :, None] * by[:, None, :])).astype(np.float32)
                new = fresh[place] & real
                says = (s > worst[place][:, :, None]) & (new[:, :, None] | new[:, None, :]) & real[:, :, None] & real[:, None, :]
                says[:, np.arange(size.max()), np.arange(size.max())] = False
                r, i, j = np.nonzero(says)
                us.append(m[place[r, i]])
                ws.append(m[place[r, j]])
                sims.append(s[r, i, j])
            if us:
                yield _top(np.concatenate(us), np.concatenate(ws), np.concatenate(sims), k)

    return groups.where("any").select("met").mapInArrow(run, _PAIRS)


def build(rows: DataFrame, k: int = K, rounds: int = MOST_ROUNDS, block: int = BLOCK, deals: int = DEALS) -> tuple[DataFrame, DataFrame, int]:
    """(nodes (u, near, worst), packed vectors, number of nodes) of rows (id, vec) by NN-descent in at most `rounds` rounds."""
    packed = materialize(_pack(rows), "nn-packed")
    n = packed.count()
    seeds = _seeds(packed, n, k, block, deals) if n else packed.select(F.col("id").alias("u"), F.col("id").alias("w"), F.lit(0.0).cast("float").alias("sim"))
    with batches_of(rows.sparkSession, 64):
        nodes = materialize(_merge(seeds.withColumn("fresh", F.lit(True)), k), "nn-graph")
    for _ in range(rounds if n > block else 0):
        last = nodes
        with batches_of(rows.sparkSession, 1024):
            found = _meet(last, packed, k).withColumn("fresh", F.lit(True))
            nodes = materialize(_merge(_edges(last).withColumn("fresh", F.lit(False)).unionByName(found), k), "nn-graph")
        drop_tables(last)
        if _news(nodes) < DELTA:
            break
    return nodes, packed, n


def search(nodes: DataFrame, packed: DataFrame, queries: DataFrame, beam: int, k: int = K, meet: int = MEET) -> DataFrame:
    """(u, near, worst): each query node's beam, started from the node itself. queries: (id), a subset of the nodes."""
    around = _around(nodes, k).select("v", "m").distinct().join(packed.withColumnsRenamed({"id": "m", "q": "wq"}), "m")
    around = materialize(around.groupBy("v").agg(F.collect_list(F.struct(F.col("m").alias("w"), "wq")).alias("ws")), "nn-around")
    mine = materialize(packed.join(queries.select("id"), "id", "left_semi").withColumnsRenamed({"id": "u", "q": "uq"}), "nn-queries")
    salts = 1 + mine.count() // meet
    step = mine.select("u", "uq", F.col("u").alias("v"), F.lit(-math.inf).cast("float").alias("worst"))

    def run(batches):
        for batch in batches:
            many, flat = _lists(batch.column(0))
            sizes, near = _lists(batch.column(1))
            u, worst, w = flat.field("u").to_numpy(), flat.field("worst").to_numpy(), near.field("w").to_numpy()
            (x, xs), (y, ys) = _unpack(flat.field("uq")), _unpack(near.field("wq"))
            a = b = 0
            us, ws, sims = [], [], []
            for n, size in zip(many, sizes, strict=True):
                s = (x[a : a + n] @ y[b : b + size].T * (xs[a : a + n, None] * ys[None, b : b + size])).astype(np.float32)
                i, j = np.nonzero((s > worst[a : a + n, None]) & (u[a : a + n, None] != w[None, b : b + size]))
                us.append(u[a + i])
                ws.append(w[b + j])
                sims.append(s[i, j])
                a, b = a + n, b + size
            if us:
                yield _top(np.concatenate(us), np.concatenate(ws), np.concatenate(sims), beam)

    beams = None
    for _ in range(MOST_ROUNDS):
        met = step.groupBy("v", F.pmod(F.xxhash64("u"), F.lit(salts)).alias("salt")).agg(F.collect_list(F.struct("u", "uq", "worst")).alias("us"))
        pairs = met.join(around, "v").select("us", "ws").mapInArrow(run, _PAIRS).withColumn("fresh", F.lit(True))
        last = beams
        with batches_of(packed.sparkSession, 1024):
            beams = materialize(_merge(pairs if last is None else pairs.unionByName(_edges(last).withColumn("fresh", F.lit(False))), beam), "nn-beam")
        if last is not None:
            drop_tables(last)
        if _news(beams) < DELTA:
            break
        fresh = F.transform(F.filter("near", lambda x: x["fresh"]), lambda x: x["w"])
        step = beams.join(mine, "u").select("u", "uq", "worst", F.explode(fresh).alias("v"))
    drop_tables(around, mine)
    return beams


def _dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def nearest(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", every: int = EVERY, top: int = TOP, k: int = K, rounds: int = MOST_ROUNDS, block: int = BLOCK) -> DataFrame:
    """query_id, rank, id_col, score: for each row whose id is divisible by `every`, its `top` nearest by inner product.

    See vectors.usable() for rows that take no part; with fewer candidates than `top` all are returned. A table without usable
    vectors gives no rows. Ties go to the smaller id. Equal vectors are searched for once; of each such group the top + 1
    smallest ids can be among anyone's nearest.
    """
    rows = usable(df, id_col, vec_col)
    classes = materialize(rows.groupBy("vec").agg(F.min("id").alias("rep")), "nn-classes")
    members = materialize(rows.join(classes, "vec").select("id", "rep"), "nn-members")
    asked = members.where(F.col("id") % every == 0)
    nodes, packed, n = build(classes.select(F.col("rep").alias("id"), "vec"), k, rounds, block)
    beams = search(nodes, packed, asked.select(F.col("rep").alias("id")).distinct(), beam_width(n), k)
    # a query's own group is a candidate too: its other members
    pairs = _edges(beams).select("u", "w").unionByName(asked.select(F.col("rep").alias("u"), F.col("rep").alias("w")).distinct())
    left, right = classes.select(F.col("rep").alias("u"), F.col("vec").alias("a")), classes.select(F.col("rep").alias("w"), F.col("vec").alias("b"))
    scored = pairs.join(left, "u").join(right, "w").select("u", "w", _dot("a", "b").alias("score"))
    ranked = scored.withColumn("r", F.row_number().over(Window.partitionBy("u").orderBy(F.desc("score"), "w")))
    # with itself, top + 1 groups hold top others at least, but equal scores may draw in one of a later group
    edge = F.max(F.when(F.col("r") == top + 1, F.col("score"))).over(Window.partitionBy("u"))
    ranked = ranked.withColumn("edge", edge).where((F.col("r") <= top + 1) | (F.col("score") >= F.col("edge")))
    first = members.withColumn("place", F.row_number().over(Window.partitionBy("rep").orderBy("id"))).where(F.col("place") <= top + 1)
    found = ranked.join(first.select(F.col("rep").alias("w"), "id"), "w").select("u", "id", "score")
    best = found.withColumn("r", F.row_number().over(Window.partitionBy("u").orderBy(F.desc("score"), "id"))).where(F.col("r") <= top + 1)
    best = materialize(best.groupBy(F.col("u").alias("rep")).agg(F.array_sort(F.collect_list(F.struct("r", "id", "score"))).alias("best")), "nn-best")
    drop_tables(nodes, packed, beams)
    out = asked.join(best, "rep").select("id", F.slice(F.filter("best", lambda x: x["id"] != F.col("id")), 1, top).alias("best"))
    return out.select(F.col("id").alias("query_id"), F.posexplode("best").alias("at", "x")).select("query_id", (F.col("at") + 1).alias("rank"), F.col("x.id").alias(id_col), F.col("x.score").alias("score"))


def op7_nearest(spark, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
