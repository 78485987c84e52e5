"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints that differ in at most 2 of 64 bits agree on at least 2 of 4 blocks of 16 bits, so the 6 pairs of blocks
deal distinct fingerprints out to groups that hold every link whole. Inside a group fingerprints stand in Gray rank
order. Runs of FAN neighbours form a node that keeps the bits they all agree on; runs of nodes form the next level; what
an upper node keeps is taken out of the lower ones. A search adds up differing bits from the root down and drops a whole
node once more than the limit have differed; at a member the sum is the exact distance.

A group of more than GROUP distinct fingerprints is not gathered. Its members go to the exact overflow: two fingerprints
are within 2 bits exactly if some 64-bit word is within 1 bit of both, so joining each to its 65 such words gives groups
of at most 65 members, all of them linked.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_read, materialize
from .components import components

SEED = 42
FAN = 16
GROUP = 32_768
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_COLUMN = (np.arange(8, dtype=np.int64) * 256)[None, :]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


_BLOCKS = [0xFFFF << (16 * i) for i in range(4)]
MASKS = [_signed(a | b) for a, b in combinations(_BLOCKS, 2)]


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """The unsigned fingerprint of one text's UTF-8 bytes; no words: 0."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined, n = b" ".join(words), len(words)
    if n <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = list(accumulate(len(w) + 1 for w in words))
        starts = [0, *ends[: n - shingle]]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[s : e - 1], SEED) for s, e in zip(starts, ends[shingle - 1 :], strict=True)]
    total = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], dtype="<u8").view(np.uint8).reshape(-1, 8)
        total += (np.bincount((part + _COLUMN).ravel(), minlength=2048).reshape(8, 256) @ _BITS).ravel()
    return int(np.packbits(total * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id_col, fp): each row's 64-bit fingerprint as a long. A null text counts as empty; a null id stays null."""
    id_type = docs.schema[id_col].dataType

    def run(batches):
        for batch in batches:
            fps = [_signed(fingerprint(t, shingle)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], names=[id_col, "fp"])

    return docs.select(id_col, F.col(text_col).cast("binary").alias("t")).mapInArrow(run, f"`{id_col}` {id_type.simpleString()}, fp long")


class GrayIndex:
    """Levels of masked patterns over fingerprints in Gray rank order."""

    def __init__(self, fps: np.ndarray, fan: int = FAN):
        self.fps, self.fan = fps.astype(np.uint64), fan
        full = np.full(len(fps), np.uint64(0xFFFFFFFFFFFFFFFF))
        bits, masks = self.fps, full
        levels = [(bits, masks)]
        while len(bits) > 1:
            starts = np.arange(0, len(bits), fan)
            every, some = np.bitwise_and.reduceat(bits, starts), np.bitwise_or.reduceat(bits, starts)
            masks = np.bitwise_and.reduceat(masks, starts) & ~(every ^ some)
            bits = every & masks
            levels.append((bits, masks))
        #: from the root down: patterns, and the bits that no upper node has compared
        self.levels = []
        for k in range(len(levels) - 1, -1, -1):
            bits, masks = levels[k]
            above = np.zeros(len(bits), np.uint64) if k == len(levels) - 1 else np.repeat(levels[k + 1][1], fan)[: len(bits)]
            self.levels.append((bits, masks & ~above))

    def within(self, queries: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """(query number, member number) of every pair at most limit bits apart."""
        q = np.arange(len(queries))
        node = np.zeros(len(queries), dtype=np.int64)
        acc = np.zeros(len(queries), dtype=np.uint8)
        for k, (bits, left) in enumerate(self.levels):
            if k:
                child = (node[:, None] * self.fan + np.arange(self.fan)).ravel()
                q, acc = np.repeat(q, self.fan), np.repeat(acc, self.fan)
                there = child < len(bits)
                q, acc, node = q[there], acc[there], child[there]
            acc = acc + np.bitwise_count((queries[q] ^ bits[node]) & left[node])
            near = acc <= limit
            q, node, acc = q[near], node[near], acc[near]
        return q, node


def _settle(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Give all members joined by pairs (i, j) their smallest label, in place."""
    while True:
        low = np.minimum(labels[i], labels[j])
        if (labels[i] == low).all() and (labels[j] == low).all():
            return
        for end in (i, j):
            np.minimum.at(labels, labels[end], low)
            np.minimum.at(labels, end, low)
        while (labels[labels] != labels).any():
            labels[:] = labels[labels]


def _group_edges(fps: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges from members to the first of their local component: linear in the group, whatever its links."""
    index, labels = GrayIndex(fps), np.arange(len(fps))
    for at in range(0, len(fps), 256):
        q, m = index.within(index.fps[at : at + 256], limit)
        _settle(labels, q + at, m)
    far = np.nonzero(labels != np.arange(len(fps)))[0]
    return fps[far], fps[labels[far]]


def _search(limit: int, most: int):
    """Stream rows sorted by (band, key, Gray rank); give edges (a, b), and members of too large groups as (a, null)."""

    def edges_of(key, fps):
        out_a, out_b = [], []
        same = np.append(0, np.cumsum((key[1:] != key[:-1]).any(axis=1)))
        sizes = np.bincount(same)
        small = sizes[same] <= FAN
        for step in range(1, FAN):  # groups of one leaf: members are compared at once
            if len(fps) <= step or sizes.max() <= step:
                break
            hit = (same[step:] == same[:-step]) & small[step:] & (np.bitwise_count(fps[step:].view(np.uint64) ^ fps[:-step].view(np.uint64)) <= limit)
            out_a.append(fps[step:][hit])
            out_b.append(fps[:-step][hit])
        starts = np.append(0, np.cumsum(sizes))
        for g in np.nonzero(sizes > FAN)[0]:
            a, b = _group_edges(fps[starts[g] : starts[g + 1]], limit)
            out_a.append(a)
            out_b.append(b)
        return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (fps[:0], fps[:0])

    def give(a, b):
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def run(batches):
        tail_key, tail, spilling = None, np.empty(0, np.int64), None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([np.asarray(batch.column(0)).astype(np.int64), np.asarray(batch.column(1))], axis=1)
            fps = np.asarray(batch.column(2))
            if len(tail):
                key, fps = np.concatenate([np.repeat(tail_key[None, :], len(tail), 0), key]), np.concatenate([tail, fps])
            last = key[-1].copy()
            cut = int(np.nonzero((key != last).any(axis=1))[0][-1] + 1) if (key != last).any() else 0
            if spilling is not None:  # go on with the group that is too large
                end = int(np.argmax((key != spilling).any(axis=1))) if (key != spilling).any() else len(fps)
                yield give(fps[:end], [None] * end)
                key, fps, cut = key[end:], fps[end:], cut - end
                if not len(fps):
                    tail = fps
                    continue
                spilling = None
            if cut > 0:
                yield give(*edges_of(key[:cut], fps[:cut]))
            tail_key, tail = last, fps[max(cut, 0) :]
            if len(tail) > most:
                yield give(tail, [None] * len(tail))
                spilling, tail = last, tail[:0]
        if len(tail):
            yield give(*edges_of(np.repeat(tail_key[None, :], len(tail), 0), tail))

    return run


def links(fps: DataFrame, limit: int = 2, most: int = GROUP) -> DataFrame:
    """Edges (a, b) that join all distinct fingerprints of column fp within limit (at most 2) differing bits, and none beyond."""
    if not 0 <= limit <= 2:
        raise ValueError("the blocks hold links of at most 2 bits")
    fp = F.col("fp")
    rank = fp
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    dealt = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("band"), fp.bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(MASKS)])).alias("g"), rank.bitwiseXOR(F.lit(-(1 << 63))).alias("gray"))
    dealt = dealt.select("g.band", "g.key", "fp", "gray").repartition("band", "key").sortWithinPartitions("band", "key", "gray")
    found = materialize(dealt.select("band", "key", "fp").mapInArrow(_search(limit, most), "a long, b long"), "simhash-links")
    over = found.where("b is null").select(F.col("a").alias("fp")).distinct()
    near = F.array(fp, *[fp.bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64)])
    if limit == 2:
        words = over.select("fp", F.explode(near).alias("word"))
        stars = words.groupBy("word").agg(F.collect_set("fp").alias("all")).where("size(all) > 1").select(F.array_min("all").alias("b"), F.explode("all").alias("a")).where("a <> b")
    else:  # at distance 1 a member is itself one of the other's words
        words = over.select(fp.alias("a"), F.explode(near).alias("fp")) if limit else over.select(fp.alias("a"), "fp")
        stars = words.join(over, "fp").select("a", fp.alias("b")).where("a > b")
    return found.where("b is not null").unionByName(stars.select("a", "b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, limit: int = 2, most: int = GROUP, also: DataFrame | None = None) -> DataFrame:
    """One row per document: id_col, fp, component_id (the smallest id reachable over links of at most limit bits).

    also: more edges (a, b) between fingerprints, which count as links.

    Texts: null counts as empty; texts without words have fingerprint 0 and so link with one another. A null id never
    becomes a component's id unless the whole component has none. Repeated rows stay. An empty table gives no rows; other
    columns are not read.
    """
    fps = materialize(fingerprints(docs, id_col, text_col, shingle), "simhash-fps")
    least = fps.groupBy("fp").agg(F.min(id_col).alias("rep"))
    edges = links(least.select("fp"), limit, most)
    comps = components(edges if also is None else edges.unionByName(also))
    placed = materialize(least.join(comps, least.fp == comps.node, "left").select("fp", "rep", F.coalesce("component", "fp").alias("c")), "simhash-classes")
    drop_read(comps)
    drop_read(edges)
    ids = placed.groupBy("c").agg(F.min("rep").alias("component_id"))
    labels = placed.select("fp", "c").join(ids, "c").select("fp", "component_id")
    return fps.join(labels, "fp").select(id_col, "fp", "component_id")


def op3_simhash(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
