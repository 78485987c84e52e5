"""Conflict-constrained best-fit packing of documents into sequences of fixed capacity.

Documents longer than the capacity fill whole bins of their own; every rest, and every shorter document, is a piece. Pieces are
dealt at random into shards of about SHARD pieces, so that a hot source or cluster has the same share in each, and each
shard is packed by itself, largest piece first (leaving at most a few open bins a shard). Open bins stand in order of what is left
in them. A bin carries bitmaps of its sources, one plane for each time a source may occur, and of the duplicate clusters
in it; clusters with one piece in a shard need no bit. For a piece the search starts at the tightest bin that has room and
goes on to the next until one has neither the source's last plane nor the cluster's bit set.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, materialize, n_words

CAPACITY = 4096
SHARD = 8192
PER_SOURCE = 6


def best_fit(pieces: list[tuple[int, int, int]], capacity: int, per_source: int) -> list[tuple[int, int]]:
    """(bin, offset) of each piece (size, source, cluster; cluster -1: none), for pieces in order of falling size.

    Full bins and bins that no later piece can enter leave the search.
    """
    left: list[tuple[int, int]] = []  # (room, bin), ascending
    planes: list[list[int]] = []
    clusters: list[int] = []
    used: list[int] = []
    out = []
    for size, source, cluster in pieces:
        bit, own = 1 << source, 1 << cluster if cluster >= 0 else 0
        at = bisect_left(left, (size, -1))
        while at < len(left):
            b = left[at][1]
            if not (planes[b][-1] & bit or clusters[b] & own):
                break
            at += 1
        if at < len(left):
            room, b = left.pop(at)
        else:
            room, b = capacity, len(used)
            planes.append([0] * per_source)
            clusters.append(0)
            used.append(0)
        for i, p in enumerate(planes[b]):
            if not p & bit:
                planes[b][i] = p | bit
                break
        clusters[b] |= own
        out.append((b, used[b]))
        used[b] += size
        if room > size:
            insort(left, (room - size, b))
    return out


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", cluster: Column | None = None, capacity: int = CAPACITY, per_source: int = PER_SOURCE, shard: int = SHARD) -> DataFrame:
    """One row per piece: id_col, piece (0, 1, ..), bin_id, offset, size (words), source, cluster.

    Documents of one cluster (by default: of equal words but for the case of A-Z) never share a bin, and a bin holds at
    most per_source pieces of a source. A document without words (null or empty) has no piece. A null source is a source; null ids
    and repeated rows are documents of their own. bin_id is unique over all shards and the same in reruns on the same rows, however
    they are partitioned.
    An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.btrim(F.regexp_replace(ascii_lower(text), r"[\x20\x09-\x0D]+", " "), F.lit(" "))
    small = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("n"), (F.xxhash64(words) if cluster is None else F.xxhash64(cluster)).alias("cluster"), F.xxhash64(text).alias("th"))
    # equal rows are documents of their own, told apart by number, whatever tasks they come from
    small = small.where("n > 0").groupBy("id", "source", "n", "cluster", "th").agg(F.count("*").alias("many"))
    small = materialize(small.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("many")))).drop("many"), "packing-sizes")
    full = F.floor(F.col("n") / capacity).cast("long")
    rest = F.col("n") % capacity
    shards = max(1, round(small.where(rest > 0).count() / shard))
    # the row's place in its shard comes from content alone, so that a lost task's rerun packs the same bins
    mixed = F.xxhash64(F.lit("packing"), "id", "th", "k")
    part = small.where(rest > 0).select(F.pmod(mixed, F.lit(shards)).cast("int").alias("shard"), "id", "source", "cluster", "th", "k", rest.alias("size"), full.alias("piece"))
    id_type = docs.schema[id_col].dataType
    schema = f"`{id_col}` {id_type.simpleString()}, piece long, bin_id string, offset long, size long, source string, cluster long"

    def run(key, table):
        table = table.sort_by([("size", "descending"), ("cluster", "ascending"), ("th", "ascending"), ("id", "ascending"), ("k", "ascending")])
        sources, clusters, seen = {}, {}, {}
        for c in table["cluster"].to_pylist():
            seen[c] = seen.get(c, 0) + 1
        pieces = []
        for size, source, c in zip(table["size"].to_pylist(), table["source"].to_pylist(), table["cluster"].to_pylist(), strict=True):
            pieces.append((size, sources.setdefault(source, len(sources)), clusters.setdefault(c, len(clusters)) if seen[c] > 1 else -1))
        bins = best_fit(pieces, capacity, per_source)
        label = f"s{key[0].as_py()}-"
        return pa.table([table["id"], table["piece"], pa.array([f"{label}{b}" for b, _ in bins], pa.string()), pa.array([o for _, o in bins], pa.int64()), table["size"], table["source"].cast(pa.string()), table["cluster"]], names=[id_col, "piece", "bin_id", "offset", "size", "source", "cluster"])

    packed = part.groupBy("shard").applyInArrow(run, schema)
    whole = small.where(full > 0).select(F.col("id"), F.explode(F.sequence(F.lit(0), full - 1)).alias("piece"), "source", "cluster", "th", "k")
    whole = whole.select(F.col("id").alias(id_col), "piece", F.concat_ws("-", F.lit("w"), F.coalesce(F.col("id").cast("string"), F.lit("null")), F.lower(F.hex(F.xxhash64("source", "cluster", "th"))), "k", "piece").alias("bin_id"), F.lit(0).cast("long").alias("offset"), F.lit(capacity).cast("long").alias("size"), F.col("source").cast("string"), "cluster")
    return packed.unionByName(whole)


def op2_packing(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
