"""Pairs of texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more, found without a miss.

Two such sets share a shingle among the n - ceil(0.8 n) + 1 of each that come first in any one order. The order used puts
shingles that are common in a sample of the texts last; the sample decides how much work there is, never what is found. Texts
that share one of those shingles are compared by the parities of their shingles' counts in BITS buckets: differing parities
are at most the shingles in which the sets differ, which are at most a ninth of both sizes, so the filter drops no pair either.
Of texts with more than LONG shingles, which fill those buckets, pairs that are left meet WIDE buckets before any text is sent.

What passes is compared shingle by shingle, in two rounds. Of each group of texts that share a shingle, the first round takes a
spanning forest only, so that a large group of near copies gives no pairs by the square; the second takes all pairs that are
still in different components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import batches_of, drop_read, drop_tables, materialize
from .components import components
from .simhash import SEED, _settle, _signed, fingerprint

WORDS = 5
BITS = 1024
LONG, WIDE = 1024, 16_384
#: texts from which common shingles are learnt, and how many of those are kept
SAMPLE, COMMON = 4_096, 65_536
#: rows of texts in one Arrow batch
ROWS = 256
#: hashes of texts (8 MB) up to which these go to the texts, and beyond which the texts are shuffled to them
HELD = 1 << 20


def shingles(text: bytes | None, n: int = WORDS) -> set[bytes]:
    """The runs of n words, lower-cased in ASCII; all words of a shorter text; no words: none."""
    words = (text or b"").lower().split()
    return {b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def near(a: set, b: set) -> bool:
    """Whether the Jaccard similarity is 0.8 or more."""
    both = len(a & b)
    return 5 * both >= 4 * (len(a) + len(b) - both) > 0


def _hashes(text: bytes | None) -> np.ndarray:
    return np.unique(np.array([_signed(xxhash.xxh64_intdigest(s, SEED)) for s in shingles(text)], dtype=np.int64))


def _common(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hash, count) of what is common in a sample, by hash."""
    share = max(1, texts.count() // SAMPLE)

    def run(batches):
        for batch in batches:
            for t in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(_hashes(t))], names=["token"])

    tokens = texts.where(F.pmod("node", F.lit(share)) == 0).select(F.col("text").cast("binary")).mapInArrow(run, "token long")
    with batches_of(texts.sparkSession, ROWS):
        rows = tokens.groupBy("token").count().where("count > 2").orderBy(F.desc("count"), "token").limit(COMMON).collect()
    found = np.array(sorted(map(tuple, rows)), dtype=np.int64).reshape(-1, 2)
    return found[:, 0], found[:, 1]


def signatures(texts: DataFrame) -> DataFrame:
    """(node, fp, n, bits, wide, first) of texts (node, text): fingerprint, number of shingles, parities in BITS and, of long texts,
    in WIDE buckets, hashes of the first shingles."""
    common, counts = _common(texts)

    def one(text):
        h = _hashes(text)
        at = np.minimum(np.searchsorted(common, h), max(len(common) - 1, 0))
        often = np.where(common[at] == h, counts[at], 0) if len(common) else np.zeros(len(h), np.int64)
        first = h[np.lexsort((h, often))][: len(h) - (4 * len(h) + 4) // 5 + 1] if len(h) else h
        parity = lambda size: np.packbits((np.bincount(h & (size - 1), minlength=size) & 1).astype(np.uint8)).tobytes()
        return _signed(fingerprint(text)), len(h), parity(BITS), parity(WIDE) if len(h) > LONG else None, first

    def run(batches):
        for batch in batches:
            fp, n, bits, wide, first = zip(*map(one, batch.column(1).to_pylist()), strict=True) if batch.num_rows else ((), (), (), (), ())
            columns = [batch.column(0), pa.array(fp, pa.int64()), pa.array(n, pa.int64()), pa.array(bits, pa.binary()), pa.array(wide, pa.binary()), pa.array(first, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "fp", "n", "bits", "wide", "first"])

    return texts.select("node", F.col("text").cast("binary")).mapInArrow(run, "node long, fp long, n long, bits binary, wide binary, first array<long>")


def _group_pairs(label: np.ndarray, n: np.ndarray, bits: np.ndarray, forest: bool):
    """(i, j) of members with different labels that sizes and parities let pass; forest: only as many as join what all join."""
    order = np.argsort(n, kind="stable")
    n, bits = n[order], bits[order]
    _, label = np.unique(label[order], return_inverse=True)
    for at in range(0, len(n), 256):
        for to in range(at, len(n), 1024):
            if 4 * n[to] > 5 * n[min(at + 255, len(n) - 1)]:
                break
            differ = np.bitwise_count(bits[at : at + 256, None] ^ bits[None, to : to + 1024]).sum(axis=2, dtype=np.int64)
            low, high = n[at : at + 256, None], n[None, to : to + 1024]
            i, j = np.nonzero((9 * differ <= low + high) & (4 * high <= 5 * low))
            i, j = i + at, j + to
            keep = (i < j) & (label[i] != label[j])
            i, j = i[keep], j[keep]
            while len(i):
                if not forest:
                    yield order[i], order[j]
                    break
                _, k = np.unique(np.maximum(label[i], label[j]), return_index=True)
                yield order[i[k]], order[j[k]]
                names = np.arange(label.max() + 1)
                _settle(names, label[i[k]], label[j[k]])
                label = names[label]
                keep = label[i] != label[j]
                i, j = i[keep], j[keep]


def _pairs(members: DataFrame, forest: bool) -> DataFrame:
    """Distinct (a, b) from members (token, node, label, n, bits), compared within each token."""

    def of(key, node, label, n, bits):
        starts = np.append(np.nonzero(np.append(True, key[1:] != key[:-1]))[0], len(key))
        out = []
        for s, e in zip(starts, starts[1:], strict=False):
            out += [(node[s:e][i], node[s:e][j]) for i, j in _group_pairs(label[s:e], n[s:e], bits[s:e], forest)]
        a, b = (np.concatenate([x[k] for x in out]) if out else np.empty(0, np.int64) for k in (0, 1))
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["a", "b"])

    def run(batches):
        held: list[list[np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [np.asarray(batch.column(k)) for k in range(4)]
            now.append(np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint64).reshape(-1, BITS // 64))
            cut = int(np.argmax(now[0] == now[0][-1]))
            if held and (cut or held[-1][0][-1] != now[0][0]):
                held.append([x[:cut] for x in now])
                yield of(*map(np.concatenate, zip(*held, strict=True)))
                held = []
            elif cut:
                yield of(*[x[:cut] for x in now])
            held.append([x[cut:] for x in now])
        if held:
            yield of(*map(np.concatenate, zip(*held, strict=True)))

    dealt = members.select("token", "node", "label", "n", "bits").repartition("token").sortWithinPartitions("token")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def _apart(pairs: DataFrame, sigs: DataFrame) -> DataFrame:
    """(a, b): the pairs of long texts whose WIDE parities differ too often."""

    def run(batches):
        for batch in batches:
            n = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            one, two = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint64).reshape(-1, WIDE // 64) for k in (4, 5))
            far = pa.array(9 * np.bitwise_count(one ^ two).sum(axis=1, dtype=np.int64) > n)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(far), batch.column(1).filter(far)], names=["a", "b"])

    side = lambda k: sigs.where("wide is not null").select(F.col("node").alias(k), F.col("n").alias(f"n{k}"), F.col("wide").alias(f"w{k}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "wa", "wb")
    with batches_of(pairs.sparkSession, 8 * ROWS):
        return materialize(both.mapInArrow(run, "a long, b long"), "shingles-apart")


def _verified(pairs: DataFrame, texts: DataFrame, sigs: DataFrame) -> DataFrame:
    """(a, b, near, fa, fb): pairs compared shingle by shingle, and the fingerprints of those that were."""
    apart = _apart(pairs, sigs)
    none = F.lit(None).cast("long")
    far = apart.select("a", "b", none.alias("fa"), none.alias("fb"), F.lit(False).alias("near"))
    compared = _compared(pairs.join(apart, ["a", "b"], "left_anti"), texts, sigs)
    out = materialize(compared.unionByName(far), "shingles-tried")
    drop_tables(compared, apart)
    return out


def _compared(pairs: DataFrame, texts: DataFrame, sigs: DataFrame) -> DataFrame:
    """(a, b, near, fa, fb) by the texts themselves."""

    def run(batches):
        for batch in batches:
            sets = [map(shingles, batch.column(k).to_pylist()) for k in (4, 5)]
            says = pa.array([near(x, y) for x, y in zip(*sets, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], says], names=["a", "b", "fa", "fb", "near"])

    wanted = materialize(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "shingles-wanted")
    held = F.broadcast(wanted) if wanted.count() <= HELD else wanted
    some = texts.join(held, "node", "left_semi").dropDuplicates(["node"]).join(sigs.select("node", "fp"), "node")
    some = materialize(some.select("node", "fp", F.col("text").cast("binary").alias("t")), "shingles-texts")
    side = lambda k: some.select(F.col("node").alias(k), F.col("fp").alias(f"f{k}"), F.col("t").alias(f"t{k}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "fa", "fb", "ta", "tb")
    with batches_of(pairs.sparkSession, ROWS):
        out = materialize(both.mapInArrow(run, "a long, b long, fa long, fb long, near boolean"), "shingles-pairs")
    drop_tables(some, wanted)
    return out


def near_links(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Edges (a, b) between simhash fingerprints: they join all texts whose five-word shingles are similar by 0.8 or more, and
    no others. A null text counts as empty; texts without words have no links; an empty table gives no rows."""
    text: Column = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.xxhash64(text).alias("node"), text.alias("text"))
    with batches_of(docs.sparkSession, ROWS):
        rows = materialize(signatures(texts), "shingles-rows")
    sigs = materialize(rows.where("n > 0").dropDuplicates(["node"]), "shingles-nodes")
    drop_tables(rows)
    tokens = sigs.select("node", F.explode("first").alias("token"))
    tokens = tokens.withColumn("c", F.count("*").over(Window.partitionBy("token"))).where("c > 1").select("node", "token")
    tokens = materialize(tokens, "shingles-tokens")
    members = tokens.join(sigs.select("node", "fp", "n", "bits"), "node")
    forest = materialize(_pairs(members.withColumn("label", F.col("fp")), True), "shingles-forest")
    tried = _verified(forest, texts, sigs)
    drop_tables(forest)
    edges = lambda df: df.where("near").select(F.col("fa").alias("a"), F.col("fb").alias("b"))
    found = materialize(edges(tried), "shingles-links")
    if tried.where("not near").isEmpty():
        drop_tables(sigs, tokens, tried)
        return found
    comps = components(found).withColumnsRenamed({"node": "fp", "component": "c"})
    members = members.join(comps, "fp", "left").withColumn("label", F.coalesce("c", "fp"))
    rest = materialize(_pairs(members, False).join(tried.select("a", "b"), ["a", "b"], "left_anti"), "shingles-rest")
    more = _verified(rest, texts, sigs)
    out = materialize(found.unionByName(edges(more)), "shingles-links")
    drop_read(comps)
    drop_tables(sigs, tokens, tried, found, rest, more)
    return out
