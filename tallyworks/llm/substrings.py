"""Substring dedup by difference-cover anchors.

COVER is a perfect difference set modulo PERIOD: whatever the offset between two places, within PERIOD words of any two
equal starts there is a step after which both stand at positions that are in COVER modulo PERIOD. So two equal windows of
WINDOW words share an equal anchor of WINDOW - PERIOD + 1 words at cover positions of their own documents, and only
len(COVER) / PERIOD of all positions need hashing.

1. Anchors of all documents are dealt by hash and sorted; equal neighbours mark their places. Each Python batch first
   finds its own repeats: those need no partner, and only one row of each goes to the hash's task as evidence, so that a
   passage in a third of all documents brings a few rows a batch to that task. The task keeps one row in memory.
2. Extension: a document's windows around marked anchors, and no others, are hashed whole (96 bits) and meet in the
   same way.
3. Words under windows that met are cut.

What a step finds is written before the next one starts, and the step's shuffle files go.

A row is known by a 64-bit hash of its id and text; rows of equal id and text share marks, as they should.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

WINDOW = 35
PERIOD = 21
COVER = (0, 1, 4, 14, 16)
#: bytes of text that one round of in-batch matching holds
ROUND_BYTES = 16 << 20

_M64 = (1 << 64) - 1
_BASES = (0x9E3779B97F4A7C15 | 3, 0xC2B2AE3D27D4EB4F | 3)


class _Hashes(dict):
    """Word to 64-bit hash, remembered within bounds."""

    def __init__(self, seed: int):
        super().__init__()
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1 << 19:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word, self.seed)
        return value


class _Rolling:
    """Hashes of runs of words from prefix sums of a polynomial modulo 2**64."""

    def __init__(self, base: int, seed: int):
        self.base, self.inverse, self.words = base, pow(base, -1, 1 << 64), _Hashes(seed)
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) <= n:
            n = 1 << n.bit_length()
            with np.errstate(over="ignore"):
                self.up = np.multiply.accumulate(np.append(np.uint64(1), np.full(n, self.base, np.uint64)))
                self.down = np.multiply.accumulate(np.append(np.uint64(1), np.full(n, self.inverse, np.uint64)))

    def prefix(self, words: list[bytes]) -> np.ndarray:
        n = len(words)
        self._powers(n)
        each = np.fromiter(map(self.words.__getitem__, words), np.uint64, n)
        out = np.zeros(n + 1, np.uint64)
        np.cumsum(each * self.up[:n], out=out[1:])
        return out

    def runs(self, prefix: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
        x = (prefix[at + length] - prefix[at]) * self.down[at]
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def _cover_positions(n: int, window: int, period: int, cover: tuple[int, ...], anchor: int) -> np.ndarray:
    """Anchor starts in a document of n words; a document shorter than a window needs none."""
    if n < window:
        return np.empty(0, np.int64)
    at = (np.arange(0, n - anchor + 1, period)[:, None] + np.array(cover)).ravel()
    return at[at <= n - anchor]


_KEYED = "k long, u long, x long"


def _meet_in_batch(k: np.ndarray, u: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
    """Rows of keys seen once go on by key; of a repeated key one goes as evidence (its place all ones), and all its places
    go on as met (x < 0), dealt by u. x holds the key's further bits above and the place in its lower 32 bits."""
    order = np.argsort(k)
    ko, co = k[order], x[order] >> 32
    new = np.append(True, (ko[1:] != ko[:-1]) | (co[1:] != co[:-1]))[: len(k)]
    single = new & np.append(new[1:], True)[: len(k)]
    alone, first = np.empty(len(k), bool), np.empty(len(k), bool)
    alone[order], first[order] = single, new & ~single  # back in the documents' order, which packs better
    met = ~alone
    ks = np.concatenate([k[alone], k[first], u[met]])
    us = np.concatenate([u[alone], u[first], u[met]])
    xs = np.concatenate([x[alone], x[first] | 0xFFFFFFFF, (x[met] & 0xFFFFFFFF) | np.int64(-(1 << 63))])
    return pa.RecordBatch.from_arrays([pa.array(ks), pa.array(us), pa.array(xs)], names=["k", "u", "x"])


def _rounds(batches, make):
    """Call make(row of columns) on documents until ROUND_BYTES of text are in; give what meets."""
    ks, us, xs, held = [], [], [], 0

    def give():
        return _meet_in_batch(np.concatenate(ks).view(np.int64), np.concatenate(us), np.concatenate(xs))

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            made = make(row)
            if made is not None:
                k, x = made
                ks.append(k)
                xs.append(x)
                us.append(np.full(len(k), row[0], np.int64))
                held += len(row[1] or b"")
                if held > ROUND_BYTES:
                    yield give()
                    ks, us, xs, held = [], [], [], 0
    if ks:
        yield give()


def _met(batches):
    """From rows sorted by (k, x): the places (u, at) whose key stands on another row too, or that have met before.

    Holds one row: the last one of what was read, with what is known of it.
    """
    last = None
    for batch in batches:
        k, u, x = (np.asarray(c) for c in batch.columns)
        if not len(k):
            continue
        if last is not None:
            k, u, x = np.append(last[0], k), np.append(last[1], u), np.append(last[2], x)
        check = x >> 32
        same = (k[1:] == k[:-1]) & (check[1:] == check[:-1]) & (x[1:] >= 0) & (x[:-1] >= 0)
        met = x < 0
        met[1:] |= same
        met[:-1] |= same
        if last is not None:
            met[0] |= last[3]
        # the evidence of a batch (place -1) speaks for two rows at least
        place = (x & 0xFFFFFFFF).astype(np.int64)
        mark = met & (place != 0xFFFFFFFF)
        last = (k[-1:], u[-1:], x[-1:], bool(met[-1]))
        mark[-1] = False
        yield pa.RecordBatch.from_arrays([pa.array(u[mark]), pa.array(place[mark].astype(np.int32))], names=["u", "at"])
    if last is not None and last[3] and (last[2][0] & 0xFFFFFFFF) != 0xFFFFFFFF:
        yield pa.RecordBatch.from_arrays([pa.array(last[1]), pa.array((last[2] & 0xFFFFFFFF).astype(np.int32))], names=["u", "at"])


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, period: int = PERIOD, cover: tuple[int, ...] = COVER) -> DataFrame:
    """One row per document: id_col, n_words, n_removed (ints), kept (the words that stay, joined by single spaces), and
    spans (array of start, end word positions that went).

    A null text has no words; null ids, repeated ids and repeated rows are documents like any other (and so repeat each
    other). Other columns are not read. An empty table gives no rows. Texts may have up to 2**31 - 1 words.
    """
    if {(a - b) % period for a in cover for b in cover} != set(range(period)):
        raise ValueError("cover is no difference cover modulo period")
    anchor = window - period + 1
    if anchor < 1:
        raise ValueError("period is at most window")
    id_type = docs.schema[id_col].dataType.simpleString()
    keyed = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("t"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("u"))

    def anchors(batches):
        roll = _Rolling(_BASES[0], 0)

        def make(row):
            words = (row[1] or b"").split()
            at = _cover_positions(len(words), window, period, cover, anchor)
            return (roll.runs(roll.prefix(words), at, anchor), at) if len(at) else None

        yield from _rounds(batches, make)

    def windows(batches):
        one, two = _Rolling(_BASES[0], 0), _Rolling(_BASES[1], 1)

        def make(row):
            words = row[1].split()
            n = len(words)
            marked = np.zeros(n + 1, np.int32)
            places = np.array(row[2], np.int64)
            np.add.at(marked, np.maximum(places - (window - anchor), 0), 1)
            np.add.at(marked, np.minimum(places + 1, n), -1)
            at = np.nonzero(np.cumsum(marked[:n])[: max(0, n - window + 1)] > 0)[0]
            if not len(at):
                return None
            check = two.runs(two.prefix(words), at, window) >> np.uint64(33)
            return one.runs(one.prefix(words), at, window), (check.astype(np.int64) << 32) | at

        yield from _rounds(batches, make)

    def cut(batches):
        for batch in batches:
            out = []
            for i, text, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words, spans = (text or b"").split(), []
                n = len(words)
                if places:
                    at = np.unique(np.array(places, np.int64))
                    new = np.append(True, at[1:] > at[:-1] + window)
                    starts, ends = at[new], at[np.append(new[1:], True)] + window
                    spans = [{"start": int(a), "end": int(b)} for a, b in zip(starts, ends, strict=True)]
                    kept, done = [], 0
                    for s in spans:
                        kept += words[done : s["start"]]
                        done = s["end"]
                    words = kept + words[done:]
                out.append({id_col: i, "n_words": n, "n_removed": n - len(words), "kept": b" ".join(words).decode(), "spans": spans})
            yield pa.RecordBatch.from_pylist(out, schema=_schema)

    _schema = pa.schema([pa.field(id_col, _arrow(docs, id_col)), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])

    def meet(rows: DataFrame) -> DataFrame:
        return rows.repartition("k").sortWithinPartitions("k", "x").mapInArrow(_met, "u long, at int")

    marks = meet(keyed.select("u", "t").mapInArrow(anchors, _KEYED)).groupBy("u").agg(F.collect_list("at").alias("ats"))
    marks = materialize(marks, "substring-marks")
    found = meet(keyed.join(marks, "u").select("u", "t", "ats").mapInArrow(windows, _KEYED)).groupBy("u").agg(F.collect_list("at").alias("ats"))
    found = materialize(found, "substring-found")
    return keyed.join(found, "u", "left").select("id", "t", "ats").mapInArrow(cut, f"`{id_col}` {id_type}, n_words long, n_removed long, kept string, spans array<struct<start: long, end: long>>")


def _arrow(df: DataFrame, name: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[name].dataType)


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def op4_substrings(spark, sf_dir: str) -> DataFrame:
    found = cut_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), windows AS (
  SELECT r, p, md5(array_to_string(ws[p : p + 34], ' ')) AS h
  FROM (SELECT r, ws, unnest(generate_series(1, len(ws) - 34)) AS p FROM words WHERE len(ws) >= 35)
), repeated AS (
  SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY h) AS n FROM windows) WHERE n > 1
), gone AS (
  SELECT DISTINCT r, unnest(generate_series(p, p + 34)) AS i FROM repeated
), listed AS (
  SELECT r, list(i) AS gone FROM gone GROUP BY r
), placed AS (
  SELECT w.r, w.doc_id, len(w.ws) AS n, unnest(w.ws) AS word, generate_subscripts(w.ws, 1) AS i FROM words w
), kept AS (
  SELECT p.r, string_agg(word, ' ' ORDER BY p.i) AS t, count(*) AS n_kept FROM placed p LEFT JOIN gone g ON g.r = p.r AND g.i = p.i WHERE g.i IS NULL GROUP BY p.r
)
SELECT w.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words, CAST(len(w.ws) - coalesce(k.n_kept, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM words w LEFT JOIN kept k USING (r)
"""
