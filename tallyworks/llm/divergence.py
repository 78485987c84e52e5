"""How far sources diverge from each other and from their language, over integer-encoded vocabularies.

Terms are counted where the texts are; the counts of a term meet once, in a shuffle by language and term. There sorted runs of
terms become chunks: the sorted array of the terms that are kept is the dictionary, searchsorted gives ids in UTF-8 order, and
bincount by id and group gives the counts. A chunk is stored with its non-zero counts and made dense, groups by terms, only
while it is scored. All arithmetic is in integers, exact up to 2**53 occurrences in a group.

What a task holds is the groups of one language (lang, source), which the result holds squared, times a chunk of CELLS cells.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import drop_tables, materialize

LEAST_DOCS = 3
TERMS = 200
SCALE = 10**9
#: entries that a task counts before it hands them on, bytes of a text that are split at a time, cells and terms of a chunk
ENTRIES, PIECE, CELLS, WIDE = 400_000, 1 << 20, 1 << 20, 8192
#: groups of which the totals go to each task; a table with more has a result of at least so many rows to the square a language
GROUPS = 1_000_000
RESULT = "lang string, source string, part string, item string, value bigint, rank int"

# ASCII letters lower-cased, other ASCII one space, bytes of other characters as they are
_LETTERS = bytes(c if c >= 128 or chr(c).islower() else c + 32 if chr(c).isupper() else 32 for c in range(128)) + bytes(range(128, 256))


def _words(text: bytes):
    """Lists of the text's terms, piece by piece."""
    clean, at = text.translate(_LETTERS), 0
    while at < len(clean):
        end = clean.find(b" ", at + PIECE)
        end = len(clean) if end < 0 else end
        yield clean[at:end].split()
        at = end


def _counter(ids: dict[tuple[bytes, bytes], tuple[int, int]]):
    def flush(held):
        for (lang, group), (count, docs) in held.items():
            n = len(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * n, pa.int32()), pa.array([group] * n, pa.int32()), pa.array(list(count), pa.binary()).cast(pa.string()), pa.array(count.values(), pa.int64()), pa.array([docs[w] for w in count], pa.int64())],
                ["l", "g", "term", "n", "docs"],
            )

    def count(batches):
        held, size = {}, 0
        for batch in batches:
            for lang, source, text in zip(*(batch.column(i).cast(pa.binary()) for i in range(3)), strict=True):
                key = ids[lang.as_py(), source.as_py()]
                counts, docs = held.setdefault(key, (Counter(), Counter()))
                size -= len(counts)
                seen: set[bytes] = set()
                for words in _words(text.as_py()):
                    counts.update(words)
                    seen.update(words)
                docs.update(seen)
                size += len(counts)
                if size > ENTRIES:
                    yield from flush(held)
                    held, size = {}, 0
        yield from flush(held)

    return count


def _encoder(sizes: list[int], least: int):
    """Sorted (l, term, g, n, docs) to chunks (l, terms, pos, n, totals); pos is group * width + id."""

    def chunk(lang, rows):
        terms, group, n, docs = (np.concatenate(x) for x in zip(*rows, strict=True))
        known = np.unique(terms)
        ids = np.searchsorted(known, terms)
        keep = np.bincount(ids, weights=docs) >= least
        if not keep.any():
            return
        kept, own = known[keep], keep[ids]
        ids, width = np.searchsorted(kept, terms[own]), len(kept)
        dense = np.bincount(group[own] * width + ids, weights=n[own], minlength=sizes[lang] * width).astype(np.int64)
        pos = np.flatnonzero(dense)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang], pa.int32()), pa.array([kept.tolist()], pa.list_(pa.binary())).cast(pa.list_(pa.string())), pa.array([pos], pa.list_(pa.int64())), pa.array([dense[pos]], pa.list_(pa.int64())), pa.array([dense.reshape(sizes[lang], width).sum(axis=1)], pa.list_(pa.int64()))],
            ["l", "terms", "pos", "n", "totals"],
        )

    def encode(batches):
        held, last, seen = [], None, 0
        for batch in batches:
            langs = batch.column(0).to_numpy()
            terms = np.empty(len(langs), object)
            terms[:] = batch.column(1).cast(pa.binary()).to_pylist()
            columns = (terms, batch.column(2).to_numpy().astype(np.int64), batch.column(3).to_numpy(), batch.column(4).to_numpy())
            at = 0
            for start in np.flatnonzero(np.r_[True, (langs[1:] != langs[:-1]) | (terms[1:] != terms[:-1])]) if len(langs) else ():
                now = (int(langs[start]), terms[start])
                if now == last:
                    continue
                if last and (now[0] != last[0] or seen >= min(WIDE, CELLS // sizes[last[0]] + 1)):
                    held.append([x[at:start] for x in columns])
                    yield from chunk(last[0], held)
                    held, seen, at = [], 0, start
                last, seen = now, seen + 1
            held.append([x[at:] for x in columns])
        if last:
            yield from chunk(last[0], held)

    return encode


def scaled(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * count / total) by long division, three decimal digits at a time; exact while total is below 2**53."""
    out, rest = count // total, count % total
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // total, rest % total
    return out + 1


def _scorer(langs: list[tuple[str, list[str], np.ndarray, int]], top: int):
    """Chunks to (lang, source, part, item, value): sums over the chunk for pairs, the chunk's first `top` terms of each group."""

    def rows(lang, source, part, items, values):
        n = len(items)
        return pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()), pa.array([part] * n, pa.string()), pa.array(items, pa.string()), pa.array(values, pa.int64())], ["lang", "source", "part", "item", "value"])

    def score(batches):
        for batch in batches:
            for l, terms, pos, n in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), batch.column(3), strict=True):
                lang, sources, totals, size = langs[l]
                words, width = terms.values, len(terms.values)
                dense = np.zeros(len(sources) * width, np.int64)
                dense[pos.values.to_numpy()] = n.values.to_numpy()
                dense = dense.reshape(len(sources), width)
                p = scaled(dense + 1, (totals + size)[:, None])
                q = scaled(dense.sum(axis=0) + 1, np.int64(totals.sum() + size))
                for g, source in enumerate(sources):
                    others = np.flatnonzero(np.arange(len(sources)) != g)
                    if len(others):
                        value = ((p[g] - p) ** 2 // p).sum(axis=1)
                        yield rows(lang, source, "pair", [sources[h] for h in others], value[others])
                    own = np.flatnonzero((dense[g] > 0) & (p[g] > q))
                    value = (p[g, own] - q[own]) ** 2 // q[own]
                    # ids follow UTF-8 order, so they break ties
                    first = np.lexsort((own, -value))[:top]
                    if len(first):
                        yield rows(lang, source, "term", words.take(pa.array(own[first])), value[first])

    return score


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least: int = LEAST_DOCS, top: int = TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): see the module. Null text, lang and source are ''.

    Part pair has every other source of the language (value 0 if it keeps no term), part term the first `top` of the group's
    terms that it has more often than its language. Repeated rows are documents like any other, other columns are not read,
    an empty table gives no rows, and a text of any length is split piece by piece.
    """
    spark = docs.sparkSession
    read = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name) for c, name in ((lang_col, "l"), (source_col, "s"), (text_col, "t"))])
    groups = sorted((r.l.encode(), r.s.encode()) for r in read.select("l", "s").distinct().limit(GROUPS + 1).collect())
    if len(groups) > GROUPS:
        raise ValueError(f"more than {GROUPS} groups of a language and a source")
    if not groups:
        return spark.createDataFrame([], RESULT)
    names: dict[bytes, list[str]] = {}
    ids = {}
    for lang, source in groups:
        of = names.setdefault(lang, [])
        ids[lang, source] = (len(names) - 1, len(of))
        of.append(source.decode())
    sizes = [len(x) for x in names.values()]
    counted = read.mapInArrow(_counter(ids), "l int, g int, term string, n bigint, docs bigint")
    met = counted.repartition("l", "term").groupBy("l", "term", "g").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    sorted_terms = met.select("l", "term", "g", "n", "docs").sortWithinPartitions("l", "term")
    chunks = materialize(sorted_terms.mapInArrow(_encoder(sizes, least), "l int, terms array<string>, pos array<bigint>, n array<bigint>, totals array<bigint>"), "divergence-chunks")
    totals = [np.zeros(n, np.int64) for n in sizes]
    for l, g, n in chunks.select("l", F.posexplode("totals").alias("g", "n")).groupBy("l", "g").agg(F.sum("n")).collect():
        totals[l][g] = n
    kept = {r[0]: r[1] for r in chunks.groupBy("l").agg(F.sum(F.size("terms"))).collect()}
    langs = [(lang.decode(), names[lang], totals[i], kept.get(i, 0)) for i, lang in enumerate(names)]
    scored = chunks.select("l", "terms", "pos", "n").mapInArrow(_scorer(langs, top), "lang string, source string, part string, item string, value bigint")
    bare = [(lang, s) for i, (lang, sources, _, _) in enumerate(langs) if i not in kept for s in sources]
    alone = spark.createDataFrame(bare, "lang string, source string")
    nothing = alone.join(alone.withColumnRenamed("source", "item"), "lang").where("source <> item").select("lang", "source", F.lit("pair").alias("part"), "item", F.lit(0).cast("bigint").alias("value"))
    pairs = scored.where("part = 'pair'").unionByName(nothing).groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    by = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = pairs.withColumn("rank", F.row_number().over(by))
    terms = scored.where("part = 'term'").withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)
    out = materialize(ranked.unionByName(terms), "divergence")
    drop_tables(chunks)
    return out


def op12_divergence(spark, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP12_SQL = f"""WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t FROM documents),
 grp AS (SELECT DISTINCT lang, source FROM d),
 tok AS (SELECT id, lang, source, unnest(regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
 kept AS (SELECT lang, term FROM tok GROUP BY ALL HAVING count(DISTINCT id) >= {LEAST_DOCS}),
 v AS (SELECT g.lang, count(k.term) AS v FROM (SELECT DISTINCT lang FROM grp) g LEFT JOIN kept k ON k.lang = g.lang GROUP BY 1),
 c AS (SELECT lang, source, term, count(*) AS n FROM tok JOIN kept USING (lang, term) GROUP BY ALL),
 cell AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM grp g JOIN kept k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
 whole AS (SELECT lang, term, sum(n) AS n FROM cell GROUP BY ALL),
 p AS (SELECT cell.lang, source, term, n, 1 + CAST({SCALE} AS HUGEINT) * (n + 1) // (sum(n) OVER (PARTITION BY cell.lang, source) + v) AS p FROM cell JOIN v USING (lang)),
 q AS (SELECT whole.lang, term, 1 + CAST({SCALE} AS HUGEINT) * (n + 1) // (sum(n) OVER (PARTITION BY whole.lang) + v) AS q FROM whole JOIN v USING (lang)),
 pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value FROM grp a JOIN grp b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value FROM p x JOIN p y ON y.lang = x.lang AND y.term = x.term AND y.source <> x.source GROUP BY ALL) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
 term AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
 SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank
 FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pair UNION ALL SELECT * FROM term)) WHERE part = 'pair' OR rank <= {TERMS}"""
