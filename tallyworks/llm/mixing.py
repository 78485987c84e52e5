"""Mixing sources to target weights by weighted fair queueing.

Every document of a source stands in a shuffled order; pass e of the source repeats that order. A document's virtual
finish time is the source's words up to and with it, over all passes so far, divided by the source's target. Sources thus
advance in proportion to their targets, and the globally range-sorted queue is cut where its words reach the budget.

Running sums never gather a source in one task: the shuffle key's leading hex digits deal a source to buckets, bucket
totals are added up first, and each bucket sums its own rows. The queue is cut in the same way over ranges of finish
times, in which every source moves at a constant rate, so that the ranges hold about as many words each.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, n_words

WEIGHTS = (1, 2, 3)
MOST = 3
#: rows that one bucket of a running sum is meant to hold
BUCKET_ROWS = 4096


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, rank, source_size, target) from rows (source, size): one row per source, nulls being a source too.

    Sources in code point order, null last, weigh `weights` in turn and share all words; no target exceeds `most` times
    its source, what is cut off being shared again by weight. In order of size per weight the sources cut form a prefix,
    so one ordered pass over the sources settles all rounds, in whole numbers.
    """
    big = "decimal(38,0)"
    lcm = math.lcm(*weights)
    per = sized.groupBy("source").agg(F.sum("size").cast(big).alias("s"))
    per = per.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("w", turn)
    by_size = Window.orderBy((F.col("s") * F.lit(lcm) / F.col("w")).cast(big), "rank")
    upto = by_size.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.withColumn("rest", (F.sum("s").over(everything) - F.lit(most) * (F.sum("s").over(upto) - F.col("s"))).cast(big))
    per = per.withColumn("left_w", (F.sum("w").over(everything) - F.sum("w").over(upto) + F.col("w")).cast("long"))
    per = per.withColumn("cut", (F.col("rest") * F.col("w")).cast(big) > (F.lit(most) * F.col("s") * F.col("left_w")).cast(big))
    per = per.withColumn("i", F.row_number().over(by_size))
    per = per.withColumn("level", F.min(F.when(~F.col("cut"), F.struct("i", "rest", "left_w"))).over(everything))
    level = F.col("level")
    shared = (F.col("w") * level["rest"]).cast("double") / level["left_w"].cast("double")
    target = F.when(level.isNull() | (F.col("i") < level["i"]), (F.lit(most) * F.col("s")).cast("double")).otherwise(shared)
    return per.select("source", "rank", F.col("s").cast("long").alias("source_size"), target.alias("target"))


def _running(df: DataFrame, group: list[str], bucket: Column, order: list, value: str, name: str) -> DataFrame:
    """df with `name`: the sum of `value` up to and with each row, in order of bucket, then order, within group."""
    df = df.withColumn("_bucket", bucket)
    totals = df.groupBy(*group, "_bucket").agg(F.sum(value).alias("_total"))
    over = Window.partitionBy(*group).orderBy("_bucket") if group else Window.orderBy("_bucket")
    before = totals.select(*group, "_bucket", (F.sum("_total").over(over) - F.col("_total")).alias("_before"))
    own = Window.partitionBy(*group, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.join(before, [*group, "_bucket"]).withColumn(name, F.col("_before") + F.sum(value).over(own)).drop("_bucket", "_before")


def queue(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """(sized, taken): every document with its size and its source's target, and the mix in order.

    sized: id_col, th (xxhash64 of the text), size, rank, source_size, target. taken: id_col, th, size, epoch, finish,
    range-sorted by finish. A null text has size 0; documents without words are in no mix; a null source is a source and a
    null id is an id like any other. Rows of the same id and text are documents of their own, with one and the same fate
    where only one of them is taken. Reruns agree.
    """
    small = docs.select(id_col, F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"), F.xxhash64(text_col).alias("th"))
    small = materialize(small, "mixing-sizes")
    n = small.count()
    digits = max(1, math.ceil(math.log(max(n, 1) / BUCKET_ROWS, 16))) if n > BUCKET_ROWS else 1
    targets = materialize(source_targets(small, weights, most), "mixing-targets")
    sized = small.join(targets, small["source"].eqNullSafe(targets["source"])).select(id_col, "th", "size", "rank", "source_size", "target")
    key = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    dealt = sized.where("size > 0").withColumn("_key", key)
    dealt = _running(dealt, ["rank"], F.substring("_key", 1, digits), ["_key", id_col, "size", "th"], "size", "upto")
    epochs = F.sequence(F.lit(0), F.least(F.lit(most - 1), F.floor(F.col("target") / F.col("source_size"))).cast("int"))
    passes = dealt.withColumn("epoch", F.explode(epochs))
    words = F.col("epoch") * F.col("source_size") + F.col("upto")
    passes = passes.withColumn("finish", words.cast("double") / F.col("target")).where((words - F.col("size")).cast("double") < F.col("target"))
    ranges = max(1, n // BUCKET_ROWS)
    cut = _running(passes, [], F.least(F.floor(F.col("finish") * ranges), F.lit(2 * ranges)), ["finish", "rank"], "size", "total")
    budget = small.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    taken = cut.where(F.col("total") <= budget).select(id_col, "th", "size", "epoch", "finish", "rank")
    return sized, taken.repartitionByRange("finish", "rank").sortWithinPartitions("finish", "rank").drop("rank")


def mix(docs: DataFrame, **options) -> DataFrame:
    """One row per document: id_col, th, size, source_size, target, copies (times taken), taken (words, repeats counted)."""
    id_col = options.get("id_col", "doc_id")
    sized, taken = queue(docs, **options)
    copies = taken.groupBy(id_col, "th").agg(F.count("*").alias("_copies"))
    same = Window.partitionBy(id_col, "th").orderBy("size")
    whole = Window.partitionBy(id_col, "th")
    left, right = sized.withColumn("_nth", F.row_number().over(same)).withColumn("_of", F.count("*").over(whole)), copies.withColumnsRenamed({id_col: "_id", "th": "_th"})
    out = left.join(right, left[id_col].eqNullSafe(right["_id"]) & (left["th"] == right["_th"]), "left")
    # the takes of repeated rows are dealt to them evenly, the first ones getting what is left over
    all_copies = F.coalesce("_copies", F.lit(0))
    own = F.floor(all_copies / F.col("_of")) + F.when(F.col("_nth") <= all_copies % F.col("_of"), 1).otherwise(0)
    return out.withColumn("copies", own.cast("long")).select(id_col, "th", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def op6_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "size", "source_size", "target", "taken")


OP6_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), per AS (
  SELECT source, CAST(sum(size) AS HUGEINT) AS s, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rk FROM sized GROUP BY source
), weighed AS (
  SELECT *, 1 + (rk - 1) % 3 AS w FROM per
), ordered AS (
  SELECT *, row_number() OVER (ORDER BY s * 6 // w, rk) AS i,
    (sum(s) OVER ()) - 3 * (sum(s) OVER (ORDER BY s * 6 // w, rk) - s) AS rest,
    (sum(w) OVER ()) - (sum(w) OVER (ORDER BY s * 6 // w, rk)) + w AS left_w
  FROM weighed
), level AS (
  SELECT i, rest, left_w FROM ordered WHERE rest * w <= 3 * s * left_w ORDER BY i LIMIT 1
), targets AS (
  SELECT o.source, o.rk, CAST(o.s AS BIGINT) AS source_size,
    CASE WHEN l.i IS NULL OR o.i < l.i THEN CAST(3 * o.s AS DOUBLE) ELSE CAST(o.w * l.rest AS DOUBLE) / CAST(l.left_w AS DOUBLE) END AS target
  FROM ordered o LEFT JOIN level l ON true
), placed AS (
  SELECT d.doc_id, d.size, t.rk, t.source_size, t.target,
    sum(d.size) OVER (PARTITION BY t.rk ORDER BY md5(CAST(d.doc_id AS VARCHAR)), d.doc_id ROWS UNBOUNDED PRECEDING) AS upto
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), passes AS (
  SELECT doc_id, size, rk, CAST(e * source_size + upto AS DOUBLE) / target AS finish
  FROM placed, range(3) AS p(e) WHERE size > 0 AND CAST(e * source_size + upto - size AS DOUBLE) < target
), cut AS (
  SELECT doc_id, size, sum(size) OVER (ORDER BY finish, rk ROWS UNBOUNDED PRECEDING) AS total FROM passes
), taken AS (
  SELECT doc_id, sum(size) AS words FROM cut WHERE total <= (SELECT sum(size) FROM sized) GROUP BY doc_id
)
SELECT p.doc_id, p.size, p.source_size, p.target, CAST(coalesce(k.words, 0) AS BIGINT) AS taken
FROM placed p LEFT JOIN taken k USING (doc_id)
"""
