"""Relational operators that the models and the standalone queries share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def dedupe_latest(df: DataFrame, keys: list[str], order: list[Column], dealt: tuple[str, ...] = ()) -> DataFrame:
    """The first row of each key by `order`, which must end in a total order. Rows with a null in the key all stay: they are
    united back, so that no global ordinal has to tell them apart. dealt: columns that follow from the key, by which the rows have been dealt out; they are not again."""
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    w = Window.partitionBy(*dealt, *keys).orderBy(*order)
    first = df.where(whole).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
    return first.unionByName(df.where(~whole))


def zero_filled(dim: DataFrame, counts: DataFrame, keys: list[str]) -> DataFrame:
    """dim left join counts, missing counts 0."""
    names = [c for c in counts.columns if c not in keys]
    return dim.join(counts, keys, "left").withColumns({c: F.coalesce(c, F.lit(0).cast("bigint")) for c in names})


def with_total(df: DataFrame, key: str, aggs: list[Column], label: str = "ALL") -> DataFrame:
    """Groups and their grand total, by rollup; the total is known by grouping(), so that a null key stays a group."""
    out = df.rollup(key).agg(F.grouping(key).cast("int").alias("is_total"), *aggs)
    return out.withColumn(key, F.when(F.col("is_total") == 1, label).otherwise(F.col(key)))


def hash_pick(df: DataFrame, key: str, count: int, offset: int = 0) -> DataFrame:
    """`count` rows after `offset` in the order of the key's MD5 as text, then the key: the same rows on every run, unrelated to what
    they hold. A null key hashes as an empty text and comes first among equals. Spark keeps offset + count rows a task."""
    return df.orderBy(F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.col(key).asc_nulls_first()).offset(offset).limit(count)


def top_groups(df: DataFrame, size: Column, least: int, order: list[Column], k: int) -> DataFrame:
    return df.where(size >= least).orderBy(*order).limit(k)


def merge_by_key(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Delete and insert: rows of the target whose key is in the batch give way to the batch's."""
    return target.join(batch.select(*keys).distinct(), keys, "left_anti").unionByName(batch)


def merge_newest(target: DataFrame, batch: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The newest version of each key over target and batch together, whatever the order in which they came."""
    return dedupe_latest(target.unionByName(batch), keys, order)


def replace_children(target: DataFrame, batch: DataFrame, parents: DataFrame, parent_key: str) -> DataFrame:
    """Children of every parent in the batch are replaced, also of parents that now have none."""
    return target.join(parents.select(parent_key).distinct(), parent_key, "left_anti").unionByName(batch)


def beyond_watermark(rows: DataFrame, stored: DataFrame, column: str, mark) -> DataFrame:
    """Rows at or after the mark, without those at the mark that are stored already with equal content."""
    fresh = rows.where(F.col(column) >= F.lit(mark))
    both = reduce(lambda a, b: a & b, [fresh[c].eqNullSafe(stored[c]) for c in rows.columns])
    return fresh.join(stored.where(F.col(column) == F.lit(mark)), both, "left_anti")


def key_differences(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys in one frame only, tagged by side."""
    left, right = a.select(*keys), b.select(*keys)
    return left.subtract(right).withColumn("side", F.lit("left")).unionByName(right.subtract(left).withColumn("side", F.lit("right")))


def flag_present(df: DataFrame, keys: DataFrame, on: dict[str, str], name: str) -> DataFrame:
    """A boolean for whether the row's key is among keys; no row goes or multiplies."""
    there = keys.select(*[F.col(k).alias(f"_{k}") for k in on.values()]).distinct().withColumn("_there", F.lit(True))
    cond = reduce(lambda a, b: a & b, [df[c] == there[f"_{k}"] for c, k in on.items()])
    return df.join(there, cond, "left").withColumn(name, F.coalesce("_there", F.lit(False))).drop("_there", *[f"_{k}" for k in on.values()])


def owner_conflicts(df: DataFrame, group: list[str], keep: Column, owner: str) -> DataFrame:
    """One row per group: rows that count, the least and greatest owner among them, and whether they differ."""
    mine = F.when(keep, F.col(owner))
    out = df.groupBy(*group).agg(F.count_if(keep).alias("claim_count"), F.min(mine).alias("owner_min"), F.max(mine).alias("owner_max"))
    return out.withColumn("has_conflict", F.coalesce(F.col("owner_min") != F.col("owner_max"), F.lit(False)))


def progress(df: DataFrame, start: str, end: str, as_of: Column, active: Column) -> DataFrame:
    """Elapsed share of a planned span, exact to six digits, with the reason where it has none."""
    planned, elapsed = F.datediff(end, start).cast("bigint"), F.datediff(as_of, start).cast("bigint")
    flag = F.when(~active, "not_active").when(F.col(start).isNull() | F.col(end).isNull(), "missing_dates").when(planned <= 0, "non_positive_planned_duration").when(as_of < F.col(start), "cohort_not_started").when(as_of > F.col(end), "past_planned_end").otherwise("ok")
    ratio = F.least(F.greatest(elapsed.cast("double") / planned.cast("double"), F.lit(0.0)), F.lit(1.0))
    time = F.when(active & (planned > 0), F.when(planned > 0, ratio)).cast("decimal(9,6)")
    return df.withColumns({"planned_days": planned, "elapsed_days": elapsed, "time_share": time, "time_flag": flag})
