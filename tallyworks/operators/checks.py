"""Data tests. Those of a row are conditions that fail()s of one scan can count together; the others give the rows that fail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.groupBy(*columns).count().where("count > 1")


def is_null(column: str) -> Column:
    return F.col(column).isNull()


def not_between(column: str, low, high) -> Column:
    return ~F.col(column).between(low, high)


def out_of_time(column: str, low: str, high: str) -> Column:
    """Before low or not before high."""
    at = lambda s: F.lit(s).cast("timestamp")
    return (F.col(column).cast("timestamp") < at(low)) | (F.col(column).cast("timestamp") >= at(high))


def exceeds(a: str, b: str) -> Column:
    return F.col(a) > F.col(b)


def differs_from(column: str, value) -> Column:
    return ~F.col(column).eqNullSafe(F.lit(value))


def unaccepted(column: str, values: list) -> Column:
    return ~F.col(column).isin(*values)


def list_value_unaccepted(column: str, values: list) -> Column:
    return F.exists(column, lambda x: ~x.isin(*values))


def failing(df: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """One row with the number of rows that fail each test, from one scan; what is null does not fail."""
    return df.agg(*[F.count_if(F.coalesce(t, F.lit(False))).cast("bigint").alias(name) for name, t in tests.items()])


def relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    keys = parent.select(F.col(parent_column).alias("_parent"))
    return df.where(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("_parent"), "left_anti")


def statuses(issues: Column) -> Column:
    """quarantined if an issue is an error, review if one is for review, else valid; issues: array of struct with severity."""
    has = lambda s: F.exists(issues, lambda i: i["severity"] == s)
    return F.when(has("error"), "quarantined").when(has("review"), "review").otherwise("valid")


def flags(issues: Column, duplicates: Column | None = None) -> Column:
    """Rule names, duplicate flags first, each once, in the order in which they came."""
    names = F.transform(issues, lambda i: i["rule"])
    return F.array_distinct(F.concat(F.array_compact(duplicates), names) if duplicates is not None else names)
