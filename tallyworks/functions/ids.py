"""Hashes and keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def payload_hash(df: DataFrame, columns: list[str] | None = None) -> Column:
    """SHA-256 of the row as JSON with sorted keys and nulls kept: equal rows, equal hashes."""
    return F.sha2(F.to_json(F.struct(*sorted(columns or df.columns)), {"ignoreNullFields": "false"}), 256)


def stable_id(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", *parts), 256)


def business_key(*parts: Column) -> Column:
    """struct(key, complete): unknown parts are spelt out."""
    complete = F.lit(True)
    for p in parts:
        complete = complete & p.isNotNull()
    return F.struct(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("<unknown>")) for p in parts]).alias("key"), complete.alias("complete"))


def least_by_length(x: Column) -> Column:
    """Aggregate: the shortest text, of equally long ones the smallest."""
    return F.min(F.struct(F.length(x).alias("n"), x.alias("id")))["id"]


def table_checksum(df: DataFrame) -> Column:
    """Aggregate: independent of row order. The sum of 60 bits of each row's MD5, of its values as text in the order of column names."""
    row = F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("<null>")) for c in sorted(df.columns)])
    return F.sum(F.conv(F.substring(F.md5(row), 1, 15), 16, 10).cast("decimal(38,0)"))
