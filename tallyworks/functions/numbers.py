"""Numbers as people write them, as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import once, trim_text


def parse_decimal(x: Column, precision: int = 18, scale: int = 6) -> Column:
    """1.234,56, 1.234 and 3,5 (German), 12.5 and -7 (plain); anything else null. Points before three digits each group thousands."""

    def plain(t: Column) -> Column:
        grouped = t.rlike(r"^\d{1,3}(\.\d{3})+(,\d+)?$")
        return F.replace(F.when(grouped, F.replace(t, F.lit("."), F.lit(""))).otherwise(t), F.lit(","), F.lit("."))

    read = once(F.replace(trim_text(x), F.lit(" "), F.lit("")), lambda t: once(plain(t), lambda p: F.when(p.rlike(r"^-?\d+(\.\d+)?$"), p)))
    return read.try_cast(f"decimal({precision},{scale})")


def money(x: Column) -> Column:
    """DECIMAL(12,2), half up; what does not fit is null."""
    v = F.round(parse_decimal(x, 30, 10), 2)
    return F.when(F.abs(v) < 10**10, v).try_cast("decimal(12,2)")


def whole_number(x: Column) -> Column:
    """An INTEGER if the value is whole and fits."""
    v = parse_decimal(x, 30, 10)
    return F.when((v == F.floor(v)) & (F.abs(v) <= 2**31 - 1), v).try_cast("int")


def parse_answer(x: Column) -> Column:
    """struct(score, scale, kind) of "4" (kind number), "7/10" (kind ratio, scale 10), a missing answer, or other text."""
    ratio = r"^(-?\d+(?:[.,]\d+)?)\s*/\s*(\d+(?:[.,]\d+)?)$"

    def read(t: Column) -> Column:
        part = lambda i: F.regexp_extract(t, ratio, i)
        split = t.rlike(ratio)
        return F.struct(t.alias("t"), split.alias("split"), parse_decimal(F.when(split, part(1)).otherwise(t)).alias("score"), F.when(split, part(2)).alias("bottom"))

    return once(once(trim_text(x), read), _answer)


def _answer(a: Column) -> Column:
    kind = F.when(a["t"].isNull(), "missing").when(a["split"], "ratio").when(a["score"].isNotNull(), "number").otherwise("text")
    score, bottom = a["score"], a["bottom"]
    return F.struct(F.round(score, 2).try_cast("decimal(5,2)").alias("score"), parse_decimal(bottom, 18, 3).alias("scale"), kind.alias("kind"))


def nps_group(score: Column) -> Column:
    return F.when(score >= 9, "promoter").when(score >= 7, "passive").when(score.isNotNull(), "detractor")


def share(n: Column, of: Column) -> Column:
    """n / of as a double; null where of is zero."""
    return F.when(of != 0, n.cast("double") / of.cast("double"))
