"""Entity matching by a ladder of equi-joins that never guesses.

Each rung looks the rows up in a table with one row per key: the count of candidates and the smallest of them. So neither a
common key nor the number of rungs multiplies rows, and the output has exactly the input's rows. The first rung with exactly one candidate matches. Where rungs find several candidates and none finds one, the row is
ambiguous.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rung:
    name: str
    keys: list[str]
    when: Column | None = None
    #: several candidates here end the search as ambiguous
    stop_if_many: bool = False


def ladder(rows: DataFrame, known: DataFrame, row_id: str, known_id: str, rungs: list[Rung]) -> DataFrame:
    """rows with status (matched, ambiguous, unmatched), method and matched_id. Null keys match nothing; row_id names the rows and
    need not be unique."""
    out = rows
    for i, rung in enumerate(rungs):
        counts = known.where(reduce(and_, [F.col(k).isNotNull() for k in rung.keys])).groupBy(*[F.col(k).alias(f"_k{i}_{k}") for k in rung.keys])
        counts = counts.agg(F.count_distinct(known_id).alias(f"_n{i}"), F.min(known_id).alias(f"_id{i}"))
        same = reduce(and_, [F.col(k) == F.col(f"_k{i}_{k}") for k in rung.keys])
        out = out.join(counts, same if rung.when is None else same & rung.when, "left")
    method, matched, blocked = F.lit(None).cast("string"), F.lit(None), F.lit(False)
    most = F.lit(0).cast("bigint")
    for i, rung in enumerate(rungs):
        one = (F.coalesce(F.col(f"_n{i}"), F.lit(0)) == 1) & method.isNull() & ~blocked
        matched = F.when(one, F.col(f"_id{i}")).otherwise(matched)
        method = F.when(one, rung.name).otherwise(method)
        if rung.stop_if_many:
            blocked = blocked | (F.coalesce(F.col(f"_n{i}"), F.lit(0)) > 1)
        most = F.greatest(most, F.coalesce(F.col(f"_n{i}"), F.lit(0)))
    status = F.when(method.isNotNull(), "matched").when(most > 1, "ambiguous").otherwise("unmatched")
    return out.select(*rows.columns, status.alias("status"), method.alias("method"), matched.alias("matched_id"))


def demote_shared(rows: DataFrame, key: str, complete: str) -> DataFrame:
    """A match whose complete business key other rows share becomes ambiguous."""
    from pyspark.sql.window import Window

    many = (F.count("*").over(Window.partitionBy(key, complete)) > 1) & F.col(complete)
    down = many & (F.col("status") == "matched")
    return rows.withColumns({"status": F.when(down, "ambiguous").otherwise(F.col("status")), "matched_id": F.when(~down, F.col("matched_id"))})
