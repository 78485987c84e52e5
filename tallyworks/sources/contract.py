"""Table contracts: one specification gives the select, the check of types and the check of values that must be there."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class SchemaViolation(ValueError):
    """A frame is not what its contract says."""


class Contract:
    """Columns by name: a type as in DDL, with ! after it where a value must be there, and optionally the expression it is read from."""

    def __init__(self, columns: dict[str, str | tuple[str, Column]], open: bool = False):
        """open: other columns may be there too, as they are."""
        self.open = open
        of = {name: x if isinstance(x, tuple) else (x, None) for name, x in columns.items()}
        self.types = {name: kind.rstrip("!") for name, (kind, _) in of.items()}
        self.required = tuple(name for name, (kind, _) in of.items() if kind.endswith("!"))
        self.read = {name: F.col(name) if x is None else x for name, (_, x) in of.items()}

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(", ".join(f"`{n}` {t}{' NOT NULL' * (n in self.required)}" for n, t in self.types.items()))

    def select(self, df: DataFrame) -> DataFrame:
        """The contract's columns from df, each of its type; a column that an expression lacks raises, and so does a type that needs a cast."""
        return self.enforce(df.select(*[x.alias(n) for n, x in self.read.items()]))

    def enforce(self, df: DataFrame) -> DataFrame:
        """df in the contract's order, or SchemaViolation for columns too many or too few, and for other types."""
        want = {f.name: f.dataType.simpleString() for f in self.schema}
        got = {f.name: f.dataType.simpleString() for f in df.schema}
        wrong = [f"{n} is {got[n]}, not {t}" for n, t in want.items() if n in got and got[n] != t]
        extra = set() if self.open else got.keys() - want.keys()
        if want.keys() - got.keys() or extra or wrong or len(df.columns) != len(got):
            raise SchemaViolation(f"missing {sorted(want.keys() - got.keys())}, unexpected {sorted(extra)}, {wrong}")
        return df if self.open else df.select(*want)

    def check_values(self, df: DataFrame) -> None:
        """One aggregate over the required columns; a null in one raises."""
        if not self.required:
            return
        nulls = df.agg(*[F.count_if(F.col(n).isNull()).alias(n) for n in self.required]).first().asDict()
        if found := {n: k for n, k in nulls.items() if k}:
            raise SchemaViolation(f"rows without a value: {found}")


def row_is_whole(columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
