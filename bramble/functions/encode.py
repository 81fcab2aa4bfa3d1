"""Category, band and flag expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flag(condition: Column | str) -> Column:
    """1 where a boolean (or SQL text) holds, else 0."""
    return F.when(F.expr(condition) if isinstance(condition, str) else condition, 1).otherwise(0)


def band(value: Column, limits: Sequence[tuple[float, object]], otherwise: object) -> Column:
    """First class whose lower limit the value exceeds, limits in descending order."""
    out: Column | None = None
    for limit, name in limits:
        test = value > limit
        out = F.when(test, F.lit(name)) if out is None else out.when(test, F.lit(name))
    return out.otherwise(F.lit(otherwise))


def first_containing(text: Column, needles: Sequence[str], otherwise: str) -> Column:
    """First of the ordered substrings that occurs. List a longer form before its prefix."""
    out: Column | None = None
    for needle in needles:
        test = F.contains(text, F.lit(needle))
        out = F.when(test, F.lit(needle)) if out is None else out.when(test, F.lit(needle))
    return out.otherwise(F.lit(otherwise))


def dictionary(df: DataFrame, column: str, index: str = "index") -> DataFrame:
    """Distinct values numbered from 0 in alphabetical order, range by range, however many there are."""
    from bramble.operators.ranking import number_rows
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    return number_rows(values, column, index)


def lookup(df: DataFrame, table: DataFrame, on: str | Sequence[str], *, how: str = "inner",
           max_rows: int = 100_000) -> DataFrame:
    """Join to a lookup table, broadcast only if it holds at most ``max_rows`` rows."""
    small = table.limit(max_rows + 1).count() <= max_rows
    return df.join(F.broadcast(table) if small else table, on, how)


def one_hot(df: DataFrame, column: str, values: Sequence[str], prefix: str) -> DataFrame:
    """One 0/1 column per known value, no category dropped."""
    return df.select("*", *[F.when(F.col(column) == v, 1.0).otherwise(0.0).alias(f"{prefix}{i}")
                            for i, v in enumerate(values)])
