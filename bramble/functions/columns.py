"""Small column helpers shared by plans and operators."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def r6(c: str | Column) -> Column:
    return F.round(col(c).cast("double"), 6)


def big(c: str | Column) -> Column:
    return col(c).cast("bigint")


def as_array(df: DataFrame, features: str) -> Column:
    """A vector or numeric array column as ``array<double>``."""
    kind = df.schema[features].dataType
    if isinstance(kind, T.ArrayType):
        return F.col(features).cast("array<double>")
    # the conversion itself rejects nulls
    return F.when(F.col(features).isNotNull(), vector_to_array(F.col(features)))


def as_vector(c: str | Column) -> Column:
    """A numeric array column as a dense ML vector."""
    return array_to_vector(col(c).cast("array<double>"))


def with_slots(df: DataFrame, features: str, *keep: str, pos: str = "pos",
               value: str = "value") -> DataFrame:
    """One row per vector slot: ``(keep..., pos, value)``.

    The outer form keeps Spark from deriving a non-empty filter, which would convert twice.
    """
    return df.select(*keep, F.posexplode_outer(as_array(df, features)).alias(pos, value)) \
        .where(F.col(pos).isNotNull()).withColumn(pos, F.col(pos).cast("bigint"))


def exploded(df: DataFrame, items: str, out: str, *keep: str) -> DataFrame:
    """One row per array element; see ``with_slots`` for the outer form."""
    return df.select(*keep, F.explode_outer(items).alias(out)).where(F.col(out).isNotNull())


def sparse_entries(df: DataFrame, features: str, *keep: str) -> DataFrame:
    """Active entries of a sparse vector column as ``(keep..., idx, value)``, without densifying."""
    raw = F.unwrap_udt(F.col(features))
    return df.select(*keep, F.explode(F.arrays_zip(raw["indices"].alias("idx"),
                                                   raw["values"].alias("value"))).alias("_e")) \
        .select(*keep, F.col("_e.idx").alias("idx"), F.col("_e.value").alias("value"))


def dot(a: str | Column, b: str | Column) -> Column:
    """Inner product of two numeric arrays."""
    return F.aggregate(F.zip_with(col(a), col(b), lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def distance(a: str | Column, b: str | Column) -> Column:
    """Euclidean distance of two numeric arrays."""
    return F.sqrt(F.aggregate(F.zip_with(col(a), col(b), lambda x, y: (x - y) * (x - y)),
                              F.lit(0.0), lambda s, v: s + v))
