"""Recommendation by matrix factorisation for ids of any type, and its half-step as an aggregation."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bramble.functions.columns import as_array
from bramble.operators.ranking import number_rows
from bramble.session import ensure_checkpoint_dir, materialise


#: ratings that one task of a factorisation holds and sorts
BLOCK_RATINGS = 5_000_000


def blocks(ratings: DataFrame) -> dict:
    """Settings by which no task of ``ALS`` holds more than about ``BLOCK_RATINGS`` ratings; few ratings keep Spark's own.

    The ratings are counted, so they should be written. More blocks send a factor to more tasks, so
    what an iteration has shuffled is deleted once the factors after it are written.
    """
    number = math.ceil(ratings.count() / BLOCK_RATINGS)
    if number <= 1:
        return {}
    ensure_checkpoint_dir(ratings.sparkSession)
    least = ALS().getNumUserBlocks()
    return dict(numUserBlocks=max(least, number), numItemBlocks=max(least, number), checkpointInterval=1)


def dense_ids(df: DataFrame, column: str, out: str) -> DataFrame:
    """Written ``column, out``: the distinct ids numbered from 0, range by range, as 32-bit numbers."""
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    return materialise(number_rows(values, column, out).withColumn(out, F.col(out).cast("int")), "ids")


def factorise(ratings: DataFrame, *, user: str = "user", item: str = "item", rating: str = "rating",
              **params) -> tuple[DataFrame, DataFrame]:
    """Factor tables ``user, features`` and ``item, features`` of ratings with ids of any type.

    The solver wants 32-bit numbers, so ids are numbered first and looked up again in the result.
    Rows without an id are left out.
    """
    users, items = dense_ids(ratings, user, "_u"), dense_ids(ratings, item, "_i")
    rows = ratings.join(users, user).join(items, item).select("_u", "_i", F.col(rating).cast("float").alias("_r"))
    rows = materialise(rows, "ratings")
    model = ALS(userCol="_u", itemCol="_i", ratingCol="_r", **{**blocks(rows), **params}).fit(rows)
    return (model.userFactors.withColumnRenamed("id", "_u").join(users, "_u").select(user, "features"),
            model.itemFactors.withColumnRenamed("id", "_i").join(items, "_i").select(item, "features"))


def half_step(ratings: DataFrame, factors: DataFrame, reg: float, *, solve_for: str = "user", given: str = "item",
              rating: str = "rating", features: str = "features") -> DataFrame:
    """``solve_for, features``: the least-squares factors of one side for given factors of the other.

    One aggregation per id adds up the normal equations, the sums of y y' and of r y; the penalty is
    ``reg`` times the id's number of ratings. Ratings without factors are left out. A popular id's
    sums are combined in every task before they meet.
    """
    y = factors.select(given, as_array(factors, features).alias("_y"))
    rank = y.select(F.max(F.size("_y"))).first()[0] or 0
    rows = ratings.select(solve_for, given, F.col(rating).cast("double").alias("_r")).join(y, given)
    cells = [(a, b) for a in range(rank) for b in range(a, rank)]
    slot = F.col("_y")
    sums = rows.groupBy(solve_for).agg(
        F.count("*").alias("_n"), F.array(*[F.sum(slot[a] * slot[b]) for a, b in cells]).alias("_yy"),
        F.array(*[F.sum(F.col("_r") * slot[a]) for a in range(rank)]).alias("_ry"))
    kind = ratings.schema[solve_for].dataType.simpleString()

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for n, yy, ry in zip(batch["_n"], batch["_yy"], batch["_ry"]):
                left = np.zeros((rank, rank))
                for (a, b), v in zip(cells, yy):
                    left[a, b] = left[b, a] = v
                found.append(np.linalg.lstsq(left + reg * n * np.eye(rank), np.asarray(ry, float), rcond=None)[0].tolist())
            yield pd.DataFrame({solve_for: batch[solve_for], "features": found})

    return sums.mapInPandas(solve, f"`{solve_for}` {kind}, features array<double>")
