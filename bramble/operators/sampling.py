"""Deterministic and random splits and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BUCKETS = 1 << 20


def unit_hash(*keys: str | Column, seed: int = 0) -> Column:
    """A value in [0, 1) fixed by the row's key, so retried tasks agree."""
    return F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(_BUCKETS)) / float(_BUCKETS)


def unit_digest(*keys: str | Column, seed: int = 0) -> Column:
    """A value in [0, 1) from the MD5 of seed and key, which any database can restate."""
    head = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") if isinstance(k, str)
                                                                 else k.cast("string") for k in keys])), 1, 8)
    return F.conv(head, 16, 10).cast("double") / float(1 << 32)


def split_by_key(df: DataFrame, key: str | Column, train: float = 0.8,
                 seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Train and test rows chosen by the hash of a key; repeatable at any partitioning."""
    u = unit_hash(key, seed=seed)
    return df.where(u < train), df.where(u >= train)


def split_random(df: DataFrame, weights: Sequence[float], seed: int | None = None) -> list[DataFrame]:
    return df.randomSplit(list(weights), seed)


def sample_fraction(df: DataFrame, wanted: int, seed: int = 0) -> DataFrame:
    """Bernoulli sample of about ``wanted`` rows; the fraction is clamped to 1."""
    total = df.count()
    return df.sample(withReplacement=False, fraction=min(1.0, wanted / max(1, total)), seed=seed)


def digest_samples(df: DataFrame, key: str, sizes: Sequence[int], seed: int = 0) -> DataFrame:
    """Several samples in one pass: a copy of a row for every ``sample_size`` it falls into; sizes hold on average.

    A row's membership follows from its key alone, so retried tasks and later runs agree. Sizes above
    the table's take every row.
    """
    total = df.agg(F.count("*")).scalar()
    drawn = unit_digest("sample_size", key, seed=seed)
    return df.withColumn("sample_size", F.explode(F.array(*[F.lit(int(s)) for s in sizes]))) \
        .where(drawn * total < F.col("sample_size"))
