"""Registry of named plans: the Spark query beside an independent SQL statement of its result."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


class Tables:
    """Lazy access to the parquet tables of one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")


@dataclass(frozen=True)
class Plan:
    name: str
    covers: tuple[str, ...]
    build: Callable[[Tables], DataFrame]
    oracle: str | None

    def __call__(self, spark: SparkSession, root: str) -> DataFrame:
        return self.build(Tables(spark, root))


PLANS: dict[str, Plan] = {}


def plan(covers: str, oracle: str | None = None, name: str | None = None):
    """Register a plan; ``covers`` lists the inventory ids it answers for."""

    def register(build: Callable[[Tables], DataFrame]):
        key = name or build.__name__
        if key in PLANS:
            raise ValueError(f"plan {key} registered twice")
        PLANS[key] = Plan(key, tuple(covers.split()), build, oracle)
        return build

    return register


def r6(expr: str) -> str:
    """SQL text for a double rounded to six digits, without negative zero."""
    return f"(round({expr}, 6) + 0.0::DOUBLE)"
