"""CSV and LIBSVM readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, *, header: bool = False,
             schema: StructType | str | None = None, infer: bool = False, sep: str = ",",
             encoding: str = "UTF-8", sampling_ratio: float = 1.0) -> DataFrame:
    """CSV with a declared schema, inferred types, or (neither given) all-string columns.

    Inference reads the input once more; on large inputs declare a schema or lower
    ``sampling_ratio``.
    """
    reader = spark.read.option("header", header).option("sep", sep).option("encoding", encoding)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True).option("samplingRatio", sampling_ratio)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, *, header: bool = True, sep: str = ",",
              encoding: str = "UTF-8", single_file: bool = False, mode: str = "errorifexists") -> None:
    """Parallel CSV output; ``single_file`` funnels everything through one task, for small results."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", header).option("sep", sep) \
        .option("encoding", encoding).csv(path)


def read_libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    """``(label, features)``; giving the width avoids a scan to find it."""
    reader = spark.read.format("libsvm")
    if num_features is not None:
        reader = reader.option("numFeatures", num_features)
    return reader.load(path)


def write_libsvm(df: DataFrame, path: str, label: str = "label", features: str = "features") -> None:
    df.selectExpr(f"cast({label} as double) as label", f"{features} as features") \
        .write.format("libsvm").save(path)
