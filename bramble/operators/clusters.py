"""Nearest-centre assignment and centre updates for given centres."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bramble.functions.columns import as_array, distance


def centres_of(df: DataFrame, features: str, cluster: str) -> DataFrame:
    """Mean vector per cluster: ``(cluster, centre, n)``."""
    rows = df.select(F.col(cluster).alias("cluster"), array_to_vector(as_array(df, features)).alias("v"))
    return rows.groupBy("cluster").agg(vector_to_array(Summarizer.mean(F.col("v"))).alias("centre"),
                                       F.count("*").alias("n"))


def assign(df: DataFrame, centres: DataFrame, features: str = "features") -> DataFrame:
    """Add ``cluster`` and ``dist`` of the nearest centre (the smallest cluster id on ties).

    The k centres travel as one array inside the plan; rows are not joined or shuffled.
    """
    table = centres.agg(F.collect_list(F.struct("cluster", "centre"))).scalar()
    rows = df.withColumn("_x", as_array(df, features)).withColumn("_centres", table)
    near = F.array_min(F.transform(
        "_centres", lambda c: F.struct(distance(F.col("_x"), c["centre"]).alias("dist"),
                                       c["cluster"].alias("cluster"))))
    return rows.withColumn("_near", near) \
        .select(*df.columns, F.col("_near.cluster").alias("cluster"), F.col("_near.dist").alias("dist"))
