"""Moments, correlations, contingency tests and label checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import ChiSquareTest, Correlation, Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bramble.functions.columns import with_slots
from bramble.functions.encode import lookup
from bramble.operators.ranking import average_ranks_of
from bramble.session import materialise


def assemble(df: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=out).transform(df)


def moments(df: DataFrame, features: str = "features", weight: str | None = None) -> DataFrame:
    """Mean and sample variance per slot: ``(pos, mean, variance)``."""
    metric = Summarizer.metrics("mean", "variance")
    s = df.select(metric.summary(F.col(features), F.col(weight)) if weight
                  else metric.summary(F.col(features)))
    s = s.toDF("s").select("s.mean", "s.variance")
    return with_slots(s, "mean", value="mean").join(
        with_slots(s, "variance", value="variance"), "pos")


def correlations(df: DataFrame, columns: Sequence[str], method: str = "pearson") -> DataFrame:
    """Correlation matrix as rows ``(i, j, corr)``; its size is the square of the column count.

    Rows with a missing value are left out. Rank correlation replaces every column by its average
    ranks first. Ranks are found on the distinct values of a column and looked up, by broadcast where
    the values are few, so rows are never sorted as a whole.
    """
    rows = df.select(*columns).na.drop()
    if method == "spearman":
        rows = rows.select(*[F.col(c).cast("double").alias(c) for c in columns])
        ranks = materialise(average_ranks_of(rows, columns, "_rank"), "ranks")
        for slot, c in enumerate(columns):
            own = ranks.where(F.col("slot") == slot).select(F.col("value").alias(c), "_rank")
            rows = lookup(rows, own, c).withColumn(c, F.col("_rank")).drop("_rank")
    elif method != "pearson":
        raise ValueError(f"unknown method {method}")
    rows = assemble(rows.select(*columns), columns, "_features")
    matrix = Correlation.corr(rows, "_features").first()[0].toArray()
    values = [(i, j, float(matrix[i, j])) for i in range(len(matrix)) for j in range(len(matrix))]
    return df.sparkSession.createDataFrame(values, "i bigint, j bigint, corr double")


def independence(df: DataFrame, features: str = "features", label: str = "label") -> DataFrame:
    """Chi-square test of every slot against the label: ``(pos, statistic, dof, p_value)``."""
    out = ChiSquareTest.test(df, features, label, flatten=True)
    return out.select(F.col("featureIndex").cast("bigint").alias("pos"), "statistic",
                      F.col("degreesOfFreedom").cast("bigint").alias("dof"),
                      F.col("pValue").alias("p_value"))


def label_histogram(df: DataFrame, label: str = "label") -> DataFrame:
    """Counts per class label and the number of rows whose label is no class index."""
    valid = (F.col(label) >= 0) & (F.col(label) == F.floor(label))
    return df.groupBy(F.when(valid, F.col(label).cast("bigint")).alias("label")) \
        .agg(F.count("*").alias("n"))


def class_count(df: DataFrame, label: str = "label") -> int:
    """Number of classes; fails on null, negative or fractional labels."""
    valid = (F.col(label) >= 0) & (F.col(label) == F.floor(label))
    r = df.agg(F.sum(F.when(F.coalesce(valid, F.lit(False)), 0).otherwise(1)).alias("bad"),
               F.max(label).alias("top")).first()
    if r.bad:
        raise ValueError(f"{r.bad} rows have a label that is not 0, 1, 2, ...")
    return int(r.top) + 1 if r.top is not None else 0
