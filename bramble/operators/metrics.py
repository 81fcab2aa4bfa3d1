"""Evaluation measures as aggregations over a prediction table.

Tables hold ``label`` and ``prediction`` (and ``score`` for threshold measures). Everything is
reduced to a confusion table or to one row per distinct score before anything is ordered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bramble.functions.columns import as_array, dot
from bramble.operators.ranking import running_totals


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")) \
        .agg(F.count("*").alias("n"))


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    hit = F.when(F.col(label) == F.col(prediction), 1.0).otherwise(0.0)
    return df.agg(F.count("*").alias("n"), F.avg(hit).alias("accuracy"),
                  (1 - F.avg(hit)).alias("error_rate"))


def label_rates(df: DataFrame, label: str = "label", prediction: str = "prediction",
                beta: float = 1.0) -> DataFrame:
    """Per label: support, true/false positive rate, precision, recall and F-measure."""
    cells = confusion(df, label, prediction)
    sides = cells.select(F.explode(F.array(
        F.struct(F.col("label").alias("label"), F.col("n").alias("actual"),
                 F.lit(0).cast("bigint").alias("predicted"),
                 F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col("prediction").alias("label"), F.lit(0).cast("bigint").alias("actual"),
                 F.col("n").alias("predicted"), F.lit(0).cast("bigint").alias("hit")))).alias("s"))
    per = sides.groupBy(F.col("s.label").alias("label")).agg(
        F.sum("s.actual").alias("support"), F.sum("s.predicted").alias("predicted"),
        F.sum("s.hit").alias("hit"))
    total = cells.agg(F.sum("n")).scalar()
    b2 = beta * beta
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    per = per.withColumn("total", total)
    return per.select(
        "label", "support", "total",
        ratio(F.col("hit"), F.col("support")).alias("tpr"),
        ratio(F.col("predicted") - F.col("hit"), F.col("total") - F.col("support")).alias("fpr"),
        ratio(F.col("hit"), F.col("predicted")).alias("precision"),
        ratio(F.col("hit"), F.col("support")).alias("recall"),
        ratio((1 + b2) * F.col("hit"), b2 * F.col("support") + F.col("predicted")).alias("f"))


def weighted_rates(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Label rates averaged with the label frequencies as weights."""
    share = F.col("support") / F.col("total")
    return label_rates(df, label, prediction).agg(
        *[F.sum(share * F.col(m)).alias(f"weighted_{m}")
          for m in ("tpr", "fpr", "precision", "recall", "f")])


def score_steps(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One row per distinct score, highest first, with cumulative positives and negatives."""
    steps = df.groupBy(F.col(score).alias("threshold")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).alias("neg"))
    return running_totals(steps, "threshold", ["pos", "neg"], descending=True)


def _total(steps: DataFrame, name: str):
    return steps.agg(F.max(f"cum_{name}")).scalar()


def roc_points(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    steps = score_steps(df, label, score)
    return steps.select("threshold", F.try_divide("cum_neg", _total(steps, "neg")).alias("fpr"),
                        F.try_divide("cum_pos", _total(steps, "pos")).alias("tpr"))


def area_under_roc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Probability that a positive outranks a negative, ties counting one half."""
    steps = score_steps(df, label, score)
    pos, neg = F.sum("pos").cast("double"), F.sum("neg").cast("double")
    pairs = F.sum(F.col("neg").cast("double") * (F.col("cum_pos") - F.col("pos") * 0.5))
    return steps.agg(F.try_divide(pairs, pos * neg).alias("auc"))


def area_under_roc_hard(df: DataFrame, label: str = "label",
                        prediction: str = "prediction") -> DataFrame:
    """Area under the one-step curve of 0/1 predictions."""
    is_pos, hit = F.col(label) == 1, F.col(label) == F.col(prediction)
    rate = lambda c: F.avg(F.when(c, hit.cast("double")))
    return df.agg(((rate(is_pos) + rate(~is_pos)) / 2).alias("auc"))


def f_by_threshold(df: DataFrame, label: str = "label", score: str = "score",
                   beta: float = 1.0) -> DataFrame:
    steps = score_steps(df, label, score)
    b2 = beta * beta
    flagged = F.col("cum_pos") + F.col("cum_neg")
    return steps.select(
        "threshold", ((1 + b2) * F.col("cum_pos") / (b2 * _total(steps, "pos") + flagged)).alias("f"))


def best_threshold(curve: DataFrame) -> DataFrame:
    """The threshold of largest F, the smaller threshold on ties."""
    best = F.max_by("threshold", F.struct("f", -F.col("threshold")))
    return curve.agg(best.alias("threshold"), F.max("f").alias("f"))


def regression_errors(df: DataFrame, label: str = "label",
                      prediction: str = "prediction") -> DataFrame:
    e = F.col(label) - F.col(prediction)
    return df.agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(e * e).alias("mse"),
                  F.avg(F.abs(e)).alias("mae"),
                  (1 - F.try_divide(F.avg(e * e), F.var_pop(label))).alias("r2"))


def residuals(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.withColumn("residual", F.col(label) - F.col(prediction))


def silhouette(df: DataFrame, features: str = "features", cluster: str = "prediction") -> DataFrame:
    """Mean silhouette with squared Euclidean distance, from per-cluster sums.

    The mean squared distance of a point to a cluster needs only the cluster's size, mean and mean
    squared norm, so points meet the k cluster summaries and never each other. A cluster of one
    point counts as zero.
    """
    points = df.select(F.col(cluster).alias("own"), as_array(df, features).alias("x"))
    points = points.withColumn("x2", dot("x", "x"))
    means = points.select("own", F.posexplode("x").alias("pos", "v")) \
        .groupBy("own", "pos").agg(F.avg("v").alias("m")) \
        .groupBy("own").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))),
                                        lambda s: s["m"]).alias("c"))
    sizes = points.groupBy("own").agg(F.count("*").alias("n"), F.avg("x2").alias("q"))
    groups = sizes.join(means, "own").agg(F.collect_list(F.struct("own", "n", "q", "c"))).scalar()
    mean_gap = lambda g: F.struct(
        g["own"].alias("g"), g["n"].alias("n"),
        (F.col("x2") + g["q"] - 2 * dot(F.col("x"), g["c"])).alias("d"))
    gaps = points.withColumn("groups", groups).select("own", F.transform("groups", mean_gap).alias("gaps"))
    mine = F.filter("gaps", lambda g: g["g"] == F.col("own"))[0]
    other = F.array_min(F.transform(F.filter("gaps", lambda g: g["g"] != F.col("own")),
                                    lambda g: g["d"]))
    near = gaps.select(mine["n"].alias("n"), other.alias("b"),
                       (mine["d"] * mine["n"] / F.greatest(mine["n"] - 1, F.lit(1))).alias("a"))
    value = F.when((F.col("n") <= 1) | (F.greatest("a", "b") == 0), 0.0) \
        .otherwise((F.col("b") - F.col("a")) / F.greatest("a", "b"))
    return near.agg(F.avg(value).alias("silhouette"))


def cluster_cost(df: DataFrame, distance: str = "dist") -> DataFrame:
    """Within-set sum of squared distances."""
    return df.agg(F.sum(F.col(distance) * F.col(distance)).alias("cost"))
