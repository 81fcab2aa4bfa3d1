"""Topic models over all terms: hashed counts with a dictionary of names, mixtures, likelihood of a given model."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.clustering import LDAModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bramble.functions.columns import exploded, sparse_entries


def hashed_counts(df: DataFrame, words: str, out: str = "features") -> tuple[DataFrame, HashingTF]:
    """Term counts of every term, in the slots of Spark's hashing stage: no term is left out."""
    stage = HashingTF(inputCol=words, outputCol=out)
    return stage.transform(df), stage


def slot_names(df: DataFrame, words: str, stage: HashingTF) -> DataFrame:
    """``slot, term, n``: every term with its slot and count."""
    terms = exploded(df, words, "term").groupBy("term").agg(F.count("*").alias("n"))
    one = stage.copy({stage.inputCol: "_one", stage.outputCol: "_slot"})
    placed = one.transform(terms.withColumn("_one", F.array("term")))
    return sparse_entries(placed, "_slot", "term", "n").select(F.col("idx").alias("slot"), "term", "n")


def named_topics(model: LDAModel, names: DataFrame, terms: int) -> DataFrame:
    """``topic, rank, term, weight`` of each topic's heaviest slots; terms that share a slot are joined by ``|``.

    The topics' lists are the small side; the dictionary of names may have any size.
    """
    top = model.describeTopics(terms).select(
        "topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("rank", "e")) \
        .select("topic", "rank", F.col("e.termIndices").alias("slot"), F.col("e.termWeights").alias("weight"))
    wanted = names.join(F.broadcast(top.select("slot").distinct()), "slot", "left_semi")   # k times ``terms`` rows at most
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "term")))
    named = wanted.groupBy("slot").agg(F.array_join(F.transform(ordered, lambda e: e["term"]), "|").alias("term"))
    return top.join(named, "slot", "left").select("topic", "rank", "term", "weight")


def mixtures(model: LDAModel, df: DataFrame, key: str) -> DataFrame:
    """``key, topic, share`` for all topics of every document; without any term all shares are equal."""
    k = model.getK()
    shares = vector_to_array(model.getTopicDistributionCol())
    total = F.aggregate(shares, F.lit(0.0), lambda a, v: a + v)
    rows = model.transform(df).select(key, total.alias("_total"), F.posexplode(shares).alias("topic", "share"))
    return rows.select(key, "topic", F.when(F.col("_total") > 0, F.col("share")).otherwise(1.0 / k).alias("share"))


def _digamma(x: np.ndarray) -> np.ndarray:
    """Derivative of log gamma: recurrence up to 8, then the asymptotic series."""
    x, shift = np.array(x, float), 0.0
    for _ in range(8):
        low = x < 8
        shift = shift + np.where(low, 1.0 / x, 0.0)
        x = np.where(low, x + 1, x)
    y = 1.0 / (x * x)
    return np.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y * (1 / 240 - y / 132)))) - shift


def _lgamma(x: np.ndarray) -> np.ndarray:
    """Log gamma by element; np.vectorize, once called, keeps what cannot be sent to tasks."""
    return np.fromiter(map(math.lgamma, x.flat), float, x.size).reshape(x.shape)


def likelihood_bound(model: LDAModel, df: DataFrame) -> tuple[float, float]:
    """The variational bound on the log likelihood, as ``model.logLikelihood`` defines it, and the number of tokens.

    Spark's method goes through the whole topic matrix for every document. Here the expected log
    weights are worked out once and a document looks up its own slots; its mixture is the model's,
    whose unnormalised form sums to the document's tokens and the prior.
    """
    weights = model.topicsMatrix().toArray()                     # slots x topics, bounded by the slots
    slots, k = weights.shape
    alpha = np.broadcast_to(np.asarray(model.estimatedDocConcentration().toArray(), float), (k,)).copy()
    eta = model.getOrDefault(model.topicConcentration) if model.isDefined(model.topicConcentration) else 1.0 / k
    logs = _digamma(weights) - _digamma(weights.sum(0))
    shared = df.sparkSession.sparkContext.broadcast(logs)

    @F.pandas_udf("double")
    def bound(idx: pd.Series, n: pd.Series, share: pd.Series) -> pd.Series:
        out = []
        for i, c, s in zip(idx, n, share):
            c = np.asarray(c, float)
            gamma = np.asarray(s, float) * (alpha.sum() + c.sum())
            theta = _digamma(gamma) - _digamma(gamma.sum())
            words = shared.value[np.asarray(i, int)] + theta
            top = words.max(1)
            out.append(float((c * (top + np.log(np.exp(words - top[:, None]).sum(1)))).sum()
                             + ((alpha - gamma) * theta).sum() + (_lgamma(gamma) - _lgamma(alpha)).sum()
                             + math.lgamma(alpha.sum()) - math.lgamma(gamma.sum())))
        return pd.Series(out, dtype=float)

    raw = F.unwrap_udt(F.col(model.getFeaturesCol()))
    rows = model.transform(df).select(raw["indices"].alias("idx"), raw["values"].alias("n"),
                                      vector_to_array(model.getTopicDistributionCol()).alias("share"))
    tokens = F.aggregate("n", F.lit(0.0), lambda a, v: a + v)
    found = rows.where(F.size("n") > 0).select(bound("idx", "n", "share").alias("b"), tokens.alias("t"))
    total, count = found.agg(F.sum("b"), F.sum("t")).first()
    topics = ((eta - weights) * logs).sum() + (_lgamma(weights) - math.lgamma(eta)).sum() \
        + sum(math.lgamma(eta * slots) - math.lgamma(v) for v in weights.sum(0))
    return float((total or 0.0) + topics), float(count or 0.0)


def word_likelihood(counts: DataFrame, shares: DataFrame, weights: DataFrame, key: str) -> DataFrame:
    """``key, tokens, log_likelihood`` of every document under a given model, as joins and aggregations.

    ``counts`` holds ``key, term, n``, ``shares`` the mixtures ``key, topic, share`` and ``weights`` the
    topics ``topic, term, weight``. A word's probability is the mixture of its topic weights; words
    without any weight are left out of tokens and likelihood.
    """
    mixed = counts.join(weights, "term").join(shares, [key, "topic"]).groupBy(key, "term") \
        .agg(F.first("n").alias("n"), F.sum(F.col("share") * F.col("weight")).alias("p")).where("p > 0")
    return mixed.groupBy(key).agg(F.sum("n").alias("tokens"), F.sum(F.col("n") * F.log("p")).alias("log_likelihood"))


def perplexity(likelihoods: DataFrame) -> DataFrame:
    """One row: ``tokens, perplexity``."""
    return likelihoods.agg(F.sum("tokens").alias("tokens"),
                           F.exp(-F.sum("log_likelihood") / F.sum("tokens")).alias("perplexity"))
