"""Running totals, ranks, quantiles and measures against pandas and Spark's evaluators."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import (BinaryClassificationEvaluator, ClusteringEvaluator,
                                   MulticlassClassificationEvaluator, RegressionEvaluator)
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from bramble.operators import metrics, ranking, stats


@pytest.fixture(scope="module")
def scores(spark):
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 600)
    s = np.round(y * 0.3 + rng.uniform(size=600), 2)
    s[:200] = 0.5                                     # a third of the rows share one score
    pdf = pd.DataFrame({"label": y.astype(float), "score": s, "prediction": (s > 0.6).astype(float)})
    return pdf, spark.createDataFrame(pdf)


def test_running_totals_match_pandas(spark):
    pdf = pd.DataFrame({"x": np.random.default_rng(1).permutation(500) / 7.0, "n": np.arange(500) % 9})
    for down in (False, True):
        got = ranking.running_totals(spark.createDataFrame(pdf), "x", ["n"], descending=down, buckets=13).toPandas()
        want = pdf.sort_values("x", ascending=not down)
        want["cum_n"] = want["n"].cumsum()
        merged = got.merge(want, on="x", suffixes=("", "_w"))
        assert (merged["cum_n"] == merged["cum_n_w"]).all() and len(merged) == 500


def test_number_rows_and_quantiles(spark):
    df = spark.range(0, 1000, 3).withColumn("v", (F.col("id") % 10).cast("double"))
    numbered = ranking.number_rows(df, "id").orderBy("id").toPandas()
    assert list(numbered["row_no"]) == list(range(334))
    values = sorted(df.toPandas()["v"])
    assert ranking.exact_quantiles(df, "v", [0.5, 1.0]) == [values[int(np.ceil(167)) - 1], 9.0]


def test_average_ranks(spark):
    pdf = pd.DataFrame({"v": [3.0, 1.0, 1.0, 2.0, 3.0, 3.0]})
    got = {r.value: r["rank"] for r in ranking.average_ranks(spark.createDataFrame(pdf), "v").collect()}
    assert got == dict(zip(pdf["v"], pdf["v"].rank()))


def test_area_under_roc(scores):
    _, df = scores
    auc = metrics.area_under_roc(df).first().auc
    spark_auc = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(df)
    assert abs(auc - spark_auc) < 1e-9
    hard = metrics.area_under_roc_hard(df).first().auc
    assert abs(hard - BinaryClassificationEvaluator(rawPredictionCol="prediction").evaluate(df)) < 1e-9


def test_roc_and_f_curve(scores):
    pdf, df = scores
    curve = metrics.roc_points(df).orderBy("threshold").toPandas()
    assert curve["tpr"].iloc[0] == 1.0 and curve["fpr"].iloc[0] == 1.0 and len(curve) == pdf["score"].nunique()
    best = metrics.best_threshold(metrics.f_by_threshold(df)).first()
    f = {}
    for c in pdf["score"].unique():
        p = pdf["score"] >= c
        tp = (p & (pdf["label"] == 1)).sum()
        f[c] = 2 * tp / (p.sum() + (pdf["label"] == 1).sum())
    assert abs(best.f - max(f.values())) < 1e-12


def test_weighted_rates_match_evaluator(scores):
    _, df = scores
    got = metrics.weighted_rates(df).first()
    for name, metric in (("weighted_precision", "weightedPrecision"), ("weighted_recall", "weightedRecall"),
                         ("weighted_f", "weightedFMeasure"), ("weighted_fpr", "weightedFalsePositiveRate")):
        assert abs(got[name] - MulticlassClassificationEvaluator(metricName=metric).evaluate(df)) < 1e-9


def test_regression_errors(scores):
    _, df = scores
    got = metrics.regression_errors(df, "label", "score").first()
    for name in ("rmse", "mse", "mae", "r2"):
        want = RegressionEvaluator(predictionCol="score", metricName=name).evaluate(df)
        assert abs(got[name] - want) < 1e-9


def test_silhouette(spark):
    rng = np.random.default_rng(2)
    rows = [(i % 3, [float(i % 3 + v) for v in rng.normal(scale=0.4, size=2)]) for i in range(60)] + [(3, [9.0, 9.0])]
    df = spark.createDataFrame(rows, "prediction int, x array<double>").withColumn("features", array_to_vector("x"))
    assert abs(metrics.silhouette(df).first().silhouette - ClusteringEvaluator().evaluate(df)) < 1e-9


def test_summary_and_correlation_fixtures(spark):
    df = spark.createDataFrame([([2.0, 3.0, 5.0], 1.0), ([4.0, 6.0, 7.0], 2.0)], "x array<double>, w double") \
        .withColumn("features", array_to_vector("x"))
    weighted = {r.pos: r["mean"] for r in stats.moments(df, weight="w").collect()}
    assert [round(weighted[i], 4) for i in range(3)] == [3.3333, 5.0, 6.3333]
    plain = {r.pos: (r["mean"], r.variance) for r in stats.moments(df).collect()}
    assert [plain[i] for i in range(3)] == [(3.0, 2.0), (4.5, 4.5), (6.0, 2.0)]
    four = spark.createDataFrame([(1.0, 0.0, 0.0, -2.0), (4.0, 5.0, 0.0, 3.0), (6.0, 7.0, 0.0, 8.0), (9.0, 0.0, 0.0, 1.0)],
                                 "a double, b double, c double, d double")
    corr = {(r.i, r.j): r.corr for r in stats.correlations(four, ["a", "b", "c", "d"]).collect()}
    assert round(corr[0, 1], 6) == 0.055641 and round(corr[0, 3], 6) == 0.400471 and np.isnan(corr[0, 2])


def test_label_check(spark):
    with pytest.raises(ValueError):
        stats.class_count(spark.createDataFrame([(0.0,), (1.5,)], "label double"))
    assert stats.class_count(spark.createDataFrame([(0.0,), (2.0,)], "label double")) == 3


def test_top_scores_beside_one_huge_item(spark):
    import numpy as np
    from bramble.operators.ranking import top_scores
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=(40, 6)), rng.normal(size=(60, 6))
    y[7] *= 1e7
    y[8] *= 0
    users = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "u long, features array<double>")
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(y)], "i long, features array<double>")
    got = {}
    for r in top_scores(users, items, 5, user_id="u", item_id="i").collect():
        got.setdefault(r.user, {})[r["rank"]] = r.item
    want = np.argsort(-(x @ y.T), axis=1, kind="stable")[:, :5]
    assert all([got[i][k] for k in range(1, 6)] == want[i].tolist() for i in range(40))


def test_short_items_are_not_met(spark):
    """Items lie in panels by norm, of which a user meets those in reach; equal norms and repeated vectors too."""
    import numpy as np
    from bramble.operators.ranking import _best_of_panel, top_scores
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(50, 4)), rng.normal(size=(9000, 4))
    y[4000:] /= np.sqrt((y[4000:] ** 2).sum(1))[:, None]
    y[8990:] = y[0]
    frame = lambda v: spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(v)], "id long, features array<double>")
    got = {(r.user, r["rank"]): r.item for r in top_scores(frame(x), frame(y), 4, user_id="id", item_id="id").collect()}
    score = x @ y.T
    want = [sorted(range(len(y)), key=lambda j: (-round(score[i, j], 12), j))[:4] for i in range(50)]
    assert [[got[i, k] for k in (1, 2, 3, 4)] for i in range(50)] == want
    qi, bi, found = _best_of_panel(y, np.arange(len(y)), x, np.sort(score, 1)[:, -2], 4, None)
    assert np.bincount(qi).tolist() == [2] * 50 and np.allclose(found, score[qi, bi])
