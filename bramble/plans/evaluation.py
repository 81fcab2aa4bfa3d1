"""Evaluation plans over fixed prediction tables, so each measure has an exact SQL counterpart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bramble.functions.columns import big, r6
from bramble.operators import metrics
from bramble.plans.registry import Tables, plan
from bramble.plans.registry import r6 as sql6

_SCORED = """WITH s AS (
    SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1.0 ELSE 0.0 END AS label,
           o_orderkey, ((o_orderkey * 37) % 101
             + CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 20 ELSE 0 END) / 128.0::DOUBLE AS score
    FROM orders), p AS (SELECT *, CASE WHEN score > 0.5 THEN 1.0 ELSE 0.0 END AS prediction FROM s)
"""
_CLASSES = """WITH p AS (
    SELECT event_id, CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2
                     WHEN 'signup' THEN 3 ELSE 4 END AS label,
           CASE WHEN value > 50 THEN (event_id * 7) % 5
                ELSE CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2
                     WHEN 'signup' THEN 3 ELSE 4 END END AS prediction
    FROM events)
"""


def scored(t: Tables) -> DataFrame:
    """Orders with a 0/1 label (high priority), a score and a hard prediction."""
    high = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    s = t.orders.select(
        "o_orderkey", F.when(high, 1.0).otherwise(0.0).alias("label"),
        ((F.col("o_orderkey") * 37 % 101 + F.when(high, 20).otherwise(0)) / 128.0).alias("score"))
    return s.withColumn("prediction", F.when(F.col("score") > 0.5, 1.0).otherwise(0.0))


def classes(t: Tables) -> DataFrame:
    """Events with a five-class label and a fixed prediction."""
    names = ["click", "error", "purchase", "signup", "view"]
    label = F.array_position(F.lit(names), F.col("event_type")) - 1
    guess = F.when(F.col("value") > 50, F.col("event_id") * 7 % 5).otherwise(label)
    return t.events.select("event_id", label.alias("label"), guess.alias("prediction"))


def fitted_line(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey", "l_partkey", F.col("l_extendedprice").alias("label"),
        (F.col("l_quantity") * 1000 + 500).alias("prediction"))


@plan("N6", oracle=_CLASSES + """
    SELECT label::BIGINT AS label, prediction::BIGINT AS prediction, count(*) AS n FROM p GROUP BY ALL""")
def confusion(t: Tables) -> DataFrame:
    return metrics.confusion(classes(t)).select(big("label").alias("label"),
                                                big("prediction").alias("prediction"), "n")


@plan("N3 N4", oracle=_CLASSES + f"""
    SELECT count(*) AS n, {sql6('avg((label = prediction)::INT)')} AS accuracy,
           {sql6('1 - avg((label = prediction)::INT)')} AS error_rate FROM p""")
def accuracy(t: Tables) -> DataFrame:
    return metrics.accuracy(classes(t)).select("n", r6("accuracy").alias("accuracy"),
                                               r6("error_rate").alias("error_rate"))


_RATES = _CLASSES + """, l AS (SELECT DISTINCT label FROM p),
    r AS (SELECT l.label, count(*) FILTER (p.label = l.label) AS support, count(*) AS total,
                 count(*) FILTER (p.label = l.label AND prediction = l.label) AS tp,
                 count(*) FILTER (p.label <> l.label AND prediction = l.label) AS fp
          FROM l, p GROUP BY l.label),
    m AS (SELECT label::BIGINT AS label, support, tp / support AS tpr, fp / (total - support) AS fpr,
                 tp / (tp + fp) AS precision, tp / support AS recall,
                 2 * tp / (support + tp + fp) AS f, support / total AS share FROM r)
"""


@plan("N6", oracle=_RATES + f"""
    SELECT label, support, {sql6('tpr')} AS tpr, {sql6('fpr')} AS fpr,
           {sql6('precision')} AS precision, {sql6('recall')} AS recall, {sql6('f')} AS f FROM m""")
def per_label_rates(t: Tables) -> DataFrame:
    return metrics.label_rates(classes(t)).select(
        "label", "support", *[r6(c).alias(c) for c in ("tpr", "fpr", "precision", "recall", "f")])


@plan("N5 N6", oracle=_RATES + f"""
    SELECT {sql6('sum(tpr * share)')} AS weighted_tpr, {sql6('sum(fpr * share)')} AS weighted_fpr,
           {sql6('sum(precision * share)')} AS weighted_precision,
           {sql6('sum(recall * share)')} AS weighted_recall, {sql6('sum(f * share)')} AS weighted_f
    FROM m""")
def weighted_rates(t: Tables) -> DataFrame:
    rates = metrics.weighted_rates(classes(t))
    return rates.select(*[r6(c).alias(c) for c in rates.columns])


@plan("N1", oracle=_SCORED + f"""
    SELECT {sql6("(avg(prediction) FILTER (label = 1) + avg(1 - prediction) FILTER (label = 0)) / 2")} AS auc
    FROM p""")
def auc_hard(t: Tables) -> DataFrame:
    return metrics.area_under_roc_hard(scored(t)).select(r6("auc").alias("auc"))


@plan("N2", oracle=_SCORED + f""", k AS (
    SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk FROM p),
    c AS (SELECT sum(label) AS np, sum(1 - label) AS nn, sum(rk) FILTER (label = 1) AS rs FROM k)
    SELECT {sql6('(rs - np * (np + 1) / 2) / (np * nn)')} AS auc FROM c""")
def auc_score(t: Tables) -> DataFrame:
    return metrics.area_under_roc(scored(t)).select(r6("auc").alias("auc"))


_CURVE = _SCORED + """, g AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM p GROUP BY score),
    c AS (SELECT score AS threshold, sum(pos) OVER (ORDER BY score DESC) AS tp,
                 sum(neg) OVER (ORDER BY score DESC) AS fp, sum(pos) OVER () AS np, sum(neg) OVER () AS nn
          FROM g)
"""


@plan("N7", oracle=_CURVE + f"""
    SELECT {sql6('threshold')} AS threshold, {sql6('fp / nn')} AS fpr, {sql6('tp / np')} AS tpr FROM c""")
def roc_curve(t: Tables) -> DataFrame:
    return metrics.roc_points(scored(t)).select(*[r6(c).alias(c) for c in ("threshold", "fpr", "tpr")])


@plan("N8", oracle=_CURVE + f"""
    SELECT {sql6('threshold')} AS threshold, {sql6('2 * tp / (np + tp + fp)')} AS f FROM c""")
def f_by_threshold(t: Tables) -> DataFrame:
    return metrics.f_by_threshold(scored(t)).select(r6("threshold").alias("threshold"), r6("f").alias("f"))


@plan("N8 D2", oracle=_CURVE + f"""
    SELECT {sql6('threshold')} AS threshold, {sql6('2 * tp / (np + tp + fp)')} AS f FROM c
    ORDER BY 2 * tp / (np + tp + fp) DESC, threshold LIMIT 1""")
def best_f_threshold(t: Tables) -> DataFrame:
    best = metrics.best_threshold(metrics.f_by_threshold(scored(t)))
    return best.select(r6("threshold").alias("threshold"), r6("f").alias("f"))


_LINE = """WITH p AS (SELECT l_orderkey, l_partkey, l_extendedprice AS label,
                             l_quantity * 1000 + 500 AS prediction FROM lineitem)"""


@plan("N10", oracle=_LINE + """
    SELECT round(sqrt(avg((label - prediction) ** 2)), 4) AS rmse,
           round(avg(abs(label - prediction)), 4) AS mae,
           round(1 - avg((label - prediction) ** 2) / var_pop(label), 6) AS r2,
           round(avg((label - prediction) ** 2) / 1e6, 4) AS mse_millions FROM p""")
def regression_metrics(t: Tables) -> DataFrame:
    return metrics.regression_errors(fitted_line(t)).select(
        F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae"), F.round("r2", 6).alias("r2"),
        F.round(F.col("mse") / 1e6, 4).alias("mse_millions"))


@plan("N11", oracle=_LINE + """
    SELECT l_orderkey, l_partkey, round(label - prediction, 4) + 0.0::DOUBLE AS residual FROM p""")
def residual_rows(t: Tables) -> DataFrame:
    return metrics.residuals(fitted_line(t)).select("l_orderkey", "l_partkey",
                                                    F.round("residual", 4).alias("residual"))


@plan("N12", oracle="""
    WITH p AS (SELECT label AS g, embedding::DOUBLE[] AS x, list_sum([v * v for v in embedding::DOUBLE[]]) AS x2
               FROM embeddings),
    s AS (SELECT g, u.i AS i, avg(x[u.i]) AS m FROM p, (SELECT unnest(range(1, 65)) AS i) u GROUP BY g, u.i),
    c AS (SELECT g, list(m ORDER BY i) AS c FROM s GROUP BY g),
    z AS (SELECT g, count(*) AS n, avg(x2) AS q, any_value(c) AS c FROM p JOIN c USING (g) GROUP BY g),
    d AS (SELECT row_number() OVER () AS id, * FROM p),
    pair AS (SELECT d.id, d.g = z.g AS own, z.n, d.x2 + z.q - 2 * list_dot_product(d.x, z.c) AS d FROM d, z),
    ab AS (SELECT id, max(d * n / (n - 1)) FILTER (own) AS a, min(d) FILTER (NOT own) AS b FROM pair GROUP BY id)
    SELECT round(avg((b - a) / greatest(a, b)), 6) AS silhouette FROM ab""")
def silhouette(t: Tables) -> DataFrame:
    return metrics.silhouette(t.embeddings, "embedding", "label") \
        .select(r6("silhouette").alias("silhouette"))
