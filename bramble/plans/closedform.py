"""Learners whose fitted result has a closed form that SQL can state."""

from __future__ import annotations

import numpy as np
from pyspark.ml import classification as mc
from pyspark.ml import clustering as mk
from pyspark.ml import feature as mf
from pyspark.ml import regression as mg
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bramble.functions.columns import as_vector, big, r6, with_slots
from bramble.operators import clusters, likelihood, metrics, stats
from bramble.plans.registry import Tables, plan
from bramble.plans.registry import r6 as sql6


def _rows(t: Tables, values, schema: str) -> DataFrame:
    """A fitted model's parameters (their number does not depend on the data) as rows."""
    return t.spark.createDataFrame(values, schema)


# --- classification ---------------------------------------------------------------------------

@plan("I9", oracle=f"""
    WITH e AS (SELECT label, unnest(range(0, 64)) AS pos, unnest(embedding::DOUBLE[]) + 1 AS v FROM embeddings),
    s AS (SELECT label, pos, sum(v) AS s FROM e GROUP BY ALL),
    n AS (SELECT label, count(*) AS n, (SELECT count(*) FROM embeddings) AS total,
                 (SELECT count(DISTINCT label) FROM embeddings) AS c FROM embeddings GROUP BY label)
    SELECT label::BIGINT AS label, pos::BIGINT AS pos, {sql6('ln((n + 1) / (total + c))')} AS log_prior,
           {sql6('ln((s + 1) / (sum(s) OVER (PARTITION BY label) + 64))')} AS log_share
    FROM s JOIN n USING (label)""")
def naive_bayes(t: Tables) -> DataFrame:
    shifted = F.transform(F.col("embedding").cast("array<double>"), lambda v: v + 1)
    model = mc.NaiveBayes(smoothing=1.0).fit(
        t.embeddings.select(F.col("label").cast("double"), as_vector(shifted).alias("features")))
    theta, pi = model.theta.toArray(), model.pi.toArray()
    values = [(i, j, float(pi[i]), float(theta[i, j])) for i in range(theta.shape[0]) for j in range(theta.shape[1])]
    return _rows(t, values, "label bigint, pos bigint, log_prior double, log_share double") \
        .withColumn("log_prior", r6("log_prior")).withColumn("log_share", r6("log_share"))


@plan("I3 I1", oracle="""
    WITH o AS (SELECT o_orderstatus = 'F' AS x, o_totalprice > 250000 AS y FROM orders),
    g AS (SELECT count(*) FILTER (x AND y) / count(*) FILTER (x AND NOT y) AS o1,
                 count(*) FILTER (NOT x AND y) / count(*) FILTER (NOT x AND NOT y) AS o0 FROM o)
    SELECT round(ln(o1 / o0), 4) + 0.0::DOUBLE AS slope, round(ln(o0), 4) + 0.0::DOUBLE AS intercept FROM g""")
def logistic_odds(t: Tables) -> DataFrame:
    """With one 0/1 feature the coefficients are log odds and a log odds ratio."""
    rows = t.orders.select((F.col("o_orderstatus") == "F").cast("double").alias("x"),
                           (F.col("o_totalprice") > 250000).cast("double").alias("label"))
    model = mc.LogisticRegression(regParam=0.0, tol=1e-12, maxIter=200).fit(stats.assemble(rows, ["x"]))
    return _rows(t, [(float(model.coefficients[0]), float(model.intercept))], "slope double, intercept double") \
        .select(F.round("slope", 4).alias("slope"), F.round("intercept", 4).alias("intercept"))


@plan("I2 I3", oracle="""
    WITH p AS (SELECT p_type, CASE WHEN p_size <= 15 THEN 0 WHEN p_size <= 35 THEN 1 ELSE 2 END AS y FROM part),
    g AS (SELECT p_type, count(*) AS n FROM p GROUP BY 1)
    SELECT p_type, y::BIGINT AS class, round(count(*) / any_value(n), 3) AS probability
    FROM p JOIN g USING (p_type) GROUP BY p_type, y""")
def multinomial_shares(t: Tables) -> DataFrame:
    """A saturated multinomial model gives back the class shares of every category."""
    y = F.when(F.col("p_size") <= 15, 0.0).when(F.col("p_size") <= 35, 1.0).otherwise(2.0)
    rows = t.part.select("p_type", y.alias("label"))
    rows = mf.StringIndexer(inputCol="p_type", outputCol="i").fit(rows).transform(rows)
    rows = mf.OneHotEncoder(inputCol="i", outputCol="features").fit(rows).transform(rows)
    model = mc.LogisticRegression(family="multinomial", regParam=0.0, tol=1e-12, maxIter=500).fit(rows)
    kinds = rows.select("p_type", "features").dropDuplicates(["p_type"])
    return model.transform(kinds).select("p_type", F.posexplode(vector_to_array("probability")).alias("c", "q")) \
        .select("p_type", big("c").alias("class"), F.round("q", 3).alias("probability"))


def _stump_sql(label: str, loss: str) -> str:
    return f"""WITH s AS (SELECT p_size AS x, count(*) AS n, sum({label}) AS y, sum({label} ** 2) AS yy FROM part GROUP BY 1),
    c AS (SELECT x AS cut, sum(n) OVER (ORDER BY x) AS nl, sum(y) OVER (ORDER BY x) AS yl, sum(yy) OVER (ORDER BY x) AS yyl,
                 sum(n) OVER () AS n, sum(y) OVER () AS y, sum(yy) OVER () AS yy FROM s),
    b AS (SELECT cut, yl / nl AS lo, (y - yl) / (n - nl) AS hi FROM c WHERE nl < n ORDER BY {loss} LIMIT 1)
    SELECT x::BIGINT AS p_size, {sql6('CASE WHEN x <= cut THEN lo ELSE hi END')} AS value FROM s, b"""


def _part_sizes(t: Tables, label) -> DataFrame:
    return stats.assemble(t.part.select("p_size", label.alias("label")), ["p_size"])


_HIGH = "(p_retailprice + 2 * p_size > 1000)::INT"


@plan("I6", oracle=_stump_sql(_HIGH, "2 * yl * (1 - yl / nl) + 2 * (y - yl) * (1 - (y - yl) / (n - nl))"))
def stump_gini(t: Tables) -> DataFrame:
    rows = _part_sizes(t, (F.col("p_retailprice") + 2 * F.col("p_size") > 1000).cast("double"))
    model = mc.DecisionTreeClassifier(maxDepth=1, maxBins=64, impurity="gini").fit(rows)
    leaf = model.transform(rows).select("p_size", vector_to_array("probability")[1].alias("v"))
    return leaf.groupBy(big("p_size").alias("p_size")).agg(r6(F.max("v")).alias("value"))


@plan("J6", oracle=_stump_sql("(p_retailprice + p_size)", "(yyl - yl ** 2 / nl) + (yy - yyl - (y - yl) ** 2 / (n - nl))"))
def stump_variance(t: Tables) -> DataFrame:
    rows = _part_sizes(t, F.col("p_retailprice") + F.col("p_size"))
    model = mg.DecisionTreeRegressor(maxDepth=1, maxBins=64).fit(rows)
    return model.transform(rows).groupBy(big("p_size").alias("p_size")).agg(r6(F.max("prediction")).alias("value"))


# --- regression -------------------------------------------------------------------------------

def _priced(t: Tables) -> DataFrame:
    return stats.assemble(t.lineitem.select("l_quantity", (F.col("l_extendedprice") / 1000 + 2 * F.col("l_quantity"))
                                            .alias("label")), ["l_quantity"])


_PRICED = """WITH l AS (SELECT l_quantity AS x, l_extendedprice / 1000 + 2 * l_quantity AS y FROM lineitem),
    m AS (SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, corr(y, x) AS r, regr_r2(y, x) AS r2,
                 stddev_pop(x) AS sx, stddev_pop(y) AS sy, avg(x) AS mx, avg(y) AS my, count(*) AS n,
                 regr_sxx(y, x) AS sxx, regr_syy(y, x) AS syy FROM l)
"""


def _line(t: Tables, **params) -> DataFrame:
    model = mg.LinearRegression(solver="normal", tol=1e-12, maxIter=500, **params).fit(_priced(t))
    return _rows(t, [(float(model.coefficients[0]), float(model.intercept))], "slope double, intercept double") \
        .select(F.round("slope", 5).alias("slope"), F.round("intercept", 5).alias("intercept"))


def _line_sql(slope: str) -> str:
    return _PRICED + f", w AS (SELECT *, {slope} AS b FROM m) SELECT round(b, 5) AS slope, round(my - b * mx, 5) AS intercept FROM w"


@plan("J2", oracle=_line_sql("slope"))
def ols(t: Tables) -> DataFrame:
    return _line(t, regParam=0.0)


@plan("J4", oracle=_line_sql("r / (1 + 0.3 / sy) * sy / sx"))
def ridge(t: Tables) -> DataFrame:
    return _line(t, regParam=0.3, elasticNetParam=0.0)


@plan("J3", oracle=_line_sql("sign(r) * greatest(abs(r) - 0.3 / sy, 0) * sy / sx"))
def lasso_1d(t: Tables) -> DataFrame:
    return _line(t, regParam=0.3, elasticNetParam=1.0)


@plan("J1", oracle=_line_sql("sign(r) * greatest(abs(r) - 0.24 / sy, 0) / (1 + 0.06 / sy) * sy / sx"))
def elastic_net_1d(t: Tables) -> DataFrame:
    return _line(t, regParam=0.3, elasticNetParam=0.8)


@plan("J2 N10", oracle="""
    WITH l AS (SELECT l_quantity AS a, l_discount AS b, l_extendedprice / 1000 + 2 * l_quantity - 30 * l_discount AS y FROM lineitem),
    m AS (SELECT covar_pop(a, a) AS aa, covar_pop(b, b) AS bb, covar_pop(a, b) AS ab, covar_pop(a, y) AS ay,
                 covar_pop(b, y) AS byy, avg(a) AS ma, avg(b) AS mb, avg(y) AS my FROM l),
    c AS (SELECT *, (ay * bb - byy * ab) / (aa * bb - ab ** 2) AS ca, (byy * aa - ay * ab) / (aa * bb - ab ** 2) AS cb FROM m)
    SELECT round(ca, 5) AS quantity, round(cb, 5) AS discount, round(my - ca * ma - cb * mb, 5) AS intercept FROM c""")
def ols_two_features(t: Tables) -> DataFrame:
    y = F.col("l_extendedprice") / 1000 + 2 * F.col("l_quantity") - 30 * F.col("l_discount")
    rows = stats.assemble(t.lineitem.select("l_quantity", "l_discount", y.alias("label")), ["l_quantity", "l_discount"])
    m = mg.LinearRegression(solver="normal", regParam=0.0).fit(rows)
    values = [(float(m.coefficients[0]), float(m.coefficients[1]), float(m.intercept))]
    return _rows(t, values, "quantity double, discount double, intercept double").select(
        *[F.round(c, 5).alias(c) for c in ("quantity", "discount", "intercept")])


@plan("J5 N14 N11", oracle=_PRICED + """
    , g AS (SELECT *, syy * (1 - r2) AS dev, syy * (1 - r2) / (n - 2) AS disp FROM m),
    e AS (SELECT *, sqrt(disp / sxx) AS se, sqrt(disp * (1 / n + mx ** 2 / sxx)) AS se0 FROM g)
    SELECT round(slope, 5) AS slope, round(intercept, 5) AS intercept, round(se, 5) AS se_slope, round(se0, 5) AS se_intercept,
           round(slope / se, 3) AS t_slope, round(intercept / se0, 3) AS t_intercept, round(disp, 4) AS dispersion,
           round(syy, 2) AS null_deviance, round(dev, 2) AS deviance, n - 2 AS dof, n - 1 AS null_dof,
           round(n * (ln(dev / n * 2 * pi()) + 1) + 2 + 4, 2) AS aic FROM e""")
def glm_gaussian(t: Tables) -> DataFrame:
    model = mg.GeneralizedLinearRegression(family="gaussian", link="identity", regParam=0.0).fit(_priced(t))
    s = model.summary
    se, tv = s.coefficientStandardErrors, s.tValues
    values = [(float(model.coefficients[0]), float(model.intercept), se[0], se[1], tv[0], tv[1], s.dispersion,
               s.nullDeviance, s.deviance, s.degreesOfFreedom, s.residualDegreeOfFreedomNull, s.aic)]
    names = ["slope", "intercept", "se_slope", "se_intercept", "t_slope", "t_intercept", "dispersion",
             "null_deviance", "deviance", "dof", "null_dof", "aic"]
    digits = dict(zip(names, (5, 5, 5, 5, 3, 3, 4, 2, 2, None, None, 2)))
    df = _rows(t, values, ", ".join(f"{n} {'bigint' if digits[n] is None else 'double'}" for n in names))
    return df.select(*[F.col(n) if digits[n] is None else F.round(n, digits[n]).alias(n) for n in names])


@plan("J5", oracle="""
    SELECT p_type, round(avg(p_size), 4) AS mean FROM part GROUP BY p_type""")
def glm_poisson(t: Tables) -> DataFrame:
    """A Poisson model with one categorical feature fits every group mean."""
    rows = t.part.select("p_type", F.col("p_size").cast("double").alias("label"))
    rows = mf.StringIndexer(inputCol="p_type", outputCol="i").fit(rows).transform(rows)
    rows = mf.OneHotEncoder(inputCol="i", outputCol="features").fit(rows).transform(rows)
    model = mg.GeneralizedLinearRegression(family="poisson", link="log", tol=1e-12, maxIter=100).fit(rows)
    return model.transform(rows.select("p_type", "features").dropDuplicates(["p_type"])) \
        .select("p_type", F.round("prediction", 4).alias("mean"))


@plan("J9", oracle=f"""
    WITH s AS (SELECT p_size AS x, count(*) AS n, sum(p_retailprice) AS y FROM part GROUP BY 1),
    m AS (SELECT x.x AS x, a.x AS lo, b.x AS hi, sum(c.y) / sum(c.n) AS mean
          FROM s x JOIN s a ON a.x <= x.x JOIN s b ON b.x >= x.x JOIN s c ON c.x BETWEEN a.x AND b.x GROUP BY ALL),
    i AS (SELECT x, lo, min(mean) AS low FROM m GROUP BY ALL)
    SELECT x::BIGINT AS p_size, {sql6('max(low)')} AS prediction FROM i GROUP BY x""")
def isotonic(t: Tables) -> DataFrame:
    """Equal features are merged into one weighted row first, which leaves the fit unchanged."""
    rows = t.part.groupBy("p_size").agg(F.avg("p_retailprice").alias("label"), F.count("*").cast("double").alias("w")) \
        .withColumn("features", F.col("p_size").cast("double"))
    model = mg.IsotonicRegression(weightCol="w").fit(rows)
    return model.transform(rows).select(big("p_size").alias("p_size"), r6("prediction").alias("prediction"))


# --- clustering -------------------------------------------------------------------------------

_CENTRES = """WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
    c AS (SELECT label AS cluster, list(m ORDER BY i) AS centre FROM (
              SELECT label, i, avg(v[i]) AS m FROM e, (SELECT unnest(range(1, 65)) AS i) GROUP BY ALL) GROUP BY label),
    d AS (SELECT vec_id, v, cluster, list_distance(v, centre) AS dist FROM e, c),
    a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, cluster) AS o FROM d) WHERE o = 1)
"""


def _assigned(t: Tables) -> DataFrame:
    e = t.embeddings
    return clusters.assign(e, clusters.centres_of(e, "embedding", "label"), "embedding")


@plan("K1", oracle=_CENTRES + f"SELECT vec_id, cluster::BIGINT AS cluster, {sql6('dist')} AS dist FROM a")
def assign_centroid(t: Tables) -> DataFrame:
    return _assigned(t).select("vec_id", big("cluster").alias("cluster"), r6("dist").alias("dist"))


@plan("K1", oracle=_CENTRES + f"""
    , u AS (SELECT cluster, unnest(range(0, 64)) AS pos, unnest(v) AS x FROM a)
    SELECT cluster::BIGINT AS cluster, pos::BIGINT AS pos, {sql6('avg(x)')} AS value FROM u GROUP BY ALL""")
def centroid_update(t: Tables) -> DataFrame:
    updated = clusters.centres_of(_assigned(t), "embedding", "cluster")
    return with_slots(updated, "centre", "cluster") \
        .select(big("cluster").alias("cluster"), "pos", r6("value").alias("value"))


@plan("N13", oracle=_CENTRES + f"SELECT {sql6('sum(dist ** 2)')} AS cost FROM a")
def wssse(t: Tables) -> DataFrame:
    return metrics.cluster_cost(_assigned(t)).select(r6("cost").alias("cost"))


@plan("K3", oracle="""
    SELECT 1.0::DOUBLE AS weight, round(avg(l_quantity), 3) AS m0, round(avg(l_linenumber), 3) AS m1,
           round(avg(l_quantity ** 2), 3) AS s00, round(avg(l_quantity * l_linenumber), 3) AS s01,
           round(avg(l_linenumber ** 2), 3) AS s11 FROM lineitem""")
def mixture_moments(t: Tables) -> DataFrame:
    """Fitted weights, means and covariances together give back the first two sample moments."""
    model = mk.GaussianMixture(k=2, maxIter=20, seed=1).fit(stats.assemble(t.lineitem, ["l_quantity", "l_linenumber"]))
    parts = model.gaussiansDF.collect()
    total = np.zeros(6)
    for w, g in zip(model.weights, parts):
        m, c = g["mean"].toArray(), g["cov"].toArray()
        s = c + np.outer(m, m)
        total += w * np.array([1.0, m[0], m[1], s[0, 0], s[0, 1], s[1, 1]])
    df = _rows(t, [tuple(float(v) for v in total)], "weight double, m0 double, m1 double, s00 double, s01 double, s11 double")
    return df.select(*[F.round(n, 3).alias(n) for n in df.columns])


# --- objectives of given models ---------------------------------------------------------------

@plan("N9 I3", oracle="""
    WITH m AS (SELECT o_totalprice > 250000 AS y, -3.0 + 0.01 * (o_totalprice / 1000)
                      + 0.5 * (o_orderstatus = 'F')::INT AS m FROM orders)
    SELECT count(*) AS n, round(avg(ln(1 + exp(CASE WHEN y THEN -m ELSE m END))), 6) AS objective FROM m""")
def logistic_objective(t: Tables) -> DataFrame:
    """Objective of a logistic model with given coefficients."""
    rows = t.orders.select((F.col("o_totalprice") / 1000).alias("price"),
                           (F.col("o_orderstatus") == "F").cast("double").alias("final"),
                           (F.col("o_totalprice") > 250000).cast("double").alias("label"))
    return likelihood.logistic_objective(rows, ["price", "final"], [0.01, 0.5], -3.0) \
        .select("n", r6("objective").alias("objective"))


@plan("N9 J1", oracle="""
    SELECT count(*) AS n, round(avg((l_extendedprice / 1000 - (2 * l_quantity - 10 * l_discount + 1)) ** 2) / 2, 4) AS objective
    FROM lineitem""")
def linear_objective(t: Tables) -> DataFrame:
    """Objective of a linear model with given coefficients."""
    rows = t.lineitem.withColumn("label", F.col("l_extendedprice") / 1000)
    return likelihood.squared_objective(rows, ["l_quantity", "l_discount"], [2.0, -10.0], 1.0) \
        .select("n", F.round("objective", 4).alias("objective"))


@plan("J10", oracle="""
    WITH r AS (SELECT o_totalprice / 1000 AS time, (o_orderstatus = 'F')::INT AS seen, (o_orderpriority = '1-URGENT')::INT AS x
               FROM orders WHERE o_totalprice > 0),
    g AS (SELECT seen, (ln(time) - (5.0 - 0.2 * x)) / 0.8 AS gap FROM r)
    SELECT count(*) AS n, round(sum(seen * (gap - ln(0.8)) - exp(gap)), 3) AS log_likelihood FROM g""")
def survival_likelihood(t: Tables) -> DataFrame:
    """Log-likelihood of a failure-time model with given coefficients; orders not final are censored."""
    return likelihood.survival_likelihood(_lifetimes(t), ["urgent"], [-0.2], 5.0, 0.8) \
        .select("n", F.round("log_likelihood", 3).alias("log_likelihood"))


@plan("J10", oracle="""
    SELECT o_orderkey, round(exp(5.0 - 0.2 * (o_orderpriority = '1-URGENT')::INT + 0.8 * ln(-ln(0.7))), 6) AS q30,
           round(exp(5.0 - 0.2 * (o_orderpriority = '1-URGENT')::INT + 0.8 * ln(-ln(0.4))), 6) AS q60
    FROM orders WHERE o_totalprice > 0""")
def survival_quantiles(t: Tables) -> DataFrame:
    """Quantiles 0.3 and 0.6 of the same model for every row."""
    shares = likelihood.survival_quantiles(["urgent"], [-0.2], 5.0, 0.8, [0.3, 0.6])
    return _lifetimes(t).select("o_orderkey", *[r6(q).alias(n) for q, n in zip(shares, ("q30", "q60"))])


def _lifetimes(t: Tables) -> DataFrame:
    return t.orders.where("o_totalprice > 0").select(
        "o_orderkey", (F.col("o_totalprice") / 1000).alias("label"), (F.col("o_orderstatus") == "F").cast("double").alias("censor"),
        (F.col("o_orderpriority") == "1-URGENT").cast("double").alias("urgent"))
