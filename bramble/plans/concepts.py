"""Learners on concepts they can represent exactly: what they predict must equal the rule or mean."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml import feature as mf
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bramble.functions import text as tx
from bramble.functions.columns import big, r6, with_slots
from bramble.learners import command, jobs
from bramble.learners.knn import KNNRegression
from bramble.learners.registry import learner
from bramble.operators import stats
from bramble.operators.metrics import regression_errors
from bramble.plans.registry import Tables, plan
from bramble.plans.registry import r6 as sql6
from bramble.session import materialise, scratch_path, spread
from bramble.sources import delimited

_RULE = """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')
                  THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction FROM orders"""


def _rule_rows(t: Tables) -> DataFrame:
    """Orders as 0/1 flags, labelled by a conjunction of two of them."""
    final = (F.col("o_orderstatus") == "F").cast("double")
    high = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").cast("double")
    rows = t.orders.select("o_orderkey", final.alias("final"), high.alias("high"),
                           (F.col("o_totalprice") > 250000).cast("double").alias("dear"),
                           (final * high).alias("label"))
    return stats.assemble(rows, ["final", "high", "dear"])


def _recovered(t: Tables, stage) -> DataFrame:
    rows = _rule_rows(t)
    return stage.fit(rows).transform(rows).select("o_orderkey", "prediction")


@plan("I1 I3", oracle=_RULE)
def rule_by_logistic(t: Tables) -> DataFrame:
    return _recovered(t, learner("classification", "logistic", regParam=0.0, maxIter=100))


@plan("I4 I5", oracle=_RULE)
def rule_by_svm(t: Tables) -> DataFrame:
    return _recovered(t, learner("classification", "svm", regParam=0.0001, maxIter=100))


@plan("I6", oracle=_RULE)
def rule_by_tree(t: Tables) -> DataFrame:
    return _recovered(t, learner("classification", "decision_tree", maxDepth=3))


@plan("I7", oracle=_RULE)
def rule_by_forest(t: Tables) -> DataFrame:
    return _recovered(t, learner("classification", "random_forest", numTrees=9, maxDepth=4, seed=1,
                                 featureSubsetStrategy="all"))


@plan("I8", oracle=_RULE)
def rule_by_boosting(t: Tables) -> DataFrame:
    return _recovered(t, learner("classification", "gbt", maxIter=4, maxDepth=3, seed=1))


@plan("I10", oracle=_RULE)
def rule_by_perceptron(t: Tables) -> DataFrame:
    return _recovered(t, learner("classification", "perceptron", layers=[3, 5, 2], maxIter=200, seed=1234))


@plan("I11", oracle="""
    SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN 2.0 WHEN p_type IN ('SMALL', 'MEDIUM') THEN 1.0
                           ELSE 0.0 END::DOUBLE AS prediction FROM part""")
def rule_by_one_vs_rest(t: Tables) -> DataFrame:
    y = F.when(F.col("p_type") == "PROMO", 2.0).when(F.col("p_type").isin("SMALL", "MEDIUM"), 1.0).otherwise(0.0)
    rows = t.part.select("p_partkey", "p_type", y.alias("label"))
    stages = [mf.StringIndexer(inputCol="p_type", outputCol="i"),
              mf.OneHotEncoder(inputCol="i", outputCol="features", dropLast=False),
              learner("classification", "one_vs_rest", classifier=learner("classification", "logistic", tol=1e-6))]
    return Pipeline(stages=stages).fit(rows).transform(rows).select("p_partkey", "prediction")


_MEANS = f"""SELECT l_linenumber::BIGINT AS line, {sql6('avg(l_extendedprice / 1000 + 3 * l_linenumber ** 2)')} AS prediction
    FROM lineitem GROUP BY l_linenumber"""


def _group_means(t: Tables, stage) -> DataFrame:
    y = F.col("l_extendedprice") / 1000 + 3 * F.pow("l_linenumber", F.lit(2))
    rows = stats.assemble(t.lineitem.select("l_linenumber", y.alias("label")), ["l_linenumber"])
    return stage.fit(rows).transform(rows).groupBy(big("l_linenumber").alias("line")) \
        .agg(r6(F.max("prediction")).alias("prediction"))


@plan("J6", oracle=_MEANS)
def means_by_tree(t: Tables) -> DataFrame:
    """A tree deep enough for every value of one feature predicts the group means."""
    return _group_means(t, learner("regression", "decision_tree", maxDepth=7))


@plan("J7", oracle=_MEANS)
def means_by_forest(t: Tables) -> DataFrame:
    return _group_means(t, learner("regression", "random_forest", numTrees=1, maxDepth=7, bootstrap=False, seed=1))


@plan("J8", oracle=_MEANS)
def means_by_boosting(t: Tables) -> DataFrame:
    return _group_means(t, learner("regression", "gbt", maxIter=1, maxDepth=7, seed=1))


def _islands(t: Tables) -> DataFrame:
    """Lines as three groups of points that lie far apart."""
    centre = F.ascii("l_returnflag") * 1000.0
    rows = t.lineitem.select("l_returnflag", (centre + F.col("l_quantity")).alias("x"), F.col("l_tax").alias("y"))
    return stats.assemble(rows, ["x", "y"])


_ISLANDS = f"""SELECT unnest(['x', 'y']) AS axis, unnest([{sql6('avg(ascii(l_returnflag) * 1000.0 + l_quantity)')},
    {sql6('avg(l_tax)')}]) AS value FROM lineitem GROUP BY l_returnflag"""


def _centre_rows(t: Tables, centres) -> DataFrame:
    rows = t.spark.createDataFrame([([float(v) for v in c],) for c in centres], "c array<double>")
    return with_slots(rows, "c").select(F.when(F.col("pos") == 0, "x").otherwise("y").alias("axis"),
                                        r6("value").alias("value"))


@plan("K1 N17", oracle=_ISLANDS)
def islands_by_kmeans(t: Tables) -> DataFrame:
    return _centre_rows(t, learner("clustering", "kmeans", k=3, maxIter=12, seed=3).fit(_islands(t)).clusterCenters())


@plan("K2", oracle=_ISLANDS)
def islands_by_bisection(t: Tables) -> DataFrame:
    return _centre_rows(t, learner("clustering", "bisecting_kmeans", k=3, seed=1).fit(_islands(t)).clusterCenters())


@plan("J1 N11", oracle=f"""
    SELECT l_orderkey, l_partkey, {sql6('3 * l_quantity - 20 * l_discount + 5')} AS prediction FROM lineitem""")
def line_recovered(t: Tables) -> DataFrame:
    y = 3 * F.col("l_quantity") - 20 * F.col("l_discount") + 5
    rows = stats.assemble(t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_discount", y.alias("label")),
                          ["l_quantity", "l_discount"])
    model = learner("regression", "linear", solver="normal").fit(rows)
    return model.transform(rows).select("l_orderkey", "l_partkey", r6("prediction").alias("prediction"))


@plan("H8", oracle="SELECT doc_id, 0.0::DOUBLE AS gap FROM documents")
def document_vector_is_mean(t: Tables) -> DataFrame:
    """Largest gap between a document's vector and the mean of its word vectors."""
    docs = tx.without_stop_words(tx.tokens(spread(t.documents.select("doc_id", "text"), "doc_id")))
    docs = materialise(docs.select("doc_id", "filtered"), "words")
    model = tx.word_vector_stage(docs, "filtered", "v", size=4, maxIter=1, seed=11).fit(docs)
    scored = with_slots(model.transform(docs), "v", "doc_id")
    vectors = with_slots(tx.word_vectors(model, docs, "filtered", "v"), "vector", "word", value="part")
    words = docs.select("doc_id", F.size("filtered").alias("n"), F.explode("filtered").alias("word")) \
        .groupBy("doc_id", "n", "word").agg(F.count("*").alias("times"))
    means = words.join(vectors, "word").groupBy("doc_id", "pos") \
        .agg((F.sum(F.col("times") * F.col("part")) / F.max("n")).alias("mean"))
    gap = F.abs(F.col("value") - F.coalesce("mean", F.lit(0.0)))
    return scored.join(means, ["doc_id", "pos"], "left").groupBy("doc_id").agg(F.round(F.max(gap), 4).alias("gap"))


@plan("N16", oracle="""
    SELECT CASE WHEN count(*) > 0 THEN 'dear' END AS feature, 0.0::DOUBLE AS importance FROM orders
    UNION ALL SELECT 'final and high', 1.0 FROM (SELECT 1 WHERE EXISTS (SELECT 1 FROM orders))""")
def rule_importance(t: Tables) -> DataFrame:
    """A slot that the rule does not use gets no importance; those it uses share all of it."""
    w = learner("classification", "decision_tree", maxDepth=2).fit(_rule_rows(t)).featureImportances.toArray()
    rows = [("dear", float(w[2])), ("final and high", float(w[0] + w[1]))]
    return t.spark.createDataFrame(rows, "feature string, importance double").withColumn("importance", r6("importance"))


@plan("O2", oracle="SELECT o_orderkey, 0.0::DOUBLE AS prediction FROM orders")
def later_override_wins(t: Tables) -> DataFrame:
    """With the last threshold of 1 no row is predicted positive."""
    lr = learner("classification", "logistic", maxIter=10)
    rows = _rule_rows(t)
    model = lr.fit(rows, {**{lr.threshold: 0.0}, lr.threshold: 1.0, lr.probabilityCol: "my_probability"})
    return model.transform(rows).where(F.col("my_probability").isNotNull()).select("o_orderkey", "prediction")


@plan("O7 O8 A1 A12", oracle="""
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')
                            THEN 'yes' ELSE 'no' END AS predicted_label FROM orders""")
def job_recovers_rule(t: Tables) -> DataFrame:
    """CSV training job, saved pipeline and CSV scoring job on a rule over two text columns."""
    rule = (F.col("o_orderstatus") == "F") & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    table = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice",
                            F.when(rule, "yes").otherwise("no").alias("answer"))
    source, model, out = (scratch_path(t.spark, n) for n in ("rule-csv", "rule-model", "rule-scored"))
    delimited.write_csv(table, source)
    jobs.train_job(t.spark, source, model, kind="classification", learner="decision_tree", key="o_orderkey",
                   params={"maxDepth": 6}, schema=table.schema)
    return jobs.score_job(t.spark, source, out, model, schema=table.schema).select("o_orderkey", "predicted_label")


def _by_command(t: Tables, learner_name: str, table: DataFrame, *options: str) -> DataFrame:
    """A table written as CSV, trained on by command with the learner's default grid, and scored by command."""
    source, model, out = (scratch_path(t.spark, n) for n in ("command-csv", "command-model", "command-scored"))
    delimited.write_csv(table, source)
    command.run(["train", learner_name, source, model, *options], t.spark)
    command.run(["score", source, out, model], t.spark)
    return delimited.read_csv(t.spark, out, header=True, infer=True)


def _sized_parts(t: Tables) -> DataFrame:
    """Parts far apart in size on both sides of a gap, with a label that the size decides."""
    size = F.when(F.col("p_size") > 25, F.col("p_size") + 30).otherwise(F.col("p_size") - 30)
    return t.part.select("p_partkey", size.alias("size"), F.when(F.col("p_size") > 25, "large").otherwise("small").alias("answer"))


_SIZED = """SELECT p_partkey, CASE WHEN p_size > 25 THEN 'large' ELSE 'small' END AS predicted_label FROM part"""


@plan("O7 O8 O4 I3 A1 A12", oracle=_SIZED)
def logistic_by_command(t: Tables) -> DataFrame:
    return _by_command(t, "logistic", _sized_parts(t), "--key", "p_partkey") \
        .select(big("p_partkey").alias("p_partkey"), "predicted_label")


@plan("O7 O8 O4 A1 A12", oracle=_SIZED)
def svm_by_command(t: Tables) -> DataFrame:
    return _by_command(t, "svm", _sized_parts(t), "--key", "p_partkey", "--folds", "2", "--param", "maxIter=10") \
        .select(big("p_partkey").alias("p_partkey"), "predicted_label")


@plan("O7 O8 O4 K1 N12", oracle="""
    SELECT p_partkey, count(*) FILTER (p_size > 25) OVER () AS large, p_size > 25 AS is_large,
           CASE WHEN p_size > 25 THEN count(*) FILTER (p_size > 25) OVER () ELSE count(*) FILTER (p_size <= 25) OVER () END AS together
    FROM part""")
def kmeans_by_command(t: Tables) -> DataFrame:
    """Clusters of the same parts; every row with the size of its cluster and of the large parts' cluster."""
    table = _sized_parts(t).select("p_partkey", "size")
    found = _by_command(t, "kmeans", table, "--key", "p_partkey", "--label", "p_partkey", "--param", "seed=1")
    found = materialise(found.select(big("p_partkey").alias("p_partkey"), "prediction", (F.col("size") > 25).alias("is_large")), "scored")
    sizes = found.groupBy("prediction").agg(F.count("*").alias("together"))
    large = found.agg(F.count_if("is_large")).scalar()
    return found.join(F.broadcast(sizes.limit(100)), "prediction").select("p_partkey", large.alias("large"), "is_large", "together")


_LANGUAGE = "SELECT doc_id, (lang = 'fr')::INT::DOUBLE AS prediction FROM documents"


def _french(t: Tables) -> DataFrame:
    return spread(t.documents.select("doc_id", "text", (F.col("lang") == "fr").cast("double").alias("label")), "doc_id")


@plan("O10 O1 H5 H7", oracle=_LANGUAGE)
def language_by_tf_idf(t: Tables) -> DataFrame:
    """Whether a document is French, learned from its words."""
    rows = _french(t)
    return jobs.tf_idf_classifier(max_iter=100, reg=0.0, unit=True).fit(rows).transform(rows) \
        .select("doc_id", "prediction")


@plan("F1 O6 N10 J11", oracle="""
    WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
    r AS (SELECT q.vec_id, q.label, b.label AS y, row_number() OVER (PARTITION BY q.vec_id
              ORDER BY list_distance(q.v, b.v), b.vec_id) AS rank FROM e q JOIN e b ON q.vec_id <> b.vec_id),
    p AS (SELECT k, vec_id, label, avg(y) AS m FROM r, (SELECT unnest([1, 3, 9]) AS k) WHERE rank <= k GROUP BY ALL)
    SELECT k::BIGINT AS k, round(sqrt(avg((label - m) ** 2)), 6) AS rmse FROM p GROUP BY k ORDER BY 2 LIMIT 1""")
def knn_sweep_best(t: Tables) -> DataFrame:
    """Neighbour counts compared by leave-one-out error; the best setting."""
    rows = t.embeddings.select("vec_id", F.col("label").cast("double").alias("label"),
                               F.col("embedding").alias("features"))
    results = []
    for k in (1, 3, 9):
        scored = KNNRegression(k=k, idCol="vec_id", excludeSelf=True).fit(rows).transform(rows)
        results.append((k, float(regression_errors(scored).first().rmse)))
    return t.spark.createDataFrame(results, "k bigint, rmse double").orderBy("rmse").limit(1) \
        .withColumn("rmse", r6("rmse"))
