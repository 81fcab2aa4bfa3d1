"""Nearest-neighbour estimators, jobs and trained models."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from bramble.learners import jobs
from bramble.learners.knn import (KNN, KNNClassificationModel, KNNClassifier, KNNModel, KNNRegression,
                                  KNNRegressionModel)
from bramble.learners.registry import grid, learner
from bramble.operators import neighbours as nb
from bramble.plans.registry import PLANS
from bramble.sources import delimited

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(120):
        y = i % 3
        rows.append((i, float(y), 1.0 + i % 2, [float(v) for v in rng.normal(loc=3 * y, size=3)]))
    return spark.createDataFrame(rows, "id bigint, label double, w double, x array<double>") \
        .withColumn("features", array_to_vector("x")).cache()


def test_neighbour_arrays(points):
    model = KNN(k=4, idCol="id", inputCols=["label"], distanceCol="d", maxDistance=0.5).fit(points)
    rows = model.transform(points).collect()
    assert len(rows) == 120
    for r in rows:
        assert r.neighbors[0].id == r.id and r.d[0] == 0.0 and list(r.d) == sorted(r.d) and max(r.d) <= 0.5
    far = points.withColumn("x", F.array(F.lit(1e3), F.lit(1e3), F.lit(1e3))).withColumn("features", array_to_vector("x"))
    assert all(r.neighbors == [] for r in model.transform(far).collect())


def test_generated_ids(points):
    rows = points.drop("id", "w")
    out = KNNClassifier(k=3).fit(rows).transform(rows)
    assert out.columns[:3] == rows.columns and "_row_id" not in out.columns and out.count() == 120
    assert out.where("prediction = label").count() > 110


def test_votes_and_null_prediction(spark):
    base = spark.createDataFrame([(0, 1.0, [0.0]), (1, 0.0, [1.0]), (2, 2.0, [9.0])], "id bigint, label double, x array<double>") \
        .withColumn("features", array_to_vector("x"))
    model = KNNClassifier(k=2, idCol="id", maxDistance=2.0).fit(base)
    query = spark.createDataFrame([(7, [0.5]), (8, [99.0])], "id bigint, x array<double>").withColumn("features", array_to_vector("x"))
    rows = {r.id: r for r in model.transform(query).collect()}
    assert rows[7].prediction == 0.0 and list(rows[7].probability) == [0.5, 0.5, 0.0]
    assert rows[8].prediction is None
    mean = KNNRegression(k=2, idCol="id").fit(base)
    assert mean.predict([0.4]) == 0.5
    assert [r.prediction for r in mean.transform(query).orderBy("id").collect()] == [0.5, 1.0]


@pytest.mark.parametrize("sizes", [{}, {"topTreeSize": 60, "topTreeLeafSize": 10}])
def test_save_and_load(points, tmp_path, sizes):
    for kind, loaded in ((KNNClassifier, KNNClassificationModel), (KNNRegression, KNNRegressionModel)):
        model = kind(k=3, idCol="id", weightCol="w", **sizes).fit(points)
        path = str(tmp_path / kind.__name__)
        model.write().overwrite().save(path)
        a = model.transform(points).select("id", "prediction").orderBy("id").collect()
        again = loaded.load(path)
        assert again.getOrDefault(again.k) == 3
        assert again.transform(points).select("id", "prediction").orderBy("id").collect() == a
    model = KNN(k=2, idCol="id").fit(points)
    model.write().overwrite().save(str(tmp_path / "knn"))
    assert KNNModel.load(str(tmp_path / "knn")).transform(points).count() == 120


def test_inside_pipeline_and_cross_validation(points, tmp_path):
    stage = KNNClassifier(k=3, idCol="id", featuresCol="scaled")
    pipe = Pipeline(stages=[StandardScaler(inputCol="features", outputCol="scaled"), stage])
    search = CrossValidator(estimator=pipe, estimatorParamMaps=grid(stage, {"k": (1, 5)}), numFolds=2, seed=1,
                            evaluator=MulticlassClassificationEvaluator(metricName="accuracy"))
    best = search.fit(points)
    assert min(best.avgMetrics) > 0.9
    path = str(tmp_path / "pipe")
    best.bestModel.write().overwrite().save(path)
    assert PipelineModel.load(path).transform(points).where("prediction = label").count() > 110


def test_approximate_mode_estimates_margin(points):
    model = KNNClassifier(k=3, idCol="id", exact=False, topTreeSize=80, topTreeLeafSize=10).fit(points)
    assert model.getOrDefault(model.bufferSize) > 0
    assert model.transform(points).where("prediction = label").count() > 100


def test_parameter_checks(points):
    for bad in ({"k": 0}, {"bufferSize": -2.0}, {"bufferSizeSampleSizes": [5]}):
        with pytest.raises(ValueError):
            KNN(idCol="id", **bad).fit(points)


def test_k_can_be_raised_after_the_fit(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(10_000, 3)).round(1)      # many copies
    rows = spark.createDataFrame([(i, Vectors.dense(p)) for i, p in enumerate(x)], ["id", "features"])
    model = KNN(k=3, idCol="id", distanceCol="d").fit(rows)
    out = model.setParams(k=9).transform(rows.where("id < 30")).collect()
    for r in out:
        dist = np.sqrt(((x - x[r.id]) ** 2).sum(1))
        want = sorted((d, i) for i, d in enumerate(dist))[:9]
        assert [n["id"] for n in r.neighbors] == [i for _, i in want]


def test_stored_index_is_scored_without_a_shuffle_of_its_vectors(spark, tmp_path):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(300, 3)), 1e-3 * rng.normal(size=(700, 3))])
    rows = spark.createDataFrame([(i, Vectors.dense(p)) for i, p in enumerate(x)], ["id", "features"])
    model = KNN(k=3, idCol="id", topTreeSize=60, topTreeLeafSize=10, blockRows=40, distanceCol="d").fit(rows)
    path = str(tmp_path / "stored")
    model.write().overwrite().save(path)
    again = KNNModel.load(path)
    assert again._index.leaves is not None
    few = rows.where("id % 10 = 0")
    order = [r.neighbors for r in model.transform(few).orderBy("id").collect()]
    assert [r.neighbors for r in again.transform(few).orderBy("id").collect()] == order
    routed = few.select(F.col("id").alias("qid"), vector_to_array("features").alias("vec"),
                        F.lit(1.0).alias("bound"), F.lit(0).cast("bigint").alias("leaf"))
    plan = nb._scan(again._index, routed, k=3, limit=1.0)._jdf.queryExecution().executedPlan().toString()
    sides = plan[plan.index("FlatMapCoGroupsInArrow"):]
    assert sides.count("Exchange hashpartitioning(leaf") == 1 and "Bucketed: true" in sides


def test_csv_jobs(spark, points, tmp_path):
    table = points.select("id", F.col("x")[0].alias("a"), F.col("x")[1].alias("b"),
                          F.when(F.col("label") == 0, "red").otherwise("blue").alias("tint"),
                          F.concat(F.lit("class"), F.col("label").cast("int")).alias("kind"))
    src, model, out = (str(tmp_path / n) for n in ("src", "model", "out"))
    delimited.write_csv(table, src)
    for name, params in (("decision_tree", {}), ("knn", {"k": 3})):
        report = jobs.train_job(spark, src, model, kind="classification", learner=name, key="id", params=params)
        assert report.metric == "accuracy" and report.value > 0.8
    scored = jobs.score_job(spark, src, out, model, single_file=True)
    assert scored.columns == [*table.columns, "prediction", "predicted_label"]
    assert scored.where("kind = predicted_label").count() > 100
    everything = jobs.fit_table(spark.read.csv(src, header=True, inferSchema=True), kind="classification",
                                learner="decision_tree", key="id", index="all", params={"maxBins": 256})
    assert 0 <= everything.value <= 1


def test_unknown_learner():
    with pytest.raises(ValueError):
        learner("classification", "nope")


def accuracy(spark, name):
    df = PLANS[name](spark, SMALL)
    return df.where("label = prediction").count() / df.count()


@pytest.mark.parametrize("name,least", [("logistic_multinomial", 0.5), ("linear_svm", 0.6), ("decision_tree", 0.8),
                                        ("random_forest", 0.7), ("boosted_trees", 0.8),
                                        ("boosted_trees_squared_loss", 0.8), ("one_vs_rest", 0.6)])
def test_classifiers_learn(spark, name, least):
    assert accuracy(spark, name) >= least


def test_training_invariants(spark):
    history = [r.objective for r in PLANS["training_history"](spark, SMALL).orderBy("iteration").collect()]
    assert all(b <= a + 1e-9 for a, b in zip(history, history[1:]))
    weights = PLANS["feature_importance"](spark, SMALL).agg(F.sum("importance")).first()[0]
    assert abs(weights - 1) < 1e-9
    q = PLANS["survival_regression"](spark, SMALL)
    assert q.where("not (q30 <= q60)").count() == 0
    exact = {(r.a_id, r.b_id) for r in PLANS["euclid_range_join"](spark, SMALL).collect()}
    lsh = {(r.a_id, r.b_id) for r in PLANS["lsh_euclid_join"](spark, SMALL).collect()}
    assert lsh <= exact


def test_language_of_short_texts_with_words_of_one_slot(spark):
    """A French and an English word of one slot among 2**14, each the whole of a text."""
    from pyspark.ml.feature import HashingTF
    from bramble.plans.concepts import language_by_tf_idf
    small, seen, pair = HashingTF(numFeatures=1 << 14), {}, None
    for word in (f"w{i}" for i in range(2000)):
        other = seen.setdefault(small.indexOf(word), word)
        if other != word:
            pair = other, word
            break
    texts = [(0, pair[0], "fr"), (1, pair[1], "en"), (2, "le chat noir " * 50, "fr"), (3, "the black cat " * 50, "en")]
    table = type("Rows", (), {"documents": spark.createDataFrame(texts, "doc_id bigint, text string, lang string")})
    assert {r.doc_id: r.prediction for r in language_by_tf_idf(table).collect()} == {0: 1.0, 1: 0.0, 2: 1.0, 3: 0.0}


def test_word_vectors_do_not_grow_with_the_words(spark, monkeypatch):
    """Every word has a vector, of its own but for words that share both slots; the model holds slots only."""
    from bramble.functions import text
    monkeypatch.setattr(text, "WORD_SLOTS", 64)
    df = spark.createDataFrame([(i, [f"w{i}", f"w{i + 1}", "common"]) for i in range(500)] + [(500, [])],
                               "id int, words array<string>")
    model = text.word_vector_stage(df, "words", "v", size=5, maxIter=1, seed=1).fit(df)
    assert [s.getVectors().count() <= 64 for s in model.stages if hasattr(s, "getVectors")] == [True, True]
    vectors = {r.word: r.vector.toArray() for r in text.word_vectors(model, df, "words", "v").collect()}
    assert len(vectors) == 502 and all(len(v) == 5 for v in vectors.values())
    assert len({tuple(v) for v in vectors.values()}) > 400
    assert model.transform(df).columns == ["id", "words", "v"]
    for r in model.transform(df).where("id in (0, 500)").collect():
        mean = sum(vectors[w] for w in r.words) / len(r.words) if r.words else 0.0
        assert abs(r.v.toArray() - mean).max() < 1e-6
