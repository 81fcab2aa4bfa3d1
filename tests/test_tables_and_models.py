"""Category tables, factorisation, rules, prepared folds, topics and objectives of given models."""

import math

import numpy as np
import pytest
from pyspark.ml import classification as mc
from pyspark.ml import regression as mg
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

from bramble.functions import encode, text
from bramble.learners import jobs
from bramble.learners.indexing import TableIndexer, TableIndexerModel
from bramble.operators import factors, likelihood, patterns, topics
from bramble.plans import training
from bramble.plans.registry import Tables


def test_many_values_are_indexed_as_spark_does(spark, tmp_path):
    rows = spark.range(200_000).select(F.concat(F.lit("v"), "id").alias("c")) \
        .union(spark.range(100_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id") % 50)).alias("c")))
    model = TableIndexer(inputCol="c", outputCol="i").fit(rows)
    out = model.transform(rows)
    assert out.agg(F.count("*"), F.count_distinct("i"), F.max("i")).first()[:] == (300_000, 200_001, 200_000.0)
    want = StringIndexer(inputCol="c", outputCol="w").fit(rows.where("c < 'v2'"))
    part = TableIndexer(inputCol="c", outputCol="i").fit(rows.where("c < 'v2'"))
    assert want.transform(part.transform(rows.where("c < 'v2'"))).where("i <> w").count() == 0
    path = str(tmp_path / "values")
    model.write().overwrite().save(path)
    again = TableIndexerModel.load(path)
    assert again.transform(rows.limit(50)).exceptAll(model.transform(rows.limit(50))).count() == 0
    assert encode.dictionary(rows, "c").agg(F.max("index"), F.count("*")).first()[:] == (200_000, 200_001)


def test_unknown_and_null_values(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "c string")
    model = TableIndexer(inputCol="c", outputCol="i", order="alphabetAsc").fit(df)
    more = spark.createDataFrame([("b", 1), ("z", 2), (None, 3)], "c string, _value int")
    assert {r["_value"]: r.i for r in model.copy({model.handleInvalid: "keep"}).transform(more).collect()} == {1: 1.0, 2: 2.0, 3: 2.0}
    assert [r["_value"] for r in model.copy({model.handleInvalid: "skip"}).transform(more).collect()] == [1]
    with pytest.raises(Exception, match="without an index"):
        model.transform(more).collect()


def test_wide_columns_are_indexed_by_table(spark, monkeypatch):
    monkeypatch.setattr(jobs, "DRIVER_CATEGORIES", 3)
    df = spark.createDataFrame([(f"k{i % 7}", f"s{i % 2}", float(i % 2)) for i in range(60)], "k string, s string, y double")
    stages = jobs.feature_stages(df, ["k", "s"])
    assert [type(s).__name__ for s in stages[:2]] == ["TableIndexer", "StringIndexer"]
    report = jobs.fit_table(df, kind="classification", learner="decision_tree", label="y", params={"maxBins": 10},
                            settings={"maxDepth": (1, 2)}, folds=2)
    assert report.value == 1.0 and len(report.grid_values) == 2


def test_half_step_equals_the_solver(spark):
    rng = np.random.default_rng(4)
    rows = spark.createDataFrame([(int(u), int(i), float(rng.integers(1, 6))) for u in range(20) for i in rng.choice(15, 8, replace=False)],
                                 "user int, item int, rating double")
    model = ALS(rank=3, maxIter=4, regParam=0.2, seed=1, userCol="user", itemCol="item", ratingCol="rating").fit(rows)
    found = factors.half_step(rows, model.itemFactors.withColumnRenamed("id", "item"), 0.2)
    want = {r.id: r.features for r in model.userFactors.collect()}
    for r in found.collect():
        assert np.allclose(r.features, want[r.user], atol=1e-3)


def test_ids_beyond_32_bits(spark):
    rows = spark.createDataFrame([(2 ** 40 + u, f"i{i}", float((u * i) % 5 + 1)) for u in range(12) for i in range(9)],
                                 "user bigint, item string, rating double")
    users, items = factors.factorise(rows, rank=4, maxIter=8, regParam=0.01, seed=1)
    assert users.agg(F.min("user")).first()[0] == 2 ** 40 and items.count() == 9
    joined = rows.join(users.withColumnRenamed("features", "x"), "user").join(items.withColumnRenamed("features", "y"), "item")
    error = F.aggregate(F.zip_with("x", "y", lambda a, b: a * b), F.lit(0.0).cast("double"), lambda s, v: s + v) - F.col("rating")
    assert joined.agg(F.avg(F.abs(error))).first()[0] < 0.5


@pytest.mark.parametrize("few", [100_000, 0])
def test_rules_meet_rows_by_their_rarest_item(spark, monkeypatch, few):
    monkeypatch.setattr(patterns, "FEW_RULES", few)
    monkeypatch.setattr(patterns, "HOT_ROWS", 20)
    baskets = [(k, ["all", f"x{k % 5}"] + (["y"] if k % 7 == 0 else [])) for k in range(200)]
    rules = [(["all"], ["z"]), (["all", "x1"], ["y"]), (["x2", "y", "all"], ["all"]), (["gone", "all"], ["q"]), (["y"], ["x3"])]
    rows = spark.createDataFrame(baskets, "k int, items array<string>")
    table = spark.createDataFrame(rules, "antecedent array<string>, consequent array<string>")
    got = {r.k: r.prediction for r in patterns.apply_rules(rows, "k", table).collect()}
    for k, items in baskets:
        want = sorted({c[0] for a, c in rules if set(a) <= set(items) and c[0] not in items})
        assert got.get(k, []) == want


def test_preparation_is_fitted_on_training_rows_only(spark):
    df = spark.createDataFrame([(i, f"v{i}", float(i % 2)) for i in range(40)], "k int, s string, y double")
    tables = jobs.prepared_folds(df, [StringIndexer(inputCol="s", outputCol="i", handleInvalid="keep")], "k", 4)
    assert sum(rest.count() for _, rest in tables) == 40
    for train, rest in tables:
        n = train.count()
        assert n + rest.count() == 40 and rest.where(F.col("i") != n).count() == 0   # all values are unknown
        assert train.where(F.col("i") >= n).count() == 0


def test_cross_validation_prefers_the_right_setting(spark):
    df = spark.createDataFrame([(i, float(i % 10), float(i % 10 > 4)) for i in range(200)], "k int, x double, label double")
    tables = jobs.prepared_folds(df, [VectorAssembler(inputCols=["x"], outputCol="features")], "k", 3)
    stage = mc.DecisionTreeClassifier()
    values = jobs.cross_validate(tables, stage, [{stage.maxDepth: 0}, {stage.maxDepth: 2}],
                                 MulticlassClassificationEvaluator(metricName="accuracy"))
    assert values[1] == 1.0 and values[0] < 0.7


def test_objectives_equal_sparks(spark):
    rng = np.random.default_rng(5)
    rows = [(float(a), float(b), float(rng.random() < 1 / (1 + math.exp(-a + b)))) for a, b in rng.normal(size=(300, 2))]
    df = spark.createDataFrame(rows, "a double, b double, label double")
    made = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    model = mc.LogisticRegression(regParam=0.0).fit(made)
    got = likelihood.logistic_objective(df, ["a", "b"], model.coefficients, model.intercept).first()
    assert got.n == 300 and abs(got.objective - model.summary.objectiveHistory[-1]) < 1e-6
    assert all(x >= y - 1e-12 for x, y in zip(model.summary.objectiveHistory, model.summary.objectiveHistory[1:]))
    line = mg.LinearRegression(solver="l-bfgs", standardization=False).fit(made.withColumn("label", F.col("a") * 2 - F.col("b") + 1))
    got = likelihood.squared_objective(df.withColumn("label", F.col("a") * 2 - F.col("b") + 1), ["a", "b"], line.coefficients, line.intercept)
    assert got.first().objective < 1e-6


def test_survival_fit_maximises_the_likelihood(spark):
    rng = np.random.default_rng(6)
    rows = []
    for _ in range(400):
        x = float(rng.integers(0, 2))
        time, limit = math.exp(1 + 0.5 * x + 0.7 * math.log(-math.log(rng.random()))), 6.0
        rows.append((x, min(time, limit), float(time <= limit)))
    df = spark.createDataFrame(rows, "x double, label double, censor double")
    made = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    model = mg.AFTSurvivalRegression(quantileProbabilities=[0.3, 0.6], quantilesCol="q", tol=1e-9, maxIter=200).fit(made)

    def value(shift=0.0, scale=1.0):
        return likelihood.survival_likelihood(df, ["x"], [model.coefficients[0] + shift], model.intercept, model.scale * scale).first()[1]

    best = value()
    assert all(best > v for v in (value(0.1), value(-0.1), value(0.0, 1.1), value(0.0, 0.9)))
    q = likelihood.survival_quantiles(["x"], model.coefficients, model.intercept, model.scale, [0.3, 0.6])
    for r in model.transform(made).withColumns({"a": q[0], "b": q[1]}).limit(20).collect():
        assert np.allclose(r.q, [r.a, r.b], rtol=1e-6)


def test_topics_use_every_term(spark):
    df = spark.createDataFrame([(i, ["red", "blue", f"rare{i}"] if i % 2 else ["sun", "moon"]) for i in range(30)] + [(99, [])],
                               "k int, words array<string>")
    rows, stage = topics.hashed_counts(df, "words")
    names = topics.slot_names(df, "words", stage)
    assert names.count() == 4 + 15
    from pyspark.ml.clustering import LDA
    model = LDA(k=2, maxIter=10, seed=3).fit(rows)
    named = topics.named_topics(model, names, 2).collect()
    assert {r.term for r in named} <= {"red", "blue", "sun", "moon"} | {f"rare{i}" for i in range(30)} and all(r.term for r in named)
    shares = topics.mixtures(model, rows, "k")
    assert shares.groupBy("k").agg(F.sum("share").alias("s")).where("abs(s - 1) > 1e-9").count() == 0
    assert {r.share for r in shares.where("k = 99").collect()} == {0.5}


def test_synonyms_are_the_largest_cosines(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(60, 5))
    x[10] = 0
    df = spark.createDataFrame([(f"w{i:02d}", [float(v) for v in p]) for i, p in enumerate(x)], "word string, vector array<double>")
    got = text.synonyms(df, df.where("word in ('w03', 'w07')"), 4).collect()
    unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    for q in (3, 7):
        want = [f"w{i:02d}" for i in np.argsort(-(unit @ unit[q])) if i != q][:4]
        assert [r.word for r in sorted(got, key=lambda r: r["rank"]) if r["query"] == f"w{q:02d}"] == want


def test_likelihood_bound_is_the_models_own(spark, monkeypatch):
    """The bound equals Spark's, which passes over all slots for every document and is not called."""
    from pyspark.ml.clustering import LDA, LDAModel
    words = [["a", "b", "b", "c"], ["c", "d"], ["a"] * 30 + ["e"], [], ["d", "e", "f", "a"] * 5]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "k int, words array<string>")
    rows, _ = topics.hashed_counts(df, "words")
    model = LDA(k=3, maxIter=3, seed=1, subsamplingRate=1.0).fit(rows)
    want = model.logLikelihood(rows), model.logPerplexity(rows)
    for name in ("logLikelihood", "logPerplexity"):
        monkeypatch.setattr(LDAModel, name, None)
    likelihood, tokens = topics.likelihood_bound(model, rows)
    assert tokens == 57 and abs(likelihood / want[0] - 1) < 1e-4 and abs(-likelihood / tokens / want[1] - 1) < 1e-4


def test_likelihood_bound_twice_in_one_process(spark):
    from pyspark.ml.clustering import LDA
    df = spark.createDataFrame([(0, ["a", "b", "b"]), (1, ["b", "c"])], "k int, words array<string>")
    rows, _ = topics.hashed_counts(df, "words")
    model = LDA(k=2, maxIter=2, seed=1, subsamplingRate=1.0).fit(rows)
    assert topics.likelihood_bound(model, rows) == pytest.approx(topics.likelihood_bound(model, rows))


def test_topic_model_learns_from_every_document(spark, tmp_path):
    """Words of one document each all outweigh the slots that no word has."""
    spark.createDataFrame([(i, f"own{i} " * 20) for i in range(40)], "doc_id bigint, text string") \
        .write.parquet(str(tmp_path / "documents.parquet"))
    model, _, docs, stage = training._topic_model(Tables(spark, str(tmp_path)))
    slots = {r.term: r.slot for r in topics.slot_names(docs, "filtered", stage).collect()}
    weights = model.topicsMatrix().toArray().sum(1)
    unused = np.delete(weights, list(slots.values())).max()
    assert len(slots) == 40 and min(weights[list(slots.values())]) > unused


def test_blocks_follow_the_number_of_ratings(spark, monkeypatch):
    """No block has more than its share; few ratings keep the solver's own number."""
    df = spark.range(600).select((F.col("id") % 30).cast("int").alias("user"), (F.col("id") % 20).cast("int").alias("item"),
                                 (F.col("id") % 7).cast("float").alias("rating"))
    assert factors.blocks(df) == {}
    few = ALS(rank=2, maxIter=3, seed=1, itemCol="item", userCol="user", ratingCol="rating")
    want = {r.id: r.features for r in few.fit(df).userFactors.collect()}
    monkeypatch.setattr(factors, "BLOCK_RATINGS", 40)
    settings = factors.blocks(df)
    assert settings["numUserBlocks"] == settings["numItemBlocks"] == 15
    model = few.copy().setParams(**settings).fit(df)
    assert model.userFactors.count() == len(want) == 30
    monkeypatch.setattr(factors, "BLOCK_RATINGS", 100)
    more = few.copy().setParams(**factors.blocks(df)).fit(df)      # ten blocks, whose shuffles are deleted on the way
    assert all(np.allclose(r.features, want[r.id], atol=1e-4) for r in more.userFactors.collect())
