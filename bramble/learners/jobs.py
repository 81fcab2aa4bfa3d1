"""Generic training and scoring jobs over CSV tables, and text classification pipelines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import (ClusteringEvaluator, Evaluator, MulticlassClassificationEvaluator,
                                   RegressionEvaluator)
from pyspark.ml.feature import (HashingTF, IDF, IndexToString, Normalizer, StandardScaler, StringIndexer, Tokenizer,
                                VectorAssembler)
from pyspark.ml.tuning import TrainValidationSplit
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from bramble.functions.text import word_vector_stage
from bramble.learners.indexing import TableIndexer
from bramble.learners.registry import grid as make_grid
from bramble.learners.registry import learner as make_learner
from bramble.operators.sampling import split_by_key, unit_hash
from bramble.session import materialise
from bramble.sources.delimited import read_csv, write_csv

#: values of a column that Spark's indexer holds on the driver; wider columns get a table, with the same numbers
DRIVER_CATEGORIES = 100_000


@dataclass(frozen=True)
class TrainReport:
    model: PipelineModel
    metric: str
    value: float
    grid_values: tuple[float, ...]


def feature_stages(df: DataFrame, columns: Sequence[str], index: str = "strings") -> list:
    """Index, assemble and standardise. ``index="all"`` also treats numbers as categories."""
    text = [c for c in columns if index == "all" or isinstance(df.schema[c].dataType, StringType)]
    sizes = df.agg(*[F.approx_count_distinct(c).alias(c) for c in text]).first().asDict() if text else {}
    wide = [c for c in text if sizes[c] > DRIVER_CATEGORIES]
    stages = [TableIndexer(inputCol=c, outputCol=f"{c}_index", handleInvalid="keep") for c in wide]
    narrow = [c for c in text if c not in wide]
    if narrow:
        stages.append(StringIndexer(inputCols=narrow, outputCols=[f"{c}_index" for c in narrow],
                                    handleInvalid="keep"))
    inputs = [f"{c}_index" if c in text else c for c in columns]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="raw_features", handleInvalid="error"))
    stages.append(StandardScaler(inputCol="raw_features", outputCol="features"))
    return stages


def evaluator_for(kind: str, label: str) -> Evaluator:
    if kind == "classification":
        return MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    if kind == "regression":
        return RegressionEvaluator(labelCol=label, metricName="rmse")
    return ClusteringEvaluator(featuresCol="features")


def prepared_folds(df: DataFrame, preparation: Sequence, key: str | None, folds: int, seed: int = 0,
                   keep: Sequence[str] = ()) -> list[tuple[DataFrame, DataFrame]]:
    """Written train and validation tables of every fold.

    The preparation is fitted on each fold's training rows only and applied once; every setting of
    a learner then reads the same two tables. With a key the fold follows its hash.
    """
    unit = unit_hash(key, seed=seed) if key else F.rand(seed)
    # drawn once, so that a row keeps its fold in every reading
    dealt = materialise(df.withColumn("_fold", F.least(F.floor(unit * folds), F.lit(folds - 1)).cast("int")), "folds")
    out = []
    for fold in range(folds):
        train, rest = dealt.where(F.col("_fold") != fold), dealt.where(F.col("_fold") == fold)
        ready = Pipeline(stages=list(preparation)).fit(train)
        columns = list(keep) or ready.transform(rest).drop("_fold").columns
        out.append(tuple(materialise(ready.transform(part).select(*columns), "fold") for part in (train, rest)))
    return out


def cross_validate(folds: Sequence[tuple[DataFrame, DataFrame]], stage, settings: Sequence[Mapping], judge: Evaluator,
                   parallelism: int = 2) -> list[float]:
    """Mean measure of every setting over prepared folds; settings are fitted side by side."""
    def run(setting: Mapping) -> float:
        values = [judge.evaluate(stage.fit(train, dict(setting)).transform(rest)) for train, rest in folds]
        return sum(values) / len(values)

    with ThreadPool(parallelism) as pool:
        return pool.map(inheritable_thread_target(folds[0][0].sparkSession)(run), list(settings))


def search_text_settings(df: DataFrame, key: str, hashing: Mapping[str, Sequence[Any]], fitting: Mapping[str, Sequence[Any]], *,
                         label: str = "label", text: str = "text", folds: int = 3, metric: str = "accuracy", max_iter: int = 20,
                         seed: int = 0, parallelism: int = 2) -> list[tuple[dict[str, Any], float]]:
    """Every setting of the text pipeline with its mean measure over the folds.

    Texts are tokenised once, hashed and weighted once per fold and hashing setting; the learner's
    settings share those tables.
    """
    words = materialise(Tokenizer(inputCol=text, outputCol="words").transform(df).select(key, "words", label), "words")
    tf = HashingTF(inputCol="words", outputCol="tf")
    stage = make_learner("classification", "logistic", labelCol=label, maxIter=max_iter)
    settings, out = make_grid(stage, fitting), []
    judge = MulticlassClassificationEvaluator(labelCol=label, metricName=metric)
    for chosen in make_grid(tf, hashing):
        tables = prepared_folds(words, [tf.copy(chosen), IDF(inputCol="tf", outputCol="features")], key, folds, seed,
                                keep=("features", label))
        for setting, value in zip(settings, cross_validate(tables, stage, settings, judge, parallelism)):
            named = {p.name: v for p, v in (*chosen.items(), *setting.items())}
            out.append((named, float(value)))
    return out


def fit_table(df: DataFrame, *, kind: str, learner: str, label: str | None = None,
              features: Sequence[str] | None = None, settings: Mapping[str, Sequence[Any]] | None = None,
              params: Mapping[str, Any] | None = None, folds: int = 3, parallelism: int = 2,
              index: str = "strings", key: str | None = None, train: float = 0.8,
              seed: int = 0) -> TrainReport:
    """Split, search a parameter grid by cross-validation and score the best model on held-out rows.

    The label defaults to the last column and the features to all others but ``key``. With a key
    the split follows its hash, otherwise the seed.
    """
    label = label or df.columns[-1]
    features = [c for c in (features or df.columns) if c not in (label, key)]
    if key:
        fit_rows, held_out = split_by_key(df, key, train, seed)
    else:
        fit_rows, held_out = df.randomSplit([train, 1 - train], seed)
    options = dict(params or {})
    if key and learner == "knn":
        options.setdefault("idCol", key)
    stages = feature_stages(df, features, index)
    target = label
    if kind == "classification":
        labels = StringIndexer(inputCol=label, outputCol="label_index").fit(df)
        stages.insert(0, labels)
        target = "label_index"
        options["labelCol"] = target
    elif kind == "regression":
        options["labelCol"] = label
    options["featuresCol"] = "features"
    before = list(stages)
    model_stage = make_learner(kind, learner, **options)
    stages.append(model_stage)
    if kind == "classification":
        stages.append(IndexToString(inputCol="prediction", outputCol="predicted_label",
                                    labels=labels.labels))
    pipeline = Pipeline(stages=stages)
    judge = evaluator_for(kind, target)
    fit_rows = materialise(fit_rows, "train")      # every fold and setting reads it again
    values: tuple[float, ...] = ()
    if settings:
        options = make_grid(model_stage, settings)
        tables = prepared_folds(fit_rows, before, key, folds, seed)
        values = tuple(cross_validate(tables, model_stage, options, judge, parallelism))
        best_at = (max if judge.isLargerBetter() else min)(range(len(values)), key=values.__getitem__)
        pipeline = pipeline.copy(options[best_at])
    best = pipeline.fit(fit_rows)
    name = judge.getMetricName()
    return TrainReport(best, name, judge.evaluate(best.transform(held_out)), values)


def train_job(spark: SparkSession, source: str, model_out: str, *, schema: StructType | str | None = None,
              **options: Any) -> TrainReport:
    """CSV with header to a saved pipeline; indexers are part of the pipeline."""
    df = read_csv(spark, source, header=True, schema=schema, infer=schema is None)
    report = fit_table(df, **options)
    report.model.write().overwrite().save(model_out)
    return report


def score_job(spark: SparkSession, source: str, out: str, model: str, *,
              schema: StructType | str | None = None, single_file: bool = False) -> DataFrame:
    """Score a CSV table with a saved pipeline; input columns and predictions are written as CSV."""
    df = read_csv(spark, source, header=True, schema=schema, infer=schema is None)
    scored = PipelineModel.load(model).transform(df)
    shown = [c for c in ("prediction", "predicted_label") if c in scored.columns]
    result = scored.select(*df.columns, *shown)
    write_csv(result, out, single_file=single_file)
    return read_csv(spark, out, header=True, schema=result.schema)


def tf_idf_classifier(*, label: str = "label", text: str = "text", slots: int = 1 << 18,
                      max_iter: int = 20, reg: float = 0.01, unit: bool = False) -> Pipeline:
    """Tokens, hashed counts, inverse document frequency, logistic regression.

    ``unit`` scales every document to length one, so that a short text weighs as much as a long one.
    """
    scaled = [Normalizer(inputCol="weights", outputCol="features")] if unit else []
    return Pipeline(stages=[
        Tokenizer(inputCol=text, outputCol="words"),
        HashingTF(inputCol="words", outputCol="tf", numFeatures=slots),
        IDF(inputCol="tf", outputCol="weights" if unit else "features"), *scaled,
        make_learner("classification", "logistic", labelCol=label, maxIter=max_iter, regParam=reg)])


def word_vector_classifier(df: DataFrame, *, label: str, text: str = "text", size: int = 100,
                           hidden: Sequence[int] = (6, 5), max_iter: int = 100, block: int = 128,
                           seed: int = 1234) -> Pipeline:
    """Label index, mean word vectors, multilayer perceptron, label text."""
    labels = StringIndexer(inputCol=label, outputCol="label_index").fit(df)
    return Pipeline(stages=[
        labels, Tokenizer(inputCol=text, outputCol="words"),
        word_vector_stage(df, "words", "features", size=size, seed=seed),
        make_learner("classification", "perceptron", labelCol="label_index", blockSize=block,
                     layers=[size, *hidden, max(2, len(labels.labels))], maxIter=max_iter, seed=seed),
        IndexToString(inputCol="prediction", outputCol="predicted_label", labels=labels.labels)])


def holdout_tuning(pipeline, settings, judge: Evaluator, *, train: float = 0.8, parallelism: int = 2,
                   seed: int = 0) -> TrainValidationSplit:
    """Parameter search on one train/validation split."""
    return TrainValidationSplit(estimator=pipeline, estimatorParamMaps=settings, evaluator=judge,
                                trainRatio=train, parallelism=parallelism, seed=seed)
