"""Nearest-neighbour estimators: neighbour lookup, classification by votes, regression by means."""

from __future__ import annotations

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (HasFeaturesCol, HasInputCols, HasLabelCol, HasPredictionCol,
                                     HasProbabilityCol, HasRawPredictionCol, HasSeed, HasWeightCol)
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable,
                             DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bramble.operators import neighbours as nb
from bramble.operators.stats import class_count
from bramble.session import materialise

_ROW_ID = "_row_id"
_AUX_LABEL, _AUX_WEIGHT = "_label", "_weight"


def _param(name: str, doc: str, convert):
    return Param(Params._dummy(), name, doc, typeConverter=convert)


class NeighbourParams(HasFeaturesCol, HasSeed, HasInputCols):
    """Parameters shared by all nearest-neighbour estimators and models."""

    k = _param("k", "number of neighbours", TypeConverters.toInt)
    idCol = _param("idCol", "row key; empty numbers the rows once", TypeConverters.toString)
    neighborsCol = _param("neighborsCol", "output array of neighbours", TypeConverters.toString)
    distanceCol = _param("distanceCol", "output array of distances; empty leaves it out", TypeConverters.toString)
    maxDistance = _param("maxDistance", "largest distance of a neighbour, inclusive", TypeConverters.toFloat)
    excludeSelf = _param("excludeSelf", "skip the base row with the query's own key", TypeConverters.toBoolean)
    exact = _param("exact", "search every cell that can hold a neighbour", TypeConverters.toBoolean)
    bufferSize = _param("bufferSize", "approximate mode: twice the routing margin, -1 to estimate it",
                        TypeConverters.toFloat)
    bufferSizeSampleSizes = _param("bufferSizeSampleSizes", "sample sizes of the margin estimate",
                                   TypeConverters.toListInt)
    topTreeSize = _param("topTreeSize", "rows sampled for pivots", TypeConverters.toInt)
    topTreeLeafSize = _param("topTreeLeafSize", "sampled rows per pivot", TypeConverters.toInt)
    blockRows = _param("blockRows", "largest number of rows compared in one task step", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(k=5, idCol="", neighborsCol="neighbors", distanceCol="",
                         maxDistance=float("inf"), excludeSelf=False, exact=True, bufferSize=-1.0,
                         bufferSizeSampleSizes=list(range(100, 1001, 100)), topTreeSize=1000,
                         topTreeLeafSize=10, blockRows=nb.BLOCK_ROWS, inputCols=[], seed=0)

    def setParams(self, **kwargs):
        return self._set(**kwargs)

    def _num_pivots(self) -> int | None:
        """Tree sizes fix the pivot count; the exact search follows the row count unless they are set."""
        if self.getOrDefault(self.exact) and not (self.isSet(self.topTreeSize) or self.isSet(self.topTreeLeafSize)):
            return None
        return max(1, self.getOrDefault(self.topTreeSize) // self.getOrDefault(self.topTreeLeafSize))

    def _with_id(self, df: DataFrame) -> tuple[DataFrame, str]:
        name = self.getOrDefault(self.idCol)
        if name:
            return df, name
        # generated numbers must not change when a task is retried, hence the written copy
        return materialise(df.withColumn(_ROW_ID, F.monotonically_increasing_id()), "numbered"), _ROW_ID

    def _check(self) -> None:
        if self.getOrDefault(self.k) <= 0 or self.getOrDefault(self.maxDistance) <= 0:
            raise ValueError("k and maxDistance must be positive")
        if self.getOrDefault(self.bufferSize) < -1:
            raise ValueError("bufferSize must be at least -1")
        sizes = self.getOrDefault(self.bufferSizeSampleSizes)
        if len(sizes) < 2 or min(sizes) <= 0:
            raise ValueError("bufferSizeSampleSizes needs two or more positive sizes")


class VoteParams(HasLabelCol, HasWeightCol, HasPredictionCol):
    """Label, weight and prediction columns of the supervised variants."""


class _NeighbourEstimator(Estimator, NeighbourParams, DefaultParamsWritable, DefaultParamsReadable):
    def __init__(self, **kwargs):
        super().__init__()
        self._set(**kwargs)

    def _index(self, df: DataFrame, aux) -> tuple[nb.NeighbourIndex, float]:
        self._check()
        rows, key = self._with_id(df)
        index = nb.build_index(rows, id_col=key, features=self.getFeaturesCol(), aux=aux,
                               num_pivots=self._num_pivots(), seed=self.getSeed(),
                               block_rows=self.getOrDefault(self.blockRows), one_panel=True)
        buffer = self.getOrDefault(self.bufferSize)
        if not self.getOrDefault(self.exact) and buffer < 0:
            buffer = 2 * nb.estimate_tau(rows, id_col=key, features=self.getFeaturesCol(),
                                         sizes=self.getOrDefault(self.bufferSizeSampleSizes),
                                         seed=self.getSeed())
        return index, buffer


class _NeighbourModel(Model, NeighbourParams, MLWritable, MLReadable):
    def __init__(self, index: nb.NeighbourIndex | None = None, num_classes: int = 0):
        super().__init__()
        self._index = index
        self.numClasses = num_classes

    def _adopt(self, estimator, buffer: float):
        self._resetUid(estimator.uid)
        estimator._copyValues(self)
        return self._set(bufferSize=buffer)

    def search(self, rows: DataFrame, key: str) -> DataFrame:
        """Neighbour rows ``(qid, rank, nid, dist, aux...)``."""
        exact = self.getOrDefault(self.exact)
        limit = self.getOrDefault(self.maxDistance)
        return nb.search(self._index, rows, k=self.getOrDefault(self.k), query_id=key,
                         features=self.getFeaturesCol(),
                         max_distance=None if limit == float("inf") else limit,
                         exclude_self=self.getOrDefault(self.excludeSelf),
                         tau=None if exact else self.getOrDefault(self.bufferSize) / 2,
                         block_rows=self.getOrDefault(self.blockRows))

    def _attach(self, rows: DataFrame, key: str, found: DataFrame) -> DataFrame:
        """Left join on the row key: no query row is lost."""
        out = rows.join(found.withColumnRenamed("qid", key), key, "left")
        return out.drop(_ROW_ID) if key == _ROW_ID else out

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader(cls)


class _ModelWriter(MLWriter):
    def __init__(self, model: _NeighbourModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        stored = nb.save_index(self.model._index, path)
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession,
                                         extraMetadata={"index": stored, "numClasses": self.model.numClasses})


class _ModelReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls(nb.load_index(self.sparkSession, path, meta["index"]), meta["numClasses"])
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        return model


# --- neighbour lookup -------------------------------------------------------------------------

class KNN(_NeighbourEstimator):
    """Fits a neighbour index; ``inputCols`` name the base columns returned with each neighbour."""

    def _fit(self, dataset: DataFrame) -> "KNNModel":
        index, buffer = self._index(dataset, tuple(self.getInputCols()))
        return KNNModel(index)._adopt(self, buffer)


class KNNModel(_NeighbourModel):
    """Adds an array of neighbour structs (and of distances), nearest first; empty if none."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        rows, key = self._with_id(dataset)
        near = self.search(rows, key)
        entry = F.struct("rank", "dist", F.struct(F.col("nid").alias("id"), *self._index.aux).alias("row"))
        lists = near.groupBy("qid").agg(F.array_sort(F.collect_list(entry)).alias("_near"))
        kind = lists.schema["_near"].dataType.simpleString()
        out = self._attach(rows, key, lists) \
            .withColumn("_near", F.coalesce("_near", F.array().cast(kind)))
        out = out.withColumn(self.getOrDefault(self.neighborsCol), F.col("_near.row"))
        if self.getOrDefault(self.distanceCol):
            out = out.withColumn(self.getOrDefault(self.distanceCol), F.col("_near.dist"))
        return out.drop("_near")


# --- supervised variants ----------------------------------------------------------------------

class _SupervisedEstimator(_NeighbourEstimator, VoteParams):
    def _labelled(self, dataset: DataFrame) -> DataFrame:
        weight = F.col(self.getWeightCol()) if self._weighted() else F.lit(1.0)
        return dataset.withColumn(_AUX_LABEL, F.col(self.getLabelCol()).cast("double")) \
            .withColumn(_AUX_WEIGHT, weight.cast("double"))

    def _weighted(self) -> bool:
        return self.isDefined(self.weightCol) and bool(self.getOrDefault(self.weightCol))


class KNNClassifier(_SupervisedEstimator, HasProbabilityCol, HasRawPredictionCol):
    """Class of the (weighted) majority of the k nearest rows."""

    def _fit(self, dataset: DataFrame) -> "KNNClassificationModel":
        rows = self._labelled(dataset)
        classes = class_count(rows, _AUX_LABEL)
        index, buffer = self._index(rows, (_AUX_LABEL, _AUX_WEIGHT))
        return KNNClassificationModel(index, classes)._adopt(self, buffer)


class KNNClassificationModel(_NeighbourModel, VoteParams, HasProbabilityCol, HasRawPredictionCol):
    """Votes per class, their shares, and the class with most votes (the lowest on ties).

    Rows without any neighbour get nulls.
    """

    def _transform(self, dataset: DataFrame) -> DataFrame:
        rows, key = self._with_id(dataset)
        votes = F.collect_list(F.struct(F.col(_AUX_LABEL).alias("y"), F.col(_AUX_WEIGHT).alias("w")))
        near = self.search(rows, key).groupBy("qid").agg(votes.alias("_v"))
        tally = F.transform(
            F.sequence(F.lit(0), F.lit(self.numClasses - 1)),
            lambda c: F.aggregate(F.filter("_v", lambda v: v["y"] == c), F.lit(0.0), lambda s, v: s + v["w"]))
        near = near.withColumn("_raw", tally)
        total = F.aggregate("_raw", F.lit(0.0), lambda s, v: s + v)
        share = F.when(total == 0, F.col("_raw")).otherwise(
            F.transform("_raw", lambda v: v / F.when(total != 0, total)))
        found = near.select(
            "qid", array_to_vector("_raw").alias(self.getRawPredictionCol()),
            array_to_vector(share).alias(self.getProbabilityCol()),
            (F.array_position("_raw", F.array_max("_raw")) - 1).cast("double").alias(self.getPredictionCol()))
        return self._attach(rows, key, found)


class KNNRegression(_SupervisedEstimator):
    """Weighted mean label of the k nearest rows."""

    def _fit(self, dataset: DataFrame) -> "KNNRegressionModel":
        index, buffer = self._index(self._labelled(dataset), (_AUX_LABEL, _AUX_WEIGHT))
        return KNNRegressionModel(index)._adopt(self, buffer)


class KNNRegressionModel(_NeighbourModel, VoteParams):
    """Adds the weighted mean of the neighbours' labels; null where there is no neighbour."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        rows, key = self._with_id(dataset)
        y, w = F.col(_AUX_LABEL), F.col(_AUX_WEIGHT)
        mean = F.try_divide(F.sum(y * w), F.sum(w)).alias(self.getPredictionCol())
        return self._attach(rows, key, self.search(rows, key).groupBy("qid").agg(mean))

    def predict(self, vector) -> float | None:
        """Unweighted mean over the neighbours of one vector, searched on the cluster."""
        point = [float(v) for v in vector]
        query = self._index.vectors.sparkSession.createDataFrame([(0, point)], "qid bigint, vec array<double>")
        limit = self.getOrDefault(self.maxDistance)
        near = nb.search(self._index, query, k=self.getOrDefault(self.k), query_id="qid", features="vec",
                         max_distance=None if limit == float("inf") else limit)
        return near.agg(F.avg(_AUX_LABEL)).first()[0]
