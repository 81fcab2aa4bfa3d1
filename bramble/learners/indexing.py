"""Category indexing with a value table of any size, as a pipeline stage."""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasHandleInvalid, HasInputCol, HasOutputCol
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
                             MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bramble.operators.ranking import number_values
from bramble.session import materialise

#: a value with more than one in HOT rows is joined by broadcast; there are HOT of them at most
HOT = 1000


class _TableParams(HasInputCol, HasOutputCol, HasHandleInvalid):
    order = Param(Params._dummy(), "order", "frequencyDesc (ties in alphabetical order) or alphabetAsc",
                  typeConverter=TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(order="frequencyDesc", handleInvalid="error")

    def setParams(self, **kwargs):
        return self._set(**kwargs)


class TableIndexer(Estimator, _TableParams, DefaultParamsWritable, DefaultParamsReadable):
    """Numbers the distinct values of a column from 0; the table stays distributed, whatever its size.

    Results equal those of Spark's indexer with the same order, which holds all values on the
    driver. Nulls are invalid values.
    """

    def __init__(self, **kwargs):
        super().__init__()
        self._set(**kwargs)

    def _fit(self, dataset: DataFrame) -> "TableIndexerModel":
        value = F.col(self.getInputCol()).cast("string").alias("value")
        counts = dataset.select(value).where("value is not null").groupBy("value").agg(F.count("*").alias("n"))
        table = materialise(number_values(counts, "value", by_count=self.getOrDefault(self.order) == "frequencyDesc"),
                            "values")
        model = TableIndexerModel(table)
        model._resetUid(self.uid)
        return self._copyValues(model)


class TableIndexerModel(Model, _TableParams, MLWritable, MLReadable):
    """Adds the index as a double. Unknown values raise, go to one further index (``keep``) or lose their row (``skip``)."""

    def __init__(self, table: DataFrame | None = None):
        super().__init__()
        self.table = table          # value, n, index

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out, mode = self.getOutputCol(), self.getOrDefault(self.handleInvalid)
        total, known = self.table.agg(F.sum("n"), F.count("*")).first()
        named = self.table.select(F.col("value").alias("_table_value"), F.col("n").alias("_table_n"),
                                  F.col("index").cast("double").alias(out))
        hot = F.col("_table_n") > (total or 0) / HOT
        rows = dataset.withColumn("_table_value", F.col(self.getInputCol()).cast("string"))
        # hot values find their index where the row is; the others meet in a shuffle without a large key
        near = rows.join(F.broadcast(named.where(hot).drop("_table_n")), "_table_value", "left")
        far = F.when(F.col(out).isNull(), F.col("_table_value"))
        placed = near.withColumn("_table_far", far).withColumnRenamed(out, "_table_near")
        rare = named.where(~hot).select(F.col("_table_value").alias("_table_far"), F.col(out).alias("_table_cold"))
        found = placed.join(rare, "_table_far", "left") \
            .withColumn(out, F.coalesce("_table_near", "_table_cold"))
        if mode == "skip":
            found = found.where(F.col(out).isNotNull())
        elif mode == "keep":
            found = found.withColumn(out, F.coalesce(out, F.lit(float(known))))
        else:
            unknown = F.raise_error(F.concat(F.lit(f"value without an index in {self.getInputCol()}: "),
                                             F.coalesce("_table_value", F.lit("null"))))
            found = found.withColumn(out, F.when(F.col(out).isNotNull(), F.col(out)).otherwise(unknown.cast("double")))
        return found.select(*dataset.columns, out)

    def write(self) -> MLWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TableReader()


class _TableWriter(MLWriter):
    def __init__(self, model: TableIndexerModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.table.write.parquet(f"{path}/values")


class _TableReader(MLReader):
    def load(self, path: str) -> TableIndexerModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = TableIndexerModel(self.sparkSession.read.parquet(f"{path}/values"))
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        return model
