"""Exact deduplication as a stateful stream (operator 4).

The documents are read as a file stream. Its only stateful step keeps, per digest of the normalised
text, the row count and the best row seen so far (stable identifier and content locator) in the
disk-backed state store, without a watermark, so nothing expires. Digests are combined within each
task before they reach the state, so a text that holds a third of all rows sends one row per task.
The state is read back as a table when the stream has caught up. Then every row of a digest that
occurred more than once is compared byte by byte with the row that its class keeps.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bramble.llm.common import PLACE, SPACE, addressable, join_by_weight, text_of
from bramble.session import materialise, owned, scratch_path

#: copies compared with one replica of their kept text
COPIES_PER_REPLICA = 256

#: state on disk, with one bounded memory for an executor's partitions, and no room reserved ahead
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "4",  # an open store reserves an eighth at least
    "spark.sql.streaming.stateStore.maintenanceInterval": "5s",  # closes the stores of a stream that has ended
}


def normalised(text: str) -> Column:
    return F.regexp_replace(text_of(text), SPACE + "+", "")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _located(df: DataFrame, doc_id: str, text: str, digest: Callable[[Column], Column]) -> DataFrame:
    return df.select(F.col(doc_id).alias("doc_id"), normalised(text).alias("norm"),
                     F.length(text_of(text)).alias("chars"),
                     F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")) \
        .withColumn("digest", digest(F.col("norm")))


def digest_state(spark: SparkSession, path: str, checkpoint: str, *, doc_id: str = "doc_id", text: str = "text",
                 files_per_batch: int = 1000, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """Run the stream over the Parquet files at ``path`` until it has caught up and return its state.

    One row per digest: ``digest, size, keep`` with keep the struct of code points, negated id and
    locator of the row that stays. A later call with the same checkpoint reads new files only.
    """
    schema = spark.read.parquet(path).schema
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch) \
        .parquet(path if path.endswith("/") else path[:-1] + f"[{path[-1]}]")  # a pattern may name one file
    rows = _located(source, doc_id, text, digest)
    states = rows.groupBy("digest").agg(
        F.count("*").alias("size"),
        F.max(F.struct("chars", (-F.col("doc_id")).alias("below"), "file", "row")).alias("keep"))
    before = {key: spark.conf.get(key, None) for key in STATE_STORE}
    for key, value in STATE_STORE.items():
        spark.conf.set(key, value)
    try:
        query = states.writeStream.outputMode("update").format("noop") \
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    query.awaitTermination()
    found = spark.read.format("statestore").load(checkpoint)
    size, keep = (F.col("value")[f] for f in found.schema["value"].dataType.names)
    return found.select(F.col("key.digest").alias("digest"), size.alias("size"), keep.alias("keep"))


def exact_classes(spark: SparkSession, path: str, *, doc_id: str = "doc_id", text: str = "text",
                  files_per_batch: int = 1000, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """Class of every row: ``doc_id, file, row, digest, keep_id, group_size, kept``.

    Texts are equal when identical without ASCII white space; a null text counts as empty. Of equal
    texts the row with the most code points stays, then the smallest id (a null id comes last); of
    fully tied rows exactly one. Other columns, also those named like the ones added here, are
    ignored. Rows of one digest whose bytes differ are put into classes by their full texts.
    """
    state = materialise(digest_state(spark, path, owned(scratch_path(spark, "dedup")), doc_id=doc_id, text=text,
                                     files_per_batch=files_per_batch, digest=digest), "digests")
    full = _located(spark.read.parquet(path), doc_id, text, digest)
    rows = materialise(full.select("doc_id", "file", "row", "digest"), "rows")
    total = rows.count()
    same_row = (F.col("file") == F.col("keep.file")) & (F.col("row") == F.col("keep.row"))
    classes = join_by_weight(rows, state, "digest", "size", total)
    collided = _collided(full, state.where("size > 1"), same_row, total)
    if not collided.isEmpty():
        by_text = full.join(collided, "digest", "left_semi").groupBy("digest", "norm").agg(
            F.count("*").alias("size"),
            F.max(F.struct("chars", (-F.col("doc_id")).alias("below"), "file", "row")).alias("keep"))
        split = full.join(collided, "digest", "left_semi").join(by_text, ["digest", "norm"]) \
            .select(*classes.columns)
        classes = classes.join(collided, "digest", "left_anti").unionByName(split)
    return classes.select("doc_id", "file", "row", "digest", (-F.col("keep.below")).alias("keep_id"),
                          F.col("size").alias("group_size"), same_row.alias("kept"))


def _collided(full: DataFrame, repeated: DataFrame, same_row: Column, total: int) -> DataFrame:
    """Digests with two different texts: each hit is compared with a replica of its kept row's text."""
    members = materialise(join_by_weight(full, repeated, "digest", "size", total)
                          .select("digest", "size", "norm", "file", "row", same_row.alias("kept")), "hits")
    replicas = F.ceil(F.col("size") / COPIES_PER_REPLICA).cast("int")
    copies = members.where("not kept").withColumn("replica", F.pmod(F.hash("file", "row"), replicas))
    stays = members.where("kept").select("digest", F.col("norm").alias("kept_norm"),
                                         F.explode(F.sequence(F.lit(0), replicas - 1)).alias("replica"))
    return materialise(copies.join(stays, ["digest", "replica"]).where("norm <> kept_norm")
                       .select("digest").distinct(), "collided")


def keep_first(content: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``content`` that stay, all columns; the content is written once to be addressable.

    Null texts count as empty, of equal texts the longest original stays, then the row of smallest id
    (null last), of fully tied rows exactly one. Ids must be numbers.
    """
    spark = content.sparkSession
    path = owned(scratch_path(spark, "content"))
    content.write.parquet(path)
    stay = exact_classes(spark, path, doc_id=doc_id, text=text).where("kept").select(
        F.col("file").alias(PLACE[0]), F.col("row").alias(PLACE[1]))
    held = addressable(spark.read.schema(content.schema).parquet(path), stored=True)
    return held.join(stay, list(PLACE), "left_semi").select(*content.columns)
