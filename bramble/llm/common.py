"""Pieces that several corpus operators share: word patterns, batches, skew-proof joins, components."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import sys
import types
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bramble.session import materialise

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: a key with more than 1/HEAVY of the rows is joined by broadcast; there are at most HEAVY of them
HEAVY = 1000
#: columns that say where a row is stored
PLACE = ("_bramble_file", "_bramble_row")


def bounded_batches(spark: SparkSession, rows: int = 1000, size: str = "16m") -> None:
    """Keep Arrow batches small, so that a task's memory follows the longest text and not 10,000 texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def id_fold(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % modulus


def carried(doc_id: str) -> Column:
    """An id on its way through pandas, as text: whole numbers beside nulls would become floats there."""
    return F.col(doc_id).cast("string").alias("doc_id")


def worker_store(name: str) -> dict:
    """A dictionary that lives as long as the Python worker; task code is unpickled anew for each task.

    A worker keeps one such store: asking for another name drops what an earlier operator left and
    returns the memory to the system, which the executor's next stage may need.
    """
    holder = sys.modules.setdefault("_bramble_worker", types.ModuleType("_bramble_worker"))
    stores = holder.__dict__.setdefault("stores", {})
    if name not in stores:
        if stores:
            stores.clear()
            gc.collect()
            with contextlib.suppress(OSError, AttributeError):
                ctypes.CDLL(None).malloc_trim(0)
        stores[name] = {}
    return stores[name]


def join_by_weight(rows: DataFrame, table: DataFrame, key: str | list[str], weight: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with a table of one row per key and the key's row count in ``weight``.

    Keys with more than 1/HEAVY of all ``total`` rows number HEAVY at most: those table rows are
    broadcast, so the rows of a hot key stay where they are. The rest meets in a shuffle in which
    no key has more than that share. ``rows`` is read twice and should be a written table.
    """
    hot = table.where(F.col(weight) > total / HEAVY)
    cold = table.where(F.col(weight) <= total / HEAVY)
    keys = [key] if isinstance(key, str) else key
    near = rows.join(F.broadcast(hot), keys)
    far = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys)
    return near.unionByName(far)


def addressable(content: DataFrame, *, stored: bool = False) -> DataFrame:
    """``content`` with the file and row number of every row in the columns PLACE.

    It is written once to the shared folder, unless it is ``stored``: a plain read of whole files.
    """
    held = content if stored else materialise(content, "content")
    return held.select("*", F.col("_metadata.file_path").alias(PLACE[0]), F.col("_metadata.row_index").alias(PLACE[1]))


def numbered(rows: DataFrame, order: Sequence[str], out: str = "number") -> DataFrame:
    """Consecutive numbers from 0 in the order of ``order``, nulls first; equal rows in any order.

    The rows are dealt out by ranges and sorted in their partitions; a partition's first number is
    the row count of those before it, and one count per partition is all that the driver sees.
    """
    spark = rows.sparkSession
    tagged = materialise(rows.withColumn("_tie", F.monotonically_increasing_id()), "tagged")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = materialise(tagged.repartitionByRange(parts, *order, "_tie").sortWithinPartitions(*order, "_tie")
                         .withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", 33).alias("_part")
    before, starts = 0, []
    for found in placed.groupBy(part).count().orderBy("_part").collect():
        starts.append((found["_part"], before))
        before += found["count"]
    shifts = spark.createDataFrame(starts, "_part long, _first long")
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("_part", part).join(F.broadcast(shifts), "_part") \
        .withColumn(out, F.col("_first") + inside).drop("_part", "_first", "_at", "_tie")


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of the edges ``(a, b)``; label is the component's smallest node.

    Each round hooks every node to its smallest neighbour below it, shortens the resulting trees to
    their roots by pointer doubling and contracts the edges to roots, until no edge is left. Work is
    a handful of aggregations and joins on written tables; nothing but counts reaches the driver.
    """
    links = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .where("a <> b").distinct(), "links")
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    labels = None
    while not links.isEmpty():
        hooks = materialise(links.groupBy("a").agg(F.min("b").alias("root")), "hooks")
        while True:
            up = hooks.select(F.col("a").alias("root"), F.col("root").alias("above"))
            step = materialise(hooks.join(up, "root", "left").select(
                "a", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")), "hooks")
            hooks = step.select("a", "root")
            if step.where("moved").isEmpty():
                break
        if labels is None:
            labels = nodes.join(hooks.withColumnRenamed("a", "node"), "node", "left") \
                .select("node", F.coalesce("root", "node").alias("label"))
        else:
            labels = labels.join(hooks.select(F.col("a").alias("label"), "root"), "label", "left") \
                .select("node", F.coalesce("root", "label").alias("label"))
        labels = materialise(labels, "labels")
        left = hooks.select("a", F.col("root").alias("ra"))
        right = hooks.select(F.col("a").alias("b"), F.col("root").alias("rb"))
        joined = links.join(left, "a", "left").join(right, "b", "left") \
            .select(F.coalesce("ra", "a").alias("x"), F.coalesce("rb", "b").alias("y")).where("x <> y")
        links = materialise(joined.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))
                            .distinct(), "links")
    return labels if labels is not None else nodes.select("node", F.col("node").alias("label"))
