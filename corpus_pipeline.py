"""From raw documents to packed sequences in five stages, each one an operator of ``bramble.llm``.

Each stage takes ``(spark, docs, sf_dir)``. Its result is written as Parquet and read again as the
next stage's ``docs``. All but the last keep the columns of ``documents``; extra columns pass
through. Null texts count as empty and repeated rows are ordinary rows in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bramble.llm import exact_dedup, mixing, packing, simhash, toxicity
from bramble.session import drop_materialised, materialise, scratch_path, written_so_far

#: learned and seeded stages have no SQL counterpart; tests compare them with brute force
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that are likelier toxic than not go."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: of texts equal but for white space, the longest stays."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: of fingerprints linked by two differing bits or fewer, one document stays."""
    return simhash.keep_one_per_component(docs, stored=True)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: each document as often as the mix takes it."""
    return mixing.mixed(docs, stored=True)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: every piece of every document with its place in a sequence."""
    return packing.pack_documents(docs)


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_exact_copies), ("near_dedup", drop_near_copies),
          ("mixing", mix_sources), ("packing", pack_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; every result but the last is written to the shared folder.

    A stage's own tables and the result before it are deleted as soon as its result is written.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    first = written_so_far()
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        docs = materialise(stage(spark, docs, sf_dir), name, path)
        drop_materialised(spark, first, keep=[path])
    return STAGES[-1][1](spark, docs, sf_dir)
