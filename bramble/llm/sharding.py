"""Reproducible shuffle into shards by a Feistel permutation with cycle walking (operator 7).

Rows are numbered in the order of a stable key. A Feistel network permutes the smallest domain of
an even number of bits that holds all numbers; a result beyond the row count is fed in again until
it falls inside (cycle walking), which keeps the map one to one on the row numbers. The permuted
place gives shard (its remainder) and slot (its quotient), both computable for any row number and
back again, without looking at other rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bramble.llm.common import bounded_batches, carried, numbered, text_of

SHARDS = 24
ROUNDS = 8
SEED = 20


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _round_keys(seed: int, rounds: int) -> np.ndarray:
    return _mix((np.arange(1, rounds + 1, dtype=np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15))


def _half_bits(size: int) -> int:
    return max(1, (max(size - 1, 1).bit_length() + 1) // 2)


def _network(x: np.ndarray, half: np.uint64, keys: np.ndarray, inverse: bool) -> np.ndarray:
    mask = (np.uint64(1) << half) - np.uint64(1)
    left, right = x >> half, x & mask
    if inverse:
        for key in keys[::-1]:
            left, right = right ^ (_mix(left ^ key) & mask), left
    else:
        for key in keys:
            left, right = right, left ^ (_mix(right ^ key) & mask)
    return (left << half) | right


def permute(numbers: np.ndarray, size: int, *, seed: int = SEED, rounds: int = ROUNDS,
            inverse: bool = False) -> np.ndarray:
    """Places of the row numbers ``0 <= n < size``, a permutation of that range; or back again."""
    x = np.asarray(numbers, dtype=np.uint64).copy()
    half, keys, limit = np.uint64(_half_bits(size)), _round_keys(seed, rounds), np.uint64(size)
    walking = np.arange(len(x))
    while len(walking):
        x[walking] = _network(x[walking], half, keys, inverse)
        walking = walking[x[walking] >= limit]
    return x.astype(np.int64)


def row_number_at(shard: int, slot: int, size: int, shards: int = SHARDS, seed: int = SEED) -> int:
    """The row number that sits in a slot of a shard."""
    return int(permute(np.array([slot * shards + shard]), size, seed=seed, inverse=True)[0])


def shard_rows(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS,
               seed: int = SEED) -> DataFrame:
    """``doc_id, size, text_crc32, number, shard, slot`` for every row.

    Rows are numbered by id (null first), then text checksum and hash; rows equal in all of them get
    neighbouring numbers in any order. Null texts have 0 bytes and checksum 0. Row counts of shards
    differ by one at most, and slots are gapless from 0.
    """
    spark = docs.sparkSession
    bounded_batches(spark, rows=50_000)
    crc = F.crc32(text_of(text))
    rows = docs.select(F.col(doc_id).alias("doc_id"), (F.octet_length(text_of(text)) + 8).cast("long").alias("size"),
                       crc.alias("text_crc32"), F.xxhash64(text_of(text)).alias("_hash"))
    placed = numbered(rows, ["doc_id", "text_crc32", "_hash"]).drop("_hash")
    total = placed.count()

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = permute(batch["number"].to_numpy(), total, seed=seed)
            yield batch.assign(shard=(at % shards).astype("int32"), slot=at // shards)

    return placed.select(carried("doc_id"), "size", "text_crc32", "number").mapInPandas(
        places, "doc_id string, size long, text_crc32 long, number long, shard int, slot long") \
        .withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType))
