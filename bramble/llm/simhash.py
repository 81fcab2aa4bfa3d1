"""SimHash near-duplicates by multi-index hashing (operator 8).

A fingerprint consists of 64-bit lanes. A table of the index is one lane seen through a mask: its
key holds the bits inside ``keep``. Every fingerprint is filed once per table and looks up its own
key and the keys one step away, where the bits of ``ball`` may flip (the small Hamming ball). Only
steps from 0 to 1 are enumerated: of two keys one bit apart, one has the 0 and finds the other.
Matches are compared over the complete fingerprint.

* ``exact_tables`` finds every pair within two bits of a single lane. Of the four 16-bit segments
  each table leaves one out, so a key has 48 bits. Two bits that differ lie in one segment (then
  that segment's table has equal keys) or in two (then the table that leaves one out is one step
  away inside the other); every pair of segments is served by exactly one table.
* ``segment_tables`` cuts several lanes into 32-bit segments with a ball of radius one each, for
  wider distances: copies are found with the probability that one segment has at most one flip.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bramble.llm.common import PLACE, addressable, bounded_batches, carried, connected_components, join_by_weight
from bramble.session import materialise

SEED = 42
#: shingles hashed and counted at a time, so that a long text needs no more memory than a short one
BLOCK = 1 << 16
FULL = (1 << 64) - 1
#: places of dropped rows up to which they are broadcast (about 20 MB); more are joined by a shuffle
FEW = 200_000


@dataclass(frozen=True)
class Table:
    lane: int
    keep: int
    ball: int


def exact_tables() -> list[Table]:
    segment = [0xFFFF << (16 * s) for s in range(4)]
    flips = {0: (1, 2), 1: (2, 3), 2: (3,), 3: (0,)}  # left out: stepped in
    return [Table(0, FULL & ~segment[out], sum(segment[s] for s in steps)) for out, steps in flips.items()]


def segment_tables(lanes: int) -> list[Table]:
    return [Table(lane, half, half) for lane in range(lanes) for half in (0xFFFFFFFF, 0xFFFFFFFF << 32)]


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def majority(hashes: Iterator[np.ndarray]) -> np.ndarray:
    """64-bit majority of blocks of hashes, one fingerprint lane per column of the blocks."""
    ones, total = None, 0
    for block in hashes:
        bits = np.unpackbits(np.ascontiguousarray(block, "<u8").view(np.uint8), axis=1, bitorder="little")
        counted = bits.sum(axis=0, dtype=np.int64)
        ones = counted if ones is None else ones + counted
        total += len(block)
    return np.packbits(2 * ones > total, bitorder="little").view("<u8")


def shingle_hashes(words: list[bytes], width: int, seed: int = SEED) -> Iterator[np.ndarray]:
    """Blocks of XXH64 hashes of the shingles of ``width`` words (fewer words: of them all)."""
    from xxhash import xxh64_intdigest
    text = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    width = min(width, len(words))
    count = len(words) - width + 1
    firsts, lasts = starts[:count].tolist(), (starts + lengths)[width - 1:].tolist()
    for lo in range(0, count, BLOCK):
        part = [xxh64_intdigest(text[a:b], seed) for a, b in zip(firsts[lo:lo + BLOCK], lasts[lo:lo + BLOCK])]
        yield np.array(part, np.uint64).reshape(-1, 1)


def fingerprint(text: str | None, width: int = 3) -> int:
    """SimHash of the word shingles, repeats counted; 0 for a text without words. A-Z are lowered."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return int(majority(shingle_hashes(words, width))[0]) if words else 0


def fingerprints(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = 3,
                 carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id, lanes`` and the columns of ``carry``: one lane per row of ``docs``; null texts have no words."""
    bounded_batches(docs.sparkSession)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            prints = [[signed(fingerprint(t if isinstance(t, str) else None, width))] for t in batch["_text"]]
            yield batch[["doc_id", *carry]].assign(lanes=prints)

    kept = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in carry) if carry else ""
    return docs.select(carried(doc_id), F.col(text).alias("_text"), *carry) \
        .mapInPandas(score, f"doc_id string{kept}, lanes array<long>") \
        .withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType))


def _keys(tables: list[Table], probe: bool) -> Column:
    """Array of ``(table, key)`` of a row of ``lanes``; for probes also the steps from 0 to 1."""
    return F.concat(*[_table_keys(number, t, probe) for number, t in enumerate(tables)])


def _table_keys(number: int, t: Table, probe: bool) -> Column:
    key = F.col("lanes")[t.lane].bitwiseAND(F.lit(signed(t.keep)))

    def entry(k: Column, step: bool) -> Column:
        return F.struct(F.lit(number).alias("table"), k.alias("key"), F.lit(step).alias("step"))

    own = F.array(entry(key, False))
    if not probe:
        return own
    bits = F.array(*[F.shiftleft(F.lit(1).cast("long"), b) for b in range(64) if t.ball >> b & 1])
    steps = F.transform(F.filter(bits, lambda b: key.bitwiseAND(b) == 0), lambda b: entry(key.bitwiseOR(b), True))
    return F.concat(own, steps)


def distance(a: str, b: str, lanes: int) -> Column:
    total = None
    for lane in range(lanes):
        bits = F.bit_count(F.col(a)[lane].bitwiseXOR(F.col(b)[lane]))
        total = bits if total is None else total + bits
    return total


def links_within_two(points: DataFrame) -> DataFrame:
    """``(a, b)`` of all distinct one-lane fingerprints ``fp`` with at most two differing bits.

    Fingerprints are distinct, so a row has at most 2,080 partners however many copies there are,
    and a bucket of 48 equal bits holds few rows.
    """
    tables = exact_tables()
    lanes = points.select("fp", F.array("fp").alias("lanes"))
    filed = lanes.select(F.col("fp").alias("b"), F.explode(_keys(tables, False)).alias("k")) \
        .select("b", "k.table", "k.key")
    probes = lanes.select(F.col("fp").alias("a"), F.explode(_keys(tables, True)).alias("k")) \
        .select("a", "k.table", "k.key", "k.step")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2
    return probes.join(filed, ["table", "key"]).where(near & (F.col("step") | (F.col("a") < F.col("b")))) \
        .select("a", "b")


def _labelled(docs: DataFrame, doc_id: str, text: str, width: int, carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id, fp, label, component_id`` and the columns of ``carry``; rows of one component have one label."""
    rows = materialise(fingerprints(docs, doc_id=doc_id, text=text, width=width, carry=carry)
                       .select("doc_id", F.col("lanes")[0].alias("fp"), *carry), "prints")
    points = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies")),
                         "points")
    label = connected_components(links_within_two(points)).withColumnRenamed("node", "fp")
    labelled = points.join(label, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    lowest = labelled.groupBy("label").agg(F.min("first_id").alias("component_id"))
    table = materialise(labelled.join(lowest, "label").select("fp", "copies", "label", "component_id"), "components")
    return join_by_weight(rows, table, "fp", "copies", rows.count())


def simhash_components(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    Rows link when their fingerprints differ in at most two bits (equal fingerprints included, and
    fingerprint zero like any other); a component has the smallest non-null id in it, null if it has
    none. Repeated rows give repeated rows; other columns are ignored.
    """
    return _labelled(docs, doc_id, text, width).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_per_component(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = 3,
                           stored: bool = False) -> DataFrame:
    """One row of each component of ``simhash_components``, with the columns of ``docs``.

    The row of the smallest id stays, a null id coming last; of rows with equal ids it is the one
    stored first. Texts without words, null ones included, have fingerprint zero and hence one row.
    """
    content = addressable(docs, stored=stored)
    rows = materialise(_labelled(content, doc_id, text, width, PLACE), "labelled")
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("first"), *PLACE)
    stay = rows.groupBy("label").agg(F.min(order).alias("stay")).select("stay.*").select(*PLACE)
    gone = materialise(rows.select(*PLACE).join(stay, list(PLACE), "left_anti"), "gone")
    few = gone.count() <= FEW
    return content.join(F.broadcast(gone) if few else gone, list(PLACE), "left_anti").select(*docs.columns)
