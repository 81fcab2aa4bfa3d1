"""Quality score by compression with dictionaries of good and bad text (operator 2).

Two zstandard dictionaries are built, one from labelled good and one from labelled bad documents. A
document is cut into blocks and every block of the whole text is compressed against both. Text
that resembles the good documents becomes smaller with the good dictionary. The difference of the
two sizes over the bytes of the text is calibrated to a probability by logistic regression on labelled
documents that went into neither dictionary.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bramble.llm.common import bounded_batches, carried, id_fold
from bramble.session import materialise

#: labelled documents of each kind that go into a dictionary, and that calibrate, at most
DICTIONARY_DOCS, CALIBRATION_DOCS = 1_500, 3_000
#: bytes of a dictionary, and of a kind's training blocks at most
DICTIONARY_BYTES, TRAINING_BYTES = 64 << 10, 6 << 20
#: texts are compressed in blocks, as a dictionary helps only at the start of what it is applied to
BLOCK = 1024
LEVEL = 1
FOLDS, HELD_OUT = 3, 1


@dataclass(frozen=True)
class CompressionModel:
    good: bytes
    bad: bytes
    slope: float
    offset: float

    def score(self, difference: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.offset + self.slope * difference, -500, 500)))


class Sizes:
    """Compressed sizes of a text under both dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        import zstandard as z
        self.packers = [z.ZstdCompressor(level=LEVEL, dict_data=self._dictionary(d), write_content_size=False,
                                         write_dict_id=False, write_checksum=False) for d in (good, bad)]

    @staticmethod
    def _dictionary(data: bytes):
        import zstandard as z
        held = z.ZstdCompressionDict(data, dict_type=z.DICT_TYPE_AUTO)
        held.precompute_compress(level=LEVEL)
        return held

    def difference(self, text: str | None) -> float:
        """(bad - good) / bytes: above 0 if the good dictionary fits better; 0 for no text.

        Sizes are normalised by the text's own, not by the compressed sizes: a text that repeats
        itself is small under either dictionary, and tells as little as an empty one.
        """
        data = (text or "").encode("utf-8", "surrogatepass")
        good, bad = (sum(len(p.compress(data[i:i + BLOCK])) for i in range(0, len(data), BLOCK))
                     for p in self.packers)
        return (bad - good) / len(data) if data else 0.0


def build_dictionary(texts: list[str], size: int = DICTIONARY_BYTES, budget: int = TRAINING_BYTES) -> bytes:
    """A trained dictionary from the blocks of whole texts; raw text where there is too little to train."""
    import zstandard as z
    blocks, used = [], 0
    for text in texts:
        data = text.encode("utf-8", "surrogatepass")
        if used + len(data) > budget:
            continue
        used += len(data)
        blocks.extend(data[i:i + BLOCK] for i in range(0, len(data), BLOCK))
    try:
        return z.train_dictionary(size, blocks, level=LEVEL).as_bytes()
    except z.ZstdError:
        return b"".join(blocks)[:size] or b" "


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-6) -> tuple[float, float]:
    """Slope and offset by Newton steps; the data are scaled so that the ridge means the same everywhere."""
    scale = float(np.std(x)) or 1.0
    a = np.column_stack([x / scale, np.ones(len(x))])
    beta = np.zeros(2)
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(a @ beta, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a / len(x) + ridge * np.eye(2),
                               a.T @ (y - p) / len(x) - ridge * beta)
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
        quality: str = "quality") -> CompressionModel:
    """Learn from the labelled documents outside the held-out fold.

    Of each kind the documents of lowest id hash are read, at most DICTIONARY_DOCS for a dictionary
    and CALIBRATION_DOCS others for calibration. If a kind is missing the score is the share of
    good labels (0.5 without labels).
    """
    spark = docs.sparkSession
    ids = labels.where(F.col(quality).isNotNull() & F.col(doc_id).isNotNull() & (id_fold(doc_id, FOLDS) != HELD_OUT)) \
        .groupBy(F.col(doc_id).alias("doc_id")).agg(F.min(F.col(quality).cast("int")).alias("good"))
    ids = materialise(ids, "labelled")
    counts = {r["good"]: r["count"] for r in ids.groupBy("good").count().collect()}
    by_hash, most = [F.xxhash64("doc_id"), F.col("doc_id")], DICTIONARY_DOCS + CALIBRATION_DOCS
    some = ids.where("good = 1").orderBy(*by_hash).limit(most) \
        .unionByName(ids.where("good = 0").orderBy(*by_hash).limit(most))
    held = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where("text is not null") \
        .join(F.broadcast(materialise(some, "chosen")), "doc_id")
    sample = materialise(held.select("good", "text", F.xxhash64("doc_id").alias("turn"), "doc_id"), "sample")

    def part(kind: int) -> list[str]:
        # a third of each kind's sample makes the dictionary, so that some is left to calibrate
        rows = sample.where((F.col("good") == kind) & (F.pmod(F.xxhash64("turn"), F.lit(3)) == 0)) \
            .orderBy("turn", "doc_id", "text").select("text").limit(DICTIONARY_DOCS).collect()
        return [r["text"] for r in rows]

    total = sum(counts.values())
    share = (counts.get(1, 0) + 1) / (total + 2)
    good, bad = build_dictionary(part(1)), build_dictionary(part(0))
    flat = CompressionModel(good, bad, 0.0, float(np.log(share / (1 - share))))
    if not counts.get(1) or not counts.get(0):
        return flat
    rest = sample.where(F.pmod(F.xxhash64("turn"), F.lit(3)) != 0)
    rows = differences(rest.select("good", "text"), good, bad, ["good"]).collect()
    x, y = np.array([r["difference"] for r in rows]), np.array([r["good"] for r in rows], float)
    order = np.lexsort((y, x))
    if len(set(y)) < 2:
        return flat
    slope, offset = fit_logistic(x[order], y[order])
    # the sample is drawn by kind: move the offset from its share of good documents to that of the labels
    offset += np.log(counts[1] / counts[0]) - np.log(y.sum() / (len(y) - y.sum()))
    return CompressionModel(good, bad, slope, float(offset))


def differences(docs: DataFrame, good: bytes, bad: bytes, keep: list[str], text: str = "text") -> DataFrame:
    """``difference`` of every row's whole text, after the columns in ``keep``."""
    bounded_batches(docs.sparkSession)
    source = docs.select(*keep, F.col(text).alias("_text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]]
                       + ["difference double"])

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sizes = Sizes(good, bad)
        for batch in batches:
            yield batch[keep].assign(difference=[sizes.difference(t if isinstance(t, str) else None)
                                                 for t in batch["_text"]])

    return source.mapInPandas(measure, schema)


def scored(docs: DataFrame, model: CompressionModel, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row; null and empty texts have difference 0."""
    found = differences(docs.select(carried(doc_id), F.col(text).alias("text")), model.good, model.bad, ["doc_id"]) \
        .withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType))
    score = 1 / (1 + F.exp(-(F.lit(model.offset) + F.lit(model.slope) * F.col("difference"))))
    return found.select("doc_id", (id_fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), score.alias("score"),
                        (score >= 0.5).cast("int").alias("predicted"), "difference")
