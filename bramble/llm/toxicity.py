"""Toxicity grades by cumulative-link ordinal regression on sparse text features (operator 6).

Features are a document's words and word beginnings. Those that occur clearly more often in toxic
than in other labelled documents form the sparse vector. One weight vector is shared by all
thresholds: P(grade <= k) = sigmoid(threshold_k - w.x). The severity is the expected grade.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bramble.llm.common import bounded_batches, carried, id_fold, worker_store
from bramble.session import materialise

#: labelled documents of each kind that the fit reads at most; the whole of each text is read
SAMPLE_TOXIC, SAMPLE_CLEAN = 6_000, 12_000
MAX_FEATURES = 2_000
MIN_DOCS, MIN_LOG_ODDS, MIN_Z = 5, 2.3, 4.0
#: lengths of word beginnings; inflected insults share one
PREFIXES = (4, 5, 6, 7, 8)
#: words that a task remembers the features of
_MEMO = 200_000
#: marker words from which a toxic training document counts as grade 2 and 3
GRADE_FROM = (3, 6)
#: ids whose crc32 leaves this remainder are never learned from
FOLDS, HELD_OUT = 5, 0


@dataclass(frozen=True)
class OrdinalModel:
    """Weights by feature and increasing thresholds between the grades 0..len(thresholds)."""
    weights: dict[str, float]
    thresholds: tuple[float, ...]

    def score(self, counts: dict[str, int]) -> np.ndarray:
        """Probabilities of the grades for counted features."""
        eta = sum(self.weights[f] * np.log1p(n) for f, n in counts.items())
        below = 1.0 / (1.0 + np.exp(np.clip(eta - np.array(self.thresholds), -500, 500)))
        return np.diff(np.concatenate([[0.0], below, [1.0]]))


def words_of(text: str | None) -> list[str]:
    """Words of letters: lower case, without the punctuation around them."""
    if not text:
        return []
    return [w for w in (x.strip(".,;:!?\"'()[]{}|*#$%&<>") for x in text.lower().split()) if w.isalpha()]


def known_features(words: Sequence[str], known, memo: dict[str, tuple]) -> dict[str, int]:
    """Counts of the known words and, marked by a star, of the known beginnings of longer words."""
    counts: dict[str, int] = {}
    for w in words:
        found = memo.get(w)
        if found is None:
            if len(memo) >= _MEMO:
                memo.clear()
            named = (w, *(w[:n] + "*" for n in PREFIXES if len(w) > n))
            found = memo[w] = tuple(f for f in named if f in known)
        for f in found:
            counts[f] = counts.get(f, 0) + 1
    return counts


def fit_cumulative_link(x: list[dict[int, float]], grades: np.ndarray, features: int, levels: int,
                        steps: int = 500, rate: float = 0.1, ridge: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by Adam on the penalised likelihood of the observed grades."""
    row = np.repeat(np.arange(len(x)), [len(r) for r in x])
    col = np.array([c for r in x for c in r], dtype=np.int64)
    val = np.array([v for r in x for v in r.values()], dtype=float)
    w = np.zeros(features)
    share = np.clip(np.array([np.mean(grades <= k) for k in range(levels - 1)]), 1e-3, 1 - 1e-3)
    first = np.log(share / (1 - share))
    # thresholds as a start and positive steps, so that their order holds
    theta = np.concatenate([first[:1], np.log(np.maximum(np.diff(first), 1e-2))])
    m, v = np.zeros(features + levels - 1), np.zeros(features + levels - 1)
    n = max(1, len(x))

    def sig(z):
        return 1.0 / (1.0 + np.exp(-np.clip(z, -50, 50)))

    for t in range(1, steps + 1):
        gaps = np.exp(theta[1:])
        cuts = theta[0] + np.concatenate([[0.0], np.cumsum(gaps)])
        eta = np.bincount(row, w[col] * val, minlength=len(x)) if len(row) else np.zeros(len(x))
        edge = np.concatenate([[-np.inf], cuts, [np.inf]])
        hi, lo = sig(edge[grades + 1] - eta), sig(edge[grades] - eta)
        p = np.maximum(hi - lo, 1e-12)
        fh, fl = hi * (1 - hi), lo * (1 - lo)
        d_eta = -(fh - fl) / p
        d_cut = np.array([np.sum(fh[grades == k] / p[grades == k]) - np.sum(fl[grades == k + 1] / p[grades == k + 1])
                          for k in range(levels - 1)])
        d_theta = np.concatenate([[d_cut.sum()], [d_cut[k + 1:].sum() * gaps[k] for k in range(levels - 2)]])
        d_w = np.bincount(col, d_eta[row] * val, minlength=features) if len(row) else np.zeros(features)
        g = np.concatenate([d_w / n - ridge * w, d_theta / n])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, theta = w + step[:features], theta + step[features:]
    return w, theta[0] + np.concatenate([[0.0], np.cumsum(np.exp(theta[1:]))])


def _beginnings(n: int) -> Column:
    return F.transform(F.filter("words", lambda w: F.length(w) > n), lambda w: F.concat(F.substring(w, 1, n), F.lit("*")))


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
        toxic: str = "toxic") -> OrdinalModel:
    """Learn from the labelled documents outside the held-out fold.

    At most SAMPLE_TOXIC toxic and SAMPLE_CLEAN other labels are used, those of lowest id hash, so
    the fit reads a bounded number of whole texts. Where a limit bites, the sample's odds of toxic
    labels differ from all labels' odds; all thresholds are shifted by the log of their ratio, so
    that calls do not depend on the size of the table. A toxic document's training grade is 1, and
    higher with the number of its marker words. Without labels of both kinds the model calls
    everything grade 0.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    ids = labels.where(F.col(toxic).isNotNull() & F.col(doc_id).isNotNull() & (id_fold(doc_id, FOLDS) != HELD_OUT)) \
        .groupBy(F.col(doc_id).alias("doc_id")).agg(F.max(F.col(toxic).cast("int")).alias("toxic"))
    ids = materialise(ids, "labels")
    found = {r["toxic"]: r["count"] for r in ids.groupBy("toxic").count().collect()}
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    some = ids.where("toxic = 1").orderBy(*by_hash).limit(SAMPLE_TOXIC) \
        .unionByName(ids.where("toxic = 0").orderBy(*by_hash).limit(SAMPLE_CLEAN))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"toxic": batch["toxic"], "words": [words_of(t) for t in batch["text"]]})

    held = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")) \
        .join(F.broadcast(materialise(some, "labelled")), "doc_id").select("toxic", "text")
    sample = materialise(held.mapInPandas(count, "toxic int, words array<string>"), "sample")
    kinds = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n1, n0 = kinds.get(1, 0), kinds.get(0, 0)
    if not n1 or not n0:
        return OrdinalModel({}, (50.0, 51.0, 52.0))
    starts = [_beginnings(n) for n in PREFIXES]
    seen = sample.select("toxic", F.explode(F.array_distinct(F.concat("words", *starts))).alias("feature")) \
        .groupBy("feature").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")) \
        .where(F.col("a") >= MIN_DOCS)
    odds = F.log((F.col("a") + 0.5) / (n1 - F.col("a") + 0.5)) - F.log((F.col("b") + 0.5) / (n0 - F.col("b") + 0.5))
    z = odds / F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))
    chosen = seen.where((odds >= MIN_LOG_ODDS) & (z >= MIN_Z)).orderBy(z.desc(), "feature").limit(MAX_FEATURES)
    known = {r["feature"]: i for i, r in enumerate(chosen.collect())}

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo: dict[str, tuple] = {}
        for batch in batches:
            found = [known_features(words, known, memo) for words in batch["words"]]
            yield pd.DataFrame({"toxic": batch["toxic"], "index": [[known[f] for f in c] for c in found],
                                "n": [list(c.values()) for c in found],
                                "markers": [sum(bool(memo[w]) if w in memo else bool(known_features([w], known, {}))
                                                for w in words) for words in batch["words"]]})

    rows = sample.mapInPandas(vectors, "toxic int, index array<int>, n array<int>, markers int").collect()
    rows.sort(key=lambda r: (r["toxic"], r["markers"], list(r["index"]), list(r["n"])))
    grades = np.array([0 if not r["toxic"] else 1 + sum(r["markers"] >= g for g in GRADE_FROM) for r in rows])
    x = [{i: float(np.log1p(n)) for i, n in zip(r["index"], r["n"])} for r in rows]
    w, cuts = fit_cumulative_link(x, grades, len(known), len(GRADE_FROM) + 2)
    shift = prior_shift(found.get(1, 0), found.get(0, 0))
    return OrdinalModel({f: float(w[i]) for f, i in known.items()}, tuple(float(c) + shift for c in cuts))


def prior_shift(toxic: int, clean: int) -> float:
    """Log of the sample's odds of toxic labels over all labels' odds."""
    if not toxic or not clean:
        return 0.0
    return float(np.log(min(toxic, SAMPLE_TOXIC) / min(clean, SAMPLE_CLEAN)) - np.log(toxic / clean))


def graded(docs: DataFrame, model: OrdinalModel, *, doc_id: str = "doc_id", text: str = "text",
           keep: Sequence[str] = ()) -> DataFrame:
    """``severity, grade, toxic`` for every row, with its id as ``doc_id`` and the columns in ``keep``.

    ``severity`` is the expected grade, ``grade`` the median one and ``toxic`` whether a grade
    above 0 is likelier than not. Null and empty texts have no features and get the base rates.
    """
    bounded_batches(docs.sparkSession)
    weights = model.weights
    columns = [carried(doc_id), F.col(text).alias("_text"), *keep]
    source = docs.select(*columns)
    kept = [f for f in source.schema.fields if f.name != "_text"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept]
                       + ["severity double", "grade int", "toxic boolean"])

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo: dict[str, tuple] = {}
        for batch in batches:
            p = np.array([model.score(known_features(words_of(t), weights, memo)) for t in batch["_text"]])
            p = p.reshape(len(batch), -1)
            yield batch[[f.name for f in kept]].assign(
                severity=p @ np.arange(p.shape[1]) if len(p) else [],
                grade=(np.cumsum(p, axis=1)[:, :-1] < 0.5).sum(axis=1) if len(p) else [],
                toxic=p[:, 0] < 0.5 if len(p) else [])

    return source.mapInPandas(score, schema).withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType))


def without_toxic(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that are not called toxic, with the columns of ``docs``.

    A row goes if a grade above 0 is likelier than not; at exactly one half it stays. Null and empty
    texts have no features and stay unless the base rate alone says toxic. Repeated rows are judged
    alike, and an empty table gives an empty one.
    """
    model = fit(docs, labels, doc_id=doc_id, text=text)
    bounded_batches(docs.sparkSession)
    weights, where = model.weights, docs.columns.index(text)

    def passes(batches):
        import pyarrow as pa
        worker_store("toxicity")  # lets go of what the worker remembers for other operators
        memo: dict[str, tuple] = {}
        for batch in batches:
            calm = [model.score(known_features(words_of(t), weights, memo))[0] >= 0.5
                    for t in batch.column(where).to_pylist()]
            yield batch.filter(pa.array(calm, pa.bool_()))

    return docs.mapInArrow(passes, docs.schema)
