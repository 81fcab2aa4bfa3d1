"""Language mixtures by expectation-maximisation over character n-gram likelihoods (operator 5).

Every language is a multinomial over hashed character trigrams, counted over all learned documents.
A word's likelihood under a language is the product of its trigrams' probabilities, word boundaries
included. A document's words are draws from a mixture of languages; expectation-maximisation
estimates the proportions. Which languages a document holds is chosen by penalised likelihood:
languages are removed one at a time, least first, as long as the likelihood lost is less than the
penalty saved.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bramble.llm.common import bounded_batches, carried, id_fold, worker_store

#: trigrams are hashed to so many slots
SLOTS = 1 << 15
#: added to every slot's count
SMOOTHING = 0.5
#: largest influence of one word, in nats between the likeliest and another language
WORD_LIMIT = 12.0
#: a language costs so many nats, and half the logarithm of the number of words
LANGUAGE_COST = 6.0
ROUNDS = 12
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageModel:
    """Names and the log-probabilities of the slots, one row per language."""
    names: tuple[str, ...]
    logs: np.ndarray


def _letters() -> np.ndarray:
    """For every code point, its lower-case letter or 32; built once per worker."""
    kept = worker_store("letters")
    if "table" not in kept:
        table = np.full(0x110000, 32, np.uint32)
        for code in range(0x110000):
            c = chr(code)
            if c.isalpha():
                low = c.lower()
                table[code] = ord(low) if len(low) == 1 else code
            elif unicodedata.combining(c):
                table[code] = code  # marks stay with their letters
        kept["table"] = table
    return kept["table"]


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the trigrams of a text, and where each of its words begins among them.

    Words are runs of letters, lower-cased; a word's trigrams include the space on either side. A
    text without letters has none.
    """
    if not text:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    table = _letters()
    codes = table[np.frombuffer((" " + text + " ").encode("utf-32-le", "surrogatepass"), np.uint32)]
    gap = codes == 32
    codes = codes[~(gap & np.concatenate([[False], gap[:-1]]))]  # one space between words
    if len(codes) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    c = codes.astype(np.uint64)
    mixed = (c[:-2] * np.uint64(0x9E3779B1) + c[1:-1]) * np.uint64(0x85EBCA77) + c[2:]
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    slots = (mixed >> np.uint64(49)).astype(np.int64)
    inside = codes[1:-1] != 32  # trigrams centred on a letter belong to that letter's word
    starts = np.flatnonzero((codes[:-2] == 32) & inside)
    position = np.cumsum(inside) - 1
    return slots[inside], position[starts]


def fit(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> LanguageModel:
    """Count the trigrams of every learned document: a language, and an id outside the held-out fold.

    Counts are summed within each task before they are shuffled. The model has one row of SLOTS
    numbers per language; the number of languages is the number of distinct values of ``lang``.
    """
    bounded_batches(docs.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, value in zip(batch["lang"], batch["text"]):
                slots, _ = trigrams(value if isinstance(value, str) else None)
                if name not in held:
                    held[name] = np.zeros(SLOTS, np.int64)
                held[name] += np.bincount(slots, minlength=SLOTS)
        for name in held:
            some = np.flatnonzero(held[name])
            yield pd.DataFrame({"lang": name, "slot": some, "n": held[name][some]})

    learned = docs.where(F.col(lang).isNotNull() & (id_fold(doc_id, FOLDS) != HELD_OUT)) \
        .select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    counts = learned.mapInPandas(count, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    rows = counts.groupBy("lang").agg(F.collect_list("slot").alias("slots"), F.collect_list("n").alias("n")) \
        .orderBy("lang").toPandas()
    table = np.full((len(rows), SLOTS), SMOOTHING)
    for i, (slots, n) in enumerate(zip(rows["slots"], rows["n"])):
        table[i, np.asarray(slots, np.int64)] += np.asarray(n)
    logs = np.log(table / table.sum(axis=1, keepdims=True)) if len(rows) else table
    return LanguageModel(tuple(rows["lang"]), logs.astype(np.float32))


def mixture(weights: np.ndarray, start: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Proportions and log-likelihood of rows of likelihoods (scaled to a maximum of 1)."""
    share, across = start, weights.T
    for _ in range(rounds):
        share = share * (across @ (1.0 / (weights @ share))) / len(weights)
    return share, float(np.log(weights @ share).sum())


def languages_of(words: np.ndarray, cost: float = LANGUAGE_COST) -> np.ndarray:
    """Proportions of the languages (0 for those left out) from word log-likelihoods (words x languages).

    No set of languages is likelier than all of them: if even these gain less over the best single
    language than one more language costs, that language is the answer.
    """
    n, k = words.shape
    scaled = np.maximum(words - words.max(axis=1, keepdims=True), -WORD_LIMIT)
    alone = scaled.sum(axis=0)
    penalty = cost + 0.5 * np.log(n)
    single = np.zeros(k)
    single[np.argmax(alone)] = 1.0
    if k == 1 or -alone.max() <= penalty:
        return single
    weights = np.exp(scaled)
    share, fit_now = mixture(weights, np.full(k, 1.0 / k))
    if fit_now - alone.max() <= penalty:
        return single
    held = np.arange(k)
    while len(held) > 1:
        keep = np.delete(np.arange(len(held)), np.argmin(share))
        rest = weights[:, held[keep]]
        start = share[keep] / max(share[keep].sum(), 1e-12)
        fewer, fit_fewer = mixture(np.ascontiguousarray(rest), start)
        if fit_now - fit_fewer > penalty:
            break
        held, share, fit_now = held[keep], fewer, fit_fewer
    out = np.zeros(k)
    out[held] = share / share.sum()
    return out


def predicted(docs: DataFrame, model: LanguageModel, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score, langs, shares`` for every row.

    ``lang_pred`` has the largest share and ``score`` is that share; ``langs`` and ``shares`` are the
    chosen set, largest first (ties in alphabetical order). A text that is null or has no letter,
    or any text when nothing was learned, is ``und`` with score 0 and no languages.
    """
    bounded_batches(docs.sparkSession)
    names, logs = model.names, np.ascontiguousarray(model.logs.T)

    def classify(value) -> tuple[str, float, list, list]:
        slots, starts = trigrams(value if isinstance(value, str) else None)
        if not len(slots) or not len(names):
            return UNKNOWN, 0.0, [], []
        share = languages_of(np.add.reduceat(logs[slots], starts, axis=0, dtype=np.float64))
        order = [i for i in np.argsort(-share, kind="stable") if share[i] > 0]
        return names[order[0]], float(share[order[0]]), [names[i] for i in order], [float(share[i]) for i in order]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [classify(t) for t in batch["_text"]]
            yield batch[["doc_id", "held_out"]].assign(**{
                name: [f[i] for f in found] for i, name in enumerate(("lang_pred", "score", "langs", "shares"))})

    return docs.select(carried(doc_id), (id_fold(doc_id, FOLDS) == HELD_OUT).alias("held_out"),
                       F.col(text).alias("_text")) \
        .mapInPandas(run, "doc_id string, held_out boolean, lang_pred string, score double, "
                          "langs array<string>, shares array<double>") \
        .withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType))
