"""Mixing sources to target weights by Pareto order sampling (operator 1).

Every source has a target of words. Whole copies that all its documents get are taken for certain;
the words that remain are filled by a sample of unequal probabilities: a document's inclusion
probability is proportional to the square root of its words, so long documents are favoured, though
less than in proportion, and documents for which that reaches 1 are certain as well. The factor is set
so that the expected words equal the words that remain. A document's place in the Pareto order is
the odds of a uniform random number over the odds of its inclusion; documents are taken in that
order until the source's remaining words are used up. Random numbers are hashes of the row's number
in the sorted table, so that reruns agree whatever the partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bramble.llm.common import PLACE, SPACE, addressable, join_by_weight, numbered, text_of
from bramble.session import materialise

WEIGHTS = (5.0, 2.0, 1.0)
MAX_COPIES = 3
#: documents of a source that one task orders row by row
BUCKET = 4_000


def words_in(text: str) -> Column:
    """Number of words: starts of runs without ASCII white space; null has none."""
    trimmed = F.regexp_replace(text_of(text), "^" + SPACE + "+|" + SPACE + "+$", "")
    gaps = F.regexp_count(trimmed, F.lit(SPACE + "+"))
    return F.when(trimmed == "", 0).otherwise(gaps + 1).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, cap: int = MAX_COPIES) -> DataFrame:
    """Adds ``target`` to ``(key, source, docs, words)``, one row per source.

    Sources in code point order, null last, take the weights in turn and share all words; no target
    exceeds ``cap`` times its source's words, and the excess is shared again by weight. That ends at
    one price per weight: a source is capped when its cap per weight is below the price, which
    rises until the capped set is stable. Each step is one aggregate over the sources.
    """
    ranked = numbered(sizes.withColumn("_null", F.col("source").isNull().cast("int")), ["_null", "source"], "place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("most", F.col("words") * float(cap))
    ranked = materialise(ranked, "sources")
    total, mass = ranked.agg(F.sum("words"), F.sum("weight")).first()
    price, capped = (float(total) / mass if mass else 0.0), -1
    while True:
        full = F.col("most") <= F.lit(price) * F.col("weight")
        held, used, n = ranked.agg(F.sum(F.when(full, F.col("most"))), F.sum(F.when(full, F.col("weight"))),
                                   F.count(F.when(full, 1))).first()
        if n == capped or (used is not None and mass - used <= 0):
            break
        capped = n
        if used is not None:
            price = (total - held) / (mass - used)
    return ranked.withColumn("target", F.least("most", F.lit(price) * F.col("weight"))) \
        .select("key", "source", "docs", "words", "target")


def inclusion_factors(sizes: DataFrame, budgets: DataFrame) -> DataFrame:
    """``key, factor``: inclusion probabilities are ``least(1, factor * sqrt(size))`` and their words add up to the budget.

    ``sizes`` holds ``key, size, docs``, one row per size of a source. Documents whose probability
    reaches 1 are set aside and the factor is computed anew, until no more do; every step is one
    aggregate over the sizes.
    """
    held = materialise(sizes.where("size > 0").join(budgets.select("key", "budget"), "key").where("budget > 0"), "sizes")
    mass = F.col("docs") * F.col("size")
    # the largest size that is not certain; nothing is at first
    limits = materialise(held.groupBy("key").agg(F.max("size").alias("limit")), "limits")
    while True:
        open_ = F.col("size") <= F.col("limit")
        sums = held.join(limits, "key").groupBy("key", "limit").agg(
            F.first("budget").alias("budget"), F.sum(F.when(~open_, mass)).alias("certain"),
            F.sum(F.when(open_, mass * F.sqrt("size"))).alias("mass"))
        factor = (F.col("budget") - F.coalesce("certain", F.lit(0))) / F.col("mass")
        steps = materialise(sums.withColumn("factor", factor)
                            .withColumn("next", F.floor(1 / (F.col("factor") * F.col("factor")) - 1e-9)), "factors")
        # a size is certain from factor * sqrt(size) >= 1 on
        if steps.where("next < limit").isEmpty():
            return steps.select("key", "factor")
        limits = materialise(steps.select("key", F.least("next", "limit").alias("limit")), "limits")


def plan_mix(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source",
             weights: Sequence[float] = WEIGHTS, cap: int = MAX_COPIES, seed: int = 7,
             keep: Sequence[str] = ()) -> DataFrame:
    """``doc_id, size, source_size, target, copies, taken, inclusion`` for every row, and the columns in ``keep``.

    Null texts have size 0 and take no words, a null source is a source, repeated rows are sampled
    one by one. The words taken from a source differ from its target by less than half of the smallest
    document left in the last stretch of the order. Ties in the order go to the row of smaller number.
    """
    key = F.when(F.col(source).isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), F.col(source)))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), key.alias("key"),
                       words_in(text).alias("size"), F.xxhash64(text_of(text)).alias("_h"), *keep)
    rows = materialise(numbered(rows, ["doc_id", "_h", "key"]), "mix")
    sizes = rows.groupBy("key", "source").agg(F.count("*").alias("docs"), F.sum("size").alias("words"))
    shares = source_targets(materialise(sizes, "sizes"), weights, cap)
    copies = F.when(F.col("words") > 0, F.col("target") / F.col("words")).otherwise(0.0)
    shares = shares.withColumn("whole", F.floor(copies + 1e-12)).withColumn(
        "budget", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("words"))) \
        .withColumn("mean", F.greatest(F.lit(0.0), copies - F.col("whole")))
    shares = materialise(shares.drop("source"), "budgets")
    counted = rows.groupBy("key", "size").agg(F.count("*").alias("docs"))
    factors = inclusion_factors(counted, shares)
    shares = materialise(shares.join(factors, "key", "left"), "shares")
    joined = join_by_weight(rows, shares, "key", "docs", rows.count())
    u = (F.shiftrightunsigned(F.xxhash64("number", F.lit(seed)), 11) + 0.5) * F.lit(2.0 ** -53)
    joined = joined.withColumn("inclusion", F.least(F.lit(1.0), F.coalesce(F.col("factor") * F.sqrt("size"), F.lit(0.0))))
    # certain documents come first
    order = F.when(F.col("inclusion") >= 1, 0.0).otherwise((u / (1 - u)) * (1 - F.col("inclusion")) / F.col("inclusion"))
    # a monotone function of the order that is about uniform in a source
    odds = F.col("mean") / (1 - F.col("mean"))
    stretch = F.floor(F.col("order") * odds / (1 + F.col("order") * odds) * F.ceil(F.col("docs") / BUCKET))
    sampled = F.col("inclusion") > 0
    placed = materialise(joined.withColumn("order", F.when(sampled, order))
                         .withColumn("stretch", F.when(sampled, stretch)), "order")
    run = Window.partitionBy("key").orderBy("stretch")
    sums = placed.where("stretch is not null").groupBy("key", "stretch").agg(
        F.sum("size").alias("held"), F.first("budget").alias("budget"))
    sums = sums.withColumn("upto", F.sum("held").over(run))
    cut = materialise(sums.where("upto > budget").groupBy("key").agg(
        F.min(F.struct("stretch", (F.col("budget") - F.col("upto") + F.col("held")).alias("room"))).alias("c"))
        .select("key", "c.*", F.lit(True).alias("_cut")), "cut")
    whole = sums.where("upto <= budget").select("key", "stretch")
    last = placed.join(cut.select("key", "stretch", "room"), ["key", "stretch"]) \
        .select("key", "number", "order", "size", "room").groupBy("key") \
        .applyInPandas(_take_in_order, "number long, taken_too boolean")
    sure = placed.join(whole, ["key", "stretch"], "left_semi").select("number", F.lit(True).alias("taken_too"))
    chosen = placed.join(sure.unionByName(last.where("taken_too")), "number", "left")
    copies = F.col("whole") + F.coalesce(F.col("taken_too"), F.lit(False)).cast("long")
    return chosen.select("doc_id", "size", F.col("words").alias("source_size"), "target", copies.alias("copies"),
                         (copies * F.col("size")).alias("taken"), "inclusion", *keep)


def _take_in_order(rows: pd.DataFrame) -> pd.DataFrame:
    """Of the stretch in which a source's words run out, take each document that still fits.

    One more closes the gap if it overshoots by less than what is missing.
    """
    rows = rows.sort_values(["order", "number"])
    sizes = rows["size"].tolist()
    room, taken = float(rows["room"].iloc[0]), []
    for size in sizes:
        taken.append(0 < size <= room)
        room -= size if taken[-1] else 0
    over, last = min(((size - room, k) for k, size in enumerate(sizes) if size > 0 and not taken[k]),
                     default=(room, None))
    if last is not None and over < room:
        taken[last] = True
    return pd.DataFrame({"number": rows["number"], "taken_too": taken})


def mixed(docs: DataFrame, *, stored: bool = False, **options) -> DataFrame:
    """The rows of ``docs`` in the mix, each as often as it is taken, with the columns of ``docs``."""
    content = addressable(docs, stored=stored)
    plan = plan_mix(content, keep=PLACE, **options).where("copies > 0") \
        .select(*PLACE, F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_bramble_copy"))
    return content.join(plan, list(PLACE)).select(*docs.columns)
