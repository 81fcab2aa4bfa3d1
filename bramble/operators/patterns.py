"""Baskets, frequent itemsets, association rules and sequential patterns."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth, FPGrowthModel, PrefixSpan
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bramble.operators.ranking import top_per_key
from bramble.session import materialise


def baskets(df: DataFrame, key: str, item: str, items: str = "items") -> DataFrame:
    """One row per key with its distinct items, sorted; repeats are removed before grouping."""
    return df.select(key, item).distinct().groupBy(key) \
        .agg(F.array_sort(F.collect_list(item)).alias(items))


def mine(df: DataFrame, *, items: str = "items", min_support: float = 0.5,
         min_confidence: float = 0.8, partitions: int | None = None) -> FPGrowthModel:
    """Parallel FP-growth: conditional transactions are shuffled by item group."""
    learner = FPGrowth(itemsCol=items, minSupport=min_support, minConfidence=min_confidence)
    if partitions:
        learner = learner.setNumPartitions(partitions)
    return learner.fit(df)


def item_key(items: str) -> Column:
    return F.array_join(F.array_sort(items), "_")


#: rules that are broadcast; rows that one key of a frequent item may have
FEW_RULES, HOT_ROWS = 100_000, 4096


def apply_rules(rows: DataFrame, key: str, rules: DataFrame, items: str = "items", out: str = "prediction") -> DataFrame:
    """``(key, out)``: consequents of the rules whose antecedents a row holds and which it lacks.

    A rule meets the rows of its rarest antecedent item only, and the row's own items decide the
    rest. A few rules are broadcast; many meet the rows in a shuffle, in which a frequent item's
    rows are dealt to several keys and its rules are repeated for each.
    """
    named = rules.select(F.col("consequent")[0].alias("_then"), F.array_distinct("antecedent").alias("_if"))
    held = rows.select(key, F.array_distinct(items).alias("_has")).withColumn("_item", F.explode("_has"))
    counts = materialise(held.groupBy("_item").agg(F.count("*").alias("_rows")), "items")
    each = named.withColumn("_item", F.explode("_if")).join(counts, "_item", "left")   # an item no row has is the rarest
    rarest = each.groupBy("_then", "_if").agg(F.min(F.struct(F.coalesce("_rows", F.lit(0)).alias("_rows"), "_item")).alias("_r"))
    needs = materialise(rarest.select("_then", "_if", "_r._item", "_r._rows").where("_rows > 0"), "rules")
    fits = (F.size(F.array_except("_if", "_has")) == 0) & ~F.array_contains("_has", F.col("_then"))
    if needs.count() <= FEW_RULES:
        met = held.join(F.broadcast(needs.drop("_rows")), "_item")
    else:
        keys = F.ceil(F.col("_rows") / HOT_ROWS).cast("int")
        spread = needs.withColumn("_salt", F.explode(F.sequence(F.lit(0), keys - 1))).drop("_rows")
        frequent = counts.where(F.col("_rows") > HOT_ROWS)
        dealt = held.join(frequent.withColumnRenamed("_rows", "_n") if frequent.count() > FEW_RULES
                          else F.broadcast(frequent.withColumnRenamed("_rows", "_n")), "_item", "left")
        salt = F.pmod(F.xxhash64(key), F.ceil(F.coalesce("_n", F.lit(1)) / HOT_ROWS)).cast("int")
        met = dealt.withColumn("_salt", salt).join(spread, ["_item", "_salt"])
    return met.where(fits).select(key, "_then").distinct().groupBy(key) \
        .agg(F.array_sort(F.collect_list("_then")).alias(out))


def rule_rollup(rules: DataFrame, best: int = 5) -> DataFrame:
    """For single-item antecedents the consequents of highest confidence, best first."""
    rows = rules.where(F.size("antecedent") == 1).select(
        F.col("antecedent")[0].alias("item"), F.col("consequent")[0].alias("other"), "confidence")
    top = top_per_key(rows, ["item"], [F.desc("confidence"), F.asc("other")], best)
    ordered = F.array_sort(F.collect_list(F.struct("rank", "other")))["other"]
    return top.groupBy("item").agg(ordered.alias("also"))


def sequences(df: DataFrame, key: str, time: str, item: str, out: str = "sequence") -> DataFrame:
    """Per key the day-by-day sets of distinct items, in time order."""
    days = df.select(key, F.to_date(time).alias("_day"), item).distinct() \
        .groupBy(key, "_day").agg(F.array_sort(F.collect_list(item)).alias("_set"))
    return days.groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_day", "_set"))), lambda d: d["_set"]).alias(out))


def frequent_sequences(df: DataFrame, *, sequence: str = "sequence", min_support: float = 0.5,
                       max_length: int = 5) -> DataFrame:
    return PrefixSpan(minSupport=min_support, maxPatternLength=max_length, sequenceCol=sequence) \
        .findFrequentSequentialPatterns(df)
