"""Aggregation, statistics and top-k plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bramble.functions.columns import big, r6
from bramble.operators import ranking, stats
from bramble.plans.registry import Tables, plan
from bramble.plans.registry import r6 as sql6


@plan("D1 D3", oracle=f"""
    SELECT count(*) AS n, {sql6('avg(o_totalprice)')} AS mean, max(o_totalprice) AS top FROM orders""")
def global_average(t: Tables) -> DataFrame:
    return t.orders.agg(F.count("*").alias("n"), r6(F.avg("o_totalprice")).alias("mean"),
                        F.max("o_totalprice").alias("top"))


@plan("D2", oracle="""
    SELECT event_id, value FROM events WHERE value = (SELECT max(value) FROM events)""")
def argmax_rows(t: Tables) -> DataFrame:
    top = t.events.agg(F.max("value")).scalar()
    return t.events.where(F.col("value") == top).select("event_id", "value")




@plan("D5 D6", oracle="""
    WITH q AS (SELECT l_suppkey, l_partkey, sum(l_quantity) AS qty FROM lineitem GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY qty DESC, l_partkey) AS rank FROM q)
    SELECT l_suppkey, string_agg(l_partkey::VARCHAR, ' ' ORDER BY rank) AS best FROM r
    WHERE rank <= 5 GROUP BY l_suppkey""")
def best_list_per_key(t: Tables) -> DataFrame:
    sold = t.lineitem.groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("qty"))
    top = ranking.top_per_key(sold, ["l_suppkey"], [F.desc("qty"), F.asc("l_partkey")], 5)
    parts = F.array_sort(F.collect_list(F.struct("rank", "l_partkey")))["l_partkey"]
    return top.groupBy("l_suppkey").agg(F.array_join(parts.cast("array<string>"), " ").alias("best"))


@plan("D6", oracle="""
    SELECT o_custkey, o_orderkey, o_totalprice, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank
        FROM orders) WHERE rank <= 3""")
def top_k_per_key(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return ranking.top_per_key(rows, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3) \
        .withColumn("rank", big("rank"))


@plan("D7 Q3", oracle="""
    SELECT label::BIGINT AS label, count(*) AS n, 10::BIGINT AS classes FROM embeddings GROUP BY label""")
def label_histogram(t: Tables) -> DataFrame:
    n = stats.class_count(t.embeddings)
    return stats.label_histogram(t.embeddings).withColumn("classes", F.lit(n).cast("bigint"))


_X = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _summary_sql(weighted: bool) -> str:
    parts = []
    for i, c in enumerate(_X):
        if weighted:
            mean = f"sum({c} * l_linenumber) / sum(l_linenumber)"
            var = (f"(sum(l_linenumber * {c} ** 2) - sum(l_linenumber * {c}) ** 2 / sum(l_linenumber))"
                   f" / (sum(l_linenumber) - sum(l_linenumber ** 2) / sum(l_linenumber))")
        else:
            mean, var = f"avg({c})", f"var_samp({c})"
        scale = "1e6" if c == "l_extendedprice" else "1"
        parts.append(f"SELECT {i}::BIGINT AS pos, round({mean}, 5) AS mean, "
                     f"round({var} / {scale}, 5) AS variance FROM lineitem")
    return " UNION ALL ".join(parts)


def _summary(t: Tables, weight: str | None) -> DataFrame:
    rows = stats.assemble(t.lineitem.withColumn("w", F.col("l_linenumber").cast("double")), _X)
    scale = F.when(F.col("pos") == 1, 1e6).otherwise(1.0)
    return stats.moments(rows, weight=weight).select(
        "pos", F.round("mean", 5).alias("mean"), F.round(F.col("variance") / scale, 5).alias("variance"))


@plan("D10", oracle=_summary_sql(False))
def summary_stats(t: Tables) -> DataFrame:
    return _summary(t, None)


@plan("D10", oracle=_summary_sql(True))
def summary_stats_weighted(t: Tables) -> DataFrame:
    return _summary(t, "w")


@plan("D11", oracle=" UNION ALL ".join(
    f"SELECT {i}::BIGINT AS i, {j}::BIGINT AS j, {sql6(f'corr({a}, {b})')} AS corr FROM lineitem"
    for i, a in enumerate(_X) for j, b in enumerate(_X)))
def corr_pearson(t: Tables) -> DataFrame:
    return stats.correlations(t.lineitem, _X).withColumn("corr", r6("corr"))


@plan("D12", oracle="WITH k AS (SELECT " + ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in _X)
    + " FROM lineitem) " + " UNION ALL ".join(
    f"SELECT {i}::BIGINT AS i, {j}::BIGINT AS j, {sql6(f'corr({a}, {b})')} AS corr FROM k"
    for i, a in enumerate(_X) for j, b in enumerate(_X)))
def corr_spearman(t: Tables) -> DataFrame:
    return stats.correlations(t.lineitem, _X, method="spearman") \
        .withColumn("corr", r6("corr"))


def chi_rows(t: Tables) -> DataFrame:
    """Orders with four small categorical slots and a priority label."""
    rows = t.orders.select(
        F.substring("o_orderpriority", 1, 1).cast("double").alias("label"),
        F.ascii("o_orderstatus").cast("double").alias("status"),
        F.month("o_orderdate").cast("double").alias("month"),
        (F.col("o_totalprice") > 250000).cast("double").alias("dear"),
        (F.substring("o_orderpriority", 1, 1).cast("int") % 2).cast("double").alias("odd"))
    return stats.assemble(rows, ["status", "month", "dear", "odd"])


def _chi_sql() -> str:
    base = """WITH o AS (SELECT o_orderpriority[1] AS y, o_orderstatus AS x0, month(o_orderdate) AS x1,
        o_totalprice > 250000 AS x2, o_orderpriority[1]::INT % 2 AS x3 FROM orders)"""
    # five priorities make the degrees of freedom even, for which the tail is a finite sum
    one = """SELECT pos, round(chi, 6) AS statistic, dof,
        round(exp(-chi / 2) * list_sum([(chi / 2) ** k / factorial(k::INT) FOR k IN range(dof // 2)]), 6) AS p_value
        FROM (SELECT {i}::BIGINT AS pos, sum((coalesce(n, 0) - e) ** 2 / e) AS chi,
        (any_value(dx) - 1) * (any_value(dy) - 1) AS dof
        FROM (SELECT a.x, b.y, a.n * b.n / (SELECT count(*) FROM o) AS e,
                     (SELECT count(DISTINCT x{i}) FROM o) AS dx, (SELECT count(DISTINCT y) FROM o) AS dy
              FROM (SELECT x{i} AS x, count(*) AS n FROM o GROUP BY 1) a,
                   (SELECT y, count(*) AS n FROM o GROUP BY 1) b) m
        LEFT JOIN (SELECT x{i} AS x, y, count(*) AS n FROM o GROUP BY ALL) c USING (x, y))"""
    return base + " UNION ALL ".join(one.format(i=i) for i in range(4))


@plan("D13", oracle=_chi_sql())
def chi_square(t: Tables) -> DataFrame:
    return stats.independence(chi_rows(t)).select(
        "pos", r6("statistic").alias("statistic"), "dof", r6("p_value").alias("p_value"))


@plan("D14", oracle="""
    SELECT count(DISTINCT p_brand) AS brands, count(DISTINCT p_type) AS types FROM part""")
def category_counts(t: Tables) -> DataFrame:
    return t.part.agg(F.countDistinct("p_brand").alias("brands"), F.countDistinct("p_type").alias("types"))


@plan("D15", oracle=f"""
    WITH g AS (SELECT o_custkey, ln(count(*)) AS x, ln(avg(o_totalprice)) AS y FROM orders GROUP BY 1)
    SELECT {sql6('regr_slope(y, x)')} AS slope, {sql6('regr_intercept(y, x)')} AS intercept FROM g""")
def log_line_fit(t: Tables) -> DataFrame:
    points = t.orders.groupBy("o_custkey").agg(F.log(F.count("*")).alias("x"),
                                               F.log(F.avg("o_totalprice")).alias("y"))
    return points.agg(r6(F.regr_slope("y", "x")).alias("slope"),
                      r6(F.regr_intercept("y", "x")).alias("intercept"))


RATINGS_SQL = """r AS (SELECT o_custkey AS u, l_partkey AS i, sum(l_quantity) AS rating
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)"""


def ratings(t: Tables) -> DataFrame:
    """Customer, part and total quantity bought."""
    return t.lineitem.select("l_orderkey", "l_partkey", "l_quantity") \
        .join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")) \
        .groupBy(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item")) \
        .agg(F.sum("l_quantity").alias("rating"))


@plan("C1", oracle=f"""
    WITH {RATINGS_SQL}, p AS (SELECT o_custkey AS u, l_partkey AS i, avg(l_quantity) AS prediction
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_discount > 0 GROUP BY ALL)
    SELECT u AS user, i AS item, rating, {sql6('prediction')} AS prediction FROM r JOIN p USING (u, i)""")
def rating_join(t: Tables) -> DataFrame:
    """Predicted and actual ratings matched on the composite key, in one aggregation by that key."""
    priced = F.when(F.col("l_discount") > 0, F.col("l_quantity"))
    return t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_discount") \
        .join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")) \
        .groupBy(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item")) \
        .agg(F.sum("l_quantity").alias("rating"), r6(F.avg(priced)).alias("prediction")) \
        .where("prediction is not null")
