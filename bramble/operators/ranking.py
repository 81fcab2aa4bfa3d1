"""Top-k per key, running totals and best-scoring partners."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bramble.functions.columns import dot
from bramble.operators import neighbours as nb
from bramble.session import materialise, spread


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int,
                rank: str = "rank") -> DataFrame:
    """The first k rows of every key; Spark applies the limit before the shuffle as well."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


#: of a score join: longest items that bound the scores, rows of a panel and of a cluster in it, and tasks at most
FIRST_ITEMS, PANEL_ROWS, LEAF_ROWS, MOST_TASKS = 2048, 1 << 16, 512, 4096
#: distinct rows that one bucket of a running total holds, if the session's partitions are fewer
BUCKET_ROWS = 1_000_000


def running_totals(df: DataFrame, by: str, sums: Sequence[str], *, descending: bool = False,
                   buckets: int | None = None, within: Sequence[str] = ()) -> DataFrame:
    """Add ``cum_<name>`` for each column of ``sums``, accumulated in the order of ``by``, per group of ``within``.

    Rows must be unique in ``within`` and ``by`` (aggregate first). They are dealt out by ranges;
    each range is accumulated on its own and shifted by the totals of its group in the ranges
    before it, so no task sorts a whole group. The number of ranges follows the row count.
    """
    df = materialise(df, "totals")
    if buckets is None:
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        buckets = max(2, parts, -(-df.count() // BUCKET_ROWS))
    order = F.col(by).desc() if descending else F.col(by).asc()
    placed = materialise(df.repartitionByRange(buckets, *within, order).withColumn("_bucket", F.spark_partition_id()), "ranges")
    before = Window.partitionBy(*(within or [F.lit(0)])).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("_bucket", *within).agg(*[F.sum(s).alias(s) for s in sums])
    shifts = totals.select("_bucket", *within, *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"_b_{s}")
                                                 for s in sums])   # one row per range and group in it
    inside = Window.partitionBy("_bucket", *within).orderBy(order) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # ungrouped totals have one row per range; groups may be many
    shifts = shifts if within else F.broadcast(shifts)
    return placed.join(shifts, ["_bucket", *within]).select(
        *df.columns, *[(F.sum(s).over(inside) + F.col(f"_b_{s}")).alias(f"cum_{s}") for s in sums])


def number_rows(df: DataFrame, key: str, out: str = "row_no") -> DataFrame:
    """Consecutive numbers from 0 in the order of a unique key."""
    counted = running_totals(df.withColumn("_one", F.lit(1)), key, ["_one"])
    return counted.withColumn(out, (F.col("cum__one") - 1).cast("bigint")).drop("_one", "cum__one")


def number_values(counts: DataFrame, value: str, out: str = "index", *, by_count: bool = False) -> DataFrame:
    """Numbers from 0 for the rows of ``value, n``: in the order of the values, or of falling counts, ties by value.

    Rows are unique in ``value``. They are dealt out by ranges of that order and numbered range by range.
    """
    if not by_count:
        return number_rows(counts, value, out)
    order = F.struct((-F.col("n")).alias("rare"), F.col(value).alias("value"))
    return number_rows(counts.withColumn("_order", order), "_order", out).drop("_order")


def average_ranks(df: DataFrame, column: str, out: str = "rank") -> DataFrame:
    """``(value, rank)``: the mean position of every distinct value, ties sharing one rank."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    totals = running_totals(counts, "value", ["n"])
    return totals.select("value", (F.col("cum_n") - (F.col("n") - 1) / 2.0).alias(out))


def average_ranks_of(df: DataFrame, columns: Sequence[str], out: str = "rank") -> DataFrame:
    """``(slot, value, rank)`` of several numeric columns in one pass; ``slot`` is the column's place in the list."""
    stacked = df.select(F.posexplode(F.array(*[F.col(c).cast("double") for c in columns])).alias("slot", "value"))
    counts = stacked.groupBy("slot", "value").agg(F.count("*").alias("n"))
    totals = running_totals(counts, "value", ["n"], within=["slot"])
    return totals.select("slot", "value", (F.col("cum_n") - (F.col("n") - 1) / 2.0).alias(out))


def exact_quantiles(df: DataFrame, column: str, shares: Sequence[float]) -> list[float]:
    """The smallest values that reach each share of the rows; one row per share leaves the cluster."""
    values = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")) \
        .agg(F.count("*").alias("n"))
    totals = running_totals(values, "value", ["n"])
    rows = totals.agg(F.max("cum_n")).first()[0] or 0
    row = totals.agg(*[F.min(F.when(F.col("cum_n") >= rows * s - 1e-9, F.col("value"))).alias(f"q{i}")
                       for i, s in enumerate(shares)]).first()
    return [float(v) for v in row]


def _best_of_panel(y: np.ndarray, tie: np.ndarray, x: np.ndarray, bound: np.ndarray, n: int, pivots: int | None):
    """``(query row, item row, score)`` of each query's n best items that reach its bound, ties in the order of ``tie``.

    Items are met in clusters of large norms first. No score in a cluster exceeds the query's length
    times the largest norm, nor the centre's score plus that length times the radius.
    """
    rng = np.random.default_rng(len(y))
    seeds = y[rng.choice(len(y), min(len(y), pivots or -(-len(y) // LEAF_ROWS)), replace=False)]
    near = np.concatenate([nb._squared(y[part], seeds).argmin(1) for part in nb._chunks(len(y), len(seeds))])
    order = np.argsort(near, kind="stable")
    norms, lengths = np.sqrt((y * y).sum(1)), np.sqrt((x * x).sum(1))
    clusters = [rows[lo:lo + nb.BLOCK_ROWS] for rows in np.split(order, np.flatnonzero(np.diff(near[order])) + 1)
                for lo in range(0, len(rows), nb.BLOCK_ROWS)]
    clusters.sort(key=lambda rows: -norms[rows].max())
    least, longest = bound.copy(), lengths.max()
    score, item = np.full((len(x), n), -np.inf), np.full((len(x), n), -1, np.int64)
    for rows in clusters:
        inside, top = y[rows], norms[rows].max()
        centre = inside.mean(0)
        radius = np.sqrt(((inside - centre) ** 2).sum(1).max())
        # of sums in single precision and another order, which only prune; double where single has no such range
        kind, unit = (np.float32, 1.2e-7) if 1e-15 < top * longest < 1e30 else (float, 2.3e-16)
        slack = (2 * y.shape[1] + 8) * unit * lengths * top + 1e-30 * (kind is np.float32)
        most = np.minimum(lengths * top, x @ centre + lengths * radius) + slack
        right = inside.T.astype(kind)
        for part in nb._chunks(len(at := np.flatnonzero(most >= least)), len(rows), nb._PAIR_CELLS):
            some = at[part]
            rough = x[some].astype(kind) @ right
            need = (least[some] - slack[some]).astype(kind)
            open_ = rough.max(1) >= need                    # few queries are, after the first clusters
            some, rough, need = some[open_], rough[open_], need[open_]
            keep = rough >= need[:, None]
            if n < len(rows) and np.count_nonzero(keep) > 4 * n * len(some):
                cut = np.partition(rough, len(rows) - n, axis=1)[:, len(rows) - n]
                keep &= rough >= (cut - 2 * slack[some]).astype(kind)[:, None]
            qi, bi = np.divmod(np.flatnonzero(keep), len(rows))
            if not len(qi):
                continue
            qi, bi = some[qi], rows[bi]
            found = np.zeros(len(qi))
            for slot in range(y.shape[1]):                  # in the order of ``dot``
                found += x[qi, slot] * y[bi, slot]
            met = np.unique(qi)
            qi, bi = np.concatenate([np.repeat(met, n), qi]), np.concatenate([item[met].ravel(), bi])
            found = np.concatenate([score[met].ravel(), found])
            qi, bi, found = (v[bi >= 0] for v in (qi, bi, found))
            qi, bi, less, place = nb._first(qi, bi, -found, tie, n)
            score[met], item[met] = -np.inf, -1
            score[qi, place], item[qi, place] = -less, bi
            least[met] = np.maximum(least[met], score[met, n - 1])
    qi, place = np.nonzero(item >= 0)
    return qi, item[qi, place], score[qi, place]


def top_scores(users: DataFrame, items: DataFrame, n: int, *, user_id: str, item_id: str,
               user_factors: str = "features", item_factors: str = "features",
               num_pivots: int | None = None) -> DataFrame:
    """For every user the n items of largest dot product: ``(user, item, rank, score)``, exactly.

    No score exceeds the product of the norms, so items lie in panels by falling norm. The n-th best
    score among the ``FIRST_ITEMS`` longest items bounds the result from below, and a user meets only
    the panels whose norms reach that bound, in parts of bounded size. ``num_pivots`` is the number of
    clusters in a panel, which are left out by the bound in turn.
    """
    spark = items.sparkSession
    y = items.select(F.col(item_id).alias("item"), nb._points(items, item_factors).alias("vec")).where(F.col("vec").isNotNull())
    y = materialise(y.withColumn("n2", dot(*[F.col("vec").cast("array<double>")] * 2)).where(~F.isnan("n2")), "items")
    x = users.select(F.col(user_id).alias("user"), nb._points(users, user_factors).alias("vec")).where(F.col("vec").isNotNull())
    total, width = y.agg(F.count("*"), F.max(F.size("vec"))).first()
    if not total:
        return x.select("user", F.lit(None).cast(items.schema[item_id].dataType).alias("item"),
                        F.lit(0).alias("rank"), F.lit(0.0).alias("score")).limit(0)
    cores = spark.sparkContext.defaultParallelism
    rows = max(nb.BLOCK_ROWS, min(PANEL_ROWS, nb.PANEL_BYTES // (8 * max(1, width))))
    pieces = lambda count: max(1, math.ceil(count / rows), min(math.ceil(math.sqrt(cores)), math.ceil(count / nb.BLOCK_ROWS)))
    first = np.array([r.vec for r in y.orderBy(F.desc("n2"), "item").limit(FIRST_ITEMS).select("vec").collect()], dtype=float)

    # ranges of falling norm; equal norms cannot be told apart and are dealt to several panels
    ranges = pieces(total)
    cuts = y.agg(F.percentile_approx("n2", [1 - i / ranges for i in range(1, ranges)], 10_000)).first()[0] if ranges > 1 else []
    cuts = sorted(set(cuts), reverse=True)
    at = F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: c > F.col("n2"))) if cuts else F.lit(0)
    y = y.withColumn("range", at)
    held = {r.range: r for r in y.groupBy("range").agg(F.count("*").alias("n"), F.max("n2").alias("top")).collect()}
    norms = [math.sqrt(held[r].top) if r in held else 0.0 for r in range(max(held) + 1)]
    norms = np.maximum.accumulate(np.array(norms)[::-1])[::-1] * (1 + 1e-9)

    @F.pandas_udf("bound double, reach int")
    def routed(vec: pd.Series) -> pd.DataFrame:
        q = nb._stacked(vec, width)
        lengths, bound = np.sqrt((q * q).sum(1)), np.full(len(q), -np.inf)
        if len(first) >= n:
            for part in nb._chunks(len(q), len(first)):
                bound[part] = np.partition(q[part] @ first.T, len(first) - n, axis=1)[:, len(first) - n]
            bound -= 1e-9 * lengths * norms[0]
        reach = (lengths[:, None] * norms[None, :] >= bound[:, None]).sum(1)
        return pd.DataFrame({"bound": bound, "reach": reach.astype(np.int32)})

    asked = materialise(spread(x).withColumn("_r", routed("vec")).select("user", "vec", "_r.bound", "_r.reach"), "queries")
    reached = {r.reach: r["count"] for r in asked.groupBy("reach").count().collect()}
    panel = 1.25 * math.ceil(total / ranges)                # ranges are of about equal size but where norms are equal
    table = [(r, math.ceil(held[r].n / panel), pieces(sum(c for reach, c in reached.items() if reach > r))) for r in sorted(held)]
    tasks = sum(subs * parts for _, subs, parts in table)
    table = F.broadcast(spark.createDataFrame(table, "range int, subs int, parts int"))    # one row per range
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    base = y.join(table, "range").select("item", "vec", "range", F.pmod(F.xxhash64("item", "vec"), F.col("subs")).cast("int").alias("sub"),
                                         every("parts").alias("part"))
    query = asked.where("reach > 0").withColumn("range", F.explode(F.sequence(F.lit(0), F.col("reach") - 1))).join(table, "range") \
        .select("user", "vec", "bound", "range", F.pmod(F.xxhash64("user", "vec"), F.col("parts")).cast("int").alias("part"), every("subs").alias("sub"))

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        qi, bi, found = np.empty(0, int), np.empty(0, int), np.empty(0)
        if left.num_rows and right.num_rows:
            tie = np.unique(nb._ids(left["item"]), return_inverse=True)[1]
            qi, bi, found = _best_of_panel(nb._matrix(left["vec"]), tie, nb._matrix(right["vec"]),
                                           nb._ids(right["bound"]).astype(float), n, num_pivots)
        return pa.table({"user": right["user"].take(pa.array(qi, pa.int64())), "item": left["item"].take(pa.array(bi, pa.int64())),
                         "score": pa.array(found, pa.float64())})

    keys = ["range", "sub", "part"]
    out = T.StructType([T.StructField("user", x.schema["user"].dataType), T.StructField("item", y.schema["item"].dataType),
                        T.StructField("score", T.DoubleType())])
    # few and heavy groups, a task or two for each, so none are put together
    dealt = [side.repartition(min(2 * tasks, MOST_TASKS), *keys) for side in (base, query)]
    best = dealt[0].groupBy(*keys).cogroup(dealt[1].groupBy(*keys)).applyInArrow(compare, schema=out)
    order = [F.desc("score"), F.asc("item")]
    best = top_per_key(best, ["user"], order, n).select("user", "item", "score")
    return top_per_key(best.join(asked.select("user"), "user"), ["user"], order, n).select("user", "item", "rank", "score")
