"""Exact and approximate nearest-neighbour joins over vector columns.

Distinct base vectors are assigned to the cell of their nearest pivot, and crowded cells are split
once more by pivots of their own. Queries first search their home leaf, which bounds the distance of
the k-th neighbour, and are then sent only to the cells, and in them to the leaves, that the triangle
inequality cannot exclude (the published two-phase MapReduce kNN-join scheme). Leaves are cut into
blocks, and so are the queries of a leaf where they are many. A vector stands for all its copies; ids
and other columns are looked up for the vectors found.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bramble.functions.columns import as_array
from bramble.session import materialise

BLOCK_ROWS = 4096
#: pivots of the first level, and of a crowded cell
MAX_PIVOTS, MAX_SUBS = 4096, 1024
#: narrow rows up to which a table is broadcast
BROADCAST_ROWS = 100_000
#: blocks of queries in one leaf from which both sides are cut
QUERY_BLOCKS = 4
#: a panel of vectors, which queries with many leaves in reach meet whole: blocks and bytes at most
PANEL_BLOCKS, PANEL_BYTES = 64, 1 << 25
_CHUNK_CELLS = 4_000_000
_PAIR_CELLS = 1 << 19
_SLACK = 1e-6


# --- numeric kernels, run inside tasks on one block ------------------------------------------

def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(flat)
    if not n:
        return np.empty((0, 0))
    return flat.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(n, -1)


def _stacked(vec: pd.Series, width: int) -> np.ndarray:
    return np.vstack(vec.to_numpy()).astype(float, copy=False) if len(vec) else np.empty((0, width))


def _squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances by the norm identity; used only to prune."""
    out = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2.0 * (x @ y.T)
    return np.maximum(out, 0.0)


def _chunks(rows: int, width: int, cells: int = _CHUNK_CELLS):
    step = max(1, cells // max(1, width))
    for start in range(0, rows, step):
        yield slice(start, min(rows, start + step))


def _ids(column) -> np.ndarray:
    return column.to_numpy() if isinstance(column, pa.ChunkedArray) else np.asarray(column)


def _pairs(x: np.ndarray, y: np.ndarray, tie: np.ndarray, bound: np.ndarray, *, k: int | None, strict: bool,
           skip_zero: bool):
    """Candidate ``(query row, base row, distance)`` within each query's bound, its k nearest if k is given."""
    y2 = (y * y).sum(1)
    scale = float(y2.max())
    right = np.vstack([-2.0 * y.T, np.ones(len(y)), y2])
    found = []
    for part in _chunks(len(x), len(y), _PAIR_CELLS):
        xs = x[part]
        x2 = (xs * xs).sum(1)
        approx = np.hstack([xs, x2[:, None], np.ones((len(xs), 1))]) @ right   # norm identity; used only to prune
        slack = 1e-9 * (x2 + scale) + 1e-18
        if skip_zero:
            approx[_exact_zero(xs, y, approx, slack)] = np.inf
        keep = approx <= (bound[part] ** 2 + slack)[:, None]
        if k is not None and k < len(y):
            crowded = np.flatnonzero(keep.sum(1) > 8 * k)
            if len(crowded):
                some = approx[crowded]
                cut = np.partition(some, k - 1, axis=1)[:, k - 1]
                keep[crowded] &= some <= (cut + slack[crowded])[:, None]
        qi, bi = np.nonzero(keep)
        finite = np.isfinite(approx[qi, bi])
        qi, bi = qi[finite], bi[finite]
        dist = np.sqrt(((xs[qi] - y[bi]) ** 2).sum(1))
        limits = bound[part][qi]
        ok = dist < limits if strict else dist <= limits
        qi, bi, dist = qi[ok], bi[ok], dist[ok]
        if k is not None:
            qi, bi, dist, _ = _first(qi, bi, dist, tie, k)
        found.append((qi + part.start, bi, dist))
    return tuple(np.concatenate(f) for f in zip(*found))


def _first(qi, bi, dist, tie, k: int):
    """The k nearest of each query row, ties in the order of ``tie``, with their places from 0."""
    order = np.lexsort((tie[bi], dist, qi))
    qi, bi, dist = qi[order], bi[order], dist[order]
    place = np.arange(len(qi)) - np.searchsorted(qi, qi, side="left")
    top = place < k
    return qi[top], bi[top], dist[top], place[top]


def _block_pairs(base: pa.Table, query: pa.Table, *, k: int | None, limit: float,
                 strict: bool, skip_zero: bool):
    """``_pairs`` of one block pair."""
    bound = np.minimum(_ids(query["bound"]).astype(float), limit)
    tie = np.unique(_ids(base["nid"]), return_inverse=True)[1]
    return _pairs(_matrix(query["vec"]), _matrix(base["vec"]), tie, bound, k=k, strict=strict, skip_zero=skip_zero)


def _panel_pairs(base: pa.Table, query: pa.Table, *, k: int | None, limit: float, strict: bool, skip_zero: bool):
    """``_pairs`` of a panel, leaf by leaf and a block at a time: the rows' ball, the query's home and its best so far
    leave them out."""
    x, y = _matrix(query["vec"]), _matrix(base["vec"])
    home, leaf = _ids(query["home"]), _ids(base["leaf"])
    bound = np.minimum(_ids(query["bound"]).astype(float), limit)
    tie = np.unique(_ids(base["nid"]), return_inverse=True)[1]
    order = np.argsort(leaf, kind="stable")
    cuts = [0, *(np.flatnonzero(np.diff(leaf[order])) + 1).tolist(), len(order)]
    edges = [at for lo, hi in zip(cuts, cuts[1:]) for at in range(lo, hi, BLOCK_ROWS)] + [len(order)]
    held = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
    for lo, hi in zip(edges, edges[1:]):
        rows = order[lo:hi]
        inside = y[rows]
        centre = inside.mean(0)
        radius = np.sqrt(((inside - centre) ** 2).sum(1).max())
        far = np.concatenate([np.sqrt(((x[part] - centre) ** 2).sum(1)) for part in _chunks(len(x), x.shape[1])])
        outside = (home == leaf[rows[0]]) | (far - radius > bound * (1 + 1e-9) + _SLACK)
        at = np.flatnonzero(~outside)
        if not len(at):
            continue
        qi, bi, dist = _pairs(x[at], inside, tie[rows], bound[at], k=k, strict=strict, skip_zero=skip_zero)
        held.append((at[qi], rows[bi], dist))
        if k is not None and len(qi):
            qi, bi, dist, place = _first(*(np.concatenate(f) for f in zip(*held)), tie, k)
            held = [(qi, bi, dist)]
            last = place == k - 1
            bound[qi[last]] = np.minimum(bound[qi[last]], dist[last])
    return tuple(np.concatenate(f) for f in zip(*held))


def _exact_zero(x, y, approx, slack):
    zero = np.zeros(approx.shape, dtype=bool)
    qi, bi = np.nonzero(approx <= slack[:, None])
    zero[qi, bi] = (x[qi] == y[bi]).all(1)
    return zero


def _nearest_pivot(pivots: np.ndarray):
    @F.pandas_udf("cell int, gap double")
    def assign(vec: pd.Series) -> pd.DataFrame:
        x = _stacked(vec, pivots.shape[1])
        cell = np.empty(len(x), dtype=np.int32)
        gap = np.empty(len(x))
        for part in _chunks(len(x), len(pivots)):
            d2 = _squared(x[part], pivots)
            cell[part] = d2.argmin(1)
            gap[part] = np.sqrt(d2[np.arange(len(d2)), cell[part]])
        return pd.DataFrame({"cell": cell, "gap": gap})

    return assign


def _reachable(pivots: np.ndarray, radius: np.ndarray, filled: np.ndarray, skip_home: np.ndarray,
               blocks: np.ndarray, most: int):
    """Cells that may hold a row within ``bound`` of the query, but for home cells in ``skip_home``.

    A query whose cells have more than ``most`` blocks is marked ``wide`` and gets no list.
    """
    between = np.sqrt(_squared(pivots, pivots))
    none = np.empty(0, np.int32)

    @F.pandas_udf("cells array<int>, wide boolean")
    def route(vec: pd.Series, home: pd.Series, bound: pd.Series) -> pd.DataFrame:
        x = _stacked(vec, pivots.shape[1])
        h, b = home.to_numpy(), bound.to_numpy(dtype=float)
        out, wide = [], np.zeros(len(x), bool)
        for part in _chunks(len(x), len(pivots)):
            d2 = _squared(x[part], pivots)
            d = np.sqrt(d2)
            hp, reach = h[part], (b[part] * (1 + 1e-9) + _SLACK)[:, None]
            own = d2[np.arange(len(d2)), hp][:, None]
            ball = d - radius[None, :] <= reach
            with np.errstate(divide="ignore", invalid="ignore"):
                plane = (d2 - own) / (2.0 * between[hp])
            ok = ball & ~(plane > reach) & filled[None, :]
            mine = np.flatnonzero(skip_home[hp])
            ok[mine, hp[mine]] = False
            wide[part] = ok @ blocks > most
            out.extend(none if w else np.nonzero(row)[0].astype(np.int32) for row, w in zip(ok, wide[part]))
        return pd.DataFrame({"cells": pd.Series(out, dtype=object), "wide": wide})

    return route


def _margin(pivots: np.ndarray, filled: np.ndarray, tau: float):
    """Approximate routing: cells whose pivot is at most ``tau`` farther than the nearest one."""

    @F.pandas_udf("array<int>")
    def route(vec: pd.Series) -> pd.Series:
        x = _stacked(vec, pivots.shape[1])
        out = []
        for part in _chunks(len(x), len(pivots)):
            d = np.sqrt(_squared(x[part], pivots))
            ok = (d - d.min(1)[:, None] <= tau) & filled[None, :]
            out.extend(np.nonzero(row)[0].astype(np.int32) for row in ok)
        return pd.Series(out, dtype=object)

    return route


# --- index ------------------------------------------------------------------------------------

def _points(df: DataFrame, features: str) -> Column:
    """The vectors to move: floats stay floats, half the bytes of doubles; tasks compute in doubles."""
    kind = df.schema[features].dataType
    plain = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    return F.col(features) if plain else as_array(df, features)


def digest(vec: str) -> Column:
    """128-bit digest of a vector, of floats the same as of their doubles; equal vectors share it."""
    values = F.col(vec).cast("array<double>")
    return F.unhex(F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(s), values)), 16, "0") for s in (0, 1)]))


def _hash_order(seed: int) -> tuple[Column, Column]:
    # a hash order is a uniform sample that stays the same when a task is retried
    return F.xxhash64(F.lit(seed), F.hex("vid")), F.col("vid")


@dataclass
class NeighbourIndex:
    """A pivot tree of depth two over distinct vectors, and the ids of each.

    Up to ``MAX_PIVOTS`` pivots of the first level are held by the driver. Cells with more than two
    blocks of vectors are split by up to ``MAX_SUBS`` pivots of their own, which stay in a table.
    Leaf numbers are ``cell * MAX_SUBS + sub``; a cell that is not split is its leaf 0.
    """

    vectors: DataFrame          # vid, nid (smallest id), copies, vec, leaf, block
    members: DataFrame          # vid, nid, aux columns: every base row
    pivots: np.ndarray          # first level; empty for a single cell
    rows: np.ndarray            # distinct vectors per cell
    radius: np.ndarray          # largest pivot distance per cell
    split: np.ndarray           # whether the cell has pivots of its own
    leaves: DataFrame | None    # cell, sub, pivot, radius of the split cells
    sizes: DataFrame            # leaf, blocks
    aux: tuple[str, ...]
    copied: bool                # whether any vector has more than one id
    width: int                  # numbers in a vector

    @property
    def single(self) -> bool:
        return len(self.pivots) <= 1


def _few(table: DataFrame) -> DataFrame:
    """A hint to broadcast a written table of narrow rows, if it is small."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def _by_hash(rows: DataFrame, seed: int, count: int) -> DataFrame:
    return rows.orderBy(*_hash_order(seed)).limit(count)


def build_index(base: DataFrame, *, id_col: str, features: str = "features", aux: Sequence[str] = (),
                num_pivots: int | None = None, seed: int = 0, pivots: np.ndarray | None = None,
                block_rows: int = BLOCK_ROWS, one_panel: bool = False) -> NeighbourIndex:
    """Assign the distinct base vectors to the leaves of the pivot tree. Null vectors are left out.

    Unless ``num_pivots`` asks for it, with ``one_panel`` no tree is made of vectors that fit one panel.
    """
    rows = base.select(F.col(id_col).alias("nid"), _points(base, features).alias("vec"), *aux) \
        .where(F.col("vec").isNotNull()).withColumn("vid", digest("vec"))
    distinct = materialise(rows.groupBy("vid").agg(
        F.min("nid").alias("nid"), F.count("*").alias("copies"), F.first("vec").alias("vec")), "distinct")
    total, copied, width = distinct.agg(F.count("*"), F.max("copies"), F.max(F.size("vec"))).first()
    width = width or 1
    if num_pivots is None:
        small = one_panel and total <= _panel_rows(distinct, width, block_rows, True)
        num_pivots = 0 if small else total // block_rows
    if pivots is None:
        chosen = _by_hash(distinct, seed, min(MAX_PIVOTS, num_pivots)).collect() if num_pivots > 1 else []
        pivots = np.array([r.vec for r in chosen], dtype=float) if len(chosen) > 1 else np.empty((0, 0))
    if len(pivots):
        placed = distinct.withColumn("_a", _nearest_pivot(pivots)("vec")).select("*", "_a.cell", "_a.gap").drop("_a")
        cells = materialise(placed, "cells")
    else:
        cells = distinct.withColumn("cell", F.lit(0)).withColumn("gap", F.lit(float("inf")))
    counted, radius = np.zeros(max(1, len(pivots)), np.int64), np.zeros(max(1, len(pivots)))
    stats = cells.groupBy("cell").agg(F.count("*").alias("n"), F.max("gap").alias("r")).collect() if len(pivots) else []
    for s in stats:
        counted[s.cell], radius[s.cell] = s.n, s.r
    if not stats:
        counted[0], radius[0] = total, np.inf
    split = (counted > 2 * block_rows) if len(pivots) else np.zeros(1, bool)
    whole = cells.withColumn("leaf", F.col("cell").cast("bigint") * MAX_SUBS)
    known = [(int(c) * MAX_SUBS, max(1, math.ceil(n / block_rows))) for c, n in enumerate(counted) if not split[c]]
    sizes = base.sparkSession.createDataFrame(known, "leaf bigint, blocks int")
    leaves = None
    if split.any():
        inner, leaves, inner_sizes = _split_cells(cells, counted, split, seed, block_rows)
        cut = base.sparkSession.createDataFrame([(int(c),) for c in np.flatnonzero(split)], "cell int")
        whole = whole.join(F.broadcast(cut), "cell", "left_anti").drop("cell", "gap").unionByName(inner)
        sizes = materialise(sizes.unionByName(inner_sizes), "sizes")
    block = F.pmod(F.xxhash64("vid"), F.col("blocks")).cast("int").alias("block")
    vectors = whole.join(_few(sizes), "leaf").select("vid", "nid", "copies", "vec", "leaf", block)
    if leaves is not None and sizes.count() > BROADCAST_ROWS:  # else nothing but narrow joins since the last write
        vectors = materialise(vectors, "leaves")
    return NeighbourIndex(vectors, rows.select("vid", "nid", *aux), pivots, counted, radius, split, leaves, sizes,
                          tuple(aux), (copied or 0) > 1, width)


def _split_cells(cells: DataFrame, counted: np.ndarray, split: np.ndarray, seed: int, block_rows: int):
    """Second level: leaves of the crowded cells, their pivots and their numbers of blocks.

    A cell's rows are dealt to blocks that each meet all of the cell's pivots, so no task holds a cell.
    """
    spark = cells.sparkSession
    crowded = [(int(c), min(MAX_SUBS, math.ceil(counted[c] / block_rows)), math.ceil(counted[c] / block_rows))
               for c in np.flatnonzero(split)]
    table = F.broadcast(spark.createDataFrame(crowded, "cell int, want int, parts int"))  # MAX_PIVOTS rows at most
    inside = cells.join(table, "cell")
    order = Window.partitionBy("cell").orderBy(*_hash_order(seed + 1))
    pivots = inside.withColumn("sub", F.row_number().over(order) - 1).where(F.col("sub") < MAX_SUBS) \
        .where(F.col("sub") < F.col("want")).select("cell", "sub", F.col("vec").alias("pivot"), "parts")
    pivots = materialise(pivots, "pivots")

    def assign(rows: pa.Table, tops: pa.Table) -> pa.Table:
        if not rows.num_rows or not tops.num_rows:
            return pa.table({**{c: rows[c] for c in ("vid", "nid", "copies", "vec")}, "cell": rows["cell"],
                             "sub": pa.array([], pa.int32()), "gap": pa.array([], pa.float64())})
        x, p, subs = _matrix(rows["vec"]), _matrix(tops["pivot"]), _ids(tops["sub"])
        order = np.argsort(subs)
        p, sub, gap = p[order], np.empty(len(x), np.int32), np.empty(len(x))
        for part in _chunks(len(x), len(p)):
            d2 = _squared(x[part], p)
            at = d2.argmin(1)
            sub[part], gap[part] = subs[order][at], np.sqrt(d2[np.arange(len(at)), at])
        return pa.table({**{c: rows[c] for c in ("vid", "nid", "copies", "vec")}, "cell": rows["cell"],
                         "sub": pa.array(sub, pa.int32()), "gap": pa.array(gap, pa.float64())})

    shape = T.StructType([*(cells.schema[c] for c in ("vid", "nid", "copies", "vec", "cell")),
                          T.StructField("sub", T.IntegerType()), T.StructField("gap", T.DoubleType())])
    dealt = inside.withColumn("part", F.pmod(F.xxhash64("vid"), F.col("parts")).cast("int")) \
        .select("vid", "nid", "copies", "vec", "cell", "part")
    met = pivots.select("cell", "sub", "pivot", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    placed = materialise(dealt.groupBy("cell", "part").cogroup(met.groupBy("cell", "part"))
                         .applyInArrow(assign, schema=shape), "assigned")
    stats = materialise(placed.groupBy("cell", "sub").agg(F.count("*").alias("n"), F.max("gap").alias("radius")), "stats")
    leaf = (F.col("cell").cast("bigint") * MAX_SUBS + F.col("sub")).alias("leaf")
    leaves = materialise(pivots.drop("parts").join(stats, ["cell", "sub"]).select("cell", "sub", "pivot", "radius"), "subs")
    sizes = stats.select(leaf, F.ceil(F.col("n") / block_rows).cast("int").alias("blocks"))
    return placed.select("vid", "nid", "copies", "vec", leaf), leaves, sizes


# --- routing ----------------------------------------------------------------------------------

def _descend(index: NeighbourIndex, routed: DataFrame, choose, block_rows: int) -> DataFrame:
    """Queries ``(qid, vec, bound, cell)`` to their leaves: ``qid, vec, bound, leaf``.

    ``choose(points, bounds, pivots, radii)`` tells which leaves of a split cell each query visits.
    The queries of a cell are dealt to parts, each of which meets the cell's pivots.
    """
    columns = ["qid", "vec", "bound"]
    direct = routed.withColumn("leaf", F.col("cell").cast("bigint") * MAX_SUBS)
    if index.leaves is None:
        return direct.select(*columns, "leaf")
    spark = routed.sparkSession
    crowded = F.broadcast(spark.createDataFrame([(int(c),) for c in np.flatnonzero(index.split)], "cell int"))
    inside = routed.join(crowded, "cell")
    per_cell = [(r["cell"], math.ceil(r["count"] / block_rows)) for r in inside.groupBy("cell").count().collect()]
    parts = F.broadcast(spark.createDataFrame(per_cell, "cell int, parts int"))

    def visit(rows: pa.Table, tops: pa.Table) -> pa.Table:
        at, to = np.empty(0, int), np.empty(0, np.int64)
        if rows.num_rows and tops.num_rows:
            x, p = _matrix(rows["vec"]), _matrix(tops["pivot"])
            reach, radii = _ids(rows["bound"]).astype(float), _ids(tops["radius"]).astype(float)
            found = [choose(x[part], reach[part], p, radii) for part in _chunks(len(x), len(p))]
            at, picked = np.nonzero(np.concatenate(found))
            to = _ids(tops["cell"]).astype(np.int64)[picked] * MAX_SUBS + _ids(tops["sub"])[picked]
        some = rows.select(columns).take(pa.array(at, pa.int64()))
        return some.append_column("leaf", pa.array(to, pa.int64()))

    shape = T.StructType([*(routed.schema[c] for c in columns), T.StructField("leaf", T.LongType())])
    dealt = inside.join(parts, "cell").withColumn("part", F.pmod(F.xxhash64("qid"), F.col("parts")).cast("int"))
    met = index.leaves.join(parts, "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    deep = dealt.select("cell", "part", *columns).groupBy("cell", "part") \
        .cogroup(met.select("cell", "sub", "pivot", "radius", "part").groupBy("cell", "part")) \
        .applyInArrow(visit, schema=shape)
    return direct.join(crowded, "cell", "left_anti").select(*columns, "leaf").unionByName(deep)


def _home_leaf(x, bound, pivots, radii):
    d2 = _squared(x, pivots)
    return np.arange(len(pivots))[None, :] == d2.argmin(1)[:, None]


def _leaves_in_reach(x, bound, pivots, radii):
    """Leaves whose ball and whose side of the bisector the query's ball touches."""
    d2 = _squared(x, pivots)
    between = np.sqrt(_squared(pivots, pivots))
    near = d2.argmin(1)
    reach = (bound * (1 + 1e-9) + _SLACK)[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        plane = (d2 - d2[np.arange(len(x)), near][:, None]) / (2.0 * between[near])
    return (np.sqrt(d2) - radii[None, :] <= reach) & ~(plane > reach)


def _leaves_within(tau: float):
    def choose(x, bound, pivots, radii):
        d = np.sqrt(_squared(x, pivots))
        return d - d.min(1)[:, None] <= tau

    return choose


# --- search -----------------------------------------------------------------------------------

def _scan(index: NeighbourIndex, routed: DataFrame, *, k: int | None, limit: float, strict: bool = False,
          skip_zero: bool = False, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Compare routed queries ``(qid, vec, bound, leaf)`` with the vectors of their leaf: ``qid, vid, nid, copies, dist``.

    Queries go to the blocks of their leaf, so a stored index that is bucketed by leaf and block stays
    where it is. Only leaves with many queries are shuffled on both sides, in blocks of queries too.
    """
    out = T.StructType([T.StructField("qid", routed.schema["qid"].dataType),
                        *(index.vectors.schema[c] for c in ("vid", "nid", "copies")),
                        T.StructField("dist", T.DoubleType())])

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0 or right.num_rows == 0:
            qi, bi, dist = np.empty(0, int), np.empty(0, int), np.empty(0)
        else:
            qi, bi, dist = _block_pairs(left, right, k=k, limit=limit, strict=strict, skip_zero=skip_zero)
        picked = left.take(pa.array(bi, type=pa.int64()))
        return pa.table({"qid": right["qid"].take(pa.array(qi, type=pa.int64())),
                         **{c: picked[c] for c in ("vid", "nid", "copies")}, "dist": pa.array(dist, type=pa.float64())})

    def meet(base: DataFrame, query: DataFrame, keys: list[str]) -> DataFrame:
        return base.groupBy(*keys).cogroup(query.groupBy(*keys)).applyInArrow(compare, schema=out)

    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    base = index.vectors.select("vid", "nid", "copies", "vec", "leaf", "block")
    sizes = _few(index.sizes)
    counts = routed.groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") > QUERY_BLOCKS * block_rows)
    busy = materialise(counts.select("leaf", F.ceil(F.col("n") / block_rows).cast("int").alias("parts")), "busy")
    sent = routed.join(sizes, "leaf").select("leaf", every, "qid", "vec", "bound")
    if busy.isEmpty():
        return meet(base, sent, ["leaf", "block"])
    some = _few(busy)
    calm = meet(base, sent.join(some, "leaf", "left_anti"), ["leaf", "block"])
    part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    dealt = sent.join(some, "leaf").withColumn("part", F.pmod(F.xxhash64("qid"), F.col("parts")).cast("int")).drop("parts")
    return calm.unionByName(meet(base.join(some, "leaf").select(*base.columns, part), dealt, ["leaf", "block", "part"]))


def _panel_rows(vectors: DataFrame, width: int, block_rows: int, ranked: bool) -> int:
    """Rows of a panel; smaller where all pairs within the bound are returned, as they are held until a task's pair is done."""
    number = 4 if isinstance(vectors.schema["vec"].dataType.elementType, T.FloatType) else 8
    blocks = PANEL_BLOCKS if ranked else min(QUERY_BLOCKS, PANEL_BLOCKS)
    return min(blocks * block_rows, max(block_rows, PANEL_BYTES // (number * max(1, width))))


def _panels(index: NeighbourIndex, count: int, block_rows: int, ranked: bool) -> int:
    """Panels for so many rows: as many as their size asks for, or as give each core one pair of panel and part."""
    cores = index.vectors.sparkSession.sparkContext.defaultParallelism
    return max(1, math.ceil(count / _panel_rows(index.vectors, index.width, block_rows, ranked)),
               min(math.ceil(math.sqrt(cores)), math.ceil(count / block_rows)))


def _scan_panels(index: NeighbourIndex, wide: DataFrame, *, k: int | None, limit: float, strict: bool = False,
                 skip_zero: bool = False, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Compare written queries ``(qid, vec, bound, home)`` with all vectors but those of the leaf ``home``.

    Where the bound excludes little, a copy of the query for every leaf would be most of the work's
    data. Leaves are put together to panels instead and queries to parts of the same size; every
    part meets every panel, and the bound is applied leaf by leaf inside. Copies are as many as there
    are panels, respectively parts.
    """
    panels, parts = (_panels(index, n, block_rows, k is not None) for n in (int(index.rows.sum()), wide.count()))
    out = T.StructType([T.StructField("qid", wide.schema["qid"].dataType),
                        *(index.vectors.schema[c] for c in ("vid", "nid", "copies")),
                        T.StructField("dist", T.DoubleType())])

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0 or right.num_rows == 0:
            qi, bi, dist = np.empty(0, int), np.empty(0, int), np.empty(0)
        else:
            qi, bi, dist = _panel_pairs(left, right, k=k, limit=limit, strict=strict, skip_zero=skip_zero)
        picked = left.select(["vid", "nid", "copies"]).take(pa.array(bi, type=pa.int64()))
        return pa.table({"qid": right["qid"].take(pa.array(qi, type=pa.int64())),
                         **{c: picked[c] for c in ("vid", "nid", "copies")}, "dist": pa.array(dist, type=pa.float64())})

    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    base = index.vectors.select("vid", "nid", "copies", "vec", "leaf", every(parts).alias("part"),
                                F.pmod(F.xxhash64("leaf", "block"), F.lit(panels)).cast("int").alias("panel"))
    asked = wide.select("qid", "vec", "bound", "home", every(panels).alias("panel"),
                        F.pmod(F.xxhash64("qid", "vec"), F.lit(parts)).cast("int").alias("part"))
    # a task or two for every pair of part and panel; they are few and heavy, so none are put together
    dealt = [side.repartition(2 * panels * parts, "panel", "part") for side in (base, asked)]
    return dealt[0].groupBy("panel", "part").cogroup(dealt[1].groupBy("panel", "part")).applyInArrow(compare, schema=out)


def _away(index: NeighbourIndex, reach: DataFrame, at_home: DataFrame | None, options: dict) -> DataFrame:
    """Routed queries ``(qid, vec, bound, home, cells, wide)`` against the cells in reach, but for the leaf at home."""
    wide = reach.where("wide").select("qid", "vec", "bound", "home")
    narrow = reach.where("not wide").withColumn("cell", F.explode("cells")).select("qid", "vec", "bound", "cell")
    found = None if wide.isEmpty() else _scan_panels(index, wide, **options)
    if found is not None and narrow.isEmpty():
        return found
    routes = _descend(index, narrow if index.leaves is None else materialise(narrow, "reach"), _leaves_in_reach,
                      options["block_rows"])
    if index.leaves is not None and at_home is not None:
        routes = routes.join(at_home.select("qid", "leaf"), ["qid", "leaf"], "left_anti")
    near = _scan(index, materialise(routes, "routes").select("qid", "vec", "bound", "leaf"), **options)
    return near if found is None else near.unionByName(found)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("qid").orderBy("dist", "nid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _expanded(index: NeighbourIndex, near: DataFrame, k: int, exclude_self: bool) -> DataFrame:
    """Of the nearest distinct vectors the k nearest base rows; only the first ids of a vector can be among them."""
    ids = index.members
    if index.copied:
        first = Window.partitionBy("vid").orderBy("nid")  # Spark applies the limit before the shuffle as well
        ids = ids.withColumn("_copy", F.row_number().over(first)).where(F.col("_copy") <= k + 1).drop("_copy")
    rows = near.select("qid", "vid", "dist").join(ids, "vid") if index.copied or index.aux \
        else near.select("qid", "nid", "dist")
    if exclude_self:
        rows = rows.where(F.col("nid") != F.col("qid"))
    return _best(rows, k).select("qid", "rank", "nid", "dist", *index.aux)


def search(index: NeighbourIndex, queries: DataFrame, *, k: int, query_id: str,
           features: str = "features", max_distance: float | None = None,
           exclude_self: bool = False, exclude_identical: bool = False,
           tau: float | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows ``(qid, rank, nid, dist, aux...)``: the k nearest base rows, ties by id.

    Any k can be asked of an index. ``exclude_self`` skips a base row with the query's own id,
    ``exclude_identical`` every base row at distance zero. ``tau`` switches to approximate routing.
    Queries without any neighbour (or with a null vector) yield no row; join back on the id to keep them.
    """
    limit = float("inf") if max_distance is None else float(max_distance)
    wanted = k + int(exclude_self)   # the query's own vector may hold its own id alone
    options = dict(k=wanted, limit=limit, skip_zero=exclude_identical, block_rows=block_rows)
    q = queries.select(F.col(query_id).alias("qid"), _points(queries, features).alias("vec")) \
        .where(F.col("vec").isNotNull())
    unbounded = F.lit(float("inf"))

    if index.single:
        leaf = F.lit(0).cast("bigint")
        if index.rows.sum() > block_rows:
            q = materialise(q, "queries")
            if q.count() > QUERY_BLOCKS * block_rows:  # every query is wide, and has no home
                asked = q.select("qid", "vec", unbounded.alias("bound"), (leaf - 1).alias("home"))
                return _expanded(index, _best(_scan_panels(index, asked, **options), wanted), k, exclude_self)
        routed = q.withColumn("bound", unbounded).withColumn("leaf", leaf)
        return _expanded(index, _best(_scan(index, routed, **options), wanted), k, exclude_self)

    filled = index.rows > 0
    if tau is not None:
        routed = q.withColumn("cell", F.explode(_margin(index.pivots, filled, tau)("vec"))) \
            .withColumn("bound", unbounded)
        routed = materialise(_descend(index, routed, _leaves_within(tau), block_rows), "routes")
        return _expanded(index, _best(_scan(index, routed, **options), wanted), k, exclude_self)

    homed = materialise(q.withColumn("cell", _nearest_pivot(index.pivots)("vec")["cell"])
                        .withColumn("bound", unbounded), "homed")
    at_home = _descend(index, homed, _home_leaf, block_rows)
    at_home = at_home if index.leaves is None else materialise(at_home, "home")
    near = materialise(_best(_scan(index, at_home, **options), wanted).drop("rank"), "near")
    bounds = near.groupBy("qid").agg(F.count("*").alias("_n"), F.max("dist").alias("_d")) \
        .select("qid", F.when(F.col("_n") >= wanted, F.col("_d")).alias("_bound"))
    route = _reachable(index.pivots, index.radius, filled, ~index.split, np.ceil(index.rows / block_rows),
                       2 * _panels(index, int(index.rows.sum()), block_rows, True))
    reach = at_home.drop("bound").withColumnRenamed("leaf", "home").join(bounds, "qid", "left") \
        .withColumn("bound", F.least(F.coalesce("_bound", unbounded), F.lit(limit))) \
        .withColumn("_r", route("vec", F.floor(F.col("home") / MAX_SUBS), "bound")) \
        .select("qid", "vec", "bound", "home", "_r.cells", "_r.wide")
    away = _away(index, materialise(reach, "bounds"), at_home, options)
    return _expanded(index, _best(near.unionByName(away), wanted), k, exclude_self)


#: pivots of approximate routing if their number is not given, at any size of the table
APPROXIMATE_PIVOTS = 100


def knn_join(base: DataFrame, queries: DataFrame, k: int, *, base_id: str, query_id: str,
             features: str = "features", query_features: str | None = None,
             aux: Sequence[str] = (), max_distance: float | None = None,
             exclude_self: bool = False, exclude_identical: bool = False,
             num_pivots: int | None = None, tau: float | None = None, seed: int = 0,
             block_rows: int = BLOCK_ROWS) -> DataFrame:
    """For every query row its k nearest base rows by Euclidean distance."""
    if tau is not None and num_pivots is None:
        num_pivots = APPROXIMATE_PIVOTS
    index = build_index(base, id_col=base_id, features=features, aux=aux, num_pivots=num_pivots, seed=seed,
                        block_rows=block_rows, one_panel=True)
    return search(index, queries, k=k, query_id=query_id, features=query_features or features,
                  max_distance=max_distance, exclude_self=exclude_self,
                  exclude_identical=exclude_identical, tau=tau, block_rows=block_rows)


def distinct_vectors(df: DataFrame, id_col: str, features: str, extra: str | None = None) -> DataFrame:
    """One row per distinct vector: smallest id and number of copies, and the largest ``extra`` if a column is named."""
    more = [] if extra is None else [F.max("_extra").alias("extra")]
    return df.select(F.col(id_col).alias("_id"), _points(df, features).alias("vec"),
                     *([] if extra is None else [F.col(extra).alias("_extra")])) \
        .where(F.col("vec").isNotNull()).groupBy(digest("vec").alias("vid")) \
        .agg(F.first("vec").alias("vec"), F.min("_id").alias("nid"), F.count("*").alias("copies"), *more).drop("vid")


def distinct_ids(df: DataFrame, id_col: str, features: str) -> DataFrame:
    """``id, nid``: every row with the smallest id that has its vector, to expand a result to single rows."""
    rows = df.select(F.col(id_col).alias("id"), as_array(df, features).alias("vec")).where(F.col("vec").isNotNull()) \
        .select("id", digest("vec").alias("vid"))
    first = rows.groupBy("vid").agg(F.min("id").alias("nid"))
    return rows.join(first, "vid").select("id", "nid")


def range_join(a: DataFrame, b: DataFrame, threshold: float, *, a_id: str, b_id: str,
               features: str = "features", num_pivots: int | None = None, seed: int = 0,
               block_rows: int = BLOCK_ROWS, extra: str | None = None) -> DataFrame:
    """Pairs of distinct vectors closer than ``threshold``: ``(a_id, b_id, dist, a_copies, b_copies)``.

    A column ``extra`` of ``b`` is added to the threshold of its row (of copies the largest).

    Identical vectors are represented by their smallest id and a copy count, so a group of copies
    contributes one row per partner instead of all its pairs.
    """
    index = build_index(a, id_col=a_id, features=features, num_pivots=num_pivots, seed=seed, block_rows=block_rows)
    bound = F.lit(float(threshold)) if extra is None else F.col("extra") + float(threshold)
    q = distinct_vectors(b, b_id, features, extra).select(
        F.col("nid").alias("qid"), "vec", F.col("copies").alias("q_copies"), bound.alias("bound"))
    q = materialise(q, "queries")
    options = dict(k=None, limit=float(threshold) if extra is None else float("inf"), strict=True, block_rows=block_rows)
    if index.single:
        pairs = _scan(index, q.select("qid", "vec", "bound", F.lit(0).cast("bigint").alias("leaf")), **options)
    else:
        route = _reachable(index.pivots, index.radius, index.rows > 0, np.zeros(len(index.pivots), bool),
                           np.ceil(index.rows / block_rows), 2 * _panels(index, int(index.rows.sum()), block_rows, False))
        reach = q.withColumn("_r", route("vec", _nearest_pivot(index.pivots)("vec")["cell"], "bound")) \
            .select("qid", "vec", "bound", F.lit(-1).cast("bigint").alias("home"), "_r.cells", "_r.wide")
        pairs = _away(index, materialise(reach, "reach"), None, options)
    return pairs.join(q.select("qid", "q_copies"), "qid") \
        .select(F.col("nid").alias("a_id"), F.col("qid").alias("b_id"), "dist",
                F.col("copies").alias("a_copies"), F.col("q_copies").alias("b_copies"))


# --- stored index -----------------------------------------------------------------------------

def _bucketed(spark, path: str, parts: int) -> DataFrame:
    """The vectors at ``path`` as a table bucketed by leaf and block, under a name of this session only."""
    name = f"bramble_index_{uuid.uuid4().hex}"
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY (leaf, block) INTO {parts} BUCKETS "
              f"LOCATION '{path}'")
    return spark.table(name)


def save_index(index: NeighbourIndex, path: str) -> dict:
    """Write the index below ``path``; what the reader needs beside the tables is returned.

    The vectors are bucketed by leaf and block, the keys of the search, so scoring jobs read them
    without a shuffle.
    """
    spark = index.vectors.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"bramble_index_{uuid.uuid4().hex}"
    # one task per bucket, so that a bucket is one file
    index.vectors.repartition(parts, "leaf", "block").write.bucketBy(parts, "leaf", "block").format("parquet") \
        .option("path", f"{path}/vectors").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay
    index.members.write.parquet(f"{path}/members")
    index.sizes.write.parquet(f"{path}/sizes")
    cells = [(i, [float(v) for v in p], int(n), float(r), bool(s)) for i, (p, n, r, s) in enumerate(
        zip(index.pivots if len(index.pivots) else [[]], index.rows, index.radius, index.split))]
    spark.createDataFrame(cells, "cell int, vec array<double>, rows bigint, radius double, split boolean") \
        .write.parquet(f"{path}/pivots")
    if index.leaves is not None:
        index.leaves.write.parquet(f"{path}/leaves")
    return {"aux": list(index.aux), "copied": index.copied, "buckets": parts, "deep": index.leaves is not None,
            "width": index.width}


def load_index(spark, path: str, meta: dict) -> NeighbourIndex:
    cells = spark.read.parquet(f"{path}/pivots").orderBy("cell").collect()
    pivots = np.array([c.vec for c in cells], dtype=float) if len(cells) > 1 else np.empty((0, 0))
    return NeighbourIndex(
        _bucketed(spark, f"{path}/vectors", meta["buckets"]), spark.read.parquet(f"{path}/members"), pivots,
        np.array([c.rows for c in cells]), np.array([c.radius for c in cells]), np.array([c.split for c in cells]),
        spark.read.parquet(f"{path}/leaves") if meta["deep"] else None, spark.read.parquet(f"{path}/sizes"),
        tuple(meta["aux"]), meta["copied"], meta.get("width") or max(1, pivots.shape[1]))


# --- routing margin ---------------------------------------------------------------------------

def sample_sizes(df: DataFrame, id_col: str, sizes: Sequence[int], total: int,
                 seed: int = 0) -> DataFrame:
    """Several Bernoulli samples in one pass: a copy of a row for every sample it falls into."""
    unit = F.pmod(F.xxhash64(F.lit(seed), F.col("sample_size"), F.col(id_col)),
                  F.lit(1 << 30)) / float(1 << 30)
    return df.withColumn("sample_size", F.explode(F.array(*[F.lit(int(s)) for s in sizes]))) \
        .where(unit * float(total) < F.col("sample_size"))


def _sample_spacing(samples: DataFrame) -> DataFrame:
    """Row count and mean distance to the nearest different vector, per (bounded) sample."""

    def spacing(table: pa.Table) -> pa.Table:
        x = np.unique(_matrix(table["vec"]), axis=0)
        mean = None
        if len(x) > 1:
            d2 = _squared(x, x)
            np.fill_diagonal(d2, np.inf)
            near = d2.argmin(1)
            mean = float(np.sqrt(((x - x[near]) ** 2).sum(1)).mean())
        return pa.table({"n": pa.array([table.num_rows], pa.int64()),
                         "spacing": pa.array([mean], pa.float64())})

    return samples.groupBy("sample_size").applyInArrow(spacing, "n bigint, spacing double")


def estimate_tau(df: DataFrame, *, id_col: str, features: str = "features",
                 sizes: Sequence[int] = tuple(range(100, 1001, 100)), seed: int = 0) -> float:
    """Routing margin from the growth of neighbour spacing with sample size.

    Spacing of a sample of n rows is modelled as ``c * n ** (-1/d)``; the fit over several sample
    sizes is extrapolated to the whole table and divided by ``sqrt(d)``. Where the fit is not
    decreasing, the largest observed spacing is returned.
    """
    total = df.count()
    rows = df.select(F.col(id_col).alias("nid"), as_array(df, features).alias("vec"))
    spaced = _sample_spacing(sample_sizes(rows, "nid", sizes, total, seed)) \
        .where(F.col("spacing") > 0).select("n", "spacing").distinct()
    fit = spaced.agg(F.regr_slope(F.log("spacing"), F.log("n")).alias("slope"),
                     F.regr_intercept(F.log("spacing"), F.log("n")).alias("intercept"),
                     F.max("spacing").alias("largest")).first()
    if fit.slope is None or math.isnan(fit.slope) or fit.slope >= 0:
        return float(fit.largest or 0.0)
    spread = math.exp(fit.intercept + fit.slope * math.log(total))
    return spread / math.sqrt(-1.0 / fit.slope)
