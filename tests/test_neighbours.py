"""Neighbour, range and set joins against brute force on skewed inputs."""

import itertools

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bramble import session
from bramble.operators import neighbours as nb
from bramble.operators import ranking, setjoin


def skewed(rng, n, d=4):
    """Random points of which a third are copies of one and a third lie close together."""
    x = rng.normal(size=(n, d))
    x[: n // 3] = x[0]
    x[n // 3: 2 * n // 3] = x[1] + 1e-3 * rng.normal(size=(2 * n // 3 - n // 3, d))
    return x


def frame(spark, x, start=0):
    rows = [(start + i, [float(v) for v in p]) for i, p in enumerate(x)]
    return spark.createDataFrame(rows, "id bigint, features array<double>")


def brute(base, query, k, exclude_self=False, limit=np.inf):
    out = set()
    for q, p in enumerate(query):
        dist = np.sqrt(((base - p) ** 2).sum(1))
        order = sorted((d, i) for i, d in enumerate(dist) if d <= limit and not (exclude_self and i == q))
        out |= {(q, r + 1, i) for r, (_, i) in enumerate(order[:k])}
    return out


@pytest.mark.parametrize("pivots,block", [(None, 4096), (12, 4096), (12, 7), (1, 5)])
@pytest.mark.parametrize("exclude_self", [False, True])
def test_exact_join(spark, pivots, block, exclude_self):
    x = skewed(np.random.default_rng(1), 90)
    df = frame(spark, x)
    got = nb.knn_join(df, df, 4, base_id="id", query_id="id", exclude_self=exclude_self, num_pivots=pivots,
                      block_rows=block)
    assert {(r.qid, r.rank, r.nid) for r in got.collect()} == brute(x, x, 4, exclude_self)


def test_distance_bound_and_aux(spark):
    rng = np.random.default_rng(2)
    x, q = skewed(rng, 60), rng.normal(size=(25, 4))
    base = frame(spark, x).withColumn("tag", F.col("id") * 10)
    got = nb.knn_join(base, frame(spark, q), 5, base_id="id", query_id="id", aux=("tag",), max_distance=1.0,
                      num_pivots=6, block_rows=8).collect()
    assert {(r.qid, r.rank, r.nid) for r in got} == brute(x, q, 5, limit=1.0)
    assert all(r.tag == r.nid * 10 for r in got)


def test_fewer_rows_than_k_and_null_vectors(spark):
    df = spark.createDataFrame([(0, [0.0, 0.0]), (1, [1.0, 0.0]), (2, None)], "id bigint, features array<double>")
    got = nb.knn_join(df, df, 5, base_id="id", query_id="id").collect()
    assert {(r.qid, r.nid) for r in got} == {(0, 0), (0, 1), (1, 0), (1, 1)}


def test_string_keys(spark):
    df = frame(spark, skewed(np.random.default_rng(3), 30)).withColumn("id", F.concat(F.lit("r"), F.col("id")))
    got = nb.knn_join(df, df, 2, base_id="id", query_id="id", exclude_self=True, num_pivots=4, block_rows=6)
    assert got.count() == 60 and got.where("qid = nid").count() == 0


def test_approximate_is_subset_and_exact_with_large_margin(spark):
    x = np.random.default_rng(4).normal(size=(80, 3))
    df = frame(spark, x)
    exact = brute(x, x, 3)
    wide = nb.knn_join(df, df, 3, base_id="id", query_id="id", num_pivots=8, tau=1e6)
    assert {(r.qid, r.rank, r.nid) for r in wide.collect()} == exact
    narrow = nb.knn_join(df, df, 3, base_id="id", query_id="id", num_pivots=8, tau=0.05).collect()
    hits = {(r.qid, r.nid) for r in narrow} & {(q, i) for q, _, i in exact}
    assert 0.3 < len(hits) / len(exact) <= 1.0


def test_exclude_identical(spark):
    x = skewed(np.random.default_rng(5), 45)
    got = nb.knn_join(frame(spark, x), frame(spark, x), 1, base_id="id", query_id="id", exclude_identical=True,
                      num_pivots=5, block_rows=6).collect()
    for r in got:
        d = np.sqrt(((x - x[r.qid]) ** 2).sum(1))
        assert abs(r.dist - d[d > 0].min()) < 1e-12
    assert len(got) == 45


def clustered(seed, n, d=3):
    """Nearly all points in a few tight clusters of near copies, some far away, some identical."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(4, d))[rng.integers(0, 4, n)] + 1e-3 * rng.normal(size=(n, d))
    x[:n // 10] = rng.normal(size=(n // 10, d))
    x[-n // 6:] = x[n // 2]
    return x


def test_crowded_cells_get_pivots_of_their_own(spark):
    x = clustered(11, 600)
    df = frame(spark, x)
    index = nb.build_index(df, id_col="id", num_pivots=3, block_rows=20)
    assert index.split.any() and index.leaves.groupBy("cell").count().agg(F.max("count")).first()[0] > 4
    assert index.vectors.count() == len(np.unique(x, axis=0))       # one row per distinct vector
    assert index.members.count() == 600
    blocks = index.vectors.groupBy("leaf", "block").count().agg(F.max("count")).first()[0]
    assert blocks <= 60
    far = nb._descend(index, frame(spark, x[:50]).select(
        F.col("id").alias("qid"), F.col("features").alias("vec"), F.lit(1e-4).alias("bound"),
        F.explode(F.array([F.lit(c) for c in range(3)])).alias("cell")), nb._leaves_in_reach, 20)
    leaves = index.sizes.count()
    assert far.count() < 50 * leaves / 3                            # the bound prunes inside cells too
    for extra in ({}, {"exclude_self": True}, {"max_distance": 1e-3}):
        got = nb.search(index, df, k=4, query_id="id", block_rows=20, **extra)
        want = brute(x, x, 4, extra.get("exclude_self", False), extra.get("max_distance", np.inf))
        assert {(r.qid, r.rank, r.nid) for r in got.collect()} == want


def test_leaves_with_many_queries_are_cut(spark, monkeypatch):
    monkeypatch.setattr(nb, "QUERY_BLOCKS", 1)
    x, q = clustered(12, 300), clustered(12, 400)
    got = nb.knn_join(frame(spark, x), frame(spark, q), 3, base_id="id", query_id="id", num_pivots=4, block_rows=16)
    assert {(r.qid, r.rank, r.nid) for r in got.collect()} == brute(x, q, 3)


def test_queries_that_reach_most_leaves_meet_panels(spark, monkeypatch):
    monkeypatch.setattr(nb, "PANEL_BLOCKS", 8)
    rng = np.random.default_rng(21)
    x, q = rng.normal(size=(400, 12)), rng.normal(size=(90, 12))    # the bound excludes next to nothing
    x[300:330] = x[:30]
    mark = session.written_so_far()
    got = nb.knn_join(frame(spark, x), frame(spark, x), 3, base_id="id", query_id="id", block_rows=10, exclude_self=True)
    found = {(r.qid, r.rank, r.nid) for r in got.collect()}
    routed = sum(spark.read.parquet(p).count() for p in session._written[mark:] if "/routes-" in p)
    assert routed <= 2 * 5 * len(x)       # 400 rows are five panels; the leaves are forty
    assert found == brute(x, x, 3, True)
    got = nb.range_join(frame(spark, x), frame(spark, q), 3.8, a_id="id", b_id="id", block_rows=10)
    d = np.sqrt(((q[:, None] - x[None]) ** 2).sum(2))
    assert sum(r.a_copies * r.b_copies for r in got.collect()) == int((d < 3.8).sum())


def test_margin_acts_alike_at_every_size(spark):
    found = []
    for n in (600, 900):    # fewer and more than two blocks
        x = np.random.default_rng(13).normal(size=(n, 3))
        got = nb.knn_join(frame(spark, x), frame(spark, x[:200]), 3, base_id="id", query_id="id", tau=0.0, block_rows=400)
        hits = {(r.qid, r.nid) for r in got.collect()} & {(q, i) for q, _, i in brute(x, x[:200], 3)}
        found.append(len(hits) / 600)
    assert all(0.2 < share < 0.9 for share in found)


def test_null_vectors_strings_and_extra_columns_in_a_deep_index(spark):
    x = clustered(14, 200)
    rows = [(f"r{i:03d}", None if i % 20 == 0 else [float(v) for v in p], i, "leaf") for i, p in enumerate(x)]
    df = spark.createDataFrame(rows, "id string, features array<double>, block int, leaf string")
    got = nb.knn_join(df, df, 2, base_id="id", query_id="id", aux=("block",), num_pivots=2, block_rows=10, exclude_self=True)
    assert got.count() == 190 * 2 and got.where("qid = nid").count() == 0
    assert got.where("block <> cast(substring(nid, 2) as int)").count() == 0


def test_range_join(spark):
    x = skewed(np.random.default_rng(6), 60)
    got = nb.range_join(frame(spark, x), frame(spark, x), 0.8, a_id="id", b_id="id", num_pivots=6, block_rows=9)
    seen = sum(r.a_copies * r.b_copies for r in got.collect())
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    assert seen == int((d < 0.8).sum())


def test_margin_estimate(spark):
    x = np.random.default_rng(7).normal(size=(1500, 2))
    tau = nb.estimate_tau(frame(spark, x), id_col="id")
    assert 0 < tau < 1.0
    same = frame(spark, np.zeros((50, 2)))
    assert nb.estimate_tau(same, id_col="id") == 0.0


def jaccard_brute(sets, limit):
    out = set()
    for (i, a), (j, b) in itertools.combinations(sorted(sets.items()), 2):
        if a and b and 1 - len(a & b) / len(a | b) < limit:
            out.add((i, j))
    return out


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.frozensets(st.integers(0, 12), max_size=8), min_size=2, max_size=25),
       st.sampled_from([0.2, 0.5, 0.6, 0.8]))
def test_jaccard_join(spark, sets, limit):
    rows = [(i, [str(v) for v in s]) for i, s in enumerate(sets)]
    df = spark.createDataFrame(rows, "id bigint, tokens array<string>")
    got = {(r.a_id, r.b_id) for r in setjoin.jaccard_join(df, "id", "tokens", limit).collect()}
    first = {}
    for i, s in enumerate(sets):
        first.setdefault(s, i)
    assert got == jaccard_brute({i: s for s, i in first.items()}, limit)


def test_jaccard_salted_items_and_members(spark, monkeypatch):
    monkeypatch.setattr(setjoin, "_HOT", 2)
    rows = [(i, ["a", "b", str(i % 7), str(i % 3)]) for i in range(30)]
    df = spark.createDataFrame(rows, "id bigint, tokens array<string>")
    sets, first = {}, {}
    for i, s in rows:
        first.setdefault(frozenset(s), i)
    sets = {i: s for s, i in first.items()}
    got = {(r.a_id, r.b_id) for r in setjoin.jaccard_join(df, "id", "tokens", 0.6).collect()}
    assert got == jaccard_brute(sets, 0.6)
    reps = setjoin.distinct_sets(df, "id", "tokens")
    assert setjoin.members(df, reps, "id", "tokens").count() == 30


def test_minhash_join_is_subset(spark):
    rows = [(i, [str(v) for v in range(i % 5, i % 5 + 6 + i % 2)]) for i in range(20)]
    df = spark.createDataFrame(rows, "id bigint, tokens array<string>")
    exact = {(r.a_id, r.b_id) for r in setjoin.jaccard_join(df, "id", "tokens", 0.5).collect()}
    found = {(r.a_id, r.b_id) for r in setjoin.minhash_join(df, "id", "tokens", 0.5).collect()}
    assert found <= exact and len(found) >= len(exact) / 2


def test_top_scores(spark):
    rng = np.random.default_rng(8)
    u, v = rng.normal(size=(20, 3)), rng.normal(size=(40, 3)) * rng.uniform(0.1, 3, size=(40, 1))
    got = ranking.top_scores(frame(spark, u), frame(spark, v), 4, user_id="id", item_id="id", num_pivots=5).collect()
    want = {(i, r + 1, int(j)) for i in range(20) for r, j in enumerate(np.argsort(-(u[i] @ v.T))[:4])}
    assert {(r.user, r.rank, r.item) for r in got} == want


def test_bucket_join_lists_no_bucket_pairs(spark, monkeypatch):
    from pyspark.ml.feature import BucketedRandomProjectionLSHModel as Model
    from bramble.plans import similarity
    rng = np.random.default_rng(8)
    x = rng.normal(size=(90, 8))
    x /= np.sqrt((x ** 2).sum(1))[:, None]
    x[80:] = x[:10]
    tables = type("Rows", (), {"embeddings": frame(spark, x).select(F.col("id").alias("vec_id"), F.col("features").alias("embedding"))})
    model, rows = similarity._projection_lsh(tables)
    want = {(r[0], r[1]) for r in model.approxSimilarityJoin(rows, rows, 1.15, "dist").where("datasetA.id < datasetB.id")
            .select("datasetA.id", "datasetB.id").collect()}
    monkeypatch.setattr(Model, "approxSimilarityJoin", None, raising=False)
    got = [(r.a_id, r.b_id) for r in similarity.lsh_euclid_join(tables).collect()]
    assert set(got) == want and len(got) == len(want)


def test_sets_outside_every_pair_are_not_moved(spark, monkeypatch):
    """Candidate pairs are written and few, so the full sets are looked up by broadcast; signatures follow the pairs."""
    names = []
    keep = setjoin.materialise
    monkeypatch.setattr(setjoin, "materialise", lambda df, name, *rest: names.append(name) or keep(df, name, *rest))
    rows = [(i, [f"t{i}a", f"t{i}b", f"t{i}c", "x"]) for i in range(300)] + [(500, ["t7a", "t7b", "t7c", "x", "y"])]
    df = spark.createDataFrame(rows, "id bigint, tokens array<string>")
    found = setjoin.jaccard_join(df, "id", "tokens", 0.5)
    assert [(r.a_id, r.b_id, r.overlap) for r in found.collect()] == [(7, 500, 4)]
    assert names == ["sets", "postings", "candidates", "ids"]
    assert "ShuffledHashJoin" not in (plan := found._jdf.queryExecution().executedPlan().toString()) and "SortMergeJoin" not in plan


def test_rows_of_one_panel_meet_without_a_tree(spark, monkeypatch):
    """Queries of a table that fits one panel go to its panels, with float vectors as floats, and not to every block."""
    x = skewed(np.random.default_rng(11), 200).astype(np.float32)
    x[7], x[9] = x[150], x[151]
    df = frame(spark, x).withColumn("features", F.col("features").cast("array<float>"))
    seen, keep = [], nb._scan_panels
    monkeypatch.setattr(nb, "_scan", None)
    monkeypatch.setattr(nb, "_scan_panels", lambda index, asked, **o: seen.append((index, asked)) or keep(index, asked, **o))
    for exclude_self in (False, True):
        got = nb.knn_join(df, df, 4, base_id="id", query_id="id", exclude_self=exclude_self, block_rows=20)
        assert {(r.qid, r.rank, r.nid) for r in got.collect()} == brute(x.astype(float), x.astype(float), 4, exclude_self)
    assert len(seen) == 2 and all(index.single and index.width == 4 for index, _ in seen)
    assert all(side.schema["vec"].dataType.simpleString() == "array<float>" for i, q in seen for side in (i.vectors, q))
