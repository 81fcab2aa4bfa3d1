"""Missing values in statistics and jobs, rules applied by join, terms without a limit."""

import pytest
from pyspark.sql import functions as F

from bramble.functions import text
from bramble.learners import jobs
from bramble.operators import patterns as pt
from bramble.operators import stats


def test_spearman_leaves_incomplete_rows_out(spark):
    rows = [(1.0, 2.0), (2.0, 1.0), (None, 5.0), (4.0, 9.0), (5.0, 7.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    got = {(r.i, r.j): r["corr"] for r in stats.correlations(df, ["a", "b"], method="spearman").collect()}
    assert abs(got[0, 1] - 0.6) < 1e-12 and abs(got[0, 0] - 1) < 1e-12


def test_missing_numbers_fail_in_a_job(spark):
    from pyspark.ml import Pipeline
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0)], "a double, b double")
    with pytest.raises(Exception, match="(?i)null"):
        Pipeline(stages=jobs.feature_stages(df, ["a", "b"])).fit(df).transform(df).collect()


def test_rules_by_join_equal_the_models_own(spark):
    rows = spark.createDataFrame([(i, list(s)) for i, s in enumerate(["abc", "abd", "ab", "bc", "acd", "abc", "d"])],
                                 "k long, items array<string>")
    model = pt.mine(rows, min_support=0.2, min_confidence=0.5)
    want = {r.k: sorted(r.prediction) for r in model.transform(rows).collect() if r.prediction}
    got = {r.k: r.prediction for r in pt.apply_rules(rows, "k", model.associationRules).collect()}
    assert got == want and got


def test_no_term_is_lost(spark):
    df = spark.createDataFrame([(1, [f"w{i}" for i in range(3000)]), (2, ["w1", "w2", "w2"])], "id long, words array<string>")
    every = text.term_weights(df, "id", F.lit(2))
    assert every.select("term").distinct().count() == 3000
    assert text.term_weights(df, "id", F.lit(2), min_docs=2).select("term").distinct().count() == 2
