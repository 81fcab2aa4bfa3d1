"""Line parsing, rejects, charsets, encoders and token helpers."""

import pytest
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import functions as F

from bramble.functions import encode, text
from bramble.operators import patterns, sampling
from bramble.sources import delimited, lines


def test_malformed_line_fails_or_is_rejected(spark):
    raw = spark.createDataFrame([("1::2::3.5::4",), ("1::2",), ("x::2::3::4",)], "value string")
    fields = [("u", "int"), ("i", "int"), ("r", "float"), ("t", "bigint")]
    parsed = lines.parse_fields(raw, "::", fields)
    assert [r.is_valid for r in parsed.collect()] == [True, False, False]
    with pytest.raises(Exception, match="malformed line"):
        lines.require_valid(parsed).collect()
    assert lines.require_valid(parsed.where("is_valid")).count() == 1


def test_line_numbers_across_blocks(spark, tmp_path):
    path = tmp_path / "big.txt"
    path.write_text("\n".join(f"{'ham' if i % 10 else 'junk'} {i}" for i in range(1, 5001)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        numbered = lines.number_lines(spark, str(path))
        assert numbered.where(F.col("line_no") != F.split("value", " ")[1].cast("bigint")).count() == 0
        bad = lines.rejects(numbered, ["ham", "spam"]).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(r.line_no for r in bad) == list(range(10, 5001, 10))


def test_chinese_charset(spark, tmp_path):
    words = ["财经新闻", "体育 比赛"]
    (tmp_path / "gb.txt").write_bytes("\n".join(words).encode("gb2312"))
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    try:
        assert [r.value for r in lines.read_lines(spark, str(tmp_path / "gb.txt"), "GB2312").collect()] == words
    finally:
        spark.conf.unset("spark.sql.legacy.javaCharsets")


def test_csv_options(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b"), (2, 'q"x')], "n int, s string")
    delimited.write_csv(df, str(tmp_path / "t"), sep="\t", single_file=True)
    assert len(list((tmp_path / "t").glob("part-*"))) == 1
    assert delimited.read_csv(spark, str(tmp_path / "t"), header=True, sep="\t", infer=True).orderBy("n").collect() == df.collect()


def test_encoders(spark):
    df = spark.createDataFrame([("Mrs. Smith", 60.0), ("Mr. Jones", 31.0), ("Miss Lee", 5.0), ("Dr. No", 20.0)],
                               "name string, age double")
    title = encode.first_containing(F.col("name"), ["Miss", "Mrs", "Mr"], "RareTitle")
    band = encode.band(F.col("age"), [(55, 3), (30, 2), (18, 1)], 0)
    assert [(r.t, r.b) for r in df.select(title.alias("t"), band.alias("b")).collect()] == \
        [("Mrs", 3), ("Mr", 2), ("Miss", 0), ("RareTitle", 1)]
    codes = encode.dictionary(df, "name")
    assert encode.lookup(df, codes, "name", max_rows=1).count() == 4
    assert [r["index"] for r in codes.orderBy("name").collect()] == [0, 1, 2, 3]


def test_key_split_is_stable_and_whole(spark):
    df = spark.range(1000)
    a, b = sampling.split_by_key(df, "id", 0.8, seed=5)
    again, _ = sampling.split_by_key(df.repartition(13), "id", 0.8, seed=5)
    assert a.count() + b.count() == 1000 and {r.id for r in a.collect()} == {r.id for r in again.collect()}
    assert 700 < a.count() < 900
    assert sampling.sample_fraction(df, 5000, seed=1).count() == 1000


def test_token_fixtures(spark):
    df = spark.createDataFrame([(0, "Hi I heard about Spark"), (1, "I saw the red balloon")], "id int, text string")
    words = text.without_stop_words(text.tokens(df))
    assert [r.filtered for r in words.orderBy("id").collect()] == [["hi", "heard", "spark"], ["saw", "red", "balloon"]]
    assert [len(r.ngrams) for r in text.ngrams(words).orderBy("id").collect()] == [4, 4]
    assert "the" in text.default_stop_words()


def test_basket_fixture(spark):
    df = spark.createDataFrame([(["1", "2", "5"],), (["1", "2", "3", "5"],), (["1", "2"],)], "items array<string>")
    model = patterns.mine(df, min_support=0.5, min_confidence=0.6)
    assert model.freqItemsets.count() == 7
    assert isinstance(model, type(FPGrowth(minSupport=0.9).fit(df)))
    top = patterns.rule_rollup(model.associationRules, best=1).collect()
    assert {r.item: list(r.also) for r in top} == {"1": ["2"], "2": ["1"], "5": ["1"]}


def test_sequence_fixture(spark):
    rows = [([[1, 2], [3]],), ([[1], [3, 2], [1, 2]],), ([[1, 2], [5]],), ([[6]],)]
    df = spark.createDataFrame(rows, "sequence array<array<int>>")
    got = {tuple(tuple(sorted(s)) for s in r.sequence): r.freq for r in patterns.frequent_sequences(df).collect()}
    assert got == {((1,),): 3, ((2,),): 3, ((3,),): 2, ((1, 2),): 3, ((1,), (3,)): 2}


def test_words_are_counted_inside_their_row(spark):
    from collections import Counter
    from bramble.functions.text import word_counts
    rows = [(1, ["b", "a", "b", ""]), (2, []), (3, None), (4, ["a"]), (4, ["a", "c"]), (None, ["x"]), (None, ["x", "x"])]
    df = spark.createDataFrame(rows, "id bigint, words array<string>")
    want = Counter()
    for key, words in rows:
        want.update((key, w) for w in words or [])
    got = word_counts(df, "words", "term", "id")
    assert Counter({(r.id, r.term): r.n for r in got.collect()}) == want and got.count() == len(want)
    alone = word_counts(df.where("id < 4"), "words", "term", "id")
    assert "Exchange" not in alone._jdf.queryExecution().executedPlan().toString()


def test_perplexity_is_counted_by_mixture(spark, monkeypatch):
    import math
    from bramble.operators import topics
    from bramble.plans import training
    docs = [(1, "en", "a b b"), (2, "en", "a c"), (3, "fr", "b d d"), (4, None, "a d")]
    table = type("Rows", (), {"documents": spark.createDataFrame(docs, "doc_id bigint, lang string, text string")})
    seen = []
    keep = topics.word_likelihood
    monkeypatch.setattr(training.tp, "word_likelihood", lambda counts, *rest: seen.append(counts.count()) or keep(counts, *rest))
    row = training.given_topics_perplexity(table).first()
    weight = {"en": {"a": 2 / 5, "b": 2 / 5, "c": 1 / 5}, "fr": {"b": 1 / 3, "d": 2 / 3}}
    logs = [math.log(sum((0.7 if k == lang else 0.1) * weight[k].get(w, 0) for k in weight))
            for _, lang, text in docs for w in text.split()]
    assert row.tokens == len(logs) == 10 and abs(row.perplexity - math.exp(-sum(logs) / 10)) < 1e-4
    assert seen == [7]      # a row per language and word, not per document and word
