"""Feature-operator plans; vectors are exploded to scalars so that SQL can state the same result."""

from __future__ import annotations

import math

from pyspark.ml import feature as mf
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bramble.functions import text as tx
from bramble.functions.columns import as_vector, big, exploded, r6, sparse_entries, with_slots
from bramble.functions.encode import one_hot
from bramble.operators import ranking, stats
from bramble.plans.aggregation import chi_rows
from bramble.plans.registry import Tables, plan
from bramble.plans.registry import r6 as sql6
from bramble.session import materialise, spread

# --- text -------------------------------------------------------------------------------------

_WORDS = r"""WITH w AS (SELECT doc_id, string_split_regex(lower(text), '[ \t\n\x0B\f\r]') AS words
                       FROM documents)"""
_TERMS = _WORDS + """, t AS (SELECT doc_id, unnest(words) AS term FROM w)"""


def _docs(t: Tables) -> DataFrame:
    return tx.tokens(spread(t.documents.select("doc_id", "text"), "doc_id"))


@plan("H1 B6", oracle=_TERMS + """
    SELECT doc_id, term, count(*) AS n FROM t WHERE term <> '' GROUP BY ALL""")
def tokens(t: Tables) -> DataFrame:
    return tx.word_counts(_docs(t), "words", "term", "doc_id").where("term <> ''")


@plan("H2 Q2", oracle=r"""
    SELECT doc_id, len(list_filter(string_split_regex(lower(text), '[^a-zA-Z0-9_]'),
                                   lambda x: x <> ''))::BIGINT AS n FROM documents""")
def regex_tokens(t: Tables) -> DataFrame:
    stage = mf.RegexTokenizer(inputCol="text", outputCol="words", pattern=r"\W")
    return stage.transform(t.documents).select("doc_id", big(F.size("words")).alias("n"))


@plan("H3", oracle=_TERMS + f"""
    SELECT doc_id, count(*) AS kept FROM t WHERE term NOT IN
        ({', '.join("'" + w.replace("'", "''") + "'" for w in tx.default_stop_words())})
    GROUP BY doc_id""")
def stopwords(t: Tables) -> DataFrame:
    return tx.without_stop_words(_docs(t)) \
        .select("doc_id", big(F.size("filtered")).alias("kept")).where("kept > 0")


@plan("H4", oracle=_WORDS + """, g AS (
        SELECT doc_id, unnest(list_zip(words[:-2], words[2:])) AS p FROM w WHERE len(words) > 1)
    SELECT p[1] || ' ' || p[2] AS bigram, count(*) AS n, count(DISTINCT doc_id) AS docs FROM g GROUP BY 1""")
def bigrams(t: Tables) -> DataFrame:
    return tx.word_counts(tx.ngrams(_docs(t)), "ngrams", "bigram", "doc_id") \
        .groupBy("bigram").agg(F.sum("n").alias("n"), F.count("*").alias("docs"))


@plan("H5", oracle=_TERMS + """
    SELECT doc_id, count(*)::DOUBLE AS total FROM t GROUP BY doc_id""")
def hashed_counts(t: Tables) -> DataFrame:
    """Hashed term frequencies; collisions move counts between slots but never change their sum."""
    hashed = mf.HashingTF(inputCol="words", outputCol="tf", numFeatures=1 << 18).transform(_docs(t))
    total = F.aggregate(F.unwrap_udt(F.col("tf"))["values"], F.lit(0.0), lambda a, v: a + v)
    return hashed.select("doc_id", total.alias("total")).where("total > 0")


@plan("H6", oracle=_TERMS + """, d AS (SELECT term FROM t GROUP BY term HAVING count(DISTINCT doc_id) >= 2)
    SELECT doc_id, term, count(*)::DOUBLE AS n FROM t JOIN d USING (term) GROUP BY ALL""")
def count_vector(t: Tables) -> DataFrame:
    return tx.term_weights(_docs(t), "doc_id", F.lit(0), min_docs=2) \
        .select("doc_id", "term", F.col("n").cast("double").alias("n"))


@plan("H6", oracle=_TERMS + """
    SELECT doc_id, count(*) FILTER (term = 'the')::DOUBLE AS n_the, count(*) FILTER (term = 'le')::DOUBLE AS n_le,
           count(*) FILTER (term = 'and')::DOUBLE AS n_and FROM t GROUP BY doc_id""")
def fixed_vocabulary(t: Tables) -> DataFrame:
    model = mf.CountVectorizerModel.from_vocabulary(["the", "le", "and"], inputCol="words", outputCol="c")
    c = vector_to_array("c")
    return model.transform(_docs(t)).select("doc_id", c[0].alias("n_the"), c[1].alias("n_le"),
                                            c[2].alias("n_and"))


@plan("H7", oracle=_TERMS + f""", tf AS (SELECT doc_id, term, count(*) AS n FROM t GROUP BY ALL),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term HAVING count(*) >= 2)
    SELECT doc_id, term, {sql6('n * ln(((SELECT count(*) FROM documents) + 1) / (df + 1))')} AS tfidf
    FROM tf JOIN df USING (term)""")
def tf_idf(t: Tables) -> DataFrame:
    return tx.term_weights(_docs(t), "doc_id", t.documents.agg(F.count("*")).scalar(), min_docs=2) \
        .select("doc_id", "term", r6("tfidf").alias("tfidf"))


@plan("H7", oracle=_TERMS + f""", tf AS (SELECT doc_id, term, count(*) AS n FROM t GROUP BY ALL),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term)
    SELECT doc_id, term, n, {sql6('n * ln(((SELECT count(*) FROM documents) + 1) / (df + 1))')} AS tfidf
    FROM tf JOIN df USING (term)""")
def term_weights(t: Tables) -> DataFrame:
    return tx.term_weights(_docs(t), "doc_id", t.documents.agg(F.count("*")).scalar()) \
        .withColumn("tfidf", r6("tfidf"))


@plan("H8 H9")
def word_vectors(t: Tables) -> DataFrame:
    """Nearest words of the most frequent term in an embedding trained on every word."""
    docs = materialise(tx.without_stop_words(_docs(t)).select("filtered"), "words")
    model = tx.word_vector_stage(docs, "filtered", "v", size=16, maxIter=1, seed=11).fit(docs)
    common = docs.select(F.explode("filtered").alias("word")).groupBy("word").count() \
        .orderBy(F.desc("count"), "word").limit(1)
    return tx.synonyms(materialise(tx.word_vectors(model, docs, "filtered", "v"), "vectors"), common, 10)


@plan("H9", oracle=f"""
    WITH e AS (SELECT vec_id AS word, label, embedding::DOUBLE[] AS v FROM embeddings),
    s AS (SELECT q.word AS query, e.word, list_cosine_similarity(q.v, e.v) AS similarity FROM e q JOIN e ON q.word <> e.word
          WHERE q.word IN (SELECT min(word) FROM e GROUP BY label)),
    r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY similarity DESC, word) AS rank FROM s)
    SELECT query, word, rank, {sql6('similarity')} AS similarity FROM r WHERE rank <= 10""")
def synonyms_of_given(t: Tables) -> DataFrame:
    """Rows of largest cosine to the first row of each label, from given vectors."""
    first = t.embeddings.groupBy("label").agg(F.min("vec_id").alias("vec_id"))
    return tx.synonyms(t.embeddings, first, 10, word="vec_id", vector="embedding").select(
        "query", "word", big("rank").alias("rank"), r6("similarity").alias("similarity"))


@plan("H8")
def document_vectors(t: Tables) -> DataFrame:
    """Mean word vector per document."""
    docs = materialise(tx.without_stop_words(_docs(t)).select("doc_id", "filtered"), "words")
    model = tx.word_vector_stage(docs, "filtered", "v", size=8, maxIter=1, seed=11).fit(docs)
    return with_slots(model.transform(docs), "v", "doc_id")


@plan("H10", oracle=f"""
    SELECT o_orderkey, 4::BIGINT AS n, {sql6('o_totalprice + 3')} AS total FROM orders""")
def feature_hash(t: Tables) -> DataFrame:
    """Mixed columns hashed to one vector: per row the number of active slots and their sum."""
    rows = t.orders.select("o_orderkey", "o_totalprice", (F.col("o_totalprice") > 250000).alias("dear"),
                           "o_orderstatus", "o_orderpriority")
    hashed = mf.FeatureHasher(inputCols=rows.columns[1:], outputCol="h").transform(rows)
    return sparse_entries(hashed, "h", "o_orderkey").groupBy("o_orderkey") \
        .agg(F.count("*").alias("n"), r6(F.sum("value")).alias("total"))


# --- thresholds and buckets -------------------------------------------------------------------

@plan("H11", oracle="""
    SELECT event_id, CASE WHEN value > 50 THEN 1.0 ELSE 0.0 END::DOUBLE AS hot FROM events""")
def binarize(t: Tables) -> DataFrame:
    return mf.Binarizer(threshold=50.0, inputCol="value", outputCol="hot").transform(t.events) \
        .select("event_id", "hot")


@plan("H12", oracle="""
    SELECT event_id, CASE WHEN value < 10 THEN 0 WHEN value < 50 THEN 1 WHEN value < 100 THEN 2 ELSE 3
                     END::DOUBLE AS bucket FROM events""")
def bucketize(t: Tables) -> DataFrame:
    inf = float("inf")
    return mf.Bucketizer(splits=[-inf, 10.0, 50.0, 100.0, inf], inputCol="value", outputCol="bucket") \
        .transform(t.events).select("event_id", "bucket")


@plan("H13", oracle="""
    SELECT p_partkey, CASE WHEN p_size < 10 THEN 0 WHEN p_size < 30 THEN 1 ELSE 2 END::DOUBLE AS size_b,
           CASE WHEN p_retailprice < 925 THEN 0 WHEN p_retailprice < 950 THEN 1
                WHEN p_retailprice < 975 THEN 2 ELSE 3 END::DOUBLE AS price_b FROM part""")
def bucketize_columns(t: Tables) -> DataFrame:
    inf = float("inf")
    stage = mf.Bucketizer(splitsArray=[[-inf, 10.0, 30.0, inf], [-inf, 925.0, 950.0, 975.0, inf]],
                          inputCols=["p_size", "p_retailprice"], outputCols=["size_b", "price_b"])
    rows = t.part.withColumn("p_size", F.col("p_size").cast("double"))
    return stage.transform(rows).select("p_partkey", "size_b", "price_b")


@plan("H14", oracle="""
    WITH o AS (SELECT c_acctbal, row_number() OVER (ORDER BY c_acctbal) AS r, count(*) OVER () AS n FROM customer),
    s AS (SELECT max(c_acctbal) FILTER (r = ceil(n / 3.0)) AS a, max(c_acctbal) FILTER (r = ceil(2 * n / 3.0)) AS b FROM o)
    SELECT c_custkey, CASE WHEN c_acctbal < a THEN 0 WHEN c_acctbal < b THEN 1 ELSE 2 END::DOUBLE AS bucket
    FROM customer, s""")
def quantile_buckets(t: Tables) -> DataFrame:
    """Exact thirds. Spark's discretizer keeps every value in its sketch when asked for no error."""
    inf = float("inf")
    cuts = sorted(set(ranking.exact_quantiles(t.customer, "c_acctbal", [1 / 3, 2 / 3])))
    stage = mf.Bucketizer(splits=[-inf, *cuts, inf], inputCol="c_acctbal", outputCol="bucket")
    return stage.transform(t.customer).select("c_custkey", "bucket")


@plan("H14")
def quantile_buckets_sketch(t: Tables) -> DataFrame:
    """Buckets at approximate quantiles, from a sketch of bounded size."""
    stage = mf.QuantileDiscretizer(numBuckets=3, relativeError=0.001, inputCol="c_acctbal", outputCol="bucket")
    return stage.fit(t.customer).transform(t.customer).select("c_custkey", "bucket")


# --- categories -------------------------------------------------------------------------------

_INDEX = """WITH f AS (SELECT p_type, row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS i
                      FROM part GROUP BY p_type),
    b AS (SELECT p_brand, row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS j FROM part GROUP BY p_brand)
"""


def _indexed(t: Tables) -> tuple[DataFrame, mf.StringIndexerModel]:
    rows = t.part.select("p_partkey", "p_type", "p_brand")
    model = mf.StringIndexer(inputCols=["p_type", "p_brand"], outputCols=["type_i", "brand_i"]).fit(rows)
    return model.transform(rows), model


@plan("H15", oracle=_INDEX + """
    SELECT p_partkey, i::DOUBLE AS type_i, j::DOUBLE AS brand_i FROM part JOIN f USING (p_type) JOIN b USING (p_brand)""")
def encode_index(t: Tables) -> DataFrame:
    return _indexed(t)[0].select("p_partkey", "type_i", "brand_i")


@plan("H16", oracle="SELECT p_partkey, p_type AS restored, p_brand AS again FROM part")
def decode_index(t: Tables) -> DataFrame:
    rows, model = _indexed(t)
    types, brands = model.labelsArray
    rows = mf.IndexToString(inputCol="type_i", outputCol="restored").transform(rows)
    rows = mf.IndexToString(inputCol="brand_i", outputCol="again", labels=brands).transform(rows)
    return rows.select("p_partkey", "restored", "again")


@plan("H17", oracle="""
    WITH d AS (SELECT l_linenumber AS v, row_number() OVER (ORDER BY l_linenumber) - 1 AS i
               FROM (SELECT DISTINCT l_linenumber FROM lineitem))
    SELECT l_orderkey, l_partkey, l_linenumber::BIGINT AS line, i::DOUBLE AS line_i, l_quantity AS qty
    FROM lineitem JOIN d ON l_linenumber = v""")
def vector_index(t: Tables) -> DataFrame:
    rows = stats.assemble(t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity"),
                          ["l_linenumber", "l_quantity"])
    model = mf.VectorIndexer(inputCol="features", outputCol="ix", maxCategories=10).fit(rows)
    ix = vector_to_array("ix")
    return model.transform(rows).select("l_orderkey", "l_partkey", big("l_linenumber").alias("line"),
                                        ix[0].alias("line_i"), ix[1].alias("qty"))


@plan("H18", oracle=_INDEX + """
    SELECT p_partkey, pos, CASE WHEN i = pos THEN 1.0 ELSE 0.0 END::DOUBLE AS value
    FROM part JOIN f USING (p_type), (SELECT unnest(range(0, 5)) AS pos)""")
def encode_onehot(t: Tables) -> DataFrame:
    return with_slots(_one_hot(t), "type_v", "p_partkey")


@plan("H18", oracle=_INDEX + """
    SELECT p_partkey, pos, CASE WHEN j = pos THEN 1.0 ELSE 0.0 END::DOUBLE AS value
    FROM part JOIN b USING (p_brand), (SELECT unnest(range(0, (SELECT count(*) - 1 FROM b))) AS pos)""")
def encode_onehot_brand(t: Tables) -> DataFrame:
    return with_slots(_one_hot(t), "brand_v", "p_partkey")


def _one_hot(t: Tables) -> DataFrame:
    rows, _ = _indexed(t)
    return mf.OneHotEncoder(inputCols=["type_i", "brand_i"], outputCols=["type_v", "brand_v"]).fit(rows).transform(rows)


@plan("H19", oracle="""
    SELECT p_partkey, (p_type = 'ECONOMY')::INT::DOUBLE AS t0, (p_type = 'LARGE')::INT::DOUBLE AS t1,
           (p_type = 'MEDIUM')::INT::DOUBLE AS t2, (p_type = 'PROMO')::INT::DOUBLE AS t3,
           (p_type = 'SMALL')::INT::DOUBLE AS t4, (p_type = 'STANDARD')::INT::DOUBLE AS t5 FROM part""")
def encode_onehot_full(t: Tables) -> DataFrame:
    kinds = mf.StringIndexer(inputCol="p_type", outputCol="i", stringOrderType="alphabetAsc").fit(t.part)
    return one_hot(t.part.select("p_partkey", "p_type"), "p_type", kinds.labels, "t").drop("p_type")


# --- vectors ----------------------------------------------------------------------------------

def _quad(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_discount", "l_tax",
                             F.col("l_linenumber").cast("double").alias("line"))
    return stats.assemble(spread(rows, "l_orderkey"), ["l_quantity", "l_discount", "l_tax", "line"])


_QUAD = """WITH q AS (SELECT l_orderkey, l_partkey, l_quantity AS a, l_discount AS b, l_tax AS c,
                             l_linenumber::DOUBLE AS d FROM lineitem)"""


def _slots_sql(exprs: list[str], source: str = "q", keep: str = "l_orderkey, l_partkey") -> str:
    values = ", ".join(sql6(e) for e in exprs)
    return f"""SELECT {keep}, unnest(range(0, {len(exprs)})) AS pos, unnest([{values}]) AS value FROM {source}"""


def _slots(df: DataFrame, features: str) -> DataFrame:
    return with_slots(df, features, "l_orderkey", "l_partkey").withColumn("value", r6("value"))


@plan("H20", oracle=_QUAD + _slots_sql(["a", "b", "c", "d", "a"]))
def assemble(t: Tables) -> DataFrame:
    rows = mf.VectorAssembler(inputCols=["features", "l_quantity"], outputCol="all").transform(_quad(t))
    return _slots(rows, "all")


@plan("H21", oracle="""
    SELECT vec_id, label::BIGINT AS label FROM embeddings WHERE label <> 3""")
def size_hint(t: Tables) -> DataFrame:
    """Vectors of the wrong length (here: those of label 3, shortened) are skipped."""
    short = F.when(F.col("label") == 3, F.slice("embedding", 1, 10)).otherwise(F.col("embedding"))
    rows = t.embeddings.select("vec_id", big("label").alias("label"), as_vector(short).alias("v"))
    sized = mf.VectorSizeHint(inputCol="v", size=64, handleInvalid="skip").transform(rows)
    # the vector has to be read for the check to run
    return sized.where(F.col("v").isNotNull()).select("vec_id", "label")


@plan("H22", oracle=_QUAD + _slots_sql(["b", "c"]))
def slice_vector(t: Tables) -> DataFrame:
    rows = mf.VectorSlicer(inputCol="features", outputCol="s", indices=[1], names=["l_tax"]) \
        .transform(_quad(t))
    return _slots(rows, "s")


@plan("H23", oracle=_QUAD + _slots_sql(["d * a * b", "d * a * c", "d * c * b", "d * c * c"]))
def interact(t: Tables) -> DataFrame:
    rows = stats.assemble(stats.assemble(_quad(t), ["l_quantity", "l_tax"], "u"), ["l_discount", "l_tax"], "v")
    return _slots(mf.Interaction(inputCols=["line", "u", "v"], outputCol="x").transform(rows), "x")


@plan("H24", oracle=_QUAD + _slots_sql(
    ["a", "a * a", "a * a * a", "b", "a * b", "a * a * b", "b * b", "a * b * b", "b * b * b"]))
def poly_expand(t: Tables) -> DataFrame:
    rows = stats.assemble(_quad(t), ["l_quantity", "l_discount"], "two")
    return _slots(mf.PolynomialExpansion(degree=3, inputCol="two", outputCol="p").transform(rows), "p")


@plan("H25", oracle=_QUAD + _slots_sql(["0 * a", "1 * b", "2 * c", "3 * d"]))
def elementwise(t: Tables) -> DataFrame:
    stage = mf.ElementwiseProduct(scalingVec=Vectors.dense([0.0, 1.0, 2.0, 3.0]), inputCol="features", outputCol="p")
    return _slots(stage.transform(_quad(t)), "p")


def _dct_terms() -> list[str]:
    out = []
    for k in range(4):
        scale = math.sqrt((1 if k == 0 else 2) / 4)
        out.append(f"{scale!r}::DOUBLE * (" + " + ".join(
            f"{name} * {math.cos(math.pi * k * (2 * n + 1) / 8)!r}::DOUBLE"
            for n, name in enumerate("abcd")) + ")")
    return out


@plan("H26", oracle=_QUAD + _slots_sql(_dct_terms()))
def dct(t: Tables) -> DataFrame:
    return _slots(mf.DCT(inverse=False, inputCol="features", outputCol="f").transform(_quad(t)), "f")


@plan("H27", oracle=_QUAD + ", z AS (SELECT *, abs(a) + abs(b) + abs(c) + abs(d) AS s FROM q) "
      + _slots_sql(["a / s", "b / s", "c / s", "d / s"], "z"))
def normalize_l1(t: Tables) -> DataFrame:
    return _slots(mf.Normalizer(p=1.0, inputCol="features", outputCol="n").transform(_quad(t)), "n")


@plan("H27", oracle=_QUAD + ", z AS (SELECT *, greatest(abs(a), abs(b), abs(c), abs(d)) AS s FROM q) "
      + _slots_sql(["a / s", "b / s", "c / s", "d / s"], "z"))
def normalize_inf(t: Tables) -> DataFrame:
    stage = mf.Normalizer(p=1.0, inputCol="features", outputCol="n")
    return _slots(stage.transform(_quad(t), {stage.p: float("inf")}), "n")


def _scaled_sql(expr: str) -> str:
    stats_ = ", ".join(f"stddev_samp({c}) AS sd_{c}, min({c}) AS lo_{c}, max({c}) AS hi_{c}, "
                       f"max(abs({c})) AS top_{c}" for c in "abcd")
    return _QUAD + f", s AS (SELECT {stats_} FROM q), z AS (SELECT * FROM q, s) " + \
        _slots_sql([expr.replace("@", c) for c in "abcd"], "z")


def _scaled(t: Tables, stage) -> DataFrame:
    rows = _quad(t)
    return _slots(stage.setInputCol("features").setOutputCol("s").fit(rows).transform(rows), "s")


@plan("H28", oracle=_scaled_sql("@ / sd_@"))
def scale_std(t: Tables) -> DataFrame:
    return _scaled(t, mf.StandardScaler(withStd=True, withMean=False))


@plan("H29", oracle=_scaled_sql("(@ - lo_@) / (hi_@ - lo_@)"))
def scale_minmax(t: Tables) -> DataFrame:
    return _scaled(t, mf.MinMaxScaler())


@plan("H30", oracle=_scaled_sql("@ / top_@"))
def scale_maxabs(t: Tables) -> DataFrame:
    return _scaled(t, mf.MaxAbsScaler())


@plan("H31", oracle=f"""
    WITH q AS (SELECT l_orderkey, l_partkey, l_quantity / 50 AS x, l_linenumber + l_quantity / 10 AS y FROM lineitem),
    m AS (SELECT covar_samp(x, y) AS xy, var_samp(x) AS xx, var_samp(y) AS yy FROM q),
    l AS (SELECT *, (xx + yy + sqrt((xx - yy) ** 2 + 4 * xy ** 2)) / 2 AS e FROM m),
    u AS (SELECT xy / sqrt(xy ** 2 + (e - xx) ** 2) AS ux, (e - xx) / sqrt(xy ** 2 + (e - xx) ** 2) AS uy FROM l)
    SELECT l_orderkey, l_partkey, {sql6('abs(x * ux + y * uy)')} AS first FROM q, u""")
def pca_first(t: Tables) -> DataFrame:
    """First principal component of two columns; the sign of a component is arbitrary."""
    rows = t.lineitem.select("l_orderkey", "l_partkey", (F.col("l_quantity") / 50).alias("x"),
                             (F.col("l_linenumber") + F.col("l_quantity") / 10).alias("y"))
    rows = stats.assemble(rows, ["x", "y"])
    model = mf.PCA(k=1, inputCol="features", outputCol="p").fit(rows)
    return model.transform(rows).select("l_orderkey", "l_partkey",
                                        r6(F.abs(vector_to_array("p")[0])).alias("first"))


@plan("H31")
def pca_embeddings(t: Tables) -> DataFrame:
    rows = t.embeddings.select("vec_id", as_vector("embedding").alias("v"))
    return with_slots(mf.PCA(k=3, inputCol="v", outputCol="p").fit(rows).transform(rows), "p", "vec_id")


@plan("H32", oracle=f"""
    WITH g AS (SELECT l_orderkey, l_partkey, l_extendedprice, nullif(l_discount, 0) AS d, nullif(l_tax, 0) AS x FROM lineitem)
    SELECT l_orderkey, l_partkey, l_extendedprice, {sql6('coalesce(d, (SELECT avg(d) FROM g))')} AS disc,
           {sql6('coalesce(x, (SELECT avg(x) FROM g))')} AS tax FROM g""")
def impute_mean(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_extendedprice",
                             F.nullif("l_discount", F.lit(0.0)).alias("d"),
                             F.when(F.col("l_tax") == 0, float("nan")).otherwise(F.col("l_tax")).alias("x"))
    model = mf.Imputer(inputCols=["d", "x"], outputCols=["disc", "tax"]).fit(rows)
    return model.transform(rows).select("l_orderkey", "l_partkey", "l_extendedprice",
                                        r6("disc").alias("disc"), r6("tax").alias("tax"))


@plan("H33", oracle="SELECT 3::BIGINT AS pos, count(*) AS n, sum(o_orderpriority[1]::INT % 2)::DOUBLE AS total FROM orders")
def chi_select(t: Tables) -> DataFrame:
    """Of four slots the one that depends on the label (its parity) is selected."""
    rows = chi_rows(t)
    stage = mf.UnivariateFeatureSelector(featuresCol="features", labelCol="label", outputCol="best",
                                         selectionMode="numTopFeatures")
    stage = stage.setFeatureType("categorical").setLabelType("categorical").setSelectionThreshold(1)
    model = stage.fit(rows)
    picked = with_slots(model.transform(rows), "best")
    return picked.agg(F.lit(model.selectedFeatures[0]).cast("bigint").alias("pos"),
                      F.count("*").alias("n"), F.sum("value").alias("total"))


@plan("H34", oracle="""
    WITH f AS (SELECT p_type, row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS i FROM part GROUP BY p_type)
    SELECT p_partkey, pos, CASE WHEN pos < 5 THEN (i = pos)::INT ELSE p_size END::DOUBLE AS value, p_retailprice AS label
    FROM part JOIN f USING (p_type), (SELECT unnest(range(0, 6)) AS pos)""")
def r_formula(t: Tables) -> DataFrame:
    model = mf.RFormula(formula="p_retailprice ~ p_type + p_size").fit(t.part)
    return with_slots(model.transform(t.part), "features", "p_partkey", "label")


@plan("H35", oracle=f"""
    SELECT vec_id, embedding[1]::DOUBLE AS first, {sql6('embedding[64]::DOUBLE')} AS last,
           len(list_filter(embedding, lambda x: x > 0))::BIGINT AS positive FROM embeddings""")
def vector_access(t: Tables) -> DataFrame:
    v = vector_to_array(as_vector("embedding"))
    return t.embeddings.select("vec_id", v[0].alias("first"), r6(v[63]).alias("last"),
                               big(F.size(F.filter(v, lambda x: x > 0))).alias("positive"))
