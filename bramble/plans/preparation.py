"""Projection, filter, encoding, imputation, lookup and set plans."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bramble.functions import encode
from bramble.functions.columns import big, r6
from bramble.operators import sampling
from bramble.operators.neighbours import sample_sizes
from bramble.operators.ranking import number_rows
from bramble.session import materialise
from bramble.plans.registry import Tables, plan
from bramble.plans.registry import r6 as sql6


@plan("B1 B2 B3 B4", oracle="""
    SELECT p_partkey, p_name, p_brand, p_type, p_size::BIGINT AS p_size,
           p_retailprice AS label, p_retailprice > 950 AS prediction FROM part""")
def project_columns(t: Tables) -> DataFrame:
    part = t.part
    *features, label = part.columns
    scored = part.withColumn("prediction", F.col(label) > 950) \
        .withColumn("p_size", big("p_size")).withColumnRenamed(label, "label")
    return scored.select(*[F.col(c) for c in features], "label", "prediction")


@plan("B5 B7", oracle="""
    SELECT vec_id, label::BIGINT AS label FROM embeddings WHERE label <> 5""")
def filter_label(t: Tables) -> DataFrame:
    return t.embeddings.where(F.col("label") != 5).select("vec_id", big("label").alias("label"))


@plan("B6 B17 Q2", oracle=r"""
    SELECT conv_id, turn, len(string_split_regex(text, '[ \t\n\f\r]+'))::BIGINT AS n_tokens
    FROM conversations WHERE len(string_split_regex(text, '[ \t\n\f\r]+')) > 2""")
def token_filter(t: Tables) -> DataFrame:
    words = F.split("text", "[ \\t\\n\\f\\r]+")
    return t.conversations.where(F.size(words) > 2) \
        .select("conv_id", "turn", big(F.size(words)).alias("n_tokens"))


@plan("B8 B9", oracle="""
    SELECT o_orderkey,
           CASE WHEN o_totalprice > 250000 AND o_orderstatus = 'F'
                     AND o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END::BIGINT AS is_big,
           CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END::DOUBLE AS is_final
    FROM orders""")
def encode_flag(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey",
        big(encode.flag("o_totalprice > 250000 and o_orderstatus = 'F' "
                        "and o_orderpriority = '1-URGENT'")).alias("is_big"),
        F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0).alias("is_final"))


@plan("B10", oracle="""
    SELECT p_partkey, CASE WHEN p_size > 40 THEN 'old' WHEN p_size > 30 THEN 'middle'
                           WHEN p_size > 18 THEN 'young' ELSE 'child' END AS band FROM part""")
def encode_band(t: Tables) -> DataFrame:
    bands = [(40, "old"), (30, "middle"), (18, "young")]
    return t.part.select("p_partkey", encode.band(F.col("p_size"), bands, "child").alias("band"))


@plan("B11 Q1", oracle="""
    SELECT p_partkey, CASE WHEN contains(p_brand, 'Brand#25') THEN 'Brand#25'
                           WHEN contains(p_brand, 'Brand#2') THEN 'Brand#2'
                           WHEN contains(p_brand, 'Brand#1') THEN 'Brand#1'
                           ELSE 'Other' END AS title FROM part""")
def encode_title(t: Tables) -> DataFrame:
    # as with "Mrs" and "Mr": the longer form is tested first
    title = encode.first_containing(F.col("p_brand"), ["Brand#25", "Brand#2", "Brand#1"], "Other")
    return t.part.select("p_partkey", title.alias("title"))


@plan("B12 B13 B23", oracle=f"""
    SELECT l_orderkey, l_linenumber::BIGINT - 1 AS line0, l_partkey, l_shipdate::DATE::VARCHAR AS day,
           l_quantity::VARCHAR::DOUBLE AS qty, {sql6('l_extendedprice * (1 - l_discount)')} AS net
    FROM lineitem""")
def cast_and_arithmetic(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey", (big("l_linenumber") - 1).alias("line0"), "l_partkey",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"),
        F.col("l_quantity").cast("string").cast("double").alias("qty"),
        r6(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"))


@plan("B14 B15", oracle="""
    SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'S') AS status,
           coalesce(CASE WHEN o_totalprice > 400000 THEN NULL ELSE o_totalprice END, -1.0) AS price
    FROM orders""")
def fill_constants(t: Tables) -> DataFrame:
    gaps = t.orders.select(
        "o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
        F.when(F.col("o_totalprice") <= 400000, F.col("o_totalprice")).alias("price"))
    return gaps.fillna("S", subset=["status"]).fillna(-1.0, subset=["price"])


@plan("B16 D1", oracle=f"""
    WITH g AS (SELECT l_orderkey, l_partkey, l_extendedprice,
                      nullif(l_discount, 0) AS d FROM lineitem)
    SELECT l_orderkey, l_partkey, l_extendedprice, {sql6('coalesce(d, (SELECT avg(d) FROM g))')} AS disc
    FROM g""")
def impute_inline_mean(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_extendedprice",
                             F.nullif("l_discount", F.lit(0.0)).alias("d"))
    mean = rows.agg(F.avg("d").alias("mean")).scalar()
    return rows.select("l_orderkey", "l_partkey", "l_extendedprice",
                       r6(F.coalesce(F.col("d"), mean)).alias("disc"))


@plan("B18", oracle="""
    WITH b AS (SELECT l_orderkey, list_sort(list_distinct(list(p_type))) AS items
               FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey)
    SELECT l_orderkey, array_to_string(items, '_') AS basket, len(items)::BIGINT AS n_items,
           len(items) = 1 AS single FROM b""")
def basket_key(t: Tables) -> DataFrame:
    joined = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return joined.groupBy("l_orderkey").agg(F.array_sort(F.collect_set("p_type")).alias("items")) \
        .select("l_orderkey", F.array_join("items", "_").alias("basket"),
                big(F.size("items")).alias("n_items"),
                (F.size(F.split(F.array_join("items", "_"), "_")) == 1).alias("single"))


@plan("B19", oracle="""
    SELECT event_id, (props->>'$.k')::BIGINT AS k, [event_type, props][1] AS kind FROM events""")
def nested_access(t: Tables) -> DataFrame:
    nested = t.events.select(
        "event_id", F.from_json("props", "map<string,bigint>").alias("m"),
        F.struct(F.array("event_type", "props").alias("list")).alias("obj"))
    return nested.select("event_id", F.col("m")["k"].alias("k"), F.col("obj.list")[0].alias("kind"))


@plan("B20 B21", oracle="""
    SELECT event_id, (ts::DATE + 1)::VARCHAR AS next_day FROM events""")
def next_day(t: Tables) -> DataFrame:
    t.events.createOrReplaceTempView("bramble_events")
    return t.spark.sql("SELECT event_id, date_format(date_add(ts, 1), 'yyyy-MM-dd') AS next_day "
                       "FROM bramble_events")


@plan("B22 B23", oracle=f"""
    SELECT l_orderkey, l_quantity, l_tax, {sql6('l_quantity + l_tax')} AS v3,
           {sql6('l_quantity * l_tax')} AS v4 FROM lineitem""")
def sql_stage(t: Tables) -> DataFrame:
    stage = SQLTransformer(statement="SELECT *, round(l_quantity + l_tax, 6) AS v3, "
                                     "round(l_quantity * l_tax, 6) AS v4 FROM __THIS__")
    return stage.transform(t.lineitem.select("l_orderkey", "l_quantity", "l_tax"))


@plan("B24 G2", oracle="SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct_pairs(t: Tables) -> DataFrame:
    return t.lineitem.select("l_partkey", "l_suppkey").distinct()


@plan("B25 C3", oracle="""
    WITH d AS (SELECT p_brand, row_number() OVER (ORDER BY p_brand) - 1 AS index
               FROM (SELECT DISTINCT p_brand FROM part))
    SELECT p_partkey, p_brand, index FROM part JOIN d USING (p_brand)""")
def dictionary_lookup(t: Tables) -> DataFrame:
    codes = encode.dictionary(t.part, "p_brand")
    return encode.lookup(t.part.select("p_partkey", "p_brand"), codes, "p_brand") \
        .select("p_partkey", "p_brand", "index")


@plan("C3", oracle="""
    SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey""")
def nation_lookup(t: Tables) -> DataFrame:
    places = encode.lookup(t.nation, t.region.withColumnRenamed("r_regionkey", "n_regionkey"),
                           "n_regionkey").withColumnRenamed("n_nationkey", "c_nationkey")
    return encode.lookup(t.customer, places, "c_nationkey").select("c_custkey", "n_name", "r_name")


@plan("B26", oracle="""
    SELECT c_custkey, c_mktsegment, row_number() OVER (ORDER BY c_custkey) - 1 AS row_no FROM customer""")
def keyed_row_number(t: Tables) -> DataFrame:
    return number_rows(t.customer.select("c_custkey", "c_mktsegment"), "c_custkey")


@plan("B27", oracle="""
    SELECT CASE WHEN o_orderkey % 10 < 8 THEN 'train' ELSE 'test' END AS part,
           count(*) AS n, min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders GROUP BY 1""")
def split_by_modulus(t: Tables) -> DataFrame:
    side = F.when(F.pmod("o_orderkey", F.lit(10)) < 8, "train").otherwise("test")
    return t.orders.groupBy(side.alias("part")).agg(
        F.count("*").alias("n"), F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi"))


@plan("B27", oracle="SELECT count(*) AS n, sum(o_orderkey)::BIGINT AS key_sum FROM orders")
def split_random_whole(t: Tables) -> DataFrame:
    """The parts of a seeded random split and of a key split each add up to the table."""
    orders = t.orders.select("o_orderkey")
    train, test = sampling.split_random(orders, [0.8, 0.2], seed=12345)
    return train.unionByName(test).agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("key_sum"))


@plan("B28")
def sample_rows(t: Tables) -> DataFrame:
    return sampling.sample_fraction(t.orders, 1000, seed=7).select("o_orderkey")


@plan("B29")
def sample_many_sizes(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_totalprice")
    return sample_sizes(orders, "o_orderkey", range(100, 1001, 100), orders.count(), seed=3) \
        .groupBy("sample_size").agg(F.count("*").alias("n"), F.avg("o_totalprice").alias("mean"))


_DRAWN = """('0x' || substr(md5('3:' || s || ':' || o_orderkey), 1, 8))::BIGINT / 4294967296.0 * (SELECT count(*) FROM orders) < s"""


@plan("B28", oracle=f"SELECT o_orderkey FROM orders, (SELECT 1000 AS s) WHERE {_DRAWN}")
def digest_sample(t: Tables) -> DataFrame:
    """About a thousand rows, drawn by the digest of their key."""
    return sampling.digest_samples(t.orders.select("o_orderkey"), "o_orderkey", [1000], seed=3).select("o_orderkey")


@plan("B29", oracle=f"""
    SELECT s::INTEGER AS sample_size, count(*) AS n, round(sum(o_totalprice), 2) AS total
    FROM orders, (SELECT unnest(range(100, 1001, 100)) AS s) WHERE {_DRAWN} GROUP BY s""")
def digest_sample_sizes(t: Tables) -> DataFrame:
    """Ten samples of growing size in one pass."""
    return sampling.digest_samples(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", range(100, 1001, 100), seed=3) \
        .groupBy("sample_size").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@plan("B30 B31 B32 D3", oracle="""
    SELECT o_orderpriority, count(*) AS n, min(o_orderkey) AS first_key FROM orders GROUP BY 1""")
def cached_counts(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderpriority", "o_orderkey").persist(StorageLevel.MEMORY_AND_DISK)
    counts = rows.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_key")) \
        .coalesce(1)   # one row per priority
    found = materialise(counts, "counts")
    rows.unpersist()
    return found


@plan("F5 B24", oracle="""
    SELECT o_custkey FROM (SELECT DISTINCT o_custkey FROM orders) ORDER BY o_custkey LIMIT 3""")
def limit_distinct(t: Tables) -> DataFrame:
    return t.orders.select("o_custkey").distinct().orderBy("o_custkey").limit(3)


@plan("G1", oracle=f"""
    SELECT count(*) AS n, {sql6('avg(bal)')} AS mean FROM (
        SELECT c_acctbal AS bal FROM customer UNION ALL SELECT s_acctbal FROM supplier)""")
def union_mean(t: Tables) -> DataFrame:
    both = t.customer.select(F.col("c_acctbal").alias("bal")) \
        .unionByName(t.supplier.select(F.col("s_acctbal").alias("bal")))
    return both.agg(F.count("*").alias("n"), r6(F.avg("bal")).alias("mean"))


@plan("C2", oracle="""
    SELECT c_custkey, coalesce(len(list(o_orderkey) FILTER (o_orderkey IS NOT NULL)), 0)::BIGINT AS n_big,
           max(o_orderkey) AS last_key
    FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_totalprice > 400000) o
         ON c_custkey = o_custkey GROUP BY c_custkey""")
def left_join_keep_all(t: Tables) -> DataFrame:
    big_orders = t.orders.where(F.col("o_totalprice") > 400000) \
        .groupBy(F.col("o_custkey").alias("c_custkey")) \
        .agg(F.count("*").alias("n_big"), F.max("o_orderkey").alias("last_key"))
    return t.customer.select("c_custkey").join(big_orders, "c_custkey", "left") \
        .select("c_custkey", F.coalesce("n_big", F.lit(0)).alias("n_big"), "last_key")
