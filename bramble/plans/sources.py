"""Source and sink plans: every one writes a whole table and reads it back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bramble.functions.columns import as_vector, big, r6, with_slots
from bramble.plans.aggregation import RATINGS_SQL, ratings
from bramble.plans.registry import Tables, plan
from bramble.plans.registry import r6 as sql6
from bramble.session import scratch_path
from bramble.sources import delimited, lines

_ORDERS = ("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
           "o_orderdate::DATE::VARCHAR AS day, o_orderpriority FROM orders")


def _orders(t: Tables) -> DataFrame:
    return t.orders.withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd")) \
        .select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "day", "o_orderpriority")


def _csv(t: Tables, df: DataFrame, **options) -> str:
    path = scratch_path(t.spark, "csv")
    delimited.write_csv(df, path, **options)
    return path


def _typed(df: DataFrame) -> DataFrame:
    return df.select(big("o_orderkey").alias("o_orderkey"), big("o_custkey").alias("o_custkey"),
                     "o_orderstatus", F.col("o_totalprice").cast("double").alias("o_totalprice"),
                     F.col("day").cast("string").alias("day"), "o_orderpriority")


@plan("A1 A11", oracle=_ORDERS)
def csv_inferred(t: Tables) -> DataFrame:
    return _typed(delimited.read_csv(t.spark, _csv(t, _orders(t)), header=True, infer=True))


@plan("A2 B12", oracle=_ORDERS)
def csv_strings(t: Tables) -> DataFrame:
    return _typed(delimited.read_csv(t.spark, _csv(t, _orders(t)), header=True))


@plan("A3", oracle=_ORDERS)
def csv_schema(t: Tables) -> DataFrame:
    rows = _orders(t)
    return delimited.read_csv(t.spark, _csv(t, rows), header=True, schema=rows.schema)


@plan("A4", oracle=_ORDERS)
def tsv_schema(t: Tables) -> DataFrame:
    rows = _orders(t)
    path = _csv(t, rows, header=False, sep="\t")
    return delimited.read_csv(t.spark, path, schema=rows.schema, sep="\t")


@plan("A5", oracle="SELECT p_partkey AS c0, p_size::BIGINT AS c1, p_retailprice AS c2, p_brand AS c3 FROM part")
def csv_positional(t: Tables) -> DataFrame:
    path = _csv(t, t.part.select("p_partkey", "p_size", "p_retailprice", "p_brand"), header=False)
    df = delimited.read_csv(t.spark, path, infer=True)
    return df.select(big("_c0").alias("c0"), big("_c1").alias("c1"), F.col("_c2").alias("c2"),
                     F.col("_c3").alias("c3"))


def _text(t: Tables, values: DataFrame) -> str:
    path = scratch_path(t.spark, "text")
    values.write.text(path)
    return path


@plan("A6", oracle="""
    WITH b AS (SELECT l_orderkey, list_sort(list_distinct(list(p_type))) AS items
               FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey)
    SELECT array_to_string(items, ' ') AS items, len(items)::BIGINT AS size, count(*) AS n FROM b GROUP BY ALL""")
def text_tokens(t: Tables) -> DataFrame:
    joined = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    rows = joined.groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_set("p_type")), " ").alias("value"))
    read = lines.read_tokens(t.spark, _text(t, rows.select("value")))
    return read.groupBy(F.array_join("tokens", " ").alias("items"), big(F.size("tokens")).alias("size")) \
        .agg(F.count("*").alias("n"))


def _rating_lines(t: Tables, sep: str) -> DataFrame:
    path = _text(t, ratings(t).select(F.concat_ws(sep, "user", "item", "rating", F.lit("0")).alias("value")))
    fields = [("user", "bigint"), ("item", "bigint"), ("rating", "double"), ("ts", "bigint")]
    return lines.require_valid(lines.parse_fields(t.spark.read.text(path), sep, fields))


_RATINGS = f"WITH {RATINGS_SQL} SELECT u AS user, i AS item, rating, 0::BIGINT AS ts FROM r"


@plan("A7", oracle=_RATINGS)
def parse_double_colon(t: Tables) -> DataFrame:
    return _rating_lines(t, "::").select("user", "item", "rating", "ts")


@plan("A8", oracle=_RATINGS)
def parse_tabs(t: Tables) -> DataFrame:
    return _rating_lines(t, "\t").select("user", "item", "rating", "ts")


@plan("A7", oracle="""
    SELECT o_orderkey || '::' || o_orderstatus || '::' || o_orderkey AS line FROM orders""")
def reject_table(t: Tables) -> DataFrame:
    """Lines with a field that does not convert, kept as rejects."""
    path = _text(t, t.orders.select(F.concat_ws("::", "o_orderkey", "o_orderstatus", "o_orderkey").alias("value")))
    parsed = lines.parse_fields(t.spark.read.text(path), "::",
                                [("key", "bigint"), ("status", "double"), ("again", "bigint")])
    return parsed.where(~F.col("is_valid")).select(F.col("value").alias("line"))


_SEPARATORS = {",": ",", "=": "=", "[-]": r"\[-\]"}


@plan("A9", oracle=r"""
    WITH c AS (SELECT CASE role WHEN 'user' THEN 0 WHEN 'assistant' THEN 1 ELSE 2 END::BIGINT AS label,
                      len(string_split_regex(regexp_replace(text, '[\n\r]', ' ', 'g'), '[ \t\n\x0B\f\r]+'))::BIGINT AS tokens
               FROM conversations)
    SELECT sep, label, count(*) AS n, sum(tokens)::BIGINT AS tokens
    FROM c, (SELECT unnest([',', '=', '[-]']) AS sep) GROUP BY ALL""")
def labelled_lines(t: Tables) -> DataFrame:
    label = F.when(F.col("role") == "user", 0).when(F.col("role") == "assistant", 1).otherwise(2)
    flat = F.regexp_replace("text", r"[\n\r]", " ")
    out = None
    for sep, pattern in _SEPARATORS.items():
        path = _text(t, t.conversations.select(F.concat(label.cast("string"), F.lit(sep), flat).alias("value")))
        part = lines.parse_labelled(lines.read_lines(t.spark, path), pattern).groupBy(
            F.lit(sep).alias("sep"), big("label").alias("label")).agg(
            F.count("*").alias("n"), F.sum(big(F.size("tokens"))).alias("tokens"))
        out = part if out is None else out.unionByName(part)
    return out


@plan("A10", oracle=f"""
    SELECT label::DOUBLE AS label, pos::BIGINT AS pos, count(*) AS n, {sql6('sum(v)')} AS total
    FROM (SELECT label, unnest(range(0, 64)) AS pos, unnest(embedding::DOUBLE[]) AS v FROM embeddings) GROUP BY ALL""")
def libsvm_round_trip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "libsvm")
    delimited.write_libsvm(t.embeddings.select("label", as_vector("embedding").alias("features")), path)
    rows = delimited.read_libsvm(t.spark, path, num_features=64)
    return with_slots(rows, "features", "label").groupBy("label", "pos") \
        .agg(F.count("*").alias("n"), r6(F.sum("value")).alias("total"))


@plan("A12 B31", oracle="SELECT n_nationkey::BIGINT AS n_nationkey, n_name, 1::BIGINT AS files FROM nation")
def csv_single_file(t: Tables) -> DataFrame:
    """The one-file sink, for small results."""
    path = _csv(t, t.nation, single_file=True)
    rows = delimited.read_csv(t.spark, path, header=True)
    files = rows.select(F.input_file_name().alias("f")).agg(F.countDistinct("f")).scalar()
    return rows.select(big("n_nationkey").alias("n_nationkey"), "n_name", files.alias("files"))


@plan("A17", oracle="""
    SELECT role AS first, count(*) AS n FROM conversations
    WHERE role NOT IN ('user', 'assistant') GROUP BY role""")
def reject_lines(t: Tables) -> DataFrame:
    """Lines whose first token is not an expected label, located by file and line number."""
    flat = F.regexp_replace("text", r"[\n\r]", " ")
    path = _text(t, t.conversations.select(F.concat_ws(" ", "role", flat).alias("value")))
    bad = lines.rejects(lines.number_lines(t.spark, path), ["user", "assistant"])
    # (file, line number) locates a line, so distinct pairs count the rejected lines
    return bad.groupBy(F.split("value", " ", 2)[0].alias("first")) \
        .agg(F.countDistinct("file", "line_no").alias("n"))


@plan("A18", oracle=r"""
    SELECT doc_id, length(regexp_replace(text, '[\n\r]', ' ', 'g'))::BIGINT AS n FROM documents""")
def encoded_text(t: Tables) -> DataFrame:
    """Text written in UTF-16LE and read back through the charset-aware line reader."""
    flat = F.regexp_replace("text", r"[\n\r]", " ")
    path = scratch_path(t.spark, "utf16")
    lines.write_lines(t.documents.select(F.concat_ws("|", "doc_id", flat).alias("value")), path, "UTF-16LE")
    read = lines.read_lines(t.spark, path, "UTF-16LE")
    parts = F.split("value", r"\|", 2)
    return read.select(big(parts[0]).alias("doc_id"), big(F.length(parts[1])).alias("n"))
