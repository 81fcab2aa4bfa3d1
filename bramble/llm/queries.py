"""The queries of the corpus operators and, where SQL can say the same, their statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bramble.llm import (divergence, exact_dedup, language, minhash, mixing, packing, periodic, quality, repeats, rules,
                         sharding, simhash, toxicity)
from bramble.llm.common import id_fold

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(build):
        QUERIES[build.__name__] = build
        if sql:
            ORACLES[build.__name__] = sql
        return build

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


@query(r"""
    WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS chars,
                      regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm FROM documents)
    SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
           row_number() OVER w = 1 AS kept, sha256(norm) AS text_sha256
    FROM n WINDOW w AS (PARTITION BY norm ORDER BY chars DESC, doc_id NULLS LAST)""")
def op4_stateful_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_classes(spark, f"{sf_dir}/documents.parquet")
    return found.select("doc_id", "keep_id", "group_size", "kept",
                        F.lower(F.hex("digest")).alias("text_sha256"))


@query()
def op10_hierarchical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir))


@query()
def op8_simhash_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(documents(spark, sf_dir))


@query()
def op1_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan_mix(documents(spark, sf_dir))


@query()
def op6_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, labels(spark, sf_dir))
    return toxicity.graded(docs, model).withColumn(
        "held_out", id_fold("doc_id", toxicity.FOLDS) == toxicity.HELD_OUT)


@query()
def op7_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_rows(documents(spark, sf_dir))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query()
def op2_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.scored(docs, quality.fit(docs, labels(spark, sf_dir)))


@query()
def op5_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language.predicted(docs, language.fit(docs))


@query()
def op3_ngram_ratio_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return rules.judged(docs, rules.fit(docs, labels(spark, sf_dir)))


@query()
def op9_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.without_repeats(documents(spark, sf_dir), stored=True)
    return cut.withColumn("removed", F.col("n_removed") > 0)


@query()
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_report(documents(spark, sf_dir), change=periodic.planted_tail)


@query(r"""
    WITH d AS (SELECT row_number() OVER () AS uid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
               FROM documents),
    t AS (SELECT uid, lang, source,
                 unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
    kept AS (SELECT lang, term, count(*) AS lang_n FROM t GROUP BY ALL HAVING count(DISTINCT uid) >= 30),
    langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY ALL),
    groups AS (SELECT DISTINCT lang, source FROM d),
    held AS (SELECT t.lang, t.source, t.term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
    totals AS (SELECT lang, source, sum(n) AS total FROM held GROUP BY ALL),
    cells AS (SELECT g.lang, g.source, k.term, coalesce(h.n, 0) AS n,
                     1 + 1000000000::HUGEINT * (coalesce(h.n, 0) + 5) // (coalesce(s.total, 0) + 5 * l.v)::HUGEINT AS p,
                     1 + 1000000000::HUGEINT * (k.lang_n + 5) // (l.lang_total + 5 * l.v)::HUGEINT AS q
              FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN totals s USING (lang, source)
              LEFT JOIN held h ON h.lang = g.lang AND h.source = g.source AND h.term = k.term),
    diffs AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
              FROM cells a JOIN cells b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    parts AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
              FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
              LEFT JOIN diffs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
              UNION ALL
              SELECT lang, source, 'term', term, p - q FROM cells WHERE n > 0 AND p > q),
    ranked AS (SELECT lang, source, part, item, value::BIGINT AS value,
                      row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
               FROM parts)
    SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50""")
def op13_count_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


@query()
def op11_minhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_components(documents(spark, sf_dir), stored=True)
