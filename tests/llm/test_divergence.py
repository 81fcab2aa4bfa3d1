"""Divergence of sources against a brute-force count and against the query's SQL."""

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from bramble.llm import divergence, queries

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, term string, n int, docs int, bits int"


def audit_by_brute_force(rows, min_docs, top):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in ((r[1] or "", r[2] or "", r[3] or "") for r in rows):
        found = Counter(TERM.findall(text.translate(LOWER)))
        counts[lang, source].update(found)
        docs[lang].update(found.keys())
        groups.add((lang, source))
    out = set()
    for lang, source in groups:
        kept = [t for t, d in docs[lang].items() if d >= min_docs]
        sources = sorted(s for g, s in groups if g == lang)
        overall = Counter()
        for s in sources:
            overall.update({t: counts[lang, s][t] for t in kept})

        def shares(n):
            total = sum(n[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10 ** 9 * (n[t] + 5) // total for t in kept}

        mine, q = shares(counts[lang, source]), shares(overall)
        pairs = [(sum(abs(mine[t] - p) for t, p in shares(counts[lang, s]).items()), s) for s in sources if s != source]
        terms = [(mine[t] - q[t], t) for t in kept if counts[lang, source][t] and mine[t] > q[t]]
        for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
            found.sort(key=lambda x: (-x[0], x[1].encode()))
            out |= {(lang, source, part, item, value, k + 1) for k, (value, item) in enumerate(found[:limit])}
    return out


def sample(seed, n):
    rng = np.random.default_rng(seed)
    words = [f"{'aZäß'[k % 4]}{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(300)]
    rows = []
    for i in range(n):
        lang, source = (None, "de", "en", "en")[rng.integers(0, 4)], ("x", "y", None, "Zé", "x")[rng.integers(0, 5)]
        text = "1,2 _".join(rng.choice(words[:60 + 40 * int(rng.integers(0, 6))], rng.integers(0, 60)).tolist())
        rows.append((i, None if i % 17 == 0 else text, lang, source, "t", 1, 2, 3))
    return rows + [rows[3], rows[3], (n, None, "fr", "alone", "t", 1, 2, 3), (n + 1, "x " * 50_000, "en", "long", "t", 1, 2, 3),
                   (n + 2, "", "fr", "other", "t", 1, 2, 3)]


@pytest.mark.parametrize("min_docs", [1, 12])
def test_audit_against_brute_force(spark, min_docs):
    rows = sample(4, 400)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = divergence.audit(df, min_docs=min_docs, top=10)
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == audit_by_brute_force(rows, min_docs, 10)


def test_partial_counts_meet(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 10)
    rows = sample(5, 60)
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    assert {tuple(r) for r in divergence.audit(df, min_docs=2).collect()} == audit_by_brute_force(rows, 2, 50)


def test_empty_table_and_no_kept_terms(spark):
    df = spark.createDataFrame(sample(6, 20), SCHEMA)
    assert divergence.audit(df.limit(0)).count() == 0
    found = divergence.audit(df, min_docs=1000)
    assert {r["value"] for r in found.collect()} == {0} and found.where("part = 'term'").count() == 0


def test_shares_are_exact_for_large_counts(spark):
    big = 9 * 10 ** 17
    df = spark.createDataFrame([(big - 1, big, 3)], "n long, total long, kept long")
    assert df.select(divergence.share("n", "total", "kept")).first()[0] == 1 + 10 ** 9 * (big + 4) // (big + 15)


def test_query_agrees_with_sql(spark):
    root = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{root}/documents.parquet'")
    want = con.sql(queries.ORACLES["op13_count_bitmaps"])
    got = queries.op13_count_bitmaps(spark, root).select(want.columns)
    assert Counter(tuple(r) for r in got.collect()) == Counter(want.fetchall())
