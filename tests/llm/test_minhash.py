"""MinHash components against brute force over all pairs of exact shingle sets."""

import random
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from bramble.llm import minhash, queries


def shingles_of(text, width=3):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))) if words else frozenset()


def components_by_brute_force(rows, percent=85):
    """Counter-free: (doc_id, n_shingles, component_id, kept) of each row, by an inverted index and union-find."""
    sets = [shingles_of(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        both = defaultdict(int)
        for sh in s:
            for j in holders[sh]:
                both[j] += 1
            holders[sh].append(i)
        for j, n in both.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    lowest = {g: min((rows[i][0] for i in m if rows[i][0] is not None), default=None) for g, m in groups.items()}
    return sorted(((r[0], len(sets[i]), lowest[find(i)], r[0] == lowest[find(i)]) for i, r in enumerate(rows)), key=str)


def found(spark, rows, schema="doc_id long, text string"):
    df = spark.createDataFrame(rows, schema).repartition(4)
    return sorted((tuple(r) for r in minhash.near_components(df).collect()), key=str)


def base(seed, n, kinds=10 ** 6):
    return [f"w{k}" for k in np.random.default_rng(seed).integers(0, kinds, n)]


def test_odd_rows(spark):
    long = " ".join(base(1, 20_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "one two"), (7, "ONE  two\n"), (8, "one two three"),
            (9, "one two three four"), (8, "one two three"), (None, "one two three"), (None, "nobody else has this"),
            (10, long), (11, long + " end"), (12, "Ä b c"), (13, "ä b c"), (2 ** 60, " ".join(base(2, 30)))]
    extra = [(*r, 1, "x", b"y", 3, 4) for r in rows]
    got = found(spark, extra, "doc_id long, text string, id int, key string, least binary, n int, label int")
    assert got == components_by_brute_force(rows)


def test_families_of_all_kinds_of_edits(spark):
    """Scattered, truncated, appended and replaced copies around the threshold, some chained."""
    rng, texts = random.Random(5), []
    for f in range(60):
        words = base(100 + f, rng.choice([20, 60, 150, 300]), rng.choice([30, 10 ** 6]))
        for c in range(rng.choice([1, 2, 6])):
            own, n, share = list(words), len(words), rng.choice([0.02, 0.06, 0.1, 0.16])
            cut = max(1, int(n * share))
            kind = rng.choice(["scattered", "truncated", "appended", "replaced", "chained"])
            if kind == "scattered":
                for at in rng.sample(range(n), max(1, cut // 3)):
                    own[at] = f"e{rng.random()}"
            elif kind == "truncated":
                own = own[:n - cut]
            elif kind == "appended":
                own += base(f * 100 + c, cut)
            elif kind == "replaced":
                own[n // 3:n // 3 + cut // 2] = base(f * 100 + c, cut // 2)
            else:
                words = own = own[max(1, cut // 2):] + base(f * 100 + c, max(1, cut // 2))
            texts.append(" ".join(own))
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    want = components_by_brute_force(rows)
    assert found(spark, rows) == want and sum(not r[3] for r in want) > 50


@pytest.mark.parametrize("with_base", [True, False])
def test_large_family(spark, monkeypatch, with_base):
    """Copies of 0.85 to a base and less to each other: the base holds them together, without it only chance does."""
    monkeypatch.setattr(minhash, "MEMBERS", 64)
    monkeypatch.setattr(minhash, "SHINGLES", 20_000)
    rng, words = np.random.default_rng(3), base(7, 289)
    texts = [" ".join(words)] if with_base else []
    while len(texts) < 400:
        copy = list(words)
        for at in rng.choice(289, 7, replace=False):
            copy[at] = f"e{rng.integers(0, 10 ** 9)}"
        texts.append(" ".join(copy))
    rows = list(enumerate(texts))
    want = components_by_brute_force(rows)
    assert found(spark, rows) == want
    if not with_base:
        assert len({r[2] for r in want}) > 1


def test_star_components(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (300, 299), (299, 300)]
    got = dict(minhash.star_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 140)}, 299: 299, 300: 299}


def test_random_graphs(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(260)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    got = dict(minhash.star_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {x: find(x) for e in edges for x in e if e[0] != e[1]}


def test_signatures_estimate_the_similarity():
    words = base(1, 2000)
    a, b = (minhash.signature(minhash.shingle_set(" ".join(w))) for w in (words, words[:1700] + base(2, 300)))
    true = 1698 / (1998 * 2 - 1698)
    assert abs((a == b).mean() - true) < 0.15
    assert len(set(minhash.bands(a))) == minhash.BANDS


def test_query_against_brute_force(spark):
    root = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{root}/documents.parquet").to_pylist()]
    got = queries.op11_minhash_components(spark, root)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == components_by_brute_force(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_components(df).count() == 0
