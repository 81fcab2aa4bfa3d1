"""Periodic runs against a brute-force search over all lags."""

import hashlib
import re
import zlib

import pyarrow.parquet as pq
from hypothesis import given, settings
from hypothesis import strategies as st

from bramble.llm import periodic, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def runs_by_brute_force(words):
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            start = i - q
            while i < n and words[i] == words[i - q]:
                i += 1
            stretch = words[start:i]
            least = next(d for d in range(1, q + 1) if stretch[d:] == stretch[:-d])
            if least == q and len(stretch) >= max(6, 4 * q):
                found.append((start, len(stretch), q))
    return sorted(found, key=lambda r: (r[0], r[2]))


pieces = st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 60))


@settings(max_examples=400, deadline=None)
@given(st.lists(pieces, max_size=5))
def test_runs_against_brute_force(parts):
    words = [w for unit, n in parts for w in (unit * n)[:n]]
    runs = periodic.periodic_runs(words)
    assert runs == runs_by_brute_force(words)
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    assert periodic.collapsed(words, runs) == [w for i, w in enumerate(words) if i not in gone]


def test_period_of_powers_is_the_smallest():
    assert periodic.periodic_runs(list("abab" * 40)) == [(0, 160, 2)]
    assert periodic.periodic_runs(["x"] * 5) == []
    assert periodic.periodic_runs(["x"] * 6) == [(0, 6, 1)]
    block = list("aaaaaaab")
    assert (0, 800, 8) in periodic.periodic_runs(block * 100)


def test_long_repetitive_texts_take_few_steps():
    assert periodic.periodic_runs(["x"] * 200_000) == [(0, 200_000, 1)]
    mixed = (["x"] * 1000 + ["y"]) * 100
    assert periodic.periodic_runs(mixed)[-1][1] > 0 and len(periodic.periodic_runs(mixed)) == 101


def report_by_brute_force(doc_id, text, change):
    words = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if change and h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = runs_by_brute_force(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    return (doc_id, len(runs), *best, best[0] is not None and 1000 * best[1] // best[2] or None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest())


def test_query_against_brute_force(spark):
    root = "/root/testdata/sf0.001"
    rows = pq.read_table(f"{root}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    rows = [r for r in rows if len((r["text"] or "").split()) < 3000]
    want = {report_by_brute_force(r["doc_id"], r["text"], True) for r in rows}
    got = {tuple(r) for r in queries.op12_periodic_runs(spark, root).collect()}
    assert want <= got and len(got) >= len(rows)
    assert sum(r[1] > 0 for r in want) > 5


def test_report_of_odd_rows(spark):
    rows = [(1, None, 7, "s"), (2, "", 7, "s"), (3, " \t\n", 7, "s"), (None, "a " * 10, 7, "s"), (4, "b c " * 20, 7, "s"),
            (4, "b c " * 20, 7, "s"), (5, "x" * 100_000 + " y", 7, "s"), (6, "Ä A ä " * 3000, 7, "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_runs int, start string")
    got = sorted((tuple(r)[:8] for r in periodic.run_report(df, with_text=True).collect()), key=str)
    assert got == sorted((report_by_brute_force(r[0], r[1], False) for r in rows), key=str)
    texts = {r["doc_id"]: r["collapsed_text"] for r in periodic.run_report(df, with_text=True).collect()}
    assert texts[4] == "b c" and texts[None] == "a" and texts[6] == "Ä A ä" and texts[1] == ""
    assert periodic.planted_tail(None, [b"a"]) == [b"a"]
    empty = periodic.run_report(df.limit(0))
    assert empty.count() == 0
