"""Every corpus operator on small tables with nulls, empty and long texts, ties and repeated rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from bramble.llm import (exact_dedup, language, mixing, packing, quality, queries, repeats, rules, sharding,
                         simhash, toxicity)
from bramble.llm.common import connected_components, numbered
from bramble.session import scratch_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, label int, copies string"


def row(i, text, lang="en", source="a"):
    return (i, text, lang, source, None, "x", 3, "y")


def prose(seed, n, words=("the", "of", "river", "stone", "house", "green", "walks", "under", "cloud", "seven")):
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(words) + str(rng.integers(0, 60)) for _ in range(n))


ROWS = [row(1, None), row(2, ""), row(3, " \t\n"), row(4, "Same  text"), row(5, "Same text"), row(6, "Sametext"),
        row(7, prose(1, 40)), row(7, prose(1, 40)), row(8, prose(2, 30_000)), row(None, "no id here", None, None),
        row(9, "ÄÖ é x", "de", None), row(10, "a,b.c", None, "b"), row(11, prose(3, 100)),
        row(12, prose(3, 100) + " end"), row(2 ** 60 + 1, "large id", "fr", "c")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def stored(spark, df):
    path = scratch_path(spark, "fixture")
    df.write.parquet(path)
    return path


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


# exact deduplication

def test_exact_classes_against_brute_force(spark, docs):
    path = stored(spark, docs.repartition(4))
    groups = defaultdict(list)
    for r in ROWS:
        groups[re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")].append((-len(r[1] or ""), r[0] is None, r[0]))
    want = Counter()
    for members in groups.values():
        keep = sorted(members, key=lambda m: (m[0], m[1], m[2] or 0))[0]
        for k, m in enumerate(sorted(members, key=lambda m: (m[0], m[1], m[2] or 0))):
            want[m[2], keep[2], len(members), k == 0] += 1
    for files in (1, 1000):  # one file a batch carries the state from batch to batch
        got = exact_dedup.exact_classes(spark, path, files_per_batch=files)
        assert rows_of(got.select("doc_id", "keep_id", "group_size", "kept")) == want


def test_exact_classes_survive_digest_collisions(spark, docs):
    from pyspark.sql import functions as F
    path = stored(spark, docs)
    weak = exact_dedup.exact_classes(spark, path, digest=lambda t: F.unhex(F.lpad(F.hex(F.length(t) % 3), 2, "0")))
    true = exact_dedup.exact_classes(spark, path)
    columns = ["doc_id", "keep_id", "group_size", "kept"]
    assert rows_of(weak.select(columns)) == rows_of(true.select(columns))


def test_stream_continues_from_its_state(spark, docs):
    path, checkpoint = stored(spark, docs.where("doc_id < 6")), scratch_path(spark, "state")
    exact_dedup.digest_state(spark, path, checkpoint)
    docs.where("doc_id = 6").write.mode("append").parquet(path)
    state = exact_dedup.digest_state(spark, path, checkpoint)
    assert sorted(r["size"] for r in state.collect()) == [3, 3]


def test_exact_query_agrees_with_sql(spark):
    root = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{root}/documents.parquet'")
    got = queries.op4_stateful_exact_dedup(spark, root)
    want = con.sql(queries.ORACLES["op4_stateful_exact_dedup"])
    assert rows_of(got.select(want.columns)) == Counter(want.fetchall())


# simhash

def brute_fingerprint(text):
    import xxhash
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_components_against_brute_force(spark, docs):
    prints = [brute_fingerprint(r[1]) for r in ROWS]
    label = list(range(len(ROWS)))
    for _ in ROWS:
        for i in range(len(ROWS)):
            for j in range(len(ROWS)):
                if bin(prints[i] ^ prints[j]).count("1") <= 2:
                    label[i] = label[j] = min(label[i], label[j])
    lowest = {k: min((ROWS[i][0] for i in range(len(ROWS)) if label[i] == k and ROWS[i][0] is not None), default=None)
              for k in set(label)}
    want = Counter((r[0], f"{p:016x}", lowest[k]) for r, p, k in zip(ROWS, prints, label))
    assert rows_of(simhash.simhash_components(docs)) == want


def test_index_finds_every_pair_within_two_bits(spark):
    rng = np.random.default_rng(5)
    points = set()
    for base in rng.integers(0, 2 ** 63, 150).tolist():
        points.add(base)
        for _ in range(4):
            points.add(base ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 4)), replace=False)))
    points = sorted(simhash.signed(p) for p in points)
    found = simhash.links_within_two(spark.createDataFrame([(p,) for p in points], "fp long")).collect()
    got = {(min(r), max(r)) for r in found}
    mask = simhash.FULL
    assert got == {(a, b) for i, a in enumerate(points) for b in points[i + 1:]
                   if bin((a ^ b) & mask).count("1") <= 2}


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100, k) for k in range(101, 140)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 140)}}


def test_one_row_of_each_component_stays(spark, docs):
    """Against brute force, with null and repeated ids and extra columns; the smallest id stays."""
    prints = [brute_fingerprint(r[1]) for r in ROWS]
    label = list(range(len(ROWS)))
    for _ in ROWS:
        for i in range(len(ROWS)):
            for j in range(len(ROWS)):
                if bin(prints[i] ^ prints[j]).count("1") <= 2:
                    label[i] = label[j] = min(label[i], label[j])
    members = defaultdict(list)
    for i, r in zip(label, ROWS):
        members[i].append((r[0] is None, r[0] or 0, r))
    want = Counter(min(m, key=lambda x: x[:2])[2] for m in members.values())
    kept = simhash.keep_one_per_component(docs)
    assert kept.columns == docs.columns and rows_of(kept) == want


# packing

def test_packing_places_every_piece_once(spark, docs):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.tokenizer_path())
    want = Counter()
    for r in ROWS:
        ids = tok.encode(r[1] or "", add_special_tokens=False).ids + [0]
        for k, s in enumerate(range(0, len(ids), 2048)):
            piece = ids[s:s + 2048]
            want[r[0], k, s, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes())] += 1
    placed = packing.pack_documents(docs.repartition(5)).toPandas().astype(object)
    placed = placed.where(placed.notna(), None)
    got = Counter((None if i is None else int(i), *map(int, rest)) for i, *rest in
                  placed[["doc_id", "piece", "start", "length", "ids_crc32"]].values.tolist())
    got.pop((float(2 ** 60), 0), None)
    assert sum(got.values()) == sum(want.values())
    rows = rows_of(packing.pack_documents(docs.repartition(5)).select("doc_id", "piece", "start", "length", "ids_crc32"))
    assert rows == want
    for _, g in placed.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        ends = g["length"].astype(int).cumsum()
        assert g["offset"].astype(int).tolist() == [0, *ends.tolist()[:-1]] and ends.iloc[-1] <= 2048
    assert placed["sequence_id"].nunique() <= -(-placed["length"].astype(int).sum() // 2048) + 1


def test_word_encoder_equals_the_tokenizer():
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.tokenizer_path())
    odd = ["É<|endoftext|>x y", "!!., a., b,.c it's. ", "́ á, ΑΣ ΑΣ. \x1c a\x85b", "K İ, İstanbul. ǅ",
           "１２ ½, a¹.", "", ",", "x" * 5000, "a. a, a., .a"]
    got = [np.frombuffer(b, "<u4").tolist() for b in packing.word_encoder(packing.tokenizer_path())(odd)]
    assert got == [tok.encode(t, add_special_tokens=False).ids for t in odd]


def test_sequences_round_trip(spark, docs):
    unique = docs.where("doc_id <> 7 and doc_id is not null")
    placed = packing.pack_documents(unique.repartition(3))
    ids = {r["sequence_id"]: r["ids"] for r in packing.token_sequences(placed, unique).collect()}
    for r in placed.collect():
        piece = ids[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]]
        assert zlib.crc32(np.array(piece, "<u4").tobytes()) == r["ids_crc32"]


def test_best_fit_prefers_the_fullest_bin():
    lengths = [6, 5, 4, 3, 2]
    place = packing.best_fit(lengths, 10)
    loads = Counter()
    for b, n in zip(place, lengths):
        loads[b] += n
    assert sorted(loads.values()) == [10, 10]


# mixing

def test_mix_reaches_targets_and_reruns_agree(spark):
    rng = np.random.default_rng(4)
    rows = [(i, prose(i, int(rng.integers(1, 60))), None if i % 11 == 0 else "src" + str(i % 7), "q")
            for i in range(400)] + [(400, None, "src1", "q"), (401, "  ", "src1", "q"), (5, prose(5, 9), "src5", "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, words string")
    got = mixing.plan_mix(df).toPandas()
    size = {}
    for _, text, source, _ in rows:
        size[source] = size.get(source, 0) + len(WORD.findall(text or ""))
    order = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    capped = set()
    while True:
        left = sum(size.values()) - sum(3 * size[s] for s in capped)
        mass = sum(weight[s] for s in order if s not in capped)
        over = {s for s in order if s not in capped and left * weight[s] / mass > 3 * size[s]}
        if not over:
            break
        capped |= over
    target = {s: 3 * size[s] if s in capped else left * weight[s] / mass for s in order}
    assert len(got) == len(rows) and (got["taken"] <= 3 * got["size"]).all()
    assert len(set(size.values())) == len(size)
    taken, aim = got.groupby("source_size")["taken"].sum(), got.groupby("source_size")["target"].first()
    for s in order:
        assert abs(aim[size[s]] - target[s]) < 1e-6 and abs(taken[size[s]] - target[s]) <= 15
    again = mixing.plan_mix(df.repartition(9)).toPandas()
    key = ["doc_id", "size", "taken"]
    assert Counter(map(tuple, got[key].values.tolist())) == Counter(map(tuple, again[key].values.tolist()))
    copies = mixing.mixed(df)
    assert copies.columns == df.columns and copies.count() == got["copies"].sum()


# toxicity, quality, language

def labelled(spark):
    rng = np.random.default_rng(8)
    docs, labels = [], []
    for i in range(400):
        words = prose(1000 + i, 60).split()
        bad = i % 4 == 0
        if bad:
            for at in rng.choice(60, int(rng.integers(1, 9)), replace=False):
                words[at] = rng.choice(["nastyone", "vilething", "grimwort" + rng.choice(["en", "es"])])
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    labels += [(0, 1, 1), (None, 1, 1), (9999, 0, None)]
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_long_documents_are_likelier_and_fill_the_budget(spark):
    rows = [row(i, prose(i, 1 + i % 97), source="s" if i % 3 else "t") for i in range(2400)] + [row(9000, prose(1, 4000), source="s")]
    df = spark.createDataFrame(rows, SCHEMA)
    plan = mixing.plan_mix(df).toPandas()
    for _, own in plan.groupby("source_size"):
        copies = own["target"] / own["source_size"]
        whole = np.floor(copies.iloc[0] + 1e-12)
        p = own["inclusion"]
        if copies.iloc[0] > whole + 1e-9:
            assert abs((p * own["size"]).sum() - (own["target"].iloc[0] - whole * own["source_size"].iloc[0])) < 1e-6 * own["source_size"].iloc[0]
            part = own[p < 1]
            factor = part["inclusion"] / np.sqrt(part["size"])
            assert factor.max() - factor.min() < 1e-9                      # in proportion to the root of the size
            assert (own["copies"][p >= 1] == whole + 1).all()              # certain documents are taken
            extra = part["copies"] - whole
            long, short = extra[part["size"] > 70].mean(), extra[part["size"] < 25].mean()
            assert long > 1.3 * short                                      # equal odds would take both alike
    again = mixing.plan_mix(df.repartition(7)).toPandas()
    assert sorted(again[["doc_id", "taken"]].itertuples(index=False)) == sorted(plan[["doc_id", "taken"]].itertuples(index=False))


def test_mix_of_empty_table_and_ties(spark, none):
    assert not mixing.mixed(none).count()
    same = spark.createDataFrame([row(1, "one two three", source="a")] * 40 + [row(2, None, source="b")], SCHEMA)
    plan = mixing.plan_mix(same).toPandas()
    assert abs(plan[plan["size"] > 0]["taken"].sum() - plan[plan["size"] > 0]["target"].iloc[0]) <= 3


def test_toxicity_grades_held_out_documents(spark):
    docs, labels = labelled(spark)
    model = toxicity.fit(docs, labels)
    assert list(model.thresholds) == sorted(model.thresholds)
    got = {r["doc_id"]: r for r in toxicity.graded(docs, model).collect()}
    assert all(r["toxic"] == (i % 4 == 0) for i, r in got.items())
    assert all(r["toxic"] == (r["grade"] > 0) and 0 <= r["severity"] <= 3 for r in got.values())
    counts = {i: sum(w.startswith(("nasty", "vile", "grim")) for w in t.split()) for i, t in docs.collect()}
    few, many = ([r["severity"] for i, r in got.items() if counts[i] in n] for n in ((1,), (7, 8)))
    assert max(few) < min(many)
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i in got if i % 4}


def test_more_clean_labels_change_no_call(spark, monkeypatch):
    """A limit on clean labels shifts the thresholds back to the odds of all labels."""
    docs, labels = labelled(spark)
    monkeypatch.setattr(toxicity, "SAMPLE_CLEAN", 100)
    capped = toxicity.fit(docs, labels)
    monkeypatch.setattr(toxicity, "SAMPLE_CLEAN", 12_000)
    whole = toxicity.fit(docs, labels)
    calls = [{r["doc_id"] for r in toxicity.graded(docs, m).where("toxic").collect()} for m in (capped, whole)]
    assert calls[0] == calls[1] == {i for i in range(400) if i % 4 == 0}
    monkeypatch.setattr(toxicity, "SAMPLE_CLEAN", 100)
    assert toxicity.prior_shift(50, 80) == 0.0
    assert abs(toxicity.prior_shift(50, 300) - np.log(3)) < 1e-12
    assert toxicity.prior_shift(0, 5) == 0.0


def test_cumulative_link_recovers_order():
    rng = np.random.default_rng(2)
    x = rng.normal(size=4000)
    grades = np.searchsorted([-1.0, 0.5, 2.0], 2 * x + rng.logistic(size=4000))
    w, cuts = toxicity.fit_cumulative_link([{0: v} for v in x], grades, 1, 4)
    assert abs(w[0] - 2) < 0.2 and np.allclose(cuts, [-1, 0.5, 2], atol=0.2)


def test_quality_scores_held_out_documents(spark):
    docs, labels = [], []
    for i in range(300):
        good = i % 3 != 0
        text = prose(i, 80) if good else " ".join(w.upper() + "!!" for w in prose(i, 80).split())
        docs.append((i, text))
        labels.append((i, int(good), 0))
    docs += [(300, None), (301, ""), (None, "x")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    model = quality.fit(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = quality.scored(d, model).toPandas()
    assert len(got) == 303 and got["score"].between(0, 1).all()
    held = got[got.held_out & (got.doc_id < 300)]
    assert (held.predicted == (held.doc_id % 3 != 0)).mean() > 0.98
    want = [zlib.crc32(str(i).encode()) % 3 == 1 for i in range(300)]
    assert got[got.doc_id < 300].sort_values("doc_id").held_out.tolist() == want


def test_language_mixture(spark):
    kinds = {"aa": ("river", "stone", "green", "cloud"), "bb": ("fluss", "stein", "gruen", "wolke"),
             "cc": ("fleuve", "pierre", "verte", "nuage")}
    rng = np.random.default_rng(6)

    def text(k, n):
        return " ".join(rng.choice(kinds[k]) for _ in range(n))
    rows = [(i, text(k, 40), k) for i, k in enumerate(list(kinds) * 40)]
    rows += [(500, text("aa", 60) + " " + text("bb", 40), None), (501, None, "aa"), (502, "12 !!", "bb"),
             (503, text("cc", 20_000), None), (None, text("bb", 30), None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in language.predicted(d, language.fit(d)).collect()}
    assert all(got[i]["lang_pred"] == k for i, _, k in rows[:120])
    assert got[500]["lang_pred"] == "aa" and sorted(got[500]["langs"]) == ["aa", "bb"]
    assert abs(got[500]["score"] - 0.6) < 0.1
    assert got[501]["lang_pred"] == got[502]["lang_pred"] == "und" and got[501]["score"] == 0
    assert got[503]["langs"] == ["cc"] and got[None]["lang_pred"] == "bb"


# rules

def test_rules_against_brute_force(spark, docs):
    extra = spark.createDataFrame([row(20, "a b c a b c x\n\nq\nq\n q\n$$ <b> #|"), row(21, "de " * 400)], SCHEMA)
    labels = spark.createDataFrame([(i, 1, 0) for i in (7, 8, 11)], "doc_id long, quality int, toxic int")
    both = docs.unionByName(extra)
    got = rules.judged(both, rules.fit(both, labels))
    want = Counter()
    for r in both.collect():
        text = r["text"] or ""
        words = WORD.findall(text)
        seen = Counter(zip(words, words[1:], words[2:]))
        covered = {i + k for i in range(len(words) - 2) if seen[tuple(words[i:i + 3])] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        want[r["doc_id"], len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
             len(lines) - len(set(lines)), len(covered), len(words) < 50 or 100 * len(covered) > 50 * len(words)] += 1
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert rows_of(got.select(columns)) == want
    assert not got.where("base_failed and kept").count()


def test_ratio_separates_kinds_of_text(spark):
    def plain(i):
        return re.sub(r"\d", "", prose(i, 90, ("the ", "of ", "river ", "stone ", "green ", "walks ")).replace("  ", " "))
    good = [(i, plain(i)) for i in range(60)]
    junk = [(i, " ".join("$$$" + w.upper() for w in plain(i).split())) for i in range(60, 80)]
    d = spark.createDataFrame(good + junk, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(45)], "doc_id long, quality int, toxic int")
    model = rules.fit(d, labels)
    got = {r["doc_id"]: r for r in rules.judged(d, model).collect()}
    assert all(got[i]["ratio"] >= model.threshold for i, _ in good)
    assert not any(got[i]["ratio"] >= model.threshold or got[i]["kept"] for i, _ in junk)
    again = {r["doc_id"]: r["ratio"] for r in rules.judged(d.repartition(7), rules.fit(d.repartition(5), labels)).collect()}
    assert all(abs(again[i] - r["ratio"]) < 1e-12 for i, r in got.items())


# sharding

@pytest.mark.parametrize("size", [1, 2, 3, 5, 16, 17, 1000, 65537])
def test_feistel_is_a_permutation(size):
    places = sharding.permute(np.arange(size), size)
    assert sorted(places.tolist()) == list(range(size))
    assert (sharding.permute(places, size, inverse=True) == np.arange(size)).all()


def test_shards_are_even_and_reproducible(spark, docs):
    many = docs.unionByName(docs).unionByName(docs).repartition(6)
    got = sharding.shard_rows(many, shards=4).toPandas()
    assert sorted(got["number"]) == list(range(45))
    for s, g in got.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))
        assert sharding.row_number_at(int(s), 0, 45, 4) == g[g["slot"] == 0]["number"].iloc[0]
    counts = got.groupby("shard").size()
    assert counts.max() - counts.min() <= 1
    columns = ["doc_id", "size", "text_crc32", "shard", "slot"]
    assert rows_of(sharding.shard_rows(many.repartition(2), shards=4).select(columns)) == \
        rows_of(sharding.shard_rows(many, shards=4).select(columns))


def test_numbers_follow_the_order(spark, docs):
    got = numbered(docs.select("doc_id", "text"), ["doc_id", "text"]).orderBy("number").collect()
    assert [r["number"] for r in got] == list(range(len(ROWS)))
    assert [r["doc_id"] for r in got] == sorted((r[0] for r in ROWS), key=lambda i: (i is not None, i or 0))


# repeated strings

def brute_repeats(texts, length):
    seen = Counter(d[i:i + length] for d in texts for i in range(len(d) - length + 1))
    for d in texts:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        rest = np.frombuffer(d, np.uint8)[~gone].tobytes()
        yield len(d), int(gone.sum()), runs, hashlib.sha256(rest).hexdigest()


def test_repeats_against_brute_force(spark):
    rng = np.random.default_rng(3)
    texts = []
    for k in range(60):
        t = "".join(rng.choice(["de ", "abc", "xy z", "é"]) for _ in range(rng.integers(0, 60)))
        if k % 3 == 0 and texts:
            a, b = rng.integers(0, len(texts), 2)
            t = texts[a][:rng.integers(0, 200)] + t + texts[b][rng.integers(0, 40):]
        if k % 7 == 0:
            t = "de " * int(rng.integers(1, 80))
        if k % 11 == 0:
            t = "a" * int(rng.integers(1, 200))
        texts.append(t)
    rows = [(i, t, "z") for i, t in enumerate(texts)] + [(60, None, "z"), (61, "", "z"), (3, texts[3], "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, low string")
    data = [(t or "").encode() for _, t, _ in rows]
    want = Counter((r[0], *w) for r, w in zip(rows, brute_repeats(data, 80)))
    got = repeats.without_repeats(df, length=80, gram=20, with_bytes=True)
    assert rows_of(got.drop("kept")) == want
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in got.collect())


def test_anchors_of_long_texts_do_not_depend_on_parts(monkeypatch):
    data = prose(77, 3000).encode()
    whole = repeats.anchors(data)
    monkeypatch.setattr(repeats, "PART", 5000)
    parts = repeats.anchors(data)
    assert set(zip(whole[0].tolist(), whole[1].tolist())) == set(zip(parts[0].tolist(), parts[1].tolist()))
    assert sum((whole[3] - whole[2] + 1)) == sum((parts[3] - parts[2] + 1)) == len(data) - 399


# empty tables and the pipeline

def test_empty_tables(spark, none):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert not exact_dedup.keep_first(none).count()
    assert not simhash.simhash_components(none).count()
    assert not simhash.keep_one_per_component(none).count()
    assert not packing.pack_documents(none).count()
    assert not mixing.plan_mix(none).count()
    assert not toxicity.graded(none, toxicity.fit(none, labels)).count()
    assert not quality.scored(none, quality.fit(none, labels)).count()
    assert not language.predicted(none, language.fit(none)).count()
    assert not rules.judged(none, rules.fit(none, labels)).count()
    assert not sharding.shard_rows(none).count()
    assert not repeats.without_repeats(none).count()


def test_learners_without_labels_call_nothing_bad(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    n = len(ROWS)
    assert toxicity.without_toxic(docs, labels).count() == n
    assert quality.scored(docs, quality.fit(docs, labels)).where("score = 0.5").count() == n
    assert rules.judged(docs, rules.fit(docs, labels)).where("kept <> base_failed").count() == n
    scored = toxicity.graded(docs, toxicity.fit(docs, labels))
    assert {r["doc_id"] for r in scored.collect()} == {r[0] for r in ROWS}


def test_pipeline_deletes_the_tables_of_its_stages(spark):
    from pathlib import Path

    from bramble.session import drop_materialised, scratch_root
    drop_materialised(spark)
    before = set(Path(scratch_root(spark)).iterdir())
    result = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert result.count() > 0
    held = {p.name.rpartition("-")[0] for p in set(Path(scratch_root(spark)).iterdir()) - before}
    assert held == {"mixing", "bins"}      # the last stage's input and tables
    drop_materialised(spark)
    assert set(Path(scratch_root(spark)).iterdir()) <= before


def test_pipeline_stages(spark, docs, tmp_path):
    root = str(tmp_path)
    base = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    extra = docs.select(*base.columns).where("doc_id is null or doc_id > 20")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    labels.write.parquet(f"{root}/labels.parquet")
    base.unionByName(extra).write.parquet(f"{root}/documents.parquet")
    current = spark.read.parquet(f"{root}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, name)
        stage(spark, current, root).write.parquet(path)
        after = spark.read.parquet(path)
        if name != "packing":
            assert after.columns == base.columns
        if name == "exact_dedup":
            texts = [re.sub(r"\s", "", r["text"] or "") for r in after.collect()]
            assert len(set(texts)) == len(texts)
        if name == "near_dedup":
            assert 0 < after.count() <= current.count()
        current = after
    result = corpus_pipeline.run(spark, root)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert rows_of(result.select(columns)) == rows_of(current.select(columns))
    assert isinstance(result.toPandas(), pd.DataFrame)
