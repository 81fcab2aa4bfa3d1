"""Scores, ratios, shares, probabilities and places recomputed one document at a time by other means."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

from bramble.llm import language, quality, rules, sharding, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, difference double, langs int, shares int, score int"


def sample(n, seed=1):
    rng = np.random.default_rng(seed)
    good = [f"{a}{b}" for a in ("river", "stone", "cloud", "house") for b in ("", "s", "ly", "ing")]
    bad = ["CLICK", "here!!", "win$$", "free", "now!!", "cash"]
    rows = []
    for i in range(n):
        words = good if i % 3 else bad
        rows.append((i, " ".join(rng.choice(words, int(rng.integers(60, 120)))), "en" if i % 2 else "de", "s", 0.5, 1, 2, 3))
    rows += [rows[5], rows[5], (n, None, None, None, 0.0, 0, 0, 0), (n + 1, "", "en", "s", 0.0, 0, 0, 0),
             (None, "river stone", "en", "s", 0.0, 0, 0, 0), (n + 2, "river stones " * 40_000, "en", "s", 0.0, 0, 0, 0)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(sample(240), SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(240)], "doc_id long, quality int, toxic int")


def test_compressed_size_differences(docs, labels):
    model = quality.fit(docs, labels)
    got = Counter((r["doc_id"], round(r["difference"], 9), round(r["score"], 9), r["predicted"], r["held_out"])
                  for r in quality.scored(docs, model).collect())
    want = Counter()
    packers = [zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False,
                                        write_dict_id=False, write_checksum=False) for d in (model.good, model.bad)]
    for r in sample(240):
        data, sizes = (r[1] or "").encode(), [0, 0]
        for at in range(0, len(data), quality.BLOCK):
            sizes = [s + len(p.compress(data[at:at + quality.BLOCK])) for s, p in zip(sizes, packers)]
        gap = (sizes[1] - sizes[0]) / len(data) if data else 0.0
        score = 1 / (1 + math.exp(-(model.offset + model.slope * gap)))
        fold = zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 3 == 1
        want[(r[0], round(gap, 9), round(score, 9), int(score >= 0.5), fold)] += 1
    assert got == want


def slots_by_hand(text):
    def chained(*parts):
        seed = 42
        for p in parts:
            seed = xxhash.xxh64_intdigest(p.encode(), seed)
        return (seed - (1 << 64) if seed >> 63 else seed) % rules.SLOTS

    punct = re.escape("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
    tokens = re.findall(rf"[^\x20\x09-\x0D{punct}]+|[{punct}]+", text or "")
    return [chained(t) for t in tokens] + [chained(a, b) for a, b in zip(tokens, tokens[1:])]


def test_likelihood_ratios(spark, docs, labels):
    """Slot counts of both multinomials, every document's mean log ratio and the verdicts."""
    model = rules.fit(docs, labels)
    found = rules.judged(docs, model).collect()
    raw = Counter(s for r in sample(240) for s in slots_by_hand(r[1]))
    ids = [(i,) for i in range(240) if i % 3 > 0]
    part = spark.createDataFrame(ids, "doc_id long").selectExpr("doc_id", "pmod(xxhash64(doc_id, 'part'), 3) > 0 AS counted")
    counted = {r["doc_id"] for r in part.collect() if r["counted"]}
    target = Counter(s for r in sample(240) if r[0] in counted for s in slots_by_hand(r[1]))
    totals = [sum(c.values()) + rules.SLOTS * rules.SMOOTHING for c in (raw, target)]
    logs = {s: math.log((target[s] + rules.SMOOTHING) / totals[1]) - math.log((raw[s] + rules.SMOOTHING) / totals[0]) for s in raw}
    texts = {r[0]: r[1] for r in sample(240)}
    for r in found:
        slots = slots_by_hand(texts[r["doc_id"]])
        ratio = sum(logs[s] for s in slots) / len(slots) if slots else 0.0
        assert abs(r["ratio"] - ratio) < 1e-5
        assert r["kept"] == (not r["base_failed"] and r["ratio"] >= model.threshold)
    assert len(found) == len(sample(240))


def test_all_trusted_documents_are_counted(spark):
    """More trusted documents than a fixed number: a word that only the counted two thirds hold ends above another's ratio."""
    n = 9000
    docs = spark.range(n).selectExpr("id AS doc_id", "concat('w', id % 50, ',z') AS text")
    trusted = docs.selectExpr("doc_id", "1 AS quality", "0 AS toxic")
    table = [float(v) for v in rules.fit(docs, trusted).ratios.split(",")]
    part = docs.selectExpr("doc_id", "pmod(xxhash64(doc_id, 'part'), 3) > 0 AS counted").where("counted").count()
    raw, target = 5 * n, 5 * part     # w., comma and z, and two pairs
    shift = math.log((raw + rules.SLOTS) / (target + rules.SLOTS))
    for slot in (slots_by_hand("z")[0], slots_by_hand(",")[0], slots_by_hand(",z")[2]):
        assert abs(table[slot] - math.log((part + 1) / (n + 1)) - shift) < 1e-5


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_texts_are_not_shuffled_to_the_trusted_ids(spark, monkeypatch, kind):
    """Trusted documents are found by a small table beside the texts, whatever Spark would broadcast by itself."""
    ids = [*range(-70, 200), None, 2 ** 62, 5]
    docs = spark.createDataFrame([(i, f"w{i or 0}") for i in ids], "doc_id bigint, text string") \
        .withColumn("doc_id", F.col("doc_id").cast(kind))
    good = {i for i in range(-70, 200) if i % 3} | {2 ** 62}
    labels = spark.createDataFrame([(i, int(i in good), 0) for i in ids if i is not None],
                                   "doc_id bigint, quality int, toxic int").withColumn("doc_id", F.col("doc_id").cast(kind))
    seen, keep = [], rules.tokenised
    monkeypatch.setattr(rules, "tokenised", lambda df, text: seen.append(df) or keep(df, text))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rules.fit(docs, labels)
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in seen]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(plans) == 2 and not any("SortMergeJoin" in p or "ShuffledHashJoin" in p for p in plans)
    part = {r["doc_id"]: r["p"] for r in docs.selectExpr("doc_id", "pmod(xxhash64(doc_id, 'part'), 3) > 0 AS p").collect()}
    name = (lambda i: str(i)) if kind == "string" else (lambda i: i)
    listed = [i for i in ids if i in good]
    assert sorted(r["text"] for r in seen[0].where("_trusted = 1").collect()) == sorted(f"w{i}" for i in listed if part[name(i)])
    assert sorted(r["text"] for r in seen[1].collect()) == sorted(f"w{i}" for i in listed if not part[name(i)])
    assert seen[0].count() == len(ids)


def test_tokens_are_runs_of_punctuation_or_of_other_characters(spark):
    texts = [None, "", " ", "...", "a", " a.b,,c  d! ", "\n$$x\ty-z\x0b", "«é»…ok(1)", "\u00a0a\u2003b.\x1c", "$1 \\2 $&"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in rules.tokenised(rows, "text").collect():
        assert list(r["_slots"]) == slots_by_hand(r["text"])


def test_ngrams_are_hashed_in_compiled_stages(spark):
    """Counting and scoring see the slots of every text, and no function of array elements, which Spark interprets, makes them."""
    texts = [None, "", " \t", "...", "a", "a b", " a.b,,c  d! " * 50, "$$x\ty-z\x0b\x0c", "".join(f"q{c}" for c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"),
             "«é»…ok(1)", "\u00a0a\u2003b.\x1c", "a", None]
    rows = spark.createDataFrame([(i, i % 10, t) for i, t in enumerate(texts)], "_uid long, doc_id long, text string")
    made = rules.ngrams(rules.tokenised(rows, "text"), "_uid", "doc_id")
    got, want = {}, {}
    for r in made.collect():
        got.setdefault((r["_uid"], r["doc_id"]), []).append(r["slot"])
    for i, t in enumerate(texts):
        want[i, i % 10] = sorted(slots_by_hand(t)) or [None]
    assert {k: sorted(v) if v != [None] else v for k, v in got.items()} == want
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and plan.count("Generate") == 2
    assert not made._jdf.queryExecution().toString().count("Python")


def shares_by_hand(words, cost, limit, rounds):
    """Expectation-maximisation and the penalised choice, in plain lists."""
    k, n = len(words[0]), len(words)
    scaled = [[max(v - max(w), -limit) for v in w] for w in words]

    def climb(held, start):
        share = list(start)
        for _ in range(rounds):
            new = [0.0] * len(held)
            for w in scaled:
                p = [s * math.exp(w[h]) for s, h in zip(share, held)]
                for i, v in enumerate(p):
                    new[i] += v / sum(p) / n
            share = new
        return share, sum(math.log(sum(s * math.exp(w[h]) for s, h in zip(share, held))) for w in scaled)

    alone = [sum(w[j] for w in scaled) for j in range(k)]
    penalty, best = cost + 0.5 * math.log(n), max(alone)
    single = {alone.index(best): 1.0}
    if k == 1 or -best <= penalty:
        return single
    held = list(range(k))
    share, fit = climb(held, [1 / k] * k)
    if fit - best <= penalty:
        return single
    while len(held) > 1:
        drop = share.index(min(share))
        rest, start = held[:drop] + held[drop + 1:], share[:drop] + share[drop + 1:]
        fewer, fit_fewer = climb(rest, [s / max(sum(start), 1e-12) for s in start])
        if fit - fit_fewer > penalty:
            break
        held, share, fit = rest, fewer, fit_fewer
    return {h: s / sum(share) for h, s in zip(held, share)}


def test_language_shares(spark):
    kinds = {"aa": ("river", "stone", "green", "cloud"), "bb": ("fluss", "stein", "gruen", "wolke"), "cc": ("fleuve", "pierre", "verte")}
    rng = np.random.default_rng(3)

    def text(*parts):
        return " ".join(rng.choice(kinds[k]) for k, n in parts for _ in range(n))

    rows = [(i, text((k, 20)), k, "s", 0.0, 1, 2, 3) for i, k in enumerate(list(kinds) * 30)]
    rows += [(200 + i, text(("aa", 10 + 3 * i), ("bb", 40 - 3 * i)), None, "s", 0.0, 1, 2, 3) for i in range(10)]
    rows += [(300, text(("aa", 30), ("bb", 20), ("cc", 40)), None, "s", 0.0, 1, 2, 3), (301, "12 . !", "aa", "s", 0.0, 1, 2, 3)]
    rows += [rows[-2], rows[-2]]
    df = spark.createDataFrame(rows, SCHEMA)
    model = language.fit(df)
    found = language.predicted(df, model).collect()
    assert len(found) == len(rows)
    texts = {r[0]: r[1] for r in rows}
    for r in found:
        slots, starts = language.trigrams(texts[r["doc_id"]])
        if not len(slots):
            assert r["lang_pred"] == "und" and r["score"] == 0 and not r["langs"]
            continue
        ends = [*starts[1:], len(slots)]
        words = [[float(sum(float(model.logs[j, s]) for s in slots[a:b])) for j in range(3)] for a, b in zip(starts, ends)]
        want = shares_by_hand(words, language.LANGUAGE_COST, language.WORD_LIMIT, language.ROUNDS)
        assert {n: round(s, 6) for n, s in zip(r["langs"], r["shares"])} == {model.names[h]: round(s, 6) for h, s in want.items() if s > 0}
        assert r["lang_pred"] == r["langs"][0] and r["score"] == max(r["shares"])


def test_grade_probabilities(spark):
    weights = {"vile": 2.0, "grim*": 1.5, "nasty": 0.7}
    model = toxicity.OrdinalModel(weights, (1.0, 2.5, 4.0))
    texts = [None, "", "a calm day", "vile", "Vile, vile grimmest grim nasty!", "grimly " * 5000, "vile " * 9 + "nasty"]
    rows = [(i, t, None, None, 0.0, 1, 2, 3) for i, t in enumerate(texts)] + [(4, texts[4], None, None, 0.0, 1, 2, 3)]
    found = toxicity.graded(spark.createDataFrame(rows, SCHEMA), model).collect()
    assert len(found) == len(rows)
    for r in found:
        words = [w.strip(".,!") for w in (texts[r["doc_id"]] or "").lower().split()]
        counts = {"vile": words.count("vile"), "nasty": words.count("nasty"), "grim*": sum(w.startswith("grim") and w != "grim" for w in words)}
        eta = sum(weights[f] * math.log1p(n) for f, n in counts.items())
        below = [1 / (1 + math.exp(eta - c)) for c in model.thresholds] + [1.0]
        p = [below[0]] + [b - a for a, b in zip(below, below[1:])]
        assert abs(r["severity"] - sum(k * v for k, v in enumerate(p))) < 1e-9
        assert r["toxic"] == (p[0] < 0.5) and r["grade"] == sum(b < 0.5 for b in below[:3])


def place_by_hand(number, size, seed=sharding.SEED, rounds=sharding.ROUNDS):
    full = (1 << 64) - 1

    def mix(x):
        x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & full
        x = (x ^ (x >> 27)) * 0x94D049BB133111EB & full
        return x ^ (x >> 31)

    keys = [mix((i + seed) * 0x9E3779B97F4A7C15 & full) for i in range(1, rounds + 1)]
    half = 1
    while 4 ** half < size:
        half += 1
    while True:
        left, right = number >> half, number & (1 << half) - 1
        for key in keys:
            left, right = right, left ^ (mix(right ^ key) & (1 << half) - 1)
        number = left << half | right
        if number < size:
            return number


def test_places_of_rows(docs):
    found = sharding.shard_rows(docs, shards=7).collect()
    numbers = sorted(r["number"] for r in found)
    assert numbers == list(range(len(found)))
    for r in found:
        place = place_by_hand(r["number"], len(found))
        assert (r["shard"], r["slot"]) == (place % 7, place // 7)
        assert sharding.row_number_at(r["shard"], r["slot"], len(found), shards=7) == r["number"]
