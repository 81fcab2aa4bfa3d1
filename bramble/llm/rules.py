"""Quality rules and a hashed n-gram likelihood ratio, in DataFrame functions only (operator 3).

Words and pairs of neighbouring words (punctuation apart) are hashed to slots. Two multinomials over
the slots are counted: one over all documents, one over trusted documents. A document's ratio is the
mean over its n-grams of the log ratio of the two; it is kept if no rule fails and the ratio reaches
a threshold that the trusted documents' own ratios determine.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bramble.llm.common import text_of
from bramble.session import materialise

SLOTS = 1 << 14  # a power of two
#: added to every slot's count
SMOOTHING = 1.0
#: the threshold lies so many mean absolute deviations below the trusted documents' mean
DEVIATIONS = 20.0
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SYMBOLS = "#*$%&|<>"
#: classes without ranges, which Java looks up in a table
SPACES = r"[ \t\n\x0B\f\r]+"
PUNCTUATION = r"""[!"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~]+"""
#: rows up to which the table of trusted ids, 64 neighbouring ids a row, is broadcast
BROADCAST_ROWS = 1 << 20


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")  # empty ones can only be the first and the last


def base_fails() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def with_base(docs: DataFrame, text: str) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed.

    Words and windows of three of them are hashed to 64 bits. If a document's hashes are all different, so are
    its windows; only otherwise they are sorted with their positions and neighbours compared.
    """
    value = text_of(text)
    lines = F.filter(F.split(value, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    n = F.size("_words")
    window = F.transform(F.slice("_hashes", 1, n - 2), lambda h, i: F.xxhash64(
        h, F.get("_hashes", i + 1), F.get("_hashes", i + 2)))
    docs = docs.withColumn("_words", words(value)).withColumn("_lines", lines)
    docs = docs.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    docs = docs.withColumn("_windows", F.when(n >= 3, window))
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    order = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    docs = docs.withColumn("_sorted", F.when(repeats, order))
    twice = F.filter("_sorted", lambda e, k: (e["h"] == F.coalesce(F.get("_sorted", k - 1)["h"], F.bitwise_not(e["h"])))
                     | (e["h"] == F.coalesce(F.get("_sorted", k + 1)["h"], F.bitwise_not(e["h"]))))
    covered = F.array_distinct(F.flatten(F.transform(twice, lambda e: F.array(e["i"], e["i"] + 1, e["i"] + 2))))
    repeated = F.when(F.col("_sorted").isNull(), 0).otherwise(F.size(covered))
    docs = docs.withColumn("n_words", n.cast("long")) \
        .withColumn("word_chars", F.length(F.array_join("_words", "")).cast("long")) \
        .withColumn("n_symbols", (F.size(F.split(value, f"[{SYMBOLS}]")) - 1).cast("long")) \
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long")) \
        .withColumn("n_repeat_words", repeated.cast("long"))
    return docs.withColumn("base_failed", base_fails()).drop("_words", "_lines", "_hashes", "_windows", "_sorted")


def _slot(*parts: Column) -> Column:
    return F.xxhash64(*parts).bitwiseAND(F.lit(SLOTS - 1)).cast("int")


def ngram_slots(tokens: str) -> Column:
    """Slots of the tokens and of the pairs of neighbours."""
    pairs = F.when(F.size(tokens) > 1, F.transform(
        F.sequence(F.lit(0), F.size(tokens) - 2), lambda i: _slot(F.get(tokens, i), F.get(tokens, i + 1))))
    return F.concat(F.transform(tokens, lambda t: _slot(t)), F.coalesce(pairs, F.array().cast("array<int>")))


@dataclass(frozen=True)
class RatioModel:
    """Log ratio of the slots, as text of comma-separated numbers, and the threshold."""
    ratios: str
    threshold: float


def mean_ratio(slots: str, ratios: str) -> Column:
    """Mean log ratio over the n-grams; 0 for a text without any."""
    table = F.split(F.lit(ratios), ",").cast("array<double>")
    total = F.aggregate(slots, F.lit(0.0), lambda held, s: held + F.get(table, s))
    return F.when(F.size(slots) > 0, total / F.size(slots)).otherwise(0.0)


def tokenised(docs: DataFrame, text: str) -> DataFrame:
    """Adds the slots of the tokens, runs of punctuation or of other characters; splitting is faster than extracting."""
    apart = F.regexp_replace(text_of(text), PUNCTUATION, " $0 ")
    return docs.withColumn("_tokens", words(apart)).withColumn("_slots", ngram_slots("_tokens"))


def ngrams(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and ``slot`` per n-gram of ``_tokens``, with a null slot in their place for a text without any.

    The same slots as ``ngram_slots``, by generators and hashes that Spark compiles; functions of array elements it interprets.
    """
    following = F.slice("_tokens", 2, F.greatest(F.size("_tokens"), F.lit(1)))
    pairs = F.arrays_zip(F.col("_tokens").alias("a"), following.alias("b"))
    rows = docs.select(*keep, F.inline_outer(pairs).alias("_a", "_b"))
    pair = F.when(F.col("_b").isNotNull(), _slot("_a", "_b"))
    one = F.when(F.col("_a").isNotNull(), _slot("_a"))
    both = F.when(F.col("_b").isNotNull(), F.array(one, pair)).otherwise(F.array(one))
    return rows.select(*keep, F.explode(both).alias("slot"))


def _place(ids: DataFrame) -> DataFrame:
    """Adds ``_row`` and ``_bit`` of the id in the table of trusted ids; ids that are no whole numbers have a row each."""
    whole = isinstance(ids.schema["doc_id"].dataType, T.IntegralType)
    bit = "shiftleft(1L, cast(cast(doc_id as bigint) & 63 as int))" if whole else "1L"
    row = "shiftright(cast(doc_id as bigint), 6)" if whole else "doc_id"
    return ids.withColumn("_row", F.expr(row)).withColumn("_bit", F.expr(bit))


def _with_trusted(docs: DataFrame, table: DataFrame) -> DataFrame:
    """``text`` of all documents, ``_trusted`` (1 if counted, else null) and ``_own`` (whether it sets the threshold).

    The table goes to the texts while it is small; a join by id would shuffle every text.
    """
    few = F.broadcast(table) if table.count() <= BROADCAST_ROWS else table
    held = lambda c: F.coalesce(F.col(c).bitwiseAND(F.col("_bit")) != 0, F.lit(False))
    return _place(docs).join(few, "_row", "left") \
        .select("text", F.when(held("_counted"), 1).alias("_trusted"), held("_rest").alias("_own"))


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> RatioModel:
    """Slot counts over all documents and over the trusted ones (all that are labelled good and not toxic).

    Without trusted documents every ratio is 0 and every document passes; it also passes if none of
    them, of the third that sets the threshold, is long enough.
    """
    ids = labels.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("doc_id")) \
        .agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic")) \
        .where("quality = 1 and not coalesce(toxic, 0) = 1").select("doc_id")
    # two thirds are counted, the rest sets the threshold: counted documents look likelier than they are
    counted = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(3)) > 0
    same = ids.withColumn("_part", counted).withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType))
    table = _place(same).groupBy("_row").agg(F.bit_or(F.when(F.col("_part"), F.col("_bit"))).alias("_counted"),
                                             F.bit_or(F.when(~F.col("_part"), F.col("_bit"))).alias("_rest"))
    rows = _with_trusted(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")),
                         materialise(table, "trusted"))
    counts = ngrams(tokenised(rows, "text"), "_trusted").groupBy("slot").agg(F.count("*").alias("raw"), F.count("_trusted").alias("target")) \
        .where("slot is not null").collect()
    raw, target = [SMOOTHING] * SLOTS, [SMOOTHING] * SLOTS
    for r in counts:
        raw[r["slot"]] += r["raw"]
        target[r["slot"]] += r["target"]
    if not any(r["target"] for r in counts):
        return RatioModel(",".join(["0"] * SLOTS), 0.0)
    import math
    shift = math.log(sum(raw) / sum(target))
    ratios = ",".join(f"{math.log(t / r) + shift:.6g}" for t, r in zip(target, raw))
    found = tokenised(rows.where("_own"), "text").select(F.size("_slots").alias("n"), mean_ratio("_slots", ratios).alias("r"))
    own = materialise(found, "ratios").where(F.col("n") >= 2 * MIN_WORDS)
    middle = own.agg(F.avg(F.round("r", 9))).first()[0]
    if middle is None:  # nobody to set a threshold by: everything passes
        return RatioModel(ratios, -1e6)
    spread = own.agg(F.avg(F.abs(F.round("r", 9) - middle))).first()[0] or 0.0
    return RatioModel(ratios, round(middle - DEVIATIONS * spread, 6))


def judged(docs: DataFrame, model: RatioModel, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, the base columns, ``base_failed``, ``ratio`` and ``kept`` for every row."""
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rows = with_base(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text") \
        .withColumn("_uid", F.monotonically_increasing_id())
    table = docs.sparkSession.range(1).select(
        F.posexplode(F.split(F.lit(model.ratios), ",").cast("array<double>")).alias("slot", "r"))
    # a document's n-grams are all in one task, so only its sum is shuffled
    found = ngrams(tokenised(rows, "text"), "_uid", "doc_id", *base).join(F.broadcast(table), "slot", "left") \
        .groupBy("_uid", "doc_id").agg(F.coalesce(F.avg("r"), F.lit(0.0)).alias("ratio"),
                                       *[F.max(c).alias(c) for c in base]) \
        .withColumn("base_failed", base_fails()) \
        .withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= model.threshold)) \
        .select("doc_id", *base, "base_failed", "ratio", "kept")
    # written, as a filter on these columns would otherwise be evaluated below the arrays they are made of
    return materialise(found, "judged")
