"""Divergence of the sources of a language, from count-level bitmaps (operator 13).

A language keeps the terms that enough of its documents hold. Kept terms are numbered, frequent ones
first, and cut into chunks of 64 numbers. A source is represented by one bitmap per chunk and
count level: the terms of the chunk that occur in it exactly so often. AND and popcount of two
sources' bitmaps give the joint cell of two counts; a cell's terms have the same share in both
sources, so each contributes the same difference f(a, b). Terms of count zero have no bitmap: their
cells are complements, n(0, b) = n(b) - sum of n(a, b) and so on, which turns the sum over all
kept terms into

    sum n(a, b) (f(a, b) - f(0, b) - f(a, 0) + f(0, 0))
    + sum n(b) (f(0, b) - f(0, 0)) + sum n(a) (f(a, 0) - f(0, 0)) + V f(0, 0)

with a, b > 0. A source has at most 64 levels in a chunk, so a chunk of two sources costs 4,096 ANDs
at most, and only cells that hold a term are handed on. Shares are whole numbers of parts per
billion, by decimal division, so every result is exact.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bramble.llm.common import bounded_batches, numbered, worker_store
from bramble.session import materialise

MIN_DOCS, SMOOTHING, SCALE, TOP_TERMS = 30, 5, 1_000_000_000, 50
#: partial counts that a task holds before it hands them on
HELD = 400_000
#: terms are runs of ASCII letters and of bytes of other code points, with A-Z lowered; all else separates
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
CHUNK = 64


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(LETTERS).split() if text else []


def term_counts(docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents of every term of every group.

    A null term holds a group's number of documents, so that a group without terms is there too.
    Tasks add up before they hand on; the partial sums meet in one aggregation.
    """
    bounded_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_store("terms")  # lets go of what the worker remembers for other operators
        groups: dict[tuple, tuple[Counter, Counter, list]] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for (g, s), (n, d, seen) in groups.items():
                terms = pa.concat_arrays([pa.array(list(n), pa.binary()), pa.nulls(1, pa.binary())]).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g] * len(terms), pa.string()), pa.array([s] * len(terms), pa.string()), terms,
                     pa.array([*n.values(), 0], pa.int64()), pa.array([*map(d.__getitem__, n), seen[0]], pa.int64())],
                    names=["lang", "source", "term", "n", "docs"])
            groups.clear()

        held = 0
        for batch in batches:
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            for g, s, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
                n, d, seen = groups.setdefault((g, s), (Counter(), Counter(), [0]))
                held -= len(n)
                found = terms_of(text)
                n.update(found)
                d.update(set(found))
                seen[0] += 1
                held += len(n)
                if held > HELD:
                    yield from rows()
                    held = 0
        yield from rows()

    named = docs.select(F.coalesce(F.col(lang), F.lit("")).alias("lang"), F.coalesce(F.col(source), F.lit("")).alias("source"),
                        F.col(text).alias("text"))
    return named.mapInArrow(count, "lang string, source string, term string, n long, docs long") \
        .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: str | Column, total: str, kept: str) -> Column:
    """``1 + floor(SCALE (count + SMOOTHING) / (total + SMOOTHING kept))``, exactly; null for no kept terms."""
    count = F.col(count) if isinstance(count, str) else count
    whole = (F.col(total) + SMOOTHING * F.col(kept)).cast("decimal(19,0)")
    scaled = (count + SMOOTHING).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.when(F.col(kept) > 0, 1 + F.call_function("div", scaled, whole))


def kept_terms(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang, term, total, chunk, bit`` of the kept terms; chunks of one language share no bit."""
    kept = counts.where("term is not null").groupBy("lang", "term") \
        .agg(F.sum("n").alias("total"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
    ranked = numbered(kept.select("lang", "term", "total", (-F.col("total")).alias("_rare")), ["lang", "_rare", "term"])
    return ranked.select("lang", "term", "total", F.floor(F.col("number") / CHUNK).alias("chunk"),
                         F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("number", F.lit(CHUNK)).cast("int"))
                         .alias("bit"))


def source_groups(counts: DataFrame, kept: DataFrame, held: DataFrame) -> DataFrame:
    """``lang, source, total, kept, zero, lang_total`` of every group; ``zero`` is the share of an absent term."""
    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("total").alias("lang_total"))
    totals = held.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    return counts.where("term is null").select("lang", "source").join(langs, "lang", "left") \
        .join(totals, ["lang", "source"], "left").fillna(0, ["kept", "lang_total", "total"]) \
        .withColumn("zero", share(F.lit(0), "total", "kept"))


def pair_values(bitmaps: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for all ordered pairs of groups of a language, from the bitmaps."""
    def f(a: str, b: str) -> Column:
        return F.abs(F.col(a) - F.col(b))

    sides = [bitmaps.select("lang", "chunk", F.col("source").alias(f"source{k}"), F.col("bits").alias(f"bits{k}"),
                            F.col("p").alias(f"p{k}"), F.col("zero").alias(f"zero{k}")) for k in (1, 2)]
    cells = sides[0].join(sides[1], ["lang", "chunk"]) \
        .where((F.col("source1") < F.col("source2")) & (F.col("bits1").bitwiseAND(F.col("bits2")) != 0))
    change = f("p1", "p2") - f("zero1", "p2") - f("p1", "zero2") + f("zero1", "zero2")
    joint = cells.groupBy("lang", "source1", "source2").agg(
        F.sum(F.bit_count(F.col("bits1").bitwiseAND(F.col("bits2"))) * change).alias("joint"))
    ordered = joint.unionByName(joint.select("lang", F.col("source1").alias("source2"), F.col("source2").alias("source1"),
                                             "joint"))
    pairs = groups.select("lang", F.col("source").alias("source1"), F.col("zero").alias("zero1"), "kept").join(
        groups.select("lang", F.col("source").alias("source2"), F.col("zero").alias("zero2")), "lang") \
        .where("source1 <> source2")
    levels = bitmaps.groupBy("lang", "source", "p").agg(F.sum(F.bit_count("bits")).alias("terms")) \
        .select("lang", F.col("source").alias("source2"), F.col("p").alias("p2"), "terms")
    single = pairs.join(levels, ["lang", "source2"]).groupBy("lang", "source1", "source2") \
        .agg(F.sum(F.col("terms") * (f("zero1", "p2") - f("zero1", "zero2"))).alias("single"))
    single = materialise(single, "single")
    other = single.select("lang", F.col("source1").alias("source2"), F.col("source2").alias("source1"),
                          F.col("single").alias("other"))
    found = pairs.join(ordered, ["lang", "source1", "source2"], "left").join(single, ["lang", "source1", "source2"], "left") \
        .join(other, ["lang", "source1", "source2"], "left")
    value = F.coalesce("joint", F.lit(0)) + F.coalesce("single", F.lit(0)) + F.coalesce("other", F.lit(0)) \
        + F.coalesce(F.col("kept") * f("zero1", "zero2"), F.lit(0))
    return found.select("lang", F.col("source1").alias("source"), F.col("source2").alias("item"),
                        value.cast("long").alias("value"))


def audit(docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source",
          min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``: how far the sources of a language are apart, and by which terms.

    Part ``pair`` ranks the other sources of the language by the summed difference of the shares of
    all kept terms; part ``term`` the ``top`` terms whose share in the source exceeds the
    language's most. Ties are broken by item in UTF-8 order. Null texts have no terms, null
    languages and sources are empty strings, repeated rows are documents of their own, other
    columns are ignored.
    """
    counts = materialise(term_counts(docs, text=text, lang=lang, source=source), "counts")
    kept = materialise(kept_terms(counts, min_docs), "kept")
    held = materialise(counts.where("n > 0").drop("docs").join(kept, ["lang", "term"]), "held")
    groups = materialise(source_groups(counts, kept, held), "groups")
    levels = held.groupBy("lang", "source", "chunk", "n").agg(F.bit_or("bit").alias("bits"))
    bitmaps = materialise(levels.join(F.broadcast(groups) if groups.count() <= 10_000 else groups, ["lang", "source"])
                          .select("lang", "source", "chunk", "bits", share("n", "total", "kept").alias("p"), "zero"), "bitmaps")
    pairs = pair_values(bitmaps, groups).withColumn("part", F.lit("pair"))
    spread = held.withColumnRenamed("total", "term_total") \
        .join(F.broadcast(groups) if groups.count() <= 10_000 else groups, ["lang", "source"]) \
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                (share("n", "total", "kept") - share("term_total", "lang_total", "kept")).alias("value")).where("value > 0")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [pairs.withColumn("rank", F.row_number().over(order)),
              spread.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)]
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return ranked[0].select(columns).unionByName(ranked[1].select(columns))
