"""Text lines to typed records, with rejects kept apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """One row ``value`` per line, in any charset Spark decodes.

    Two-byte charsets must name their byte order (UTF-16LE). Charsets outside Spark's default set,
    such as GB2312, need ``spark.sql.legacy.javaCharsets``.
    """
    if encoding.upper().replace("-", "") == "UTF8":
        return spark.read.text(path)
    # a separator and quote that cannot occur turn the CSV reader into a charset-aware line reader;
    # the explicit line break is encoded too, which two-byte charsets need
    return spark.read.schema("value string").option("encoding", encoding).option("sep", "\u0001") \
        .option("lineSep", "\n").option("quote", "").option("ignoreLeadingWhiteSpace", False) \
        .option("ignoreTrailingWhiteSpace", False).csv(path)


def write_lines(df: DataFrame, path: str, encoding: str = "UTF-8") -> None:
    """One line per row of a single string column, in any charset Spark encodes."""
    df.write.option("encoding", encoding).option("sep", "\u0001").option("quote", "") \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def read_tokens(spark: SparkSession, path: str, pattern: str = r"\s+") -> DataFrame:
    """Lines split into an array of tokens."""
    return read_lines(spark, path).select(F.split("value", pattern).alias("tokens"))


def parse_fields(lines: DataFrame, sep: str, fields: Sequence[tuple[str, str]]) -> DataFrame:
    """Split on a literal separator into typed columns, plus ``value`` and ``is_valid``.

    A line is valid when it has exactly the expected number of fields and all of them convert.
    """
    pattern = r"\Q" + sep + r"\E"
    parts = F.split("value", pattern, -1)
    typed = lines.withColumn("_parts", parts).select(
        "value", F.size("_parts").alias("_n"),
        *[F.get("_parts", F.lit(i)).try_cast(kind).alias(name)
          for i, (name, kind) in enumerate(fields)])
    converted = F.lit(True)
    for name, _ in fields:
        converted = converted & F.col(name).isNotNull()
    return typed.withColumn("is_valid", (F.col("_n") == len(fields)) & converted).drop("_n")


def require_valid(parsed: DataFrame) -> DataFrame:
    """Fail the job on the first malformed line instead of dropping it."""
    message = F.concat(F.lit("malformed line: "), F.col("value"))
    fine = F.when(F.col("is_valid"), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return parsed.where(fine).drop("is_valid")


def parse_labelled(lines: DataFrame, sep: str) -> DataFrame:
    """``label<sep>text`` to an integer label and whitespace tokens; ``sep`` is a regular expression."""
    parts = F.split("value", sep, 2)
    return lines.select(F.get(parts, F.lit(0)).cast("int").alias("label"),
                        F.split(F.get(parts, F.lit(1)), r"\s+").alias("tokens"))


def number_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, line_no, value)`` with 1-based line numbers, counted block by block.

    Only one row per file block is ordered; the lines themselves are not gathered per file.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("_at"))
    blocks = lines.groupBy("file", "block").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return lines.join(blocks, ["file", "block"]).select(
        "file", (F.col("_before") + F.col("_at") - F.col("_first") + 1).alias("line_no"), "value")


def rejects(lines: DataFrame, allowed: Sequence[str], sep: str = r"\s+",
            value: str | Column = "value") -> DataFrame:
    """Lines whose first token is none of ``allowed``."""
    text = F.col(value) if isinstance(value, str) else value
    return lines.where(~F.coalesce(F.split(text, sep, 2)[0].isin(*allowed), F.lit(False)))
