"""The ranked sentiment report as text: writer (K4) and reader."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from newslens import constants as K
from newslens.functions.numbers import exact_round


def _fixed(score: Column, digits: int = 3) -> Column:
    return F.format_string(f"%.{digits}f", exact_round(score, digits))


def report_lines(ranked: DataFrame, title: str = "title") -> DataFrame:
    """Report lines as (section_no, line_no, value), in file order when sorted (U4).

    ``ranked`` has sentiment, rank_no, compound and a title. The counts in the
    headings come from one three-row aggregate.
    """
    spark = ranked.sparkSession
    labels = spark.createDataFrame(
        [(i, name, label) for i, (name, label) in enumerate(K.REPORT_SECTIONS, 1)],
        "section_no int, sentiment string, label string")
    counted = F.broadcast(labels).join(
        ranked.groupBy("sentiment").agg(F.count("*").alias("n")), "sentiment", "left").na.fill(0, ["n"])
    title_rows = spark.sql(
        f"SELECT * FROM VALUES (0, 0L, '{K.REPORT_TITLE}'), (0, 1L, '{K.REPORT_RULE}'), (0, 2L, ''),"
        f" (0, 3L, '{K.REPORT_SUMMARY}') AS t(section_no, line_no, value)")
    summary = counted.select(
        F.lit(0).alias("section_no"), (F.col("section_no") + 3).cast("long").alias("line_no"),
        F.format_string("%s: %d篇", "label", "n").alias("value"))
    total = counted.agg(F.sum("n").alias("n")).select(
        F.lit(0).alias("section_no"), F.lit(7).cast("long").alias("line_no"),
        F.format_string(f"{K.REPORT_TOTAL}: %d篇", "n").alias("value"))
    # the blank line before a heading belongs to the section above it
    gaps = counted.select((F.col("section_no") - 1).alias("section_no"),
                          F.lit(2**62).alias("line_no"), F.lit("").alias("value"))
    heads = counted.select("section_no", F.lit(0).cast("long").alias("line_no"),
                           F.format_string(f"%s{K.REPORT_LIST} (共%d篇):", "label", "n").alias("value"))
    rows = ranked.join(F.broadcast(labels), "sentiment").select(
        "section_no", F.col("rank_no").cast("long").alias("line_no"),
        F.concat(F.col("rank_no").cast("string"), F.lit(". "), F.col(title), F.lit(f" ({K.REPORT_SCORE} "),
                 _fixed(F.col("compound")), F.lit(")")).alias("value"))
    lines = title_rows
    for part in (summary, total, gaps, heads, rows):
        lines = lines.unionByName(part)
    return lines


def write_report(ranked: DataFrame, path: str, title: str = "title", partitions: int | None = None) -> None:
    """Write the report as text parts whose names sort in reading order, a byte order mark ahead of the first line."""
    first = (F.col("section_no") == 0) & (F.col("line_no") == 0)
    lines = report_lines(ranked, title).withColumn(
        "value", F.when(first, F.concat(F.lit("\ufeff"), "value")).otherwise(F.col("value")))
    keys = ["section_no", "line_no"]
    laid = lines.repartitionByRange(partitions, *keys) if partitions else lines.repartitionByRange(*keys)
    laid.sortWithinPartitions(*keys).select("value").write.mode("overwrite").text(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their place: (file_path, block, line_id, value).

    ``line_id`` grows along a file block; blocks of a file are ordered by their
    start and files by path, so a report of any size is read in parallel.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_id"),
        F.regexp_replace("value", "\\A\ufeff", "").alias("value"))


def section_of(line: Column) -> Column:
    """Class that a section heading opens, NULL on other lines."""
    found = F.lit(None).cast("string")
    for name, label in reversed(K.REPORT_SECTIONS):
        found = F.when(line.contains(label + K.REPORT_LIST), name).otherwise(found)
    return found


def parse_report(lines: DataFrame) -> DataFrame:
    """Report lines to (title, sentiment, compound, line place) rows.

    The heading is carried forward in two steps: inside one file block, and
    from block to block. The second step sees one row per block, the first one
    never more than a block.
    """
    block = ["file_path", "block"]
    marked = lines.withColumn("_head", section_of(F.col("value")))
    along = Window.partitionBy(*block).orderBy("line_id")
    filled = marked.withColumn("_section", F.last("_head", ignorenulls=True).over(along))
    # the last heading of each block, carried over the blocks that follow; place and
    # class travel as one number, since a string would turn this into a sort
    names = [name for name, _ in K.REPORT_SECTIONS]
    code = F.array_position(F.array(*map(F.lit, names)), F.col("_head"))
    ends = marked.groupBy(*block).agg(F.max(F.col("line_id") * 4 + code).alias("_last"))
    over = Window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*block, F.get(F.array(*map(F.lit, names)), (F.last(
        "_last", ignorenulls=True).over(over) % 4).cast("int") - 1).alias("_carry"))
    joined = filled.join(carried, block).withColumn("sentiment", F.coalesce("_section", "_carry"))
    listed = joined.where(F.col("_head").isNull() & F.col("sentiment").isNotNull()
                          & F.col("value").rlike(K.REPORT_LINE))
    return listed.select(
        F.trim(F.regexp_extract("value", K.REPORT_LINE, 1)).alias("title"), "sentiment",
        F.regexp_extract("value", K.REPORT_LINE, 2).cast("double").alias("compound"), *block, "line_id")


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return parse_report(read_lines(spark, path))
