"""From pages to stored articles, images, videos and links, with one parse of each page."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newslens import constants as K
from newslens.functions.text import article_text, safe_title
from newslens.operators import lifecycle as Y, pages as P
from newslens.sources import sinks

SINKS = ("articles", "images", "videos", "links", "processed")


def article_rows(records: DataFrame, position: str) -> DataFrame:
    """Article files with the lists of kept images and of videos; of equal file names the last page's stays."""
    kept = F.filter("images", lambda m: m["verdict"] == "keep")
    files = records.select(
        position, F.concat(safe_title(F.col("title")), F.lit(".txt")).alias("file_name"),
        article_text(F.col("title"), F.col("url"), F.col("text"), kept, F.col("videos")).alias("value"))
    return Y.last_write_wins(files, position=position)


def image_rows(records: DataFrame, position: str) -> DataFrame:
    rows = P.one_each(records, [position], "images")
    return rows.where("verdict = 'keep'").drop("verdict", "is_background")


def video_rows(records: DataFrame, position: str) -> DataFrame:
    return P.one_each(records, [position], "videos")


def link_rows(records: DataFrame, position: str) -> DataFrame:
    """One link file for each player page."""
    return video_rows(records, position).where("kind = 'link'").select(
        position, "file_name", F.concat(F.lit(f"{K.VIDEO_LINK_PREFIX} "), "video_url").alias("value"))


def store_pages(spark: SparkSession, pages: DataFrame, out: str, position: str = "position") -> dict[str, DataFrame]:
    """Parse a batch of ``pages`` (position, url, title, html) once and store all that comes from it below ``out``.

    The parsed records are stored first and feed every sink. Each folder counts
    from the moment its write is committed: a job that broke down is called
    again with the same ``out`` and writes only what is missing, without
    parsing a page twice. ``processed`` (the URLs) comes last, so a batch whose
    URLs are there is whole. Another batch takes another ``out``.
    """
    def stored(name: str, rows) -> DataFrame:
        path = f"{out}/{name}"
        if not sinks.is_committed(spark, path):
            rows().write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    keep = [position, "url", "title"]
    records = stored("records", lambda: P.page_records(pages, keep))
    writers = dict(zip(SINKS, (article_rows, image_rows, video_rows, link_rows)))
    tables = {name: stored(name, lambda: make(records, position)) for name, make in writers.items()}
    tables["processed"] = stored("processed", lambda: records.select("url").distinct())
    return tables
