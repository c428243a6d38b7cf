"""Image and video child tables of articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from newslens import constants as K
from newslens.functions.urls import file_format, url_host
from newslens.operators.skew import lookup
from newslens.session import written


def _listed(articles: DataFrame, key: str, kind: str) -> DataFrame:
    # the outer form, since the plain one would evaluate the lists again as a filter
    return articles.select(F.col(key).alias("corpus_id"), F.explode_outer("media").alias("m")).where(
        F.col("m.kind") == kind).select("corpus_id", "m.*")


def image_format(file_name: Column) -> Column:
    """Extension of an image file; one outside the allowed set becomes NULL."""
    extension = file_format(file_name)
    return F.when(extension.isin(*K.IMAGE_FORMATS), extension)


def image_rows(articles: DataFrame, key: str = "id", folder: str = "images") -> DataFrame:
    """One row per listed image."""
    return _listed(articles, key, "image").select(
        "corpus_id", "pos", "file_name", F.concat(F.lit(f"{folder}/"), "file_name").alias("file_path"),
        "width", "height", image_format(F.col("file_name")).alias("format"))


def video_rows(articles: DataFrame, links: DataFrame | None = None, key: str = "id",
               folder: str = "videos") -> DataFrame:
    """One row per listed video; ``links`` (file_name, url) names the players.

    Articles with equal titles share file names, so one name may be frequent.
    """
    rows = _listed(articles, key, "video").select("corpus_id", "pos", "file_name")
    local = F.concat(F.lit(f"{folder}/"), "file_name")
    if links is None:
        return rows.withColumns({"video_url": local, "platform": F.lit(None).cast("string")})
    target = links.groupBy("file_name").agg(F.min("url").alias("url"))
    found = lookup(written(rows, "listed-videos"), target, "file_name")
    return found.select("corpus_id", "pos", "file_name", F.coalesce("url", local).alias("video_url"),
                        url_host(F.col("url")).alias("platform"))
