"""URL intake, resume state, retention and overwrite rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newslens import constants as K
from newslens.functions.dates import date_from_url
from newslens.operators.ranking import first_per_group


def valid_urls(sheet: DataFrame) -> DataFrame:
    """Rows with a title and an http(s) URL."""
    return sheet.na.drop("all").na.drop("any", subset=["title", "url"]).where(
        F.col("url").startswith("http"))


def unprocessed(sheet: DataFrame, processed: DataFrame, position: str = "position") -> DataFrame:
    """Valid rows whose URL is new, first occurrence only.

    A URL repeated in the sheet counts as processed after its first row.
    """
    fresh = first_per_group(valid_urls(sheet), ["url"], [F.col(position)])
    return fresh.join(processed.select("url").distinct(), "url", "left_anti")


def merge_processed(old: DataFrame, new: DataFrame) -> DataFrame:
    """Set union of processed URLs."""
    return old.select("url").unionByName(new.select("url")).distinct()


def retention_split(articles: DataFrame, first_year: int = K.RETENTION_FIRST_YEAR,
                    url: str = "url", extended: bool = False) -> tuple[DataFrame, DataFrame]:
    """(keep, purge) by the year in the URL; articles without a date stay."""
    dated = articles.withColumn("url_date", date_from_url(F.col(url), extended))
    old = F.coalesce(F.year("url_date") < first_year, F.lit(False))
    return dated.where(~old), dated.where(old)


def cascade(children: DataFrame, gone: DataFrame, child_key: str = "corpus_id",
            parent_key: str = "id") -> tuple[DataFrame, DataFrame]:
    """(keep, delete) of child rows when parents are deleted.

    ``gone`` is reduced to distinct keys; a parent with very many children is
    split by the adaptive skew join, which may divide the child side here.
    """
    keys = gone.select(F.col(parent_key).alias(child_key)).distinct()
    return children.join(keys, child_key, "left_anti"), children.join(keys, child_key, "left_semi")


def marked(children: DataFrame, gone: DataFrame, child_key: str = "corpus_id", parent_key: str = "id") -> DataFrame:
    """Child rows with ``is_gone``, whether their parent is deleted (J7): both parts of ``cascade`` in one join.

    Only the keys of deleted parents are hashed in memory; child rows, which
    are many more, stream by without a sort.
    """
    keys = gone.select(F.col(parent_key).alias(child_key)).distinct().withColumn("is_gone", F.lit(True))
    return children.join(keys.hint("shuffle_hash"), child_key, "left").withColumn(
        "is_gone", F.coalesce("is_gone", F.lit(False)))


def last_write_wins(files: DataFrame, name: str = "file_name", position: str = "position") -> DataFrame:
    """One row per file name, the one written last."""
    return first_per_group(files, [name], [F.desc(position)])
