"""Writers for tables, result sheets, article files and resume state."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from newslens.operators.lifecycle import merge_processed
from newslens.operators.ranking import number_wide
from newslens.schema import CORPUS, PROCESSING_LOG, SENTIMENT, conform


def is_committed(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` was finished and committed."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of a store that this library writes; nothing happens if it is not there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _last_id(df: DataFrame | None) -> int:
    if df is None:
        return 0
    return df.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]


def assign_ids(new: DataFrame, order: list[Column], existing: DataFrame | None = None,
               partitions: int | None = None) -> DataFrame:
    """Consecutive ids after the largest existing one, in ``order`` (K1, K2)."""
    numbered = number_wide(new.drop("id"), order, "_no", partitions)
    return numbered.withColumn("id", F.col("_no") + F.lit(_last_id(existing))).drop("_no")


def append_corpus(parsed: DataFrame, path: str, order: list[Column],
                  existing: DataFrame | None = None) -> DataFrame:
    """Append articles with new ids (K1). Returns the appended rows, with all columns of ``parsed``."""
    rows = assign_ids(parsed, order, existing)
    conform(rows, CORPUS).write.mode("append").parquet(path)
    return rows


def append_sentiment(matched: DataFrame, path: str, order: list[Column],
                     existing: DataFrame | None = None) -> DataFrame:
    """Append scores that found their article (K2). Returns the appended rows."""
    hits = matched.where(F.col("corpus_id").isNotNull())
    rows = conform(assign_ids(hits, order, existing), SENTIMENT)
    rows.write.mode("append").parquet(path)
    return rows


def append_children(rows: DataFrame, schema: StructType, path: str, order: list[Column],
                    existing: DataFrame | None = None) -> None:
    """Append images, videos or keywords of articles with new ids."""
    conform(assign_ids(rows, order, existing), schema).write.mode("append").parquet(path)


def one_file(frame: DataFrame, most: int = 100_000) -> DataFrame:
    """A report as a single file as long as it is one: larger frames keep their partitions."""
    return frame.coalesce(1) if frame.limit(most + 1).count() <= most else frame


def write_sheets(sheets: dict[str, DataFrame], folder: str, as_csv: bool = False) -> None:
    """One dataset per result sheet (K3); CSV as the portable alternative."""
    for name, frame in sheets.items():
        out = one_file(frame).write.mode("overwrite")
        out.csv(f"{folder}/{name}", header=True) if as_csv else out.parquet(f"{folder}/{name}")


def write_article_files(files: DataFrame, folder: str, as_text: bool = False) -> None:
    """Article files as a table of (file_name, value) rows (K5).

    ``as_text`` writes one text file per article, in a folder named after it.
    The table is the better form at size: a distributed store copes badly with
    very many small files.
    """
    rows = files.select("file_name", "value")
    if as_text:
        rows.write.mode("overwrite").partitionBy("file_name").text(folder, lineSep="\n")
    else:
        rows.write.mode("overwrite").parquet(folder)


def save_processed(path: str, old: DataFrame, new: DataFrame) -> None:
    """Write the union of processed URLs to a new path."""
    merge_processed(old, new).write.mode("errorifexists").parquet(path)


def append_problems(problems: DataFrame, path: str, start: datetime) -> None:
    """Append what is wrong with single files, one row each."""
    problems.select("path", "problem").withColumn("noted_at", F.lit(start)).write.mode("append").parquet(path)


def append_log(log: DataFrame, path: str, start: datetime, end: datetime) -> None:
    """Append the row of a finished job with its two clock columns."""
    timed = log.withColumns({"start_time": F.lit(start), "end_time": F.lit(end)})
    conform(timed, PROCESSING_LOG).coalesce(1).write.mode("append").parquet(path)
