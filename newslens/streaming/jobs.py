"""Incremental versions: resumable intake, media counts, monthly statistics.

Each job drains what is available and stops, so it can run on a schedule. All
sinks write one partition per micro-batch (or per month) and overwrite it, so
a batch that is repeated after a failure leaves no duplicates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from newslens.functions.dates import month_of
from newslens.functions.text import header_title, header_url
from newslens.operators.lifecycle import unprocessed
from newslens.operators.rollups import (
    change_months, month_parts_table, monthly_parts, monthly_statistics, replace_months, statistics_of,
)
from newslens.sources.articles import plain_name
from newslens.sources.keyed_table import KeyedTable
from newslens.sources.sinks import remove_folder


def stream_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Stream over the Parquet files of a folder whose names match ``name``, or that lie in a folder of such a name."""
    path = f"{folder}/{name}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    matches = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    if any(m.isDirectory() for m in matches or []):
        return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    schema = spark.read.option("pathGlobFilter", name).parquet(folder).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)


def _drain(writer, checkpoint: str) -> None:
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def _batch_table(spark: SparkSession, schema, path: str) -> DataFrame:
    """The sink table, created empty on first use."""
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as missing:  # a path that does not exist yet
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        spark.createDataFrame([], schema).write.parquet(path)
        return spark.read.schema(schema).parquet(path)


def ingest(rows: DataFrame, out: str, checkpoint: str, position: str = "position") -> DataFrame:
    """Store each URL once, across batches, runs and restarts (ST1).

    ``rows`` is a stream with title, url and a position. The stored table is
    the resume state: a new batch is anti-joined to the URLs of the others, so
    no state store has to hold every URL that was ever seen.
    """
    spark = rows.sparkSession
    schema = rows.schema.add("batch_no", "long")

    def step(batch: DataFrame, batch_no: int) -> None:
        stored = _batch_table(spark, schema, out).where(F.col("batch_no") != batch_no)
        fresh = unprocessed(batch, stored, position).withColumn("batch_no", F.lit(batch_no).cast("long"))
        fresh.select(*schema.names).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("batch_no").parquet(out)

    _drain(rows.writeStream.foreachBatch(step), checkpoint)
    return _batch_table(spark, schema, out).drop("batch_no")


def counts_table(spark: SparkSession, out: str) -> KeyedTable:
    schema = spark.createDataFrame([], "corpus_id long, image_count long, video_count long").schema
    return KeyedTable(spark, f"{out}/counts", schema, ["corpus_id"])


def _log(spark: SparkSession, out: str, after: int) -> DataFrame:
    """Changes that the counts do not hold yet."""
    schema = counts_table(spark, out).schema
    return _batch_table(spark, StructType([*schema, StructField("batch_no", LongType())]), f"{out}/log").where(
        F.col("batch_no") > after)


def current_counts(spark: SparkSession, out: str) -> DataFrame:
    """Counts as of now: the compacted table plus the tail of the log, each key's sum."""
    table = counts_table(spark, out)
    tail = _log(spark, out, table.snapshot().upto).drop("batch_no")
    return table.read().unionByName(tail).groupBy("corpus_id").agg(
        F.sum("image_count").alias("image_count"), F.sum("video_count").alias("video_count"))


def child_counts(children: DataFrame, out: str, checkpoint: str, every: int = 10) -> DataFrame:
    """Current image and video counts per article (ST2).

    Every micro-batch appends the changes it brings to a log, summed per
    article; no state is kept beside it. After ``every`` batches the log is
    added to a keyed table, which rewrites the buckets of the articles it
    names, and then dropped. So a read adds up at most ``every`` batches, and
    the number of files does not grow with the number of batches. The table
    knows the last batch it holds: a batch that is repeated is counted once.
    """
    spark = children.sparkSession
    table = counts_table(spark, out)

    def step(batch: DataFrame, batch_no: int) -> None:
        held = table.snapshot().upto
        if batch_no <= held:
            return
        counts = batch.groupBy("corpus_id").agg(
            F.count_if(F.col("kind") == "image").alias("image_count"),
            F.count_if(F.col("kind") == "video").alias("video_count"))
        counts.write.mode("overwrite").parquet(f"{out}/log/batch_no={batch_no}")
        if batch_no - held >= every:
            compact_counts(spark, out, batch_no)

    _drain(children.writeStream.foreachBatch(step), checkpoint)
    return current_counts(spark, out)


def compact_counts(spark: SparkSession, out: str, upto: int) -> None:
    """Add the log up to batch ``upto`` to the table and drop what it then holds."""
    table = counts_table(spark, out)
    held = table.snapshot().upto
    tail = _log(spark, out, held).where(F.col("batch_no") <= upto)
    table.add_up(tail.groupBy("corpus_id").agg(
        F.sum("image_count").alias("image_count"), F.sum("video_count").alias("video_count")), upto)
    for batch_no in range(held + 1, upto + 1):
        remove_folder(spark, f"{out}/log/batch_no={batch_no}")


def refresh_months(arrivals: DataFrame, corpus: DataFrame, scores: DataFrame, out: str,
                   checkpoint: str) -> DataFrame:
    """Recompute the months that new articles belong to (ST3).

    ``arrivals`` is a stream with publish_date; ``corpus`` and ``scores`` are
    the tables at rest. Untouched months keep their partitions.
    """
    spark = arrivals.sparkSession

    def step(batch: DataFrame, batch_no: int) -> None:
        published = F.col("publish_date")
        dated = batch.where(published.isNotNull())
        first, last = dated.agg(F.min(F.trunc(published, "month")), F.max(F.last_day(published))).first()
        if first is None:
            return
        touched = dated.select(month_of(published).alias("_month")).distinct()
        # the range of dates reaches the scan, the months inside it are then chosen exactly
        chosen = corpus.where(published.between(F.lit(first), F.lit(last))).withColumn(
            "_month", month_of(published)).join(touched, "_month", "left_semi").drop("_month")
        own = scores.join(chosen.select(F.col("id").alias("corpus_id")), "corpus_id", "left_semi")
        replace_months(monthly_statistics(chosen, own), out)

    _drain(arrivals.writeStream.foreachBatch(step), checkpoint)
    return spark.read.parquet(out)


def accumulate_months(arrivals: DataFrame, corpus: DataFrame, scores: DataFrame, out: str,
                      checkpoint: str) -> DataFrame:
    """Add new articles to the sums of their months (ST3).

    ``arrivals`` is a stream with the id of each new article, once. A batch
    reads the articles and scores of its ids and adds their sums to the months
    and sources they belong to; nothing that is there is computed again. A
    batch that is repeated is added once.
    """
    spark = arrivals.sparkSession
    table = month_parts_table(spark, out)

    def step(batch: DataFrame, batch_no: int) -> None:
        if batch_no <= table.snapshot().upto:
            return
        ids = batch.select("id").distinct()
        new = corpus.join(ids, "id", "left_semi").where(F.col("publish_date").isNotNull())
        own = scores.join(ids.withColumnRenamed("id", "corpus_id"), "corpus_id", "left_semi")
        change_months(table, monthly_parts(new, own), None, batch_no)

    _drain(arrivals.writeStream.foreachBatch(step), checkpoint)
    return statistics_of(table.read())


def stream_articles(spark: SparkSession, folder: str, sep: str | None = None, per_batch: int | None = None) -> DataFrame:
    """Stream over a folder of article texts: (path, modified, title, url, value).

    A file is one article or, with ``sep``, a bundle of articles that ``sep`` parts: many small files
    make listing them the dearest step.
    """
    reader = spark.readStream.option("pathGlobFilter", "*.txt")
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    files = reader.text(folder, wholetext=sep is None, lineSep=sep).select(
        plain_name(F.col("_metadata.file_path")).alias("path"), F.col("_metadata.file_modification_time").alias("modified"),
        F.replace(F.replace("value", F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n")).alias("value"))
    return files.select("path", "modified", header_title(F.col("value"), F.substring_index("path", "/", -1)).alias("title"),
                        header_url(F.col("value")).alias("url"), "value")


def ingest_texts(articles: DataFrame, out: str, checkpoint: str, keep_for: str = "30 days") -> DataFrame:
    """Store every URL of a stream of article texts once, over batches and restarts (ST1).

    The state store holds one entry per URL, in RocksDB where the session says
    so, and forgets it ``keep_for`` after the newest file seen; a URL that
    comes again later counts as new. Texts without a URL are left out. The file
    sink commits a batch once, however often it is repeated.
    """
    spark = articles.sparkSession
    fresh = articles.where("url <> ''").withWatermark("modified", keep_for).dropDuplicatesWithinWatermark(["url"])
    _drain(fresh.writeStream.format("parquet").outputMode("append").option("path", out), checkpoint)
    return spark.read.schema(articles.schema).parquet(out)
