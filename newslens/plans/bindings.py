"""Views that give the star-schema test tables a news shape.

Each view is a plain projection or an equi-join on order keys; the SQL next to
the queries repeats the same definitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from newslens.functions.text import article_text, safe_title
from newslens.session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, *key: str) -> DataFrame:
    """A table with heavy work per row, spread over all cores when it is small."""
    return spread(table(spark, sf_dir, name), *key)


def headline(text: Column) -> Column:
    """The first line of a document."""
    return F.trim(F.substring_index(text, "\n", 1))


def article_url(id_: Column, date: Column, priority: Column) -> Column:
    new = F.concat(F.lit("http://news.example.com/a/"), F.date_format(date, "yyyyMM/dd"),
                   F.lit("/"), id_.cast("string"), F.lit(".html"))
    old = F.concat(F.lit("http://news.example.com/"), F.date_format(date, "yyyy-MM/dd"),
                   F.lit("/content_"), id_.cast("string"), F.lit(".htm"))
    return F.when(priority.isin("1-URGENT", "3-MEDIUM"), new).otherwise(old)


def dated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), "o_orderdate", "o_orderpriority", "o_orderstatus",
        F.pmod(F.floor(F.col("o_totalprice") / 1000), F.lit(4)).cast("int").alias("n_images"),
        F.pmod(F.floor(F.col("o_totalprice") / 10000), F.lit(3)).cast("int").alias("n_videos"),
    )
    docs = texts(spark, sf_dir, "documents", "doc_id").withColumnRenamed("doc_id", "id")
    # cut ahead of the join: whoever needs the title alone does not shuffle the text
    docs = docs.withColumn("title", headline(F.col("text")))
    return docs.join(orders, "id")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = dated_documents(spark, sf_dir)
    title = F.col("title")
    return d.select(
        "id", "title", F.col("text").alias("content"),
        article_url(F.col("id"), F.col("o_orderdate"), F.col("o_orderpriority")).alias("url"),
        F.col("lang").alias("source"), F.col("source").alias("media_name"),
        F.when(F.col("o_orderstatus") == "F", "text").when(F.col("o_orderstatus") == "O", "image")
        .otherwise("video").alias("content_type"),
        F.when(F.col("n_images") > 0, F.concat(F.lit("images/"), title, F.lit("_1.jpg"))).alias("image_url"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate").cast("date")).alias("publish_date"),
    )


def children(spark: SparkSession, sf_dir: str, heavy: bool = False) -> DataFrame:
    """Images (odd line numbers) and videos of articles; ``heavy`` spreads a small table."""
    read = texts if heavy else table
    line = read(spark, sf_dir, "lineitem", *(("l_orderkey", "l_linenumber") if heavy else ()))
    is_image = F.col("l_linenumber") % 2 == 1
    extension = F.when(F.col("l_returnflag") == "A", "png").when(
        F.col("l_returnflag") == "R", "jpeg").otherwise("bmp")
    stem = F.concat_ws("_", "l_orderkey", "l_linenumber")
    return line.select(
        F.col("l_orderkey").alias("corpus_id"), F.col("l_linenumber").alias("pos"),
        F.when(is_image, "image").otherwise("video").alias("kind"),
        F.when(is_image, F.concat(stem, F.lit("."), extension)).otherwise(
            F.concat(stem, F.lit("_link.txt"))).alias("file_name"),
        F.when(~is_image, F.concat(F.lit("https://player"), F.col("l_suppkey").cast("string"),
                                   F.lit(".example.com/v?src="), stem)).alias("video_url"),
        F.when(is_image, (F.col("l_quantity") * 20).cast("int")).alias("width"),
        F.when(is_image, (F.col("l_quantity") * 15).cast("int")).alias("height"),
    )


def dateline(date: Column, priority: Column) -> Column:
    """One date notation per priority; the last one is no calendar date."""
    return (
        F.when(priority == "1-URGENT", F.date_format(date, "yyyy年M月d日"))
        .when(priority == "2-HIGH", F.date_format(date, "yyyy-M-d"))
        .when(priority == "3-MEDIUM", F.date_format(date, "MM/dd/yyyy"))
        .when(priority == "4-NOT SPECIFIED", F.date_format(date, "yyyy.MM.dd"))
        .otherwise(F.concat(F.date_format(date, "yyyy"), F.lit("-02-30")))
    )


def article_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article files as (id, file_name, value): the first line is the title, the whole text the body below a date line."""
    d = dated_documents(spark, sf_dir)
    title = F.col("title")
    body = F.when(F.trim("text") != "", F.concat(
        dateline(F.col("o_orderdate"), F.col("o_orderpriority")), F.lit("\n\n"), F.col("text"))).otherwise("")
    parts = d.select(
        "id", "title", safe_title(title).alias("stem"),
        article_url(F.col("id"), F.col("o_orderdate"), F.col("o_orderpriority")).alias("url"),
        body.alias("body"), "n_images", "n_videos",
    )
    images = F.transform(F.sequence(F.lit(1), F.col("n_images") + 1), lambda i: F.struct(
        F.concat(F.col("stem"), F.lit("_"), i.cast("string"), F.lit(".jpeg")).alias("file_name"),
        (i * 160).alias("width"), (i * 120).alias("height")))
    videos = F.transform(F.sequence(F.lit(1), F.col("n_videos") + 1), lambda i: F.struct(
        F.concat(F.col("stem"), F.lit("_"), i.cast("string"), F.lit("_link.txt")).alias("file_name")))
    return parts.select(
        "id", F.concat("stem", F.lit(".txt")).alias("file_name"), "title", "url", "body",
        article_text(
            F.col("title"), F.col("url"), F.col("body"),
            F.slice(images, F.lit(1), F.col("n_images")), F.slice(videos, F.lit(1), F.col("n_videos")),
        ).alias("value"),
    )


def score_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored documents (id, compound): labelled ones, toxic ones scored twice."""
    from newslens.operators.sentiment import score_documents

    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), "toxic")
    docs = texts(spark, sf_dir, "documents", "doc_id").select(F.col("doc_id").alias("id"), "text")
    scored = score_documents(docs.join(labels, "id"), "id", "text", keep=["toxic"])
    return scored.select(
        "id", "compound", F.explode(F.sequence(F.lit(0), F.col("toxic"))).alias("pass_no"))


def sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score table rows keyed by ``corpus_id``."""
    from newslens.operators.sentiment import classify, load_form

    rows = score_rows(spark, sf_dir)
    return load_form(rows.select(
        F.col("id").alias("corpus_id"), "pass_no", classify(F.col("compound")).alias("sentiment"),
        "compound"))
