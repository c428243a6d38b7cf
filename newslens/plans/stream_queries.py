"""Incremental jobs, drained over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from newslens.operators.rollups import change_months, month_parts_table, monthly_parts, statistics_of
from newslens.plans import bindings as B, oracles as O, rollup_queries as R
from newslens.session import fresh_path, written
from newslens.streaming import jobs

SEP = "\x1e"


def stream_ingest(spark, sf_dir):
    """Every site folder of the pages table once."""
    pages = jobs.stream_table(spark, sf_dir, "pages.parquet")
    rows = pages.select(
        F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1).alias("title"),
        F.regexp_extract("url", r"^(https?://[^/]+/[^/]+)", 1).alias("url"), F.col("page_id").alias("position"))
    return jobs.ingest(rows, fresh_path(spark, "ingest"), fresh_path(spark, "ingest-state")).select(
        "position", "title", "url")


def stream_child_counts(spark, sf_dir):
    lines = jobs.stream_table(spark, sf_dir, "lineitem.parquet")
    children = lines.select(F.col("l_orderkey").alias("corpus_id"), F.when(
        F.col("l_linenumber") % 2 == 1, "image").otherwise("video").alias("kind"))
    return jobs.child_counts(children, fresh_path(spark, "counts"), fresh_path(spark, "counts-state"))


def _article_bundles(spark, sf_dir, folder):
    """Article files in three rounds of bundles: a third each, then some of the articles again, unchanged."""
    files = B.article_files(spark, sf_dir).select("id", "value")
    rounds = [files.where("id % 3 = 0"), files.where("id % 3 = 1 or id % 6 = 0"), files.where("id % 3 = 2 or id % 5 = 0")]
    for n, part in enumerate(rounds):
        yield n, part.select(F.col("value")).write.mode("overwrite").option("lineSep", SEP)


def stream_texts(spark, sf_dir):
    """Three rounds of article texts with repeats, drained one after the other by a job that starts anew each time."""
    folder, out, state = (fresh_path(spark, f"texts-{x}") for x in ("in", "out", "state"))
    for n, writer in _article_bundles(spark, sf_dir, folder):
        writer.text(f"{folder}/round={n}")
        stored = jobs.ingest_texts(jobs.stream_articles(spark, f"{folder}/*", SEP), out, state)
    return stored.select("title", "url", F.md5("value").alias("text_md5"))


def stream_month_parts(spark, sf_dir):
    """All articles arrive; a third is taken back, and comes again with the months as they then are."""
    corpus, scores = R.counted_corpus(spark, sf_dir), B.sentiment(spark, sf_dir)
    corpus, scores = written(corpus, "parts-corpus"), written(scores, "parts-scores")
    path = fresh_path(spark, "month-parts")
    arrivals = jobs.stream_table(spark, sf_dir, "documents.parquet").select(F.col("doc_id").alias("id"))
    jobs.accumulate_months(arrivals, corpus, scores, path, fresh_path(spark, "month-parts-state"))
    table = month_parts_table(spark, path)
    some = corpus.where("id % 3 = 0 and publish_date is not null")
    parts = monthly_parts(some, scores.where("corpus_id % 3 = 0"))
    change_months(table, None, parts)
    change_months(table, parts, None)
    stored = statistics_of(table.read())
    return stored.withColumns({"stat_date": F.col("stat_date").cast("string")})


def stream_months(spark, sf_dir):
    docs = jobs.stream_table(spark, sf_dir, "documents.parquet")
    dates = B.table(spark, sf_dir, "orders").where("o_orderpriority <> '5-LOW'").select(
        F.col("o_orderkey").alias("doc_id"), F.col("o_orderdate").cast("date").alias("publish_date"))
    arrivals = docs.select("doc_id").join(dates, "doc_id")
    stored = jobs.refresh_months(
        arrivals, R.counted_corpus(spark, sf_dir), B.sentiment(spark, sf_dir),
        fresh_path(spark, "stream-months"), fresh_path(spark, "stream-months-state"))
    return stored.withColumns({"stat_date": F.col("stat_date").cast("string"),
                               "stat_month": F.col("stat_month").cast("string")})


_INGEST = r"""SELECT position, title, url FROM (SELECT page_id AS position, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS title,
regexp_extract(url, '^(https?://[^/]+/[^/]+)', 1) AS url FROM pages)
QUALIFY row_number() OVER (PARTITION BY url ORDER BY position) = 1"""

QUERIES = {
    "stream_ingest": (stream_ingest, _INGEST),
    "stream_child_counts": (stream_child_counts, """SELECT l_orderkey AS corpus_id, count(*) FILTER (l_linenumber % 2 = 1) AS image_count,
count(*) FILTER (l_linenumber % 2 = 0) AS video_count FROM lineitem GROUP BY 1"""),
    "stream_texts": (stream_texts, O.with_(O.DOCS, O.FILES, final="SELECT title, url, md5(value) AS text_md5 FROM files")),
    "stream_months": (stream_months, R.QUERIES["monthly_rollup"][1]),
    "stream_month_parts": (stream_month_parts, R.QUERIES["monthly_rollup"][1]),
}
