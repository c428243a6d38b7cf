"""Load reports and data-quality counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newslens.functions.numbers import percent
from newslens.functions.text import shown
from newslens.operators.rollups import per_article


def counters(corpus: DataFrame, scores: DataFrame) -> DataFrame:
    """One row with all counters; each table is scanned once."""
    filled = F.col("content").isNotNull() & (F.col("content") != "")
    articles = corpus.agg(
        F.count("*").alias("n_articles"),
        F.count_if(filled).alias("n_with_content"),
        F.count_if(F.col("publish_date").isNotNull()).alias("n_with_date"),
        F.count_if(F.col("image_url").isNotNull()).alias("n_with_image"),
        F.count_if(F.coalesce("title", F.lit("")) == "").alias("n_blank_title"),
    )
    return articles.withColumn("n_scores", scores.agg(F.count("*")).scalar())


def articles_by_source(corpus: DataFrame) -> DataFrame:
    return corpus.groupBy("source").agg(F.count("*").alias("n"))


def score_by_sentiment(scores: DataFrame) -> DataFrame:
    """Count and mean score per class without the NULL class, largest first."""
    return (
        scores.where(F.col("sentiment").isNotNull()).groupBy("sentiment")
        .agg(F.count("*").alias("n"),
             (F.sum("sentiment_score").cast("double") / F.count("sentiment_score")).alias("avg_score"))
        .orderBy(F.desc("n"), "sentiment")
    )


def coverage(corpus: DataFrame, scores: DataFrame) -> DataFrame:
    """Joined rows with and without a score (A5).

    Scores are counted per article before the join; an article with two scores
    still counts twice, as in the plain left join, and ``n_distinct_articles``
    counts it once.
    """
    joined = corpus.select("id").join(per_article(scores), "id", "left")
    total = F.sum(F.coalesce("n_scores", F.lit(1)))
    scored = F.coalesce(F.sum("n_scores"), F.lit(0))
    return joined.agg(
        F.coalesce(total, F.lit(0)).alias("total_corpus"), scored.alias("with_sentiment"),
        F.count("*").alias("n_distinct_articles"),
    ).select(
        "total_corpus", "with_sentiment",
        (F.col("total_corpus") - F.col("with_sentiment")).alias("without_sentiment"),
        percent(F.col("with_sentiment"), F.col("total_corpus"), 1).alias("coverage_pct"),
        "n_distinct_articles",
    )


def duplicate_titles(corpus: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most repeated titles."""
    return (corpus.groupBy("title").agg(F.count("*").alias("n")).where("n > 1")
            .orderBy(F.desc("n"), "title").limit(k))


def latest(corpus: DataFrame, k: int = 10, width: int = 50, placeholder: str = "无日期") -> DataFrame:
    """The ``k`` newest articles as a report shows them."""
    return corpus.orderBy(F.desc("id")).limit(k).select(
        "id", "source", shown(F.col("title"), width).alias("title"),
        F.coalesce(F.col("publish_date").cast("string"), F.lit(placeholder)).alias("published"),
    )


def sample(corpus: DataFrame, scores: DataFrame, max_id: int = 3) -> DataFrame:
    """The first articles with their scores (F9, J1); the id range reaches both scans."""
    few = corpus.where(F.col("id") <= max_id)
    theirs = scores.where(F.col("corpus_id") <= max_id)
    return few.join(theirs, few["id"] == theirs["corpus_id"], "left").select(
        "id", "title", "source", "content_type", "sentiment", "sentiment_score",
        F.length(F.coalesce("content", F.lit(""))).alias("content_length"),
    )
