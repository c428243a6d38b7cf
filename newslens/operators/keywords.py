"""Keywords per article and topics across articles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from newslens.functions.numbers import percent
from newslens.operators.ranking import top_per_group
from newslens.operators.skew import bounded_broadcast, join_around
from newslens.operators.terms import english_counts
from newslens.session import written

WIDESPREAD = 1_000  # words in more than one of so many documents are sent to every executor


def _added_up(counts: DataFrame, docs: DataFrame, key: str) -> DataFrame:
    """Word counts by row as counts by key; keys may be missing."""
    repeated = written(docs.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1").select(
        F.col(key).alias("_repeated")), "repeated-keys")
    if repeated.isEmpty():
        return counts
    repeated = bounded_broadcast(repeated)
    same = counts[key].eqNullSafe(repeated["_repeated"])
    sums = counts.join(repeated, same, "left_semi").groupBy(key, "word").agg(F.sum("frequency").alias("frequency"))
    return written(counts.join(repeated, same, "left_anti").unionByName(sums), "word-counts")


def document_keywords(docs: DataFrame, text: str = "content", key: str = "id",
                      k: int | None = None) -> DataFrame:
    """All words of every document by tf-idf, or its ``k`` best.

    ``weight = n * (ln((1 + N) / (1 + df)) + 1)``. Words are counted inside each
    row; the counts are stored, since document frequencies are a second
    aggregate over them that is joined back on the word. Only the counts of
    rows that share a key take a shuffle, to be added up. The most widespread words are answered by broadcast: most rows then
    skip the shuffle of that join, and no word gathers its rows in one task.
    Their number is at most WIDESPREAD times the mean number of distinct words
    in a document, however large the corpus.
    """
    counts = _added_up(written(english_counts(docs, text, [key]), "word-counts"), docs, key)
    frequency = written(counts.groupBy("word").agg(F.count("*").alias("df")), "word-frequency")
    n_docs = docs.agg(F.count("*")).scalar()
    widespread = frequency.where(F.col("df") * WIDESPREAD > n_docs)
    weighted = join_around(counts, frequency, widespread, "word").withColumn("weight", F.round(
        F.col("frequency") * (F.log((n_docs + 1) / (F.col("df") + 1)) + 1), 6))
    order = [F.desc("weight"), F.col("word")]
    ranked = top_per_group(weighted, [key], order, k) if k else weighted.withColumn(
        "rank_no", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.select(
        F.col(key), F.col("word").alias("keyword"), "frequency", "df", "weight", "rank_no")


def hot_topics(keywords: DataFrame, scores: DataFrame, key: str = "id", n_words: int = 5) -> DataFrame:
    """Topics named by the best keyword of each article.

    A topic lists the ``n_words`` keywords that most of its articles have; its
    heat is its size in percent of the largest topic. Every article contributes
    its own keywords, never pairs of articles, so the work grows with the
    keywords table.
    """
    topic = keywords.where("rank_no = 1").select(key, F.col("keyword").alias("topic_name"))
    mean = scores.groupBy(F.col("corpus_id").alias(key)).agg(
        F.sum("sentiment_score").alias("score_sum"), F.count("sentiment_score").alias("score_n"))
    sizes = topic.join(mean, key, "left").groupBy("topic_name").agg(
        F.count("*").alias("article_count"),
        F.when(F.sum("score_n") > 0, F.sum("score_sum").cast("double") / F.sum("score_n"))
        .alias("avg_sentiment_score"))
    words = keywords.join(topic, key).groupBy("topic_name", "keyword").agg(F.count("*").alias("n"))
    best = top_per_group(words, ["topic_name"], [F.desc("n"), F.col("keyword")], n_words)
    listed = best.groupBy("topic_name").agg(F.to_json(F.transform(
        F.array_sort(F.collect_list(F.struct("rank_no", "keyword"))), lambda x: x["keyword"]
    )).alias("topic_keywords"))
    largest = sizes.agg(F.max("article_count")).scalar()
    return sizes.join(listed, "topic_name").withColumn("_largest", largest).withColumn(
        "heat_score", percent(F.col("article_count"), F.col("_largest"), 2)).drop("_largest")


def hot_topics_by_date(keywords: DataFrame, dates: DataFrame, scores: DataFrame, k: int = 10, n_words: int = 5,
                       key: str = "id") -> DataFrame:
    """The ``k`` hottest topics of each ``stat_date``.

    ``dates`` has one (key, stat_date) per dated article. Topics are counted per
    date with partial sums before the shuffle and cut to ``k`` a date; only the
    keywords of articles whose topic survives are then counted, on narrow rows.
    Heat is a topic's size in percent of the date's largest.
    """
    topic = written(keywords.where("rank_no = 1").select(key, F.col("keyword").alias("topic_name")).join(dates, key),
                    "dated-topics")
    by = ["stat_date", "topic_name"]
    sizes = topic.groupBy(*by).agg(F.count("*").alias("article_count"))
    hot = top_per_group(sizes, ["stat_date"], [F.desc("article_count"), F.col("topic_name")], k)
    peak = F.max("article_count").over(Window.partitionBy("stat_date"))  # over k rows
    hot = written(hot.withColumn("heat_score", percent(F.col("article_count"), peak, 2)), "hot-topics")
    own = written(topic.join(hot.select(*by), by, "left_semi"), "hot-articles")
    mean = scores.join(own.select(F.col(key).alias("corpus_id")), "corpus_id", "left_semi").groupBy(
        F.col("corpus_id").alias(key)).agg(F.sum("sentiment_score").alias("score_sum"), F.count("sentiment_score").alias("score_n"))
    means = own.join(mean, key).groupBy(*by).agg(
        F.when(F.sum("score_n") > 0, F.sum("score_sum").cast("double") / F.sum("score_n")).alias("avg_sentiment_score"))
    words = keywords.join(own, key).groupBy(*by, "keyword").agg(F.count("*").alias("n"))
    best = top_per_group(words, by, [F.desc("n"), F.col("keyword")], n_words, "word_no")
    listed = best.groupBy(*by).agg(F.to_json(F.transform(
        F.array_sort(F.collect_list(F.struct("word_no", "keyword"))), lambda x: x["keyword"])).alias("topic_keywords"))
    return hot.join(listed, by).join(means, by, "left").select(
        *by, "article_count", "avg_sentiment_score", "topic_keywords", "rank_no", "heat_score")
