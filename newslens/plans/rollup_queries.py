"""Views, monthly statistics, quality reports and declared rollups."""

from __future__ import annotations

from pyspark.sql import functions as F

from newslens import schema
from newslens.functions.dates import date_from_text
from newslens.functions.text import content_by_rules
from newslens.operators import quality as Q, rollups as R
from newslens.operators.terms import english_tokens
from newslens.plans import bindings as B, oracles as O
from newslens.session import fresh_path, written

MONTH = "1997-03"
LANGS = ("en", "fr", "de")


def counted_corpus(spark, sf_dir):
    return R.child_counts(B.corpus(spark, sf_dir), B.children(spark, sf_dir))


def _text_dates(df, *names):
    return df.withColumns({n: F.col(n).cast("string") for n in names})


def corpus_statistics(spark, sf_dir):
    return R.corpus_statistics(B.corpus(spark, sf_dir))


def sentiment_statistics(spark, sf_dir):
    return R.sentiment_statistics(B.corpus(spark, sf_dir), B.sentiment(spark, sf_dir))


def sentiment_overview(spark, sf_dir):
    return R.sentiment_overview(B.corpus(spark, sf_dir), B.sentiment(spark, sf_dir))


def content_type_stats(spark, sf_dir):
    return R.content_type_stats(counted_corpus(spark, sf_dir))


def monthly_rollup(spark, sf_dir):
    return _text_dates(R.monthly_statistics(counted_corpus(spark, sf_dir), B.sentiment(spark, sf_dir)), "stat_date")


def monthly_rollup_one_month(spark, sf_dir):
    return _text_dates(R.monthly_statistics(
        counted_corpus(spark, sf_dir), B.sentiment(spark, sf_dir), MONTH), "stat_date")


def monthly_replace(spark, sf_dir):
    """Load every month, then replace one; all others must survive."""
    corpus, scores = counted_corpus(spark, sf_dir), B.sentiment(spark, sf_dir)
    path = fresh_path(spark, "months")
    R.replace_months(R.monthly_statistics(corpus, scores), path)
    R.update_month(corpus, scores, MONTH, path)
    stored = spark.read.parquet(path)
    return _text_dates(stored.withColumn("stat_month", F.col("stat_month").cast("string")), "stat_date")


def child_counts(spark, sf_dir):
    return counted_corpus(spark, sf_dir).select("id", "image_count", "video_count")


def monthly_sentiment(spark, sf_dir):
    return R.monthly_sentiment(B.corpus(spark, sf_dir), B.sentiment(spark, sf_dir))


def quality_counters(spark, sf_dir):
    return Q.counters(B.corpus(spark, sf_dir), B.sentiment(spark, sf_dir))


def articles_by_source(spark, sf_dir):
    return Q.articles_by_source(B.corpus(spark, sf_dir))


def score_by_sentiment(spark, sf_dir):
    return Q.score_by_sentiment(B.sentiment(spark, sf_dir))


def coverage(spark, sf_dir):
    return Q.coverage(B.corpus(spark, sf_dir), B.sentiment(spark, sf_dir))


def duplicate_titles(spark, sf_dir):
    return Q.duplicate_titles(B.corpus(spark, sf_dir))


def latest_articles(spark, sf_dir):
    return Q.latest(B.corpus(spark, sf_dir))


def sample_articles(spark, sf_dir):
    rows = Q.sample(B.corpus(spark, sf_dir), B.sentiment(spark, sf_dir))
    return rows.withColumn("sentiment_score", F.col("sentiment_score").cast("double"))


def constraint_violations(spark, sf_dir):
    corpus, children = B.corpus(spark, sf_dir), B.children(spark, sf_dir)
    broken = schema.violations(corpus, schema.corpus_rules(LANGS)).groupBy("rule").agg(F.count("*").alias("n"))
    lost = schema.orphans(children, corpus, "corpus_id").agg(
        F.lit("child_without_article").alias("rule"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n"))
    twice = schema.duplicate_keys(corpus, ["title", "source"]).agg(
        F.lit("title_source_repeated").alias("rule"), F.count("*").alias("n"))
    return broken.unionByName(lost).unionByName(twice)


def daily_statistics(spark, sf_dir):
    return _text_dates(R.daily_statistics(B.corpus(spark, sf_dir), B.sentiment(spark, sf_dir)), "stat_date")


def hot_keywords(spark, sf_dir):
    dated = B.corpus(spark, sf_dir).where("publish_date is not null").withColumnRenamed("publish_date", "stat_date")
    tokens = english_tokens(dated, "content", ["source", "stat_date"], counted=True)
    return _text_dates(R.hot_keywords(tokens), "stat_date")


def keyword_heat(spark, sf_dir):
    """Heat of every keyword, summed up per date and source."""
    dated = B.corpus(spark, sf_dir).where("publish_date is not null").select(
        "content", "source", F.trunc("publish_date", "year").alias("stat_date"))
    rows = R.hot_keywords(english_tokens(dated, "content", ["source", "stat_date"]))
    return _text_dates(rows.groupBy("stat_date", "source").agg(
        F.count("*").alias("n_keywords"), F.sum("n").alias("n_words"),
        F.count_if(F.col("heat_score") >= 10).alias("n_hot")), "stat_date")


def media_activity(spark, sf_dir):
    return R.media_activity(B.corpus(spark, sf_dir))


def processing_log(spark, sf_dir):
    """Articles whose text yields a valid date count as processed; the log names the first of the others."""
    files = B.article_files(spark, sf_dir)
    found = date_from_text(content_by_rules(F.col("value")))
    status = written(files.select(
        F.col("id").cast("string").alias("path"), F.when(found.isNotNull(), "success").otherwise("failed").alias("status"),
        F.when(found.isNull(), "no date").alias("problem")), "file-status")
    return R.processing_log(R.load_counters(status), "crawl", R.error_message(status))


_C = (O.DOCS, O.CORPUS)
_CS = (O.DOCS, O.CORPUS, O.SENTIMENT)
_J = (*_CS, O.JOINED.format("corpus"))
_K = (*_C, O.CHILDREN, O.COUNTED)
_KJ = (*_CS, O.CHILDREN, O.COUNTED, O.JOINED.format("counted"))
_MONTHLY = f"""SELECT last_day(min(publish_date))::VARCHAR AS stat_date, strftime(publish_date, '%Y-%m') AS stat_month, source,
count(*) AS total_articles, count(*) FILTER (content_type = 'text') AS text_articles,
count(*) FILTER (image_count > 0) AS image_articles, count(*) FILTER (video_count > 0) AS video_articles,
{O.classes('articles')}, {O.MEAN} AS avg_sentiment_score,
sum(image_count)::BIGINT AS total_images, sum(video_count)::BIGINT AS total_videos
FROM joined WHERE publish_date IS NOT NULL {{0}} GROUP BY strftime(publish_date, '%Y-%m'), source"""

QUERIES = {
    "corpus_statistics": (corpus_statistics, O.with_(*_C, final="""SELECT source, content_type,
strftime(publish_date, '%Y-%m') AS month, count(*) AS n FROM corpus GROUP BY 1, 2, 3""")),
    "sentiment_statistics": (sentiment_statistics, O.with_(*_J, final=f"""SELECT source, sentiment, count(*) AS n,
{O.MEAN} AS avg_score FROM joined GROUP BY 1, 2""")),
    "sentiment_overview": (sentiment_overview, O.with_(*_J, final=f"""SELECT *, {O.pct('positive_count', 'total_articles', 2)} AS positive_rate
FROM (SELECT strftime(publish_date, '%Y-%m') AS month, source, count(*) AS total_articles, {O.classes('count')},
{O.MEAN} AS avg_sentiment_score FROM joined WHERE publish_date IS NOT NULL GROUP BY 1, 2)""")),
    "content_type_stats": (content_type_stats, O.with_(*_K, final="""SELECT strftime(publish_date, '%Y-%m') AS month, content_type, source,
count(*) AS n, avg(image_count) AS avg_images, avg(video_count) AS avg_videos, count(DISTINCT media_name) AS media_count
FROM counted WHERE publish_date IS NOT NULL GROUP BY 1, 2, 3""")),
    "monthly_rollup": (monthly_rollup, O.with_(*_KJ, final=_MONTHLY.format(""))),
    "monthly_rollup_one_month": (monthly_rollup_one_month, O.with_(*_KJ, final=_MONTHLY.format(
        f"AND strftime(publish_date, '%Y-%m') = '{MONTH}'"))),
    "monthly_replace": (monthly_replace, O.with_(*_KJ, final=_MONTHLY.format(""))),
    "child_counts": (child_counts, O.with_(*_K, final="SELECT id, image_count, video_count FROM counted")),
    "monthly_sentiment": (monthly_sentiment, O.with_(*_J, final="""SELECT strftime(publish_date, '%Y-%m') AS month, sentiment,
count(*) AS n FROM joined WHERE corpus_id IS NOT NULL GROUP BY 1, 2""")),
    "quality_counters": (quality_counters, O.with_(*_CS, final="""SELECT count(*) AS n_articles,
count(*) FILTER (content <> '') AS n_with_content, count(publish_date) AS n_with_date, count(image_url) AS n_with_image,
count(*) FILTER (coalesce(title, '') = '') AS n_blank_title, (SELECT count(*) FROM sentiment) AS n_scores FROM corpus""")),
    "articles_by_source": (articles_by_source, O.with_(*_C, final="SELECT source, count(*) AS n FROM corpus GROUP BY 1")),
    "score_by_sentiment": (score_by_sentiment, O.with_(O.SENTIMENT, final=f"""SELECT sentiment, count(*) AS n, {O.MEAN} AS avg_score
FROM sentiment GROUP BY 1""")),
    "coverage": (coverage, O.with_(*_J, final=f"""SELECT *, total_corpus - with_sentiment AS without_sentiment,
{O.pct('with_sentiment', 'total_corpus', 1)} AS coverage_pct FROM (SELECT count(*) AS total_corpus, count(corpus_id) AS with_sentiment,
count(DISTINCT id) AS n_distinct_articles FROM joined)""")),
    "duplicate_titles": (duplicate_titles, O.with_(*_C, final="""SELECT title, count(*) AS n FROM corpus GROUP BY 1
HAVING count(*) > 1 ORDER BY n DESC, title LIMIT 5""")),
    "latest_articles": (latest_articles, O.with_(*_C, final="""SELECT id, source, substr(title, 1, 50) AS title,
coalesce(publish_date::VARCHAR, '无日期') AS published FROM corpus ORDER BY id DESC LIMIT 10""")),
    "sample_articles": (sample_articles, O.with_(*_J, final="""SELECT id, title, source, content_type, sentiment,
sentiment_score::DOUBLE AS sentiment_score, length(content) AS content_length FROM joined WHERE id <= 3""")),
    "constraint_violations": (constraint_violations, O.with_(*_C, O.CHILDREN, final="""SELECT 'title_too_long' AS rule, count(*) AS n
FROM corpus WHERE length(title) > 500 HAVING count(*) > 0
UNION ALL SELECT 'url_too_long', count(*) FROM corpus WHERE length(url) > 1000 HAVING count(*) > 0
UNION ALL SELECT 'media_name_too_long', count(*) FROM corpus WHERE length(media_name) > 200 HAVING count(*) > 0
UNION ALL SELECT 'title_missing', count(*) FROM corpus WHERE title IS NULL HAVING count(*) > 0
UNION ALL SELECT 'source_not_allowed', count(*) FROM corpus WHERE source IS NULL OR source NOT IN ('en', 'fr', 'de') HAVING count(*) > 0
UNION ALL SELECT 'type_not_allowed', count(*) FROM corpus WHERE content_type NOT IN ('text', 'image', 'video') HAVING count(*) > 0
UNION ALL SELECT 'child_without_article', count(*) FROM children ANTI JOIN corpus ON id = corpus_id
UNION ALL SELECT 'title_source_repeated', count(*) FROM (SELECT 1 FROM corpus GROUP BY title, source HAVING count(*) > 1)""")),
    "daily_statistics": (daily_statistics, O.with_(*_J, final=f"""SELECT publish_date::VARCHAR AS stat_date, source,
count(DISTINCT id) AS total_count, count(DISTINCT id) FILTER (content_type = 'text') AS text_count,
count(DISTINCT id) FILTER (content_type = 'image') AS image_count, count(DISTINCT id) FILTER (content_type = 'video') AS video_count,
{O.classes('count')}, {O.MEAN} AS avg_sentiment FROM joined WHERE publish_date IS NOT NULL GROUP BY publish_date, source""")),
    "hot_keywords": (hot_keywords, O.with_(*_C, f"""words AS ({O.english_words(
        '(SELECT * FROM corpus WHERE publish_date IS NOT NULL)', 'content', 'source, publish_date')})""",
        """per AS (SELECT word AS keyword, CASE WHEN grouping(source) = 1 THEN 'all' ELSE source END AS source, publish_date, count(*) AS n
FROM words GROUP BY GROUPING SETS ((word, source, publish_date), (word, publish_date)))""",
        final=f"""SELECT publish_date::VARCHAR AS stat_date, source, keyword, n, {O.pct('n', 'peak', 2)} AS heat_score FROM (
SELECT *, max(n) OVER (PARTITION BY publish_date, source) AS peak FROM per)""")),
    "keyword_heat": (keyword_heat, O.with_(*_C, f"""words AS ({O.english_words(
        "(SELECT *, date_trunc('year', publish_date)::DATE AS d FROM corpus WHERE publish_date IS NOT NULL)", 'content', 'source, d')})""",
        """per AS (SELECT word AS keyword, CASE WHEN grouping(source) = 1 THEN 'all' ELSE source END AS source, d, count(*) AS n
FROM words GROUP BY GROUPING SETS ((word, source, d), (word, d)))""",
        final=f"""SELECT d::VARCHAR AS stat_date, source, count(*) AS n_keywords, sum(n)::BIGINT AS n_words,
count(*) FILTER ({O.pct('n', 'peak', 2)} >= 10) AS n_hot FROM (SELECT *, max(n) OVER (PARTITION BY d, source) AS peak FROM per) GROUP BY 1, 2""")),
    "media_activity": (media_activity, O.with_(*_C, final=f"""SELECT media_name, source, stat_month, article_count,
{O.pct('article_count', 'peak', 2)} AS activity_score FROM (SELECT *, max(article_count) OVER (PARTITION BY stat_month) AS peak FROM (
SELECT media_name, source, strftime(publish_date, '%Y-%m') AS stat_month, count(*) AS article_count FROM corpus
WHERE publish_date IS NOT NULL GROUP BY 1, 2, 3))""")),
}


def _register_log() -> None:
    from newslens.plans.article_queries import _ISO, _ZH, _from_text

    QUERIES["processing_log"] = (processing_log, O.with_(O.DOCS, O.FILES, O.PARSED,
        f"dated AS (SELECT id, {_from_text(_ZH, _ISO)} AS d FROM parsed)",
        final="""SELECT 'crawl' AS process_type, CASE WHEN failed > 0 AND processed = 0 THEN 'failed' ELSE 'success' END AS status,
processed AS processed_count, (SELECT nullif(string_agg(id || ': no date', chr(10) ORDER BY id || ': no date'), '') FROM (
  SELECT id::VARCHAR AS id FROM dated WHERE d IS NULL ORDER BY id::VARCHAR LIMIT 20)) AS error_message,
'{"processed":' || processed || ',"failed":' || failed || '}' AS details
FROM (SELECT count(d) AS processed, count(*) - count(d) AS failed FROM dated)"""))


_register_log()
