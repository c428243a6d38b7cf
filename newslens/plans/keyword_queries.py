"""Keywords, topics and bigram search."""

from __future__ import annotations

from pyspark.sql import functions as F

from newslens.operators import keywords as W, search as X
from newslens.plans import bindings as B, oracles as O
from newslens.session import fresh_path, written

TERM = "Worthless"
PHRASES = ("Worthless", "of the", "the and", "de la", "und der", "with in a")


def keyword_rows(spark, sf_dir):
    return W.document_keywords(B.corpus(spark, sf_dir))


def doc_keywords(spark, sf_dir):
    return keyword_rows(spark, sf_dir).select("id", "keyword", "frequency", "df", "weight", "rank_no")


def hot_topics(spark, sf_dir):
    stored = written(keyword_rows(spark, sf_dir), "keywords")  # the keywords table
    return W.hot_topics(stored, B.sentiment(spark, sf_dir))


def ngram_postings(spark, sf_dir):
    return X.postings(B.corpus(spark, sf_dir)).groupBy("gram").agg(
        F.count("*").alias("n_documents"), F.sum("id").alias("sum_id"))


def ngram_search(spark, sf_dir):
    return X.search(B.corpus(spark, sf_dir), TERM)


def ngram_index_search(spark, sf_dir):
    path = fresh_path(spark, "postings")
    X.write_postings(B.corpus(spark, sf_dir), path)
    return X.matching(spark.read.parquet(path), TERM, buckets=64)


def ngram_phrase(spark, sf_dir):
    """Places of a few phrases, all looked up in one pass over a stored index."""
    path = fresh_path(spark, "positions")
    X.write_positions(B.corpus(spark, sf_dir), path)
    return X.phrase(spark.read.parquet(path), PHRASES, buckets=64).select("phrase", "id", "n_places")


def hot_topics_by_date(spark, sf_dir):
    """The ten hottest topics of each month, dated by its last day."""
    stored = written(keyword_rows(spark, sf_dir).where("rank_no <= 20"), "keywords")
    dates = B.corpus(spark, sf_dir).where("publish_date is not null").select(
        "id", F.last_day("publish_date").alias("stat_date"))
    rows = W.hot_topics_by_date(stored, dates, B.sentiment(spark, sf_dir))
    return rows.withColumn("stat_date", F.col("stat_date").cast("string"))


_GRAMS = r"""grams AS (SELECT DISTINCT id, substr(w, i, 2) AS gram FROM (SELECT id, w, unnest(range(1, length(w))) AS i FROM (
    SELECT DISTINCT id, unnest(string_split_regex(lower(concat_ws(chr(10), title, content)), '[^\p{L}\p{N}]+')) AS w FROM corpus)
    WHERE length(w) > 1))"""
_TERM_GRAMS = sorted({TERM.lower()[i:i + 2] for i in range(len(TERM) - 1)})
_SEARCH = O.with_(O.DOCS, O.CORPUS, _GRAMS, final=f"""SELECT id, count(*) AS n_grams, count(*) = {len(_TERM_GRAMS)} AS is_full
FROM grams WHERE gram IN ({O._list(_TERM_GRAMS)}) GROUP BY 1""")

_KEYWORDS = (O.DOCS, O.CORPUS, f"words AS ({O.english_words('corpus', 'content', 'id')})",
             "per AS (SELECT id, word, count(*) AS frequency FROM words GROUP BY 1, 2)",
             "freq AS (SELECT word, count(*) AS df FROM per GROUP BY 1)",
             """weighted AS (SELECT *, round(frequency * (ln(((SELECT count(*) FROM corpus) + 1)::DOUBLE / (df + 1)) + 1), 6) AS weight
  FROM per JOIN freq USING (word))""",
             """keywords AS (SELECT id, word AS keyword, frequency, df, weight, rank_no FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY weight DESC, word) AS rank_no FROM weighted))""")

_PLAIN = r"trim(regexp_replace(lower(coalesce({0}, '')), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
_PHRASES = ", ".join(f"('{p}', '{p.lower()}')" for p in PHRASES)

QUERIES = {
    # none of these phrases overlaps itself, so places can be counted by taking them out; the last ends in a word of one letter
    "ngram_phrase": (ngram_phrase, O.with_(O.DOCS, O.CORPUS,
        f"plain AS (SELECT id, {_PLAIN.format('title')} || ' ' || chr(1) || ' ' || {_PLAIN.format('content')} || ' ' AS t FROM corpus)",
        f"asked AS (SELECT phrase, p || CASE WHEN regexp_matches(p, '(^| ).$') THEN ' ' ELSE '' END AS p FROM (VALUES {_PHRASES}) AS v(phrase, p))",
        final="""SELECT phrase, id, (length(t) - length(replace(t, p, ''))) // length(p) AS n_places FROM plain, asked
WHERE contains(t, p)""")),
    "hot_topics_by_date": (hot_topics_by_date, O.with_(*_KEYWORDS, O.SENTIMENT,
        """dated AS (SELECT id, last_day(publish_date) AS stat_date FROM corpus WHERE publish_date IS NOT NULL)""",
        "topics AS (SELECT stat_date, id, keyword AS topic_name FROM keywords JOIN dated USING (id) WHERE rank_no = 1)",
        """sizes AS (SELECT stat_date, topic_name, count(DISTINCT t.id) AS article_count, {0} AS avg_sentiment_score
  FROM topics t LEFT JOIN sentiment s ON s.corpus_id = t.id GROUP BY 1, 2)""".format(O.MEAN),
        """ranked AS (SELECT *, row_number() OVER (PARTITION BY stat_date ORDER BY article_count DESC, topic_name) AS rank_no,
  max(article_count) OVER (PARTITION BY stat_date) AS peak FROM sizes)""",
        """pairs AS (SELECT stat_date, topic_name, keyword, count(*) AS n FROM topics JOIN keywords k USING (id)
  WHERE k.rank_no <= 20 GROUP BY 1, 2, 3)""",
        """best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY stat_date, topic_name ORDER BY n DESC, keyword) AS r
  FROM pairs) WHERE r <= 5)""",
        """listed AS (SELECT stat_date, topic_name, '[' || string_agg('"' || keyword || '"', ',' ORDER BY r) || ']' AS topic_keywords
  FROM best GROUP BY 1, 2)""",
        final=f"""SELECT stat_date::VARCHAR AS stat_date, topic_name, article_count, avg_sentiment_score, topic_keywords, rank_no,
{O.pct('article_count', 'peak', 2)} AS heat_score FROM ranked JOIN listed USING (stat_date, topic_name) WHERE rank_no <= 10""")),
    "doc_keywords": (doc_keywords, O.with_(*_KEYWORDS, final="SELECT * FROM keywords")),
    "hot_topics": (hot_topics, O.with_(*_KEYWORDS, O.SENTIMENT,
        "topics AS (SELECT id, keyword AS topic_name FROM keywords WHERE rank_no = 1)",
        """pairs AS (SELECT topic_name, keyword, count(*) AS n FROM topics JOIN keywords USING (id) GROUP BY 1, 2)""",
        """best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY topic_name ORDER BY n DESC, keyword) AS r FROM pairs) WHERE r <= 5)""",
        """listed AS (SELECT topic_name, '[' || string_agg('"' || keyword || '"', ',' ORDER BY r) || ']' AS topic_keywords FROM best GROUP BY 1)""",
        final=f"""SELECT *, {O.pct('article_count', '(max(article_count) OVER ())', 2)} AS heat_score FROM (
SELECT topic_name, count(DISTINCT t.id) AS article_count, {O.MEAN} AS avg_sentiment_score, any_value(topic_keywords) AS topic_keywords
FROM topics t JOIN listed USING (topic_name) LEFT JOIN sentiment s ON s.corpus_id = t.id GROUP BY 1)""")),
    "ngram_postings": (ngram_postings, O.with_(O.DOCS, O.CORPUS, _GRAMS,
        final="SELECT gram, count(*) AS n_documents, sum(id)::BIGINT AS sum_id FROM grams GROUP BY 1")),
    "ngram_search": (ngram_search, _SEARCH),
    "ngram_index_search": (ngram_index_search, _SEARCH),
}
