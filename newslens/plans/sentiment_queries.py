"""Document polarity: scores, classes, ranks, reports, loading."""

from __future__ import annotations

from pyspark.sql import functions as F

from newslens import constants as K
from newslens.functions.text import safe_title, strip
from newslens.operators import sentiment as S
from newslens.plans import bindings as B, oracles as O
from newslens.session import fresh_path, written
from newslens.sources.report import read_report, write_report


def scored_files(spark, sf_dir):
    """Whole files are scored, header and media lists included."""
    files = B.article_files(spark, sf_dir)
    scored = S.score_documents(files.withColumn("stem", safe_title(F.col("title"))), "id", "value", ["stem"])
    return scored.withColumnRenamed("stem", "title").withColumn("sentiment", S.classify(F.col("compound")))


def sentiment_score(spark, sf_dir):
    return scored_files(spark, sf_dir).select("id", "n_hits", "compound")


def sentiment_label(spark, sf_dir):
    return scored_files(spark, sf_dir).select("id", "sentiment")


def sentiment_rank(spark, sf_dir):
    return S.rank_documents(scored_files(spark, sf_dir)).select("id", "sentiment", "rank_no", "title", "compound")


def sentiment_extremes(spark, sf_dir):
    return S.extremes(scored_files(spark, sf_dir)).select("sentiment", "rank_no", "id", "title", "compound")


def sentiment_totals(spark, sf_dir):
    return S.class_totals(scored_files(spark, sf_dir))


def round_trip(spark, sf_dir):
    path = fresh_path(spark, "report")
    write_report(S.rank_documents(scored_files(spark, sf_dir)), path)
    return read_report(spark, path)


def report_round_trip(spark, sf_dir):
    return round_trip(spark, sf_dir).groupBy("title", "sentiment", "compound").agg(F.count("*").alias("n"))


def matched_scores(spark, sf_dir):
    corpus = B.corpus(spark, sf_dir).select("id", strip(safe_title(F.col("title"))).alias("title"))
    return S.match_by_title(written(S.load_form(round_trip(spark, sf_dir)), "scores"), corpus)


def sentiment_load(spark, sf_dir):
    loaded = matched_scores(spark, sf_dir).where(F.col("corpus_id").isNotNull())
    rates = ["confidence", "positive_rate", "negative_rate", "neutral_rate", "emotion_joy",
             "emotion_trust", "emotion_fear", "emotion_surprise"]
    return loaded.groupBy("corpus_id", "sentiment", "sentiment_score", "fits_v1_schema", *rates).agg(
        F.count("*").alias("n")).select(
        "corpus_id", "sentiment", F.col("sentiment_score").cast("double").alias("sentiment_score"),
        "fits_v1_schema", *[F.col(r).cast("double").alias(r) for r in rates], "n")


def lookup_misses(spark, sf_dir):
    """Hits and misses when all but image articles have got a new title since."""
    corpus = B.corpus(spark, sf_dir).select("id", F.when(
        F.col("content_type") == "image", F.col("title")).otherwise(F.concat_ws(" ", "title", "id")).alias("title"))
    files = B.article_files(spark, sf_dir)
    scored = S.score_documents(files, "id", "value", ["title"]).select(
        "id", "title", S.classify(F.col("compound")).alias("sentiment"))
    matched = S.match_by_title(written(scored, "scored"), corpus)
    return matched.groupBy("sentiment").agg(
        F.count_if(F.col("corpus_id").isNotNull()).alias("hits"),
        F.count_if(F.col("corpus_id").isNull()).alias("misses"))


_SCORED = (O.DOCS, O.FILES, O.scored("files", "id", "value"),
           f"named AS (SELECT s.*, f.stem AS title, f.title AS headline, {O.label()} AS sentiment FROM scored s JOIN files f USING (id))")
_ORDER = "CASE sentiment WHEN 'positive' THEN -compound WHEN 'negative' THEN compound ELSE abs(compound) END, title, id"
_REPORT = (*_SCORED, f"""report AS (SELECT {O.strip('title')} AS title, sentiment, {O.exact('compound', 3)} AS compound
  FROM named WHERE {O.strip('title')} <> '')""")
_RATES = "rates(sentiment, confidence, positive_rate, negative_rate, neutral_rate, emotion_joy, emotion_trust, emotion_fear, emotion_surprise) AS (VALUES " + ", ".join(
    f"('{r[0]}', " + ", ".join(f"{v}::DOUBLE" for v in r[1:]) + ")" for r in K.CLASS_RATES) + ")"

QUERIES = {
    "sentiment_score": (sentiment_score, O.with_(*_SCORED, final="SELECT id, n_hits, compound FROM named")),
    "sentiment_label": (sentiment_label, O.with_(*_SCORED, final="SELECT id, sentiment FROM named")),
    "sentiment_rank": (sentiment_rank, O.with_(*_SCORED, final=f"""SELECT id, sentiment,
row_number() OVER (PARTITION BY sentiment ORDER BY {_ORDER}) AS rank_no, title, compound FROM named""")),
    "sentiment_extremes": (sentiment_extremes, O.with_(*_SCORED, final=f"""SELECT sentiment, rank_no, id, title, compound FROM (
SELECT *, row_number() OVER (PARTITION BY sentiment ORDER BY {_ORDER}) AS rank_no FROM named WHERE sentiment <> 'neutral') WHERE rank_no <= 5""")),
    "sentiment_totals": (sentiment_totals, O.with_(*_SCORED, final=f"""SELECT sentiment, n, {O.pct('n', 'total', 2)} AS share_pct
FROM (SELECT sentiment, count(*) AS n, (SELECT count(*) FROM named) AS total FROM named GROUP BY 1)
UNION ALL SELECT 'total', count(*), 100.0 FROM named""")),
    "report_round_trip": (report_round_trip, O.with_(*_REPORT, final="""SELECT title, sentiment, compound, count(*) AS n
FROM report GROUP BY ALL""")),
    "sentiment_load": (sentiment_load, O.with_(*_REPORT, _RATES,
        f"firsts AS (SELECT lower({O.strip('stem')}) AS folded, min(id) AS corpus_id FROM files GROUP BY 1)",
        final=f"""SELECT corpus_id, sentiment, {O.exact('((compound + 1) * 5)', 2)} AS sentiment_score,
{O.exact('((compound + 1) * 5)', 2)} < 10 AS fits_v1_schema, confidence, positive_rate, negative_rate, neutral_rate,
emotion_joy, emotion_trust, emotion_fear, emotion_surprise, count(*) AS n
FROM report JOIN firsts ON lower(title) = folded JOIN rates USING (sentiment) GROUP BY ALL""")),
    "lookup_misses": (lookup_misses, O.with_(*_SCORED,
        "known AS (SELECT DISTINCT lower(CASE WHEN o_orderstatus = 'O' THEN title ELSE title || ' ' || id END) AS t FROM docs)",
        final="""SELECT sentiment, count(t) AS hits, count(*) - count(t) AS misses FROM named LEFT JOIN known ON t = lower(headline)
GROUP BY 1""")),
}
