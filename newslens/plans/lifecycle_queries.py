"""URL intake, resume state, retention, overwrite rules, id assignment."""

from __future__ import annotations

from pyspark.sql import functions as F

from newslens.operators import lifecycle as Y
from newslens.plans import bindings as B, oracles as O
from newslens.session import fresh_path
from newslens.sources import sinks
from newslens.sources.articles import resolve_sheet

FIRST_YEAR = 1998


def sheet(spark, sf_dir):
    """A URL sheet with gaps, foreign schemes and repeats, from the pages table."""
    pages = B.table(spark, sf_dir, "pages")
    title = F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1)
    host = F.regexp_extract("url", r"^(https?://[^/]+/[^/]+)", 1)
    return resolve_sheet(pages.select(
        F.col("page_id").alias("position"),
        F.when(~F.col("url").contains("#"), title).alias("标题"),
        F.when(F.col("url").contains("ref=x"), F.regexp_replace("url", "^https?", "ftp"))
        .otherwise(host).alias("网址")))


def url_intake(spark, sf_dir):
    processed = B.corpus(spark, sf_dir).select("url").unionByName(
        B.table(spark, sf_dir, "pages").where("url like '%page=2%'").select(
            F.regexp_extract("url", r"^(https?://[^/]+/[^/]+)", 1).alias("url")))
    return Y.unprocessed(sheet(spark, sf_dir), processed).select("position", "title", "url")


def processed_union(spark, sf_dir):
    old, new = B.corpus(spark, sf_dir), Y.valid_urls(sheet(spark, sf_dir))
    path = fresh_path(spark, "processed")
    sinks.save_processed(path, old, new)
    return spark.read.parquet(path)


def retention_keep(spark, sf_dir):
    keep, _ = Y.retention_split(B.corpus(spark, sf_dir), FIRST_YEAR, extended=True)
    return keep.select("id", F.col("url_date").cast("string").alias("url_date"))


def retention_purge(spark, sf_dir):
    _, purge = Y.retention_split(B.corpus(spark, sf_dir), FIRST_YEAR, extended=True)
    return purge.select("id", F.col("url_date").cast("string").alias("url_date"))


def retention_media(spark, sf_dir):
    """Media rows kept and deleted with their articles."""
    _, purge = Y.retention_split(B.corpus(spark, sf_dir), FIRST_YEAR, extended=True)
    marked = Y.marked(B.children(spark, sf_dir), purge)
    return marked.groupBy(F.when(F.col("is_gone"), "delete").otherwise("keep").alias("fate"), "kind").agg(F.count("*").alias("n"))


def last_write_wins(spark, sf_dir):
    files = B.article_files(spark, sf_dir).withColumnRenamed("id", "position")
    return Y.last_write_wins(files).select("file_name", "position", F.length("value").alias("n_chars"))


def corpus_append(spark, sf_dir):
    """Text articles are loaded first, the rest is appended behind them."""
    corpus = B.corpus(spark, sf_dir)
    order = [F.col("url")]
    path = fresh_path(spark, "corpus")
    sinks.append_corpus(corpus.where("content_type = 'text'"), path, order)
    stored = spark.read.parquet(path)
    sinks.append_corpus(corpus.where("content_type <> 'text'"), path, order, stored)
    return spark.read.parquet(path).select("id", "url", "content_type")


_SHEET = r"""sheet AS (SELECT page_id AS position,
    CASE WHEN NOT contains(url, '#') THEN regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) END AS title,
    CASE WHEN contains(url, 'ref=x') THEN regexp_replace(url, '^https?', 'ftp')
      ELSE regexp_extract(url, '^(https?://[^/]+/[^/]+)', 1) END AS url FROM pages)"""
_VALID = "valid AS (SELECT * FROM sheet WHERE title IS NOT NULL AND url IS NOT NULL AND starts_with(url, 'http'))"
_DATED = f"""dated AS (SELECT id, coalesce(try_strptime(regexp_extract(url, '[0-9]{{4}}-[0-9]{{2}}/[0-9]{{2}}'), '%Y-%m/%d'),
  try_strptime(regexp_extract(url, '/a/([0-9]{{6}}/[0-9]{{2}})/', 1), '%Y%m/%d'))::DATE AS url_date FROM corpus)"""
_R = (O.DOCS, O.CORPUS, _DATED)

QUERIES = {
    "url_intake": (url_intake, O.with_(O.DOCS, _SHEET, _VALID, r"""processed AS (SELECT url FROM docs
UNION ALL SELECT regexp_extract(url, '^(https?://[^/]+/[^/]+)', 1) FROM pages WHERE url LIKE '%page=2%')""",
        final="""SELECT position, title, url FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY position) AS r FROM valid)
WHERE r = 1 AND url NOT IN (SELECT url FROM processed)""")),
    "processed_union": (processed_union, O.with_(O.DOCS, _SHEET, _VALID, final="SELECT url FROM docs UNION SELECT url FROM valid")),
    "retention_keep": (retention_keep, O.with_(*_R, final=f"""SELECT id, url_date::VARCHAR AS url_date FROM dated
WHERE url_date IS NULL OR year(url_date) >= {FIRST_YEAR}""")),
    "retention_purge": (retention_purge, O.with_(*_R, final=f"""SELECT id, url_date::VARCHAR AS url_date FROM dated
WHERE year(url_date) < {FIRST_YEAR}""")),
    "retention_media": (retention_media, O.with_(*_R, O.CHILDREN, final=f"""SELECT CASE WHEN corpus_id IN
(SELECT id FROM dated WHERE year(url_date) < {FIRST_YEAR}) THEN 'delete' ELSE 'keep' END AS fate, kind, count(*) AS n
FROM children GROUP BY 1, 2""")),
    "last_write_wins": (last_write_wins, O.with_(O.DOCS, O.FILES, final="""SELECT file_name, max(id) AS position,
arg_max(length(value), id) AS n_chars FROM files GROUP BY 1""")),
    "corpus_append": (corpus_append, O.with_(O.DOCS, O.CORPUS, final="""SELECT row_number() OVER
(ORDER BY content_type <> 'text', url) AS id, url, content_type FROM corpus""")),
}
