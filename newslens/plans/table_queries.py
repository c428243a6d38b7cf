"""Stored tables: upserts by key, deletion through child tables, appends, sheets, rules of every table."""

from __future__ import annotations

from pyspark.sql import functions as F

from newslens import constants as K, schema
from newslens.functions.text import strip
from newslens.operators import lifecycle as Y, media as M, quality as Q, rollups as R, terms
from newslens.plans import article_queries as A, bindings as B, keyword_queries as W, lifecycle_queries as L, oracles as O
from newslens.plans import rollup_queries as RQ
from newslens.session import fresh_path, written
from newslens.sources import sinks
from newslens.sources.articles import read_articles, read_sheet_rows, resolve_sheet
from newslens.sources.keyed_table import KeyedTable


def keyed_upsert(spark, sf_dir):
    """Daily figures by (date, source) and activity by (medium, month), each loaded from odd ids, then upserted twice."""
    corpus, scores = written(B.corpus(spark, sf_dir), "upsert-corpus"), written(B.sentiment(spark, sf_dir), "upsert-scores")
    odd = corpus.where("id % 2 = 1")

    def activity(articles):
        return articles.where("publish_date is not null and media_name is not null").groupBy(
            "media_name", F.date_format("publish_date", "yyyy-MM").alias("stat_month")).agg(F.count("*").alias("article_count"))

    tables = {}
    for name, keys, build in (("daily", ["stat_date", "source"], lambda c: R.daily_statistics(c, scores)),
                              ("activity", ["media_name", "stat_month"], activity)):
        whole = written(build(corpus), f"upsert-{name}")
        table = KeyedTable(spark, fresh_path(spark, f"keyed-{name}"), whole.schema, keys, buckets=16, parts=1)
        table.upsert(build(odd))
        changed = written(build(corpus.where("id % 4 = 0")).select(*keys), "touched")
        rest = written(build(corpus.where("id % 4 = 2")).select(*keys), "touched")
        for touched in (changed, rest):
            table.upsert(whole.join(touched, keys, "left_semi"))
        tables[name] = table.read()
    daily = tables["daily"].select(
        F.lit("daily").alias("kind"), F.col("stat_date").cast("string").alias("first_key"), F.col("source").alias("second_key"),
        F.col("total_count").alias("n"), "positive_count", "neutral_count", "negative_count")
    none = [F.lit(None).cast("long").alias(c) for c in ("positive_count", "neutral_count", "negative_count")]
    return daily.unionByName(tables["activity"].select(
        F.lit("activity").alias("kind"), F.col("media_name").alias("first_key"), F.col("stat_month").alias("second_key"),
        F.col("article_count").alias("n"), *none))


def cascade_delete(spark, sf_dir):
    """Old articles go; images, videos and scores follow by deletion sets, half of which are then compacted away."""
    corpus = B.corpus(spark, sf_dir)
    _, purged = Y.retention_split(corpus, L.FIRST_YEAR, extended=True)
    purged = written(purged.select("id"), "purged")
    lines, scores = B.children(spark, sf_dir), B.sentiment(spark, sf_dir)
    parts = {
        "images": lines.where("kind = 'image'").select("corpus_id", "file_name"),
        "videos": lines.where("kind = 'video'").select("corpus_id", "file_name"),
        "scores": scores.select("corpus_id", F.col("sentiment").alias("file_name")),
    }
    left = None
    for name, rows in parts.items():
        table = KeyedTable(spark, fresh_path(spark, f"child-{name}"), rows.schema, ["corpus_id"], buckets=16, parts=2)
        table.append(rows)
        for part in (0, 1):
            table.delete(purged.where(f"id % 2 = {part}").select(F.col("id").alias("corpus_id")))
            if part == 0:
                table.compact()
        kept = table.read().select(F.lit(name).alias("child"), "corpus_id", "file_name")
        left = kept if left is None else left.unionByName(kept)
    return left.groupBy("child", "corpus_id").agg(F.count("*").alias("n"))


def score_append(spark, sf_dir):
    """Scores of odd articles, then all others, appended with ids that go on (K2)."""
    scores = written(B.sentiment(spark, sf_dir), "append-scores")
    path = fresh_path(spark, "sentiment")
    order = [F.col("corpus_id"), F.col("pass_no")]
    sinks.append_sentiment(scores.where("corpus_id % 2 = 1"), path, order)
    stored = written(spark.read.parquet(path).select("id"), "loaded-scores")
    sinks.append_sentiment(scores.where("corpus_id % 2 = 0"), path, order, stored)
    return spark.read.parquet(path).select("id", "corpus_id", "sentiment", F.col("sentiment_score").cast("double").alias("score"))


def term_sheets(spark, sf_dir):
    """The sheets of the mixed report, written and read back by language."""
    from newslens.plans.term_queries import bodies

    out = fresh_path(spark, "sheets")
    report = written(terms.mixed_report(bodies(spark, sf_dir)), "mixed")
    sinks.write_sheets(terms.sheets(report), out)
    found = None
    for sheet, lang in (("all", "en"), ("all", "zh"), ("en", "en"), ("zh", "zh")):
        rows = read_sheet_rows(spark, f"{out}/{sheet}", lang).select(F.lit(sheet).alias("sheet"), "lang", "word", "n")
        found = rows if found is None else found.unionByName(rows)
    return found


def article_folder(spark, sf_dir):
    """One text file per medium with all its articles, in foreign line ends, read back as a folder."""
    files = B.article_files(spark, sf_dir).join(B.corpus(spark, sf_dir).select("id", "media_name"), "id")
    folder = fresh_path(spark, "folder")
    foreign = F.when(F.col("id") % 2 == 0, F.replace("value", F.lit("\n"), F.lit("\r\n"))).otherwise(F.col("value"))
    files.select("id", "media_name", foreign.alias("value")).repartition("media_name").sortWithinPartitions(
        "media_name", "id").select("media_name", "value").write.partitionBy("media_name").text(folder, lineSep="\r")
    read = read_articles(spark, f"{folder}/*")
    return read.select(F.regexp_extract("path", "media_name=([^/]+)/", 1).alias("media_name"), F.md5("value").alias("text_md5"))


def sheet_rules(spark, sf_dir):
    """Rows of a sheet by what becomes of them: empty, without title or URL, foreign scheme, taken."""
    pages = B.table(spark, sf_dir, "pages")
    gap = F.col("page_id") % 5
    sheet = resolve_sheet(pages.select(
        F.when(gap > 1, F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1)).alias("文章标题"),
        F.when((gap != 0) & (gap != 2), F.when(gap == 3, F.regexp_replace("url", "^https?", "ftp")).otherwise(F.col("url")))
        .alias("链接")))
    taken = Y.valid_urls(sheet)
    return sheet.na.drop("all").agg(F.count("*").alias("n_not_empty")).withColumns({
        "n_rows": sheet.agg(F.count("*")).scalar(), "n_taken": taken.agg(F.count("*")).scalar(),
        "n_urls": taken.agg(F.count_distinct("url")).scalar()})


def classes_of_all(spark, sf_dir):
    """Counts per class over all articles, where those without a score have no class and drop out."""
    joined = B.corpus(spark, sf_dir).select("id").join(
        B.sentiment(spark, sf_dir), F.col("id") == F.col("corpus_id"), "left")
    return Q.score_by_sentiment(joined).withColumn(
        "n_without", joined.agg(F.count_if(F.col("sentiment").isNull())).scalar())


def recent_months(spark, sf_dir):
    """The overview as its view shows it: newest month first, then by source."""
    return R.newest_first(R.sentiment_overview(B.corpus(spark, sf_dir), B.sentiment(spark, sf_dir)), ["source"]).select(
        "row_no", "month", "source", "total_articles")


def media_reach(spark, sf_dir):
    """Distinct media per year and source: exactly, and from monthly sketches within their error."""
    corpus = B.corpus(spark, sf_dir)
    path = fresh_path(spark, "sketches")
    R.media_reach(corpus).write.parquet(path)
    year = F.substring("month", 1, 4)
    estimates = R.merged_reach(spark.read.parquet(path), year.alias("year"), F.col("source"))
    exact = corpus.where("publish_date is not null").groupBy(
        F.date_format("publish_date", "yyyy").alias("year"), "source").agg(F.count_distinct("media_name").alias("media_count"))
    error = F.abs(F.col("media_estimate") - F.col("media_count"))
    return exact.join(estimates, ["year", "source"]).select(
        "year", "source", "media_count", (error <= F.greatest(F.lit(1.0), R.SKETCH_ERROR * F.col("media_count"))).alias("within_error"))


def table_violations(spark, sf_dir):
    """Broken rules of the score, image, video, keyword and log tables, by table and rule."""
    parsed = A._parsed(spark, sf_dir)
    images = M.image_rows(parsed).withColumns({
        "format": F.when(F.col("width") > 320, "bmp").otherwise(F.col("format")),
        "height": F.col("height") - 240})
    videos = M.video_rows(parsed).withColumns({
        "video_url": F.when(F.col("pos") > 1, F.col("video_url")), "duration": (F.col("pos") - 2).cast("int")})
    words = written(W.keyword_rows(spark, sf_dir), "keywords").select(
        F.col("id").alias("corpus_id"), F.when(F.col("rank_no") > 1, F.col("keyword")).alias("keyword"), "weight",
        F.when(F.col("frequency") > 9, "misc").otherwise("other").alias("keyword_type"))
    scores = B.sentiment(spark, sf_dir).withColumn(
        "sentiment", F.when(F.col("pass_no") > 0, "mixed").otherwise(F.col("sentiment")))
    logs = B.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.lit("crawl").alias("process_type"), F.col("o_orderstatus").alias("status"),
        F.lit(0).alias("processed_count"), F.col("o_orderdate").alias("start_time"),
        F.expr("o_orderdate - make_interval(0, 0, 0, CAST(o_orderkey % 3 AS INT) - 1)").alias("end_time"))
    tables = {
        "images": (images, schema.image_rules(), "corpus_id"), "videos": (videos, schema.video_rules(), "corpus_id"),
        "keywords": (words, schema.keyword_rules(), "corpus_id"), "scores": (scores, schema.sentiment_rules(), "corpus_id"),
        "logs": (logs, schema.log_rules(), "id")}
    found = None
    for name, (rows, rules, key) in tables.items():
        part = schema.violations(rows, rules, key).groupBy("rule").agg(F.count("*").alias("n")).select(
            F.lit(name).alias("table_name"), "rule", "n")
        found = part if found is None else found.unionByName(part)
    return found


def vocabulary_segments(spark, sf_dir):
    """All words of documents cut by longest match, with the words of the benchmark as vocabulary."""
    listed = B.table(spark, sf_dir, "benchmark").select(
        F.explode(terms.latin_words(F.lower("text"))).alias("word")).where(F.length("word") > 1)
    runs = B.texts(spark, sf_dir, "documents", "doc_id").select(
        F.explode(terms.latin_words(F.lower("text"))).alias("run")).groupBy("run").agg(F.count("*").alias("n"))
    runs = written(runs, "run-counts")
    pieces = runs.join(terms.segment(runs, listed), "run").select("n", F.explode("words").alias("piece"))
    return pieces.groupBy("piece").agg(F.sum("n").alias("n"))


_C = (O.DOCS, O.CORPUS)
_R = (*_C, L._DATED)
_JOINED = (*_C, O.SENTIMENT, O.JOINED.format("corpus"))
_DAILY = f"""SELECT 'daily' AS kind, publish_date::VARCHAR AS first_key, source AS second_key, count(DISTINCT id) AS n,
{O.classes('count')} FROM joined WHERE publish_date IS NOT NULL GROUP BY publish_date, source"""
_WORDS_OF = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')"

QUERIES = {
    "keyed_upsert": (keyed_upsert, O.with_(*_JOINED, final=f"""{_DAILY}
UNION ALL SELECT 'activity', media_name, strftime(publish_date, '%Y-%m'), count(*), NULL, NULL, NULL FROM corpus
WHERE publish_date IS NOT NULL AND media_name IS NOT NULL GROUP BY 2, 3""")),
    "cascade_delete": (cascade_delete, O.with_(*_R, O.CHILDREN, O.SENTIMENT,
        f"old AS (SELECT id FROM dated WHERE year(url_date) < {L.FIRST_YEAR})",
        """childs AS (SELECT CASE kind WHEN 'image' THEN 'images' ELSE 'videos' END AS child, corpus_id FROM children
  UNION ALL SELECT 'scores', corpus_id FROM sentiment)""",
        final="SELECT child, corpus_id, count(*) AS n FROM childs WHERE corpus_id NOT IN (SELECT id FROM old) GROUP BY 1, 2")),
    "score_append": (score_append, O.with_(O.SENTIMENT, final="""SELECT row_number() OVER (ORDER BY corpus_id % 2 DESC, corpus_id) AS id,
corpus_id, sentiment, sentiment_score::DOUBLE AS score FROM sentiment""")),
    "term_sheets": (term_sheets, O.with_(O.DOCS, O.FILES, O.BODIES, O.MIXED_WORDS, O.counts(), O.top(K.MIXED_TOP_TERMS),
        """report AS (SELECT word, n, CASE WHEN regexp_matches(word, '[\\x{4e00}-\\x{9fa5}]') THEN 'zh' ELSE 'en' END AS lang FROM tops)""",
        """shown AS (SELECT * FROM report QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) <= 40)""",
        final="SELECT 'all' AS sheet, lang, word, n FROM shown UNION ALL SELECT lang, lang, word, n FROM shown")),
    "article_folder": (article_folder, O.with_(O.DOCS, O.FILES, final="""SELECT medium AS media_name,
md5(string_agg(value || chr(10), '' ORDER BY id)) AS text_md5 FROM files JOIN (SELECT id, medium FROM docs) USING (id) GROUP BY 1""")),
    "sheet_rules": (sheet_rules, """SELECT count(*) FILTER (page_id % 5 <> 0) AS n_not_empty, count(*) AS n_rows,
count(*) FILTER (page_id % 5 = 4 AND starts_with(url, 'http')) AS n_taken,
count(DISTINCT url) FILTER (page_id % 5 = 4 AND starts_with(url, 'http')) AS n_urls FROM pages"""),
    "classes_of_all": (classes_of_all, O.with_(*_JOINED, final=f"""SELECT sentiment, count(*) AS n, {O.MEAN} AS avg_score,
(SELECT count(*) FROM joined WHERE sentiment IS NULL) AS n_without FROM joined WHERE sentiment IS NOT NULL GROUP BY 1""")),
    "recent_months": (recent_months, O.with_(*_JOINED, final="""SELECT row_number() OVER (ORDER BY month DESC, source) AS row_no, * FROM (
SELECT strftime(publish_date, '%Y-%m') AS month, source, count(*) AS total_articles FROM joined WHERE publish_date IS NOT NULL GROUP BY 1, 2)""")),
    "media_reach": (media_reach, O.with_(*_C, final="""SELECT strftime(publish_date, '%Y') AS year, source,
count(DISTINCT media_name) AS media_count, true AS within_error FROM corpus WHERE publish_date IS NOT NULL
GROUP BY 1, 2 HAVING count(media_name) > 0""")),
    "table_violations": (table_violations, O.with_(O.DOCS, O.FILES, *W._KEYWORDS[1:], O.SENTIMENT,
        """pics AS (SELECT i * 160 AS width, i * 120 - 240 AS height, 'images/' || stem || '_' || i || '.jpeg' AS path
  FROM (SELECT stem, unnest(range(1, n_images + 1)) AS i FROM files))""",
        """clips AS (SELECT i, 'videos/' || stem || '_' || i || '_link.txt' AS url
  FROM (SELECT stem, unnest(range(1, n_videos + 1)) AS i FROM files))""",
        """twice AS (SELECT doc_id FROM labels JOIN documents USING (doc_id) WHERE toxic = 1)""",
        """broken AS (SELECT 'images' AS table_name, 'format_not_allowed' AS rule FROM pics WHERE width > 320
UNION ALL SELECT 'images', 'size_not_positive' FROM pics WHERE height <= 0
UNION ALL SELECT 'images', 'file_path_too_long' FROM pics WHERE length(path) > 500
UNION ALL SELECT 'videos', 'video_url_missing' FROM clips WHERE i <= 1
UNION ALL SELECT 'videos', 'video_url_too_long' FROM clips WHERE i > 1 AND length(url) > 1000
UNION ALL SELECT 'videos', 'duration_negative' FROM clips WHERE i < 2
UNION ALL SELECT 'keywords', 'keyword_missing' FROM keywords WHERE rank_no = 1
UNION ALL SELECT 'keywords', 'keyword_too_long' FROM keywords WHERE rank_no > 1 AND length(keyword) > 100
UNION ALL SELECT 'keywords', 'keyword_type_not_allowed' FROM keywords WHERE frequency > 9
UNION ALL SELECT 'keywords', 'weight_does_not_fit' FROM keywords WHERE weight >= 1000
UNION ALL SELECT 'scores', 'sentiment_not_allowed' FROM twice
UNION ALL SELECT 'scores', 'score_does_not_fit' FROM sentiment WHERE sentiment_score >= 10
UNION ALL SELECT 'logs', 'status_not_allowed' FROM orders
UNION ALL SELECT 'logs', 'ends_before_start' FROM orders WHERE o_orderkey % 3 = 2)""",
        final="SELECT table_name, rule, count(*) AS n FROM broken GROUP BY 1, 2")),
    "vocabulary_segments": (vocabulary_segments, rf"""WITH RECURSIVE
words AS MATERIALIZED (SELECT DISTINCT w FROM (SELECT unnest({_WORDS_OF}) AS w FROM benchmark) WHERE regexp_full_match(w, '[a-z]{{2,}}')),
runs AS MATERIALIZED (SELECT w AS run, count(*) AS n FROM (SELECT unnest({_WORDS_OF}) AS w FROM documents)
  WHERE regexp_full_match(w, '[a-z]+') GROUP BY 1),
hits AS MATERIALIZED (SELECT run, i, max(length(w)) AS size FROM (SELECT run, i, unnest(range(2, length(run) - i + 2)) AS s
  FROM (SELECT run, unnest(range(1, length(run) + 1)) AS i FROM runs)) JOIN words ON w = substr(run, i, s) GROUP BY 1, 2),
-- one step per taken word: the next place where a word starts, at or behind the end of the last one
steps(run, unknown, i, size) AS (
  SELECT run, 1, min(i), arg_min(size, i) FROM hits GROUP BY run
  UNION ALL
  SELECT s.run, any_value(s.i + s.size), min(h.i), arg_min(h.size, h.i) FROM steps s JOIN hits h ON h.run = s.run AND h.i >= s.i + s.size
  GROUP BY s.run),
gaps AS (
  SELECT run, substr(run, unknown::INT, (i - unknown)::INT) AS gap FROM steps WHERE i > unknown
  UNION ALL SELECT run, substr(run, e::INT) FROM (SELECT run, max(i + size) AS e FROM steps GROUP BY 1) WHERE e <= length(run)
  UNION ALL SELECT run, run FROM runs ANTI JOIN hits USING (run)),
pieces AS (
  SELECT run, substr(run, i::INT, size::INT) AS piece FROM steps
  UNION ALL SELECT run, gap FROM gaps WHERE length(gap) = 1
  UNION ALL SELECT run, substr(gap, k::INT, 2) FROM (SELECT run, gap, unnest(range(1, length(gap))) AS k FROM gaps WHERE length(gap) > 1))
SELECT piece, sum(n)::BIGINT AS n FROM pieces JOIN runs USING (run) GROUP BY 1"""),
}
