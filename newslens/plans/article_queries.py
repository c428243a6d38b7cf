"""Article files: assembly, header, body, dates, media lists, names."""

from __future__ import annotations

from pyspark.sql import functions as F

from newslens.functions.dates import date_from_text, date_from_url
from newslens.functions.text import body_by_lines, content_by_rules, safe_title, title_from_file_name
from newslens.functions.urls import url_host
from newslens.operators import media as M
from newslens.plans import bindings as B, oracles as O
from newslens.session import written
from newslens.sources.articles import parse_articles, parse_video_links, with_defaults


def article_files(spark, sf_dir):
    return B.article_files(spark, sf_dir).select("id", "file_name", "value")


def parse_article(spark, sf_dir):
    parsed = with_defaults(parse_articles(article_files(spark, sf_dir), ["id"]))
    return parsed.select("id", "title", "url", "content", "has_images", "image_url", "source",
                         "media_name", "content_type")


def body_lines(spark, sf_dir):
    return article_files(spark, sf_dir).select("id", body_by_lines(F.col("value")).alias("body")).where("body != ''")


def date_from_text_query(spark, sf_dir):
    text = content_by_rules(F.col("value"))
    return article_files(spark, sf_dir).select(
        "id", date_from_text(text).cast("string").alias("strict_date"),
        date_from_text(text, documented=True).cast("string").alias("documented_date"))


def date_from_url_query(spark, sf_dir):
    return B.corpus(spark, sf_dir).select(
        "id", date_from_url(F.col("url"), extended=False).cast("string").alias("old_form"),
        date_from_url(F.col("url")).cast("string").alias("any_form"))


def media_list(spark, sf_dir):
    parsed = parse_articles(article_files(spark, sf_dir), ["id"])
    return parsed.select("id", F.explode_outer("media").alias("m")).where("m is not null").select(
        "id", "m.kind", F.col("m.pos").cast("long").alias("pos"), "m.file_name",
        F.col("m.width").cast("long").alias("width"), F.col("m.height").cast("long").alias("height"))


def safe_title_query(spark, sf_dir):
    safe = safe_title(F.col("title"))
    return B.corpus(spark, sf_dir).select(
        "id", safe.alias("safe_title"),
        title_from_file_name(F.concat(safe, F.lit(".txt"))).alias("title_of_file"))


def media_tables(spark, sf_dir):
    """Image and video child rows with format and platform."""
    rows = B.children(spark, sf_dir)
    is_image = F.col("kind") == "image"
    return rows.groupBy(
        "kind", F.when(is_image, M.image_format(F.col("file_name"))).alias("format"),
        F.when(~is_image, url_host(F.col("video_url"))).alias("platform"),
    ).agg(F.count("*").alias("n"), F.sum(F.col("width").cast("long")).alias("sum_width"),
          F.sum(F.col("height").cast("long")).alias("sum_height"))


def video_links(spark, sf_dir):
    lines = B.children(spark, sf_dir).where("kind = 'video'").select(
        "file_name", F.concat(F.lit("视频链接: "), F.col("video_url"), F.lit("&c=1")).alias("value"))
    return parse_video_links(lines).select("file_name", "url", "host", "src", "c")


def _parsed(spark, sf_dir):
    return parse_articles(article_files(spark, sf_dir), ["id"])


def image_rows(spark, sf_dir):
    rows = M.image_rows(_parsed(spark, sf_dir))
    return rows.withColumns({c: F.col(c).cast("long") for c in ("pos", "width", "height")})


def video_rows(spark, sf_dir):
    """Listed videos with the players of the order's video lines as their links, the first with the first and so on."""
    parsed = written(_parsed(spark, sf_dir).select("id", "media"), "parsed-media")
    players = B.children(spark, sf_dir).where("kind = 'video'").select(
        F.col("corpus_id").alias("id"), (F.col("pos") / 2).cast("int").alias("no"), "video_url")
    links = M.video_rows(parsed).join(players, (F.col("corpus_id") == F.col("id")) & (F.col("pos") == F.col("no"))).select(
        "file_name", players["video_url"].alias("url"))
    return M.video_rows(parsed, links).withColumn("pos", F.col("pos").cast("long"))


_SQL_DATE = "try_strptime({0}, '%Y-%m-%d')::DATE::VARCHAR"


def _from_text(*patterns) -> str:
    picks = []
    for pattern, groups in patterns:
        parts = " || '-' || ".join(f"lpad(regexp_extract(raw_content, '{pattern}', {g}), {4 if i == 0 else 2}, '0')"
                                   for i, g in enumerate(groups))
        picks.append(f"CASE WHEN regexp_matches(raw_content, '{pattern}') THEN {_SQL_DATE.format(f'({parts})')} END")
    return f"coalesce({', '.join(picks)})"


_ZH = ("([0-9]{4})年([0-9]{1,2})月([0-9]{1,2})日", (1, 2, 3))
_ISO = ("([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})", (1, 2, 3))
_US = ("([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})", (3, 1, 2))
_DOT = (r"([0-9]{4})\.([0-9]{1,2})\.([0-9]{1,2})", (1, 2, 3))

QUERIES = {
    "article_files": (article_files, O.with_(O.DOCS, O.FILES, final="SELECT id, file_name, value FROM files")),
    "parse_article": (parse_article, O.with_(O.DOCS, O.FILES, O.PARSED, final=f"""SELECT id, title, url, {O.strip('raw_content')} AS content,
contains(value, '图片列表:') AS has_images,
CASE WHEN contains(value, '图片列表:') THEN 'images/' || title || '_1.jpg' END AS image_url,
'china' AS source, 'China Daily' AS media_name, 'text' AS content_type FROM parsed""")),
    "body_lines": (body_lines, O.with_(O.DOCS, O.FILES, O.BODIES, final="SELECT id, body FROM bodies WHERE body <> ''")),
    "date_from_text": (date_from_text_query, O.with_(O.DOCS, O.FILES, O.PARSED, final=f"""SELECT id,
{_from_text(_ZH, _ISO)} AS strict_date, {_from_text(_ZH, _ISO, _US, _DOT)} AS documented_date FROM parsed""")),
    "date_from_url": (date_from_url_query, O.with_(O.DOCS, final="""SELECT id,
try_strptime(regexp_extract(url, '[0-9]{4}-[0-9]{2}/[0-9]{2}'), '%Y-%m/%d')::DATE::VARCHAR AS old_form,
coalesce(try_strptime(regexp_extract(url, '[0-9]{4}-[0-9]{2}/[0-9]{2}'), '%Y-%m/%d'),
  try_strptime(regexp_extract(url, '/a/([0-9]{6}/[0-9]{2})/', 1), '%Y%m/%d'))::DATE::VARCHAR AS any_form FROM docs""")),
    "media_list": (media_list, O.with_(O.DOCS, O.FILES, final="""SELECT id, 'image' AS kind, i AS pos, stem || '_' || i || '.jpeg' AS file_name,
i * 160 AS width, i * 120 AS height FROM (SELECT *, unnest(range(1, n_images + 1)) AS i FROM files)
UNION ALL SELECT id, 'video', i, stem || '_' || i || '_link.txt', NULL, NULL
FROM (SELECT *, unnest(range(1, n_videos + 1)) AS i FROM files)""")),
    "safe_title": (safe_title_query, O.with_(O.DOCS, O.FILES, final="SELECT id, stem AS safe_title, replace(file_name, '.txt', '') AS title_of_file FROM files")),
    "media_tables": (media_tables, O.with_(O.CHILDREN, final="""SELECT kind,
CASE WHEN kind = 'image' THEN nullif(regexp_extract(file_name, '[^.]+$'), 'bmp') END AS format,
CASE WHEN kind = 'video' THEN regexp_extract(video_url, '//([^/]+)/', 1) END AS platform, count(*) AS n,
sum(width)::BIGINT AS sum_width, sum(height)::BIGINT AS sum_height FROM children GROUP BY 1, 2, 3""")),
    "image_rows": (image_rows, O.with_(O.DOCS, O.FILES, final="""SELECT id AS corpus_id, i AS pos, stem || '_' || i || '.jpeg' AS file_name,
'images/' || stem || '_' || i || '.jpeg' AS file_path, i * 160 AS width, i * 120 AS height, 'jpeg' AS format
FROM (SELECT *, unnest(range(1, n_images + 1)) AS i FROM files)""")),
    "video_rows": (video_rows, O.with_(O.DOCS, O.FILES, O.CHILDREN, """listed AS (SELECT id AS corpus_id, i AS pos, stem || '_' || i || '_link.txt' AS file_name
  FROM (SELECT *, unnest(range(1, n_videos + 1)) AS i FROM files))""",
        """links AS (SELECT l.file_name, min(video_url) AS url FROM listed l JOIN children c ON c.corpus_id = l.corpus_id
  AND c.pos = 2 * l.pos WHERE kind = 'video' GROUP BY 1)""",
        final="""SELECT corpus_id, pos, file_name, coalesce(url, 'videos/' || file_name) AS video_url,
regexp_extract(url, '//([^/]+)/', 1) AS platform FROM listed LEFT JOIN links USING (file_name)""")),
    "video_links": (video_links, O.with_(O.CHILDREN, final="""SELECT file_name, video_url || '&c=1' AS url,
regexp_extract(video_url, '//([^/]+)/', 1) AS host, regexp_extract(video_url, 'src=(.*)$', 1) AS src, '1' AS c
FROM children WHERE kind = 'video'""")),
}
