"""Article folders, URL sheets, stored results and video links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from newslens import constants as K
from newslens.functions import text as T
from newslens.functions.dates import date_from_text, date_from_url
from newslens.functions.urls import url_host, url_param


def plain_name(encoded: Column) -> Column:
    """A file name as it is on disk: file metadata holds it percent-encoded."""
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def read_articles(spark: SparkSession, folder: str) -> DataFrame:
    """Every ``.txt`` file of a folder as (path, file_name, value) (S1); line ends become ``\\n``."""
    files = spark.read.text(folder, wholetext=True, pathGlobFilter="*.txt")
    return files.select(
        plain_name(F.col("_metadata.file_path")).alias("path"),
        plain_name(F.col("_metadata.file_name")).alias("file_name"),
        F.replace(F.replace("value", F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n")).alias("value"))


def parse_articles(files: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Article files (file_name, value) to parsed rows."""
    value = F.col("value")
    header = files.select(
        *(keep or []), "file_name", "value",
        T.header_title(value, F.col("file_name")).alias("title"), T.header_url(value).alias("url"),
        T.content_by_rules(value).alias("_content"))
    return header.select(
        *(keep or []), "file_name", "title", "url",
        T.strip(F.col("_content")).alias("content"),
        T.body_by_lines(value).alias("body"),
        date_from_text(F.col("_content")).alias("publish_date"),
        date_from_url(F.col("url")).alias("url_date"),
        value.contains(K.IMAGE_LIST).alias("has_images"),
        T.guessed_image_url(F.col("title"), value).alias("image_url"),
        T.media_list(value).alias("media"),
    )


def with_defaults(parsed: DataFrame) -> DataFrame:
    """Default source, medium and type."""
    defaults = {"source": K.DEFAULT_SOURCE, "media_name": K.DEFAULT_MEDIA,
                "content_type": K.DEFAULT_TYPE, "video_url": None}
    have = set(parsed.columns)
    return parsed.withColumns({
        name: F.coalesce(F.col(name), F.lit(value)) if name in have else F.lit(value).cast("string")
        for name, value in defaults.items()})


def resolve_sheet(sheet: DataFrame) -> DataFrame:
    """Rename the first title and URL alias that is present."""
    def pick(aliases: tuple[str, ...], what: str) -> str:
        for alias in aliases:
            if alias in sheet.columns:
                return alias
        raise ValueError(f"no {what} column; the sheet has {sheet.columns}")

    title, url = pick(K.TITLE_ALIASES, "title"), pick(K.URL_ALIASES, "URL")
    rest = [F.col(f"`{c}`") for c in sheet.columns if c not in (title, url)]
    return sheet.select(F.col(f"`{title}`").cast("string").alias("title"),
                        F.col(f"`{url}`").cast("string").alias("url"), *rest)


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """A URL sheet from CSV (with a header line) or Parquet."""
    if path.endswith(".csv"):
        return resolve_sheet(spark.read.csv(path, header=True, multiLine=True, escape='"'))
    return resolve_sheet(spark.read.parquet(path))


def parse_video_links(lines: DataFrame, value: str = "value") -> DataFrame:
    """``视频链接: <url>`` rows to URL, host and the two player parameters."""
    url = F.regexp_extract(F.col(value), rf"{K.VIDEO_LINK_PREFIX} ?(\S+)", 1)
    found = lines.withColumn("url", url).where("url != ''")
    return found.withColumns({
        "host": url_host(F.col("url")), "src": url_param(F.col("url"), "src"),
        "c": url_param(F.col("url"), "c")})


def read_video_links(spark: SparkSession, folder: str) -> DataFrame:
    files = spark.read.text(folder, wholetext=True, pathGlobFilter="*.txt")
    return parse_video_links(files.select(plain_name(F.col("_metadata.file_name")).alias("file_name"), "value"))


def read_sheet_rows(spark: SparkSession, path: str, lang: str, k: int = K.SHEET_ROWS) -> DataFrame:
    """The first ``k`` rows of one stored result sheet."""
    return spark.read.parquet(path).where(F.col("lang") == lang).orderBy(F.desc("n"), "word").limit(k)
