"""Table schemas and the checks that stand in for enums, keys and lengths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType, BooleanType, DateType, DecimalType, IntegerType, LongType, StringType,
    StructField, StructType, TimestampType,
)

from newslens import constants as K


def _struct(*fields: tuple) -> StructType:
    return StructType([StructField(name, kind, nullable) for name, kind, nullable in fields])


CORPUS = _struct(
    ("id", LongType(), False), ("title", StringType(), False), ("content", StringType(), True),
    ("url", StringType(), True), ("source", StringType(), False), ("media_name", StringType(), True),
    ("content_type", StringType(), False), ("file_path", StringType(), True),
    ("image_url", StringType(), True), ("video_url", StringType(), True),
    ("image_count", IntegerType(), True), ("video_count", IntegerType(), True),
    ("publish_date", DateType(), True), ("crawl_date", TimestampType(), True),
    ("create_time", TimestampType(), True),
)

_RATE = DecimalType(5, 2)
SENTIMENT = _struct(
    ("id", LongType(), False), ("corpus_id", LongType(), False), ("sentiment", StringType(), False),
    # 0..10; one digit wider than the first table layout, which cannot hold 10.00
    ("sentiment_score", DecimalType(4, 2), True),
    ("confidence", _RATE, True), ("positive_rate", _RATE, True), ("negative_rate", _RATE, True),
    ("neutral_rate", _RATE, True), ("emotion_joy", _RATE, True), ("emotion_trust", _RATE, True),
    ("emotion_fear", _RATE, True), ("emotion_surprise", _RATE, True),
    ("fits_v1_schema", BooleanType(), True),
    ("analysis_method", StringType(), True), ("analysis_time", TimestampType(), True),
)

IMAGES = _struct(
    ("id", LongType(), False), ("corpus_id", LongType(), False), ("file_name", StringType(), False),
    ("file_path", StringType(), False), ("width", IntegerType(), True),
    ("height", IntegerType(), True), ("format", StringType(), True),
)

VIDEOS = _struct(
    ("id", LongType(), False), ("corpus_id", LongType(), False), ("file_name", StringType(), False),
    ("video_url", StringType(), False), ("platform", StringType(), True),
    ("duration", IntegerType(), True),
)

KEYWORDS = _struct(
    ("id", LongType(), False), ("corpus_id", LongType(), False), ("keyword", StringType(), False),
    ("keyword_type", StringType(), True), ("frequency", IntegerType(), True),
    ("weight", DecimalType(18, 2), True),  # a word repeated in a long article outgrows (5, 2)
)

MEDIA_STATISTICS = _struct(
    ("stat_date", DateType(), False), ("stat_month", StringType(), False),
    ("source", StringType(), False), ("total_articles", LongType(), True),
    ("text_articles", LongType(), True), ("image_articles", LongType(), True),
    ("video_articles", LongType(), True), ("positive_articles", LongType(), True),
    ("neutral_articles", LongType(), True), ("negative_articles", LongType(), True),
    ("avg_sentiment_score", DecimalType(6, 3), True), ("total_images", LongType(), True),
    ("total_videos", LongType(), True),
)

MEDIA_REF = ArrayType(_struct(
    ("pos", IntegerType(), True), ("kind", StringType(), True), ("file_name", StringType(), True),
    ("width", IntegerType(), True), ("height", IntegerType(), True),
))

PROCESSING_LOG = _struct(
    ("process_type", StringType(), False), ("status", StringType(), False),
    ("start_time", TimestampType(), False), ("end_time", TimestampType(), True),
    ("processed_count", LongType(), True), ("error_message", StringType(), True), ("details", StringType(), True),
)

# v1 name <- superset name
CORPUS_V1 = {
    "id": "id", "title": "title", "content": "content", "source": "source",
    "media_name": "media_name", "type": "content_type", "file_path": "file_path",
    "image_url": "image_url", "video_url": "video_url", "publish_date": "publish_date",
    "create_time": "create_time",
}


def as_corpus_v1(corpus: DataFrame) -> DataFrame:
    """The first table layout as a projection of the superset."""
    return corpus.select(*[F.col(have).alias(name) for name, have in CORPUS_V1.items()])


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project ``df`` to ``schema``; columns it lacks become NULL."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def corpus_rules(sources=K.SOURCES, types=K.CONTENT_TYPES) -> dict[str, Column]:
    """Violation name -> condition that is true on a bad corpus row."""
    return {
        "title_missing": F.col("title").isNull(),
        "title_too_long": F.length("title") > K.TITLE_MAX,
        "url_too_long": F.length("url") > K.URL_MAX,
        "media_name_too_long": F.length("media_name") > K.MEDIA_NAME_MAX,
        "source_not_allowed": F.col("source").isNull() | ~F.col("source").isin(*sources),
        "type_not_allowed": F.col("content_type").isNull() | ~F.col("content_type").isin(*types),
    }


def sentiment_rules(labels=K.SENTIMENTS) -> dict[str, Column]:
    return {
        "corpus_id_missing": F.col("corpus_id").isNull(),
        "sentiment_not_allowed": F.col("sentiment").isNull() | ~F.col("sentiment").isin(*labels),
        "score_does_not_fit": F.abs("sentiment_score") >= 10,
    }


def image_rules(formats=K.IMAGE_FORMATS) -> dict[str, Column]:
    return {
        "corpus_id_missing": F.col("corpus_id").isNull(),
        "file_name_missing": F.col("file_name").isNull(),
        "file_path_too_long": F.length("file_path") > K.PATH_MAX,
        "format_not_allowed": F.col("format").isNotNull() & ~F.col("format").isin(*formats),
        "size_not_positive": (F.col("width") <= 0) | (F.col("height") <= 0),
    }


def video_rules() -> dict[str, Column]:
    return {
        "corpus_id_missing": F.col("corpus_id").isNull(),
        "file_name_missing": F.col("file_name").isNull(),
        "video_url_missing": F.col("video_url").isNull(),
        "video_url_too_long": F.length("video_url") > K.URL_MAX,
        "duration_negative": F.col("duration") < 0,
    }


def keyword_rules(types=K.KEYWORD_TYPES) -> dict[str, Column]:
    return {
        "corpus_id_missing": F.col("corpus_id").isNull(),
        "keyword_missing": F.col("keyword").isNull(),
        "keyword_too_long": F.length("keyword") > K.KEYWORD_MAX,
        "keyword_type_not_allowed": F.col("keyword_type").isNotNull() & ~F.col("keyword_type").isin(*types),
        # the first table layout has five digits for weights
        "weight_does_not_fit": F.abs("weight") >= 1000,
    }


def log_rules(types=K.PROCESS_TYPES, states=K.PROCESS_STATES) -> dict[str, Column]:
    return {
        "process_type_not_allowed": F.col("process_type").isNull() | ~F.col("process_type").isin(*types),
        "status_not_allowed": F.col("status").isNull() | ~F.col("status").isin(*states),
        "count_negative": F.col("processed_count") < 0,
        "ends_before_start": F.col("end_time") < F.col("start_time"),
    }


def violations(df: DataFrame, rules: dict[str, Column], id_col: str = "id") -> DataFrame:
    """One row per broken rule (C1): narrow, no shuffle."""
    marks = [F.when(bad, F.lit(name)) for name, bad in rules.items()]
    return df.select(
        F.col(id_col).alias("row_id"), F.explode(F.array_compact(F.array(*marks))).alias("rule")
    )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str = "id") -> DataFrame:
    """Child keys without a parent row (J8), with their row counts.

    Children are counted per key before the join, so a key that owns a large
    share of the rows crosses the network as one row per task.
    """
    counted = child.groupBy(F.col(child_key).alias(parent_key)).agg(F.count("*").alias("n_rows"))
    return counted.join(parent.select(parent_key), parent_key, "left_anti")


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Upsert rule for unique keys (C2): the newest row of each key stays."""
    from newslens.operators.ranking import first_per_group

    return first_per_group(df, keys, order)

