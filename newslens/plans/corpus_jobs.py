"""Whole jobs over a folder of article files: term reports, score report, loading."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from newslens import constants as K
from newslens.functions.text import body_by_lines, has_cjk, safe_title, strip, title_from_file_name
from newslens.operators import keywords as W, lifecycle as Y, media as M, rollups as R, sentiment as S, terms
from newslens.schema import IMAGES, KEYWORDS, VIDEOS, conform
from newslens.session import job_tables, written
from newslens.sources import sinks
from newslens.sources.articles import parse_articles, read_articles, with_defaults
from newslens.sources.report import read_report, write_report


def write_term_reports(spark: SparkSession, folder: str, out: str, vocabulary: Iterable[str] | DataFrame = (),
                       as_csv: bool = False) -> None:
    """English and mixed term frequency of a folder, one dataset per sheet."""
    files = read_articles(spark, folder)
    bodies = files.select("value", body_by_lines(F.col("value")).alias("body"))
    english = terms.english_report(bodies)
    sinks.write_sheets({"english_by_count": english.orderBy(F.desc("n"), "word"),
                        "english_by_word": english.orderBy("word")}, out, as_csv)
    mixed = terms.mixed_report(bodies.where(has_cjk(F.col("value"))), vocabulary=vocabulary)
    # three sheets of one small report: computed once, then split
    sinks.write_sheets(terms.sheets(written(mixed, "mixed").orderBy(F.desc("n"), "word")), out, as_csv)


def write_score_report(spark: SparkSession, folder: str, out: str) -> DataFrame:
    """Score whole files, rank them by class, write the report; returns the ranks."""
    files = read_articles(spark, folder).withColumn("title", title_from_file_name(F.col("file_name")))
    scored = S.score_documents(files, "path", "value", ["title"])
    ranked = S.rank_documents(
        scored.withColumn("sentiment", S.classify(F.col("compound"))), tie="path")
    write_report(ranked, out)
    return ranked


@dataclass(frozen=True)
class Loaded:
    """Appended articles with their ids and media, counts of the pass, and (path, problem) of files with one."""

    rows: DataFrame
    processed: int
    failed: int
    problems: DataFrame


def file_problem(value: Column) -> Column:
    """What is wrong with an article file: bytes that are no text (it is left out), or a missing header line."""
    return (F.when(~F.is_valid_utf8(value), UNREADABLE)
            .when(~value.contains(K.TITLE_PREFIX), "no title line").when(~value.contains(K.URL_PREFIX), "no URL line"))


UNREADABLE = "not UTF-8 text"


def load_folder(spark: SparkSession, folder: str, corpus_path: str, existing: DataFrame | None = None) -> Loaded:
    """Parse a folder and append what the corpus does not hold yet, by file path, in one pass over the files.

    Counters are observed while the parsed rows are stored, and problems stand
    beside them, so nothing is read twice to fill the log.
    """
    files = read_articles(spark, folder)
    if existing is not None:
        known = existing.select(F.col("file_path").alias("path"))
        files = files.join(known, "path", "left_anti")
    marked = files.withColumn("problem", file_problem(F.col("value"))).withColumn(
        "value", F.when(F.is_valid_utf8("value"), F.col("value")))
    parsed = with_defaults(parse_articles(marked, ["path", "problem"])).withColumnRenamed("path", "file_path")

    def listed(kind: str):
        return F.coalesce(F.size(F.filter("media", lambda m: m["kind"] == kind)), F.lit(0))

    counted = parsed.withColumns({
        "image_count": listed("image"), "video_count": listed("video"),
        "crawl_date": F.current_timestamp(), "create_time": F.current_timestamp()})
    bad = F.coalesce(F.col("problem") == UNREADABLE, F.lit(False))
    seen = Observation()
    stored = written(counted.observe(seen, F.count_if(~bad).alias("processed"), F.count_if(bad).alias("failed")), "parsed")
    rows = sinks.append_corpus(stored.where(~bad).drop("problem"), corpus_path, [F.col("file_path")], existing)
    problems = stored.where("problem IS NOT NULL").select(F.col("file_path").alias("path"), "problem")
    return Loaded(rows, seen.get["processed"], seen.get["failed"], problems)


def load_articles(spark: SparkSession, folder: str, corpus_path: str,
                  existing: DataFrame | None = None) -> DataFrame:
    """The articles that ``load_folder`` appends, with their ids and lists of media."""
    return load_folder(spark, folder, corpus_path, existing).rows


def unreadable(spark: SparkSession, folder: str) -> DataFrame:
    """Paths of the article files of a folder that are no UTF-8 text."""
    return read_articles(spark, folder).where(~F.is_valid_utf8("value")).select("path")


def load_media(spark: SparkSession, loaded: DataFrame, out: str) -> None:
    """Append the images and videos that new articles list."""
    for name, rows, form in (("images", M.image_rows(loaded), IMAGES), ("videos", M.video_rows(loaded), VIDEOS)):
        path = f"{out}/{name}"
        sinks.append_children(rows, form, path, [F.col("corpus_id"), F.col("pos")], stored_table(spark, path))


def write_keywords(spark: SparkSession, out: str) -> DataFrame:
    """Write the keywords of the whole corpus anew and return them.

    Weights depend on all articles, so a load changes those of older ones too.
    """
    corpus = spark.read.parquet(f"{out}/corpus")
    words = W.document_keywords(corpus).withColumnRenamed("id", "corpus_id").withColumn(
        "keyword_type", F.lit(K.DEFAULT_KEYWORD_TYPE))
    rows = conform(sinks.assign_ids(words, [F.col("corpus_id"), F.col("rank_no")]), KEYWORDS)
    rows.write.mode("overwrite").parquet(f"{out}/keywords")
    return rows


def load_scores(spark: SparkSession, report: str, corpus: DataFrame, scores_path: str,
                existing: DataFrame | None = None, strict_title: bool = False) -> DataFrame:
    """Read a report, match titles, append the hits; returns hits and misses by row.

    Articles that ``existing`` holds scores of get no further ones.

    The report knows file names only. Unless ``strict_title``, corpus titles are
    compared in their file-safe form; else titles with refused characters miss.
    """
    title = F.col("title") if strict_title else strip(safe_title(F.col("title")))
    scores = written(S.load_form(read_report(spark, report)), "scores")
    matched = written(S.match_by_title(
        scores, corpus.select("id", title.alias("title")), fold=not strict_title), "matched")
    new = matched if existing is None else matched.join(existing.select("corpus_id").distinct(), "corpus_id", "left_anti")
    sinks.append_sentiment(new, scores_path, [F.col("file_path"), F.col("block"), F.col("line_id")], existing)
    return matched.withColumn("status", F.when(F.col("corpus_id").isNull(), "failed").otherwise("success"))


def stored_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path`` as it is now, None before the first load.

    Its rows are stored apart, since the load appends to the folder it reads.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return None
    table = spark.read.parquet(path)
    keys = [c for c in ("id", "file_path", "corpus_id") if c in table.columns]
    return written(table.select(*keys), "loaded-keys")


def load_all(spark: SparkSession, folder: str, report: str, out: str) -> None:
    """Articles with their media, then scores, then keywords, and one log row for each step.

    May be run again: what the tables hold already is neither loaded nor
    numbered twice. Files that cannot be read count as failed, each time.
    Intermediate tables are removed at the end.
    """
    with job_tables(spark):
        _load_all(spark, folder, report, out)


def _load_all(spark: SparkSession, folder: str, report: str, out: str) -> None:
    def log(rows: DataFrame, step: str) -> None:
        sinks.append_log(R.processing_log(R.load_counters(rows), step), f"{out}/logs", start, datetime.now())

    start = datetime.now()
    loaded = load_folder(spark, folder, f"{out}/corpus", stored_table(spark, f"{out}/corpus"))
    load_media(spark, loaded.rows, out)
    sinks.append_problems(loaded.problems, f"{out}/problems", start)
    counted = spark.createDataFrame([(loaded.processed, loaded.failed)], "processed long, failed long")
    sinks.append_log(R.processing_log(counted, "crawl", R.error_message(loaded.problems)), f"{out}/logs", start, datetime.now())
    start = datetime.now()
    corpus = spark.read.parquet(f"{out}/corpus")
    log(load_scores(spark, report, corpus, f"{out}/sentiment", stored_table(spark, f"{out}/sentiment")),
        "sentiment_analysis")
    start = datetime.now()
    log(write_keywords(spark, out).select(F.lit("success").alias("status")), "keyword_extraction")


def split_by_age(spark: SparkSession, folder: str, first_year: int = K.RETENTION_FIRST_YEAR,
                 extended: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(keep, purge, media of purged articles) for a folder; nothing is deleted."""
    articles = parse_articles(read_articles(spark, folder), ["path"]).drop("url_date")
    keep, purge = Y.retention_split(articles, first_year, extended=extended)
    media = purge.select("path", F.explode("media").alias("m")).select("path", "m.kind", "m.file_name")
    return keep, purge, media
