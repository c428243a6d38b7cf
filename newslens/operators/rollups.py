"""Views, monthly statistics and declared rollup tables.

Score rows are summed per article before they meet the corpus. Both join sides
are then unique on the article id, so an article with very many scores cannot
overload a task, and ``COUNT(*)`` over the plain left join is the sum of
``max(1, scores)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from newslens import constants as K
from newslens.functions.dates import in_month, month_end, month_of
from newslens.functions.numbers import percent
from newslens.operators.ranking import number_rows, top_per_group
from newslens.operators.skew import bounded_broadcast
from newslens.session import written
from newslens.sources.keyed_table import KeyedTable


def per_article(scores: DataFrame) -> DataFrame:
    is_class = {name: F.col("sentiment") == name for name in K.SENTIMENTS}
    return scores.groupBy(F.col("corpus_id").alias("id")).agg(
        F.count("*").alias("n_scores"),
        *[F.count_if(cond).alias(f"n_{name}") for name, cond in is_class.items()],
        F.sum("sentiment_score").alias("score_sum"),
        F.count("sentiment_score").alias("score_n"),
    )


def with_scores(corpus: DataFrame, scores: DataFrame) -> DataFrame:
    """Corpus LEFT JOIN summed scores."""
    return corpus.join(per_article(scores), "id", "left")


def _total() -> Column:
    return F.sum(F.coalesce("n_scores", F.lit(1)))


def _class(name: str) -> Column:
    return F.coalesce(F.sum(f"n_{name}"), F.lit(0))


def _mean_score() -> Column:
    n = F.sum("score_n")
    return F.when(n > 0, F.sum("score_sum").cast("double") / n)


def corpus_statistics(corpus: DataFrame) -> DataFrame:
    """Articles by source, type and month; undated ones form their own row."""
    return corpus.groupBy("source", "content_type", month_of(F.col("publish_date")).alias("month")).agg(
        F.count("*").alias("n"))


def sentiment_statistics(corpus: DataFrame, scores: DataFrame) -> DataFrame:
    """Count and mean score by source and class, with a NULL class (A10)."""
    summed = scores.groupBy(F.col("corpus_id").alias("id"), "sentiment").agg(
        F.count("*").alias("n_scores"), F.sum("sentiment_score").alias("score_sum"),
        F.count("sentiment_score").alias("score_n"))
    joined = corpus.select("id", "source").join(summed, "id", "left")
    return joined.groupBy("source", "sentiment").agg(
        _total().alias("n"), _mean_score().alias("avg_score"))


def sentiment_overview(corpus: DataFrame, scores: DataFrame) -> DataFrame:
    """Monthly class counts, mean score and positive rate per source."""
    dated = corpus.where(F.col("publish_date").isNotNull()).select("id", "source", "publish_date")
    return with_scores(dated, scores).groupBy(
        month_of(F.col("publish_date")).alias("month"), "source"
    ).agg(
        _total().alias("total_articles"), _class("positive").alias("positive_count"),
        _class("neutral").alias("neutral_count"), _class("negative").alias("negative_count"),
        _mean_score().alias("avg_sentiment_score"),
    ).withColumn("positive_rate", percent(F.col("positive_count"), F.col("total_articles"), 2))


def newest_first(rows: DataFrame, then: list[str], month: str = "month") -> DataFrame:
    """Rows numbered as the views list them: months descending, then by ``then``."""
    return number_rows(rows, [F.desc(month), *map(F.col, then)], "row_no").orderBy("row_no")


def content_type_stats(corpus: DataFrame) -> DataFrame:
    """Monthly counts per type with mean media counts and distinct media."""
    dated = corpus.where(F.col("publish_date").isNotNull())
    return dated.groupBy(month_of(F.col("publish_date")).alias("month"), "content_type", "source").agg(
        F.count("*").alias("n"), F.avg("image_count").alias("avg_images"),
        F.avg("video_count").alias("avg_videos"), F.count_distinct("media_name").alias("media_count"))


PARTS = ("total_articles", "text_articles", "image_articles", "video_articles",
         *[f"{name}_articles" for name in K.SENTIMENTS], "score_sum", "score_n", "total_images", "total_videos")


def monthly_parts(corpus: DataFrame, scores: DataFrame) -> DataFrame:
    """Sums per month and source that may be added to, and taken from, one another (A13, ST3).

    ``corpus`` has dated articles; only their scores are summed.
    """
    published = F.col("publish_date")
    # media totals and flags count once per joined row, as in the plain left join
    weight = F.coalesce("n_scores", F.lit(1))

    def rows_where(condition: Column) -> Column:
        return F.sum(F.when(condition, weight).otherwise(0))

    return with_scores(corpus.select(
        "id", "source", "publish_date", "content_type", "image_count", "video_count"), scores
    ).groupBy(month_of(published).alias("stat_month"), "source").agg(
        _total().alias("total_articles"),
        rows_where(F.col("content_type") == "text").alias("text_articles"),
        rows_where(F.col("image_count") > 0).alias("image_articles"),
        rows_where(F.col("video_count") > 0).alias("video_articles"),
        *[_class(name).alias(f"{name}_articles") for name in K.SENTIMENTS],
        F.coalesce(F.sum("score_sum"), F.lit(0)).cast("decimal(28,2)").alias("score_sum"),
        F.coalesce(F.sum("score_n"), F.lit(0)).alias("score_n"),
        F.sum(F.col("image_count") * weight).alias("total_images"),
        F.sum(F.col("video_count") * weight).alias("total_videos"),
    )


def statistics_of(parts: DataFrame) -> DataFrame:
    """Rows of ``media_statistics`` from their parts."""
    mean = F.when(F.col("score_n") > 0, F.col("score_sum").cast("double") / F.col("score_n"))
    kept = [c for c in PARTS if c not in ("score_sum", "score_n")]
    return parts.select("stat_month", "source", *kept[:-2], mean.alias("avg_sentiment_score"), *kept[-2:],
                        month_end(F.col("stat_month")).alias("stat_date"))


def monthly_statistics(corpus: DataFrame, scores: DataFrame, month: str | None = None) -> DataFrame:
    """Rows of ``media_statistics`` for one month or for every dated month."""
    published = F.col("publish_date")
    if month is None:
        return statistics_of(monthly_parts(corpus.where(published.isNotNull()), scores))
    chosen = corpus.where(in_month(published, month))
    # scores of other months never reach the sum
    own = scores.join(chosen.select(F.col("id").alias("corpus_id")), "corpus_id", "left_semi")
    return statistics_of(monthly_parts(chosen, own))


def month_parts_table(spark: SparkSession, path: str) -> KeyedTable:
    kinds = {"score_sum": "decimal(28,2)"}
    fields = ", ".join(f"{c} {kinds.get(c, 'long')}" for c in PARTS)
    return KeyedTable(spark, path, spark.createDataFrame([], f"stat_month string, source string, {fields}").schema,
                      ["stat_month", "source"], buckets=16, parts=1)


def change_months(table: KeyedTable, added: DataFrame | None, removed: DataFrame | None, upto: int | None = None) -> None:
    """Add the parts of new articles to their months, and take those of removed ones away.

    An article whose scores or media change is removed as it was and added as it is. A month without articles of a
    source has no row there any more.
    """
    changes = None
    for parts, sign in ((added, 1), (removed, -1)):
        if parts is not None:
            signed = parts.select("stat_month", "source", *[(F.col(c) * sign).alias(c) for c in PARTS])
            changes = signed if changes is None else changes.unionByName(signed)
    summed = changes.groupBy("stat_month", "source").agg(*[F.sum(c).alias(c) for c in PARTS])
    table.add_up(summed, upto, alive=F.col("total_articles") != 0)


def replace_months(statistics: DataFrame, path: str) -> None:
    """Overwrite exactly the month partitions that ``statistics`` holds.

    A month is one row per source, so each goes to a single file.
    """
    statistics.repartition("stat_month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "stat_month").parquet(path)


def drop_months(spark: SparkSession, months: list[str], path: str) -> None:
    """Remove the partitions of months; those that are not there are passed over."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    for month in months:
        folder = hadoop(f"{path}/stat_month={month}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def update_month(corpus: DataFrame, scores: DataFrame, month: str, path: str) -> DataFrame:
    """Recompute one month in place and return the status row.

    A month without articles any more loses its partition: an overwrite alone
    touches no partition that it has no rows for.
    """
    rows = monthly_statistics(corpus, scores, month)
    if corpus.where(in_month(F.col("publish_date"), month)).isEmpty():
        drop_months(corpus.sparkSession, [month], path)
    else:
        replace_months(rows, path)
    return corpus.sparkSession.range(1).select(
        F.lit(f"Updated statistics for month: {month}").alias("result"))


def child_counts(corpus: DataFrame, children: DataFrame) -> DataFrame:
    """Corpus with current image and video counts."""
    counted = children.groupBy(F.col("corpus_id").alias("id")).agg(
        F.count_if(F.col("kind") == "image").alias("image_count"),
        F.count_if(F.col("kind") == "video").alias("video_count"))
    return corpus.drop("image_count", "video_count").join(counted, "id", "left").na.fill(
        0, ["image_count", "video_count"])


def monthly_sentiment(corpus: DataFrame, scores: DataFrame) -> DataFrame:
    """Scored rows per month and class; unscored articles drop out."""
    summed = scores.groupBy(F.col("corpus_id").alias("id"), "sentiment").agg(F.count("*").alias("n"))
    return corpus.select("id", "publish_date").join(summed, "id").groupBy(
        month_of(F.col("publish_date")).alias("month"), "sentiment").agg(F.sum("n").alias("n"))


def daily_statistics(corpus: DataFrame, scores: DataFrame) -> DataFrame:
    """``statistics``: one row per date and source."""
    dated = corpus.where(F.col("publish_date").isNotNull())
    joined = with_scores(dated.select("id", "source", "publish_date", "content_type"), scores)
    typed = {t: F.count_if(F.col("content_type") == t) for t in K.CONTENT_TYPES}
    return joined.groupBy(F.col("publish_date").alias("stat_date"), "source").agg(
        F.count("*").alias("total_count"),
        *[n.alias(f"{t}_count") for t, n in typed.items()],
        *[_class(name).alias(f"{name}_count") for name in K.SENTIMENTS],
        _mean_score().alias("avg_sentiment"))


def _heat(counts: DataFrame, groups: list[str], n: str, out: str) -> DataFrame:
    """``100 * n / max(n)`` inside each group.

    The maxima are aggregated and joined back: a window would sort a whole
    group, such as the vocabulary of a busy day, in one task. The counts are
    stored, so they are made once; the maxima, one row per group, are broadcast
    after a check of their number, and the counts stay where they are.
    """
    counts = written(counts, "heat-counts")
    peak = written(counts.groupBy(*groups).agg(F.max(n).alias("_peak")), "heat-maxima")
    return counts.join(bounded_broadcast(peak), groups).withColumn(
        out, percent(F.col(n), F.col("_peak"), 2)).drop("_peak")


def _added_by_source(counted: DataFrame) -> DataFrame:
    """Rows (word, source, stat_date, frequency) added up per source and over all sources.

    One shuffle and one sort serve both sums, and a task holds no table of its
    keywords. The submission's number of partitions is kept: merged by their
    size, as adaptive execution does, short rows take many times it in memory.
    """
    partitions = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = counted.select(F.col("word").alias("keyword"), "source", "stat_date", "frequency").repartition(
        partitions, "keyword", "stat_date")
    whole = (Window.unboundedPreceding, Window.unboundedFollowing)
    keyword = Window.partitionBy("keyword", "stat_date").orderBy("source")
    source = Window.partitionBy("keyword", "stat_date", "source").orderBy("frequency")
    per_source = rows.withColumns({
        "n": F.sum("frequency").over(source.rowsBetween(*whole)), "_row": F.row_number().over(source),
    }).where("_row = 1")
    both = per_source.withColumns({
        "_all": F.sum("n").over(keyword.rowsBetween(*whole)), "_row": F.row_number().over(keyword)})
    own = F.struct("source", "n")
    first = F.array(own, F.struct(F.lit("all").alias("source"), F.col("_all").alias("n")))
    return both.select("keyword", "stat_date", F.explode_outer(F.when(F.col("_row") == 1, first).otherwise(
        F.array(own))).alias("_s")).select("keyword", "_s.source", "stat_date", "_s.n")


def hot_keywords(tokens: DataFrame, k: int | None = None) -> DataFrame:
    """Keyword counts per date and source, and over all sources.

    ``tokens`` has (word, source, stat_date). Counts are made per source first;
    the ``all`` rows only add these up. With ``k``, the hottest ``k`` keywords
    of each date and source; the peak is then the first of them.

    Tokens counted by article, with a ``frequency``, suit dates that few
    articles share: adding up before the shuffle would then hold nearly every
    row in memory and save little.
    """
    if "frequency" in tokens.columns:
        counts = _added_by_source(tokens)
    else:
        per_source = tokens.groupBy(F.col("word").alias("keyword"), "source", "stat_date").agg(
            F.count("*").alias("n"))
        overall = per_source.groupBy("keyword", "stat_date").agg(F.sum("n").alias("n")).withColumn(
            "source", F.lit("all"))
        counts = per_source.unionByName(overall)
    groups = ["stat_date", "source"]  # null dates and sources have no heat
    if k is None:
        return _heat(counts, groups, "n", "heat_score")
    top = top_per_group(counts, groups, [F.desc("n"), F.col("keyword")], k)
    peak = F.max("n").over(Window.partitionBy(*groups))  # over k rows
    return top.withColumn("heat_score", percent(F.col("n"), peak, 2))


def media_activity(corpus: DataFrame) -> DataFrame:
    """Articles and activity per medium and month (D3)."""
    counted = corpus.where(F.col("publish_date").isNotNull()).groupBy(
        "media_name", "source", month_of(F.col("publish_date")).alias("stat_month")
    ).agg(F.count("*").alias("article_count"))
    return _heat(counted, ["stat_month"], "article_count", "activity_score")


ERRORS_SHOWN = 20


def load_counters(parsed: DataFrame, status: str = "status") -> DataFrame:
    """Rows that were loaded and rows that failed."""
    ok = F.col(status) == "success"
    return parsed.agg(F.count_if(ok).alias("processed"), F.count_if(~ok).alias("failed"))


def error_message(problems: DataFrame, path: str = "path", problem: str = "problem", shown: int = ERRORS_SHOWN) -> Column:
    """The first ``shown`` problems by file, one a line, NULL without any: a top-k, whatever their number."""
    first = problems.where(F.col(problem).isNotNull()).orderBy(path, problem).limit(shown).agg(
        F.array_sort(F.collect_list(F.concat(F.col(path), F.lit(": "), F.col(problem)))).alias("lines"))
    return first.select(F.nullif(F.array_join("lines", "\n"), F.lit(""))).scalar()


def processing_log(counted: DataFrame, process_type: str, error: Column | None = None) -> DataFrame:
    """One log row for a finished job (D7), without its two clock columns."""
    failed = F.col("failed")
    return counted.select(
        F.lit(process_type).alias("process_type"),
        F.when((failed > 0) & (F.col("processed") == 0), "failed").otherwise("success").alias("status"),
        F.col("processed").alias("processed_count"),
        (F.lit(None).cast("string") if error is None else error).alias("error_message"),
        F.to_json(F.struct("processed", "failed")).alias("details"),
    )


def media_reach(corpus: DataFrame) -> DataFrame:
    """Sketches of the distinct media of each month, type and source; they merge into any longer span."""
    dated = corpus.where(F.col("publish_date").isNotNull() & F.col("media_name").isNotNull())
    return dated.groupBy(month_of(F.col("publish_date")).alias("month"), "content_type", "source").agg(
        F.hll_sketch_agg("media_name", F.lit(SKETCH_BITS)).alias("sketch"))


SKETCH_BITS = 14
# three standard errors of a merged sketch of 2^14 registers; few keys are counted exactly
SKETCH_ERROR = 3 * 1.04 / 2 ** (SKETCH_BITS / 2)


def merged_reach(sketches: DataFrame, *groups: Column) -> DataFrame:
    """Estimated distinct media of coarser groups, from sketches alone: no article is read again."""
    return sketches.groupBy(*groups).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("media_estimate"))
