"""Rollups, quality reports, constraints, keywords, search and life cycle."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from newslens import schema
from newslens.operators import keywords as W, lifecycle as Y, quality as Q, rollups as R, search as X

from .conftest import rows

JAN, FEB = datetime.date(2024, 1, 31), datetime.date(2024, 2, 1)


@pytest.fixture
def corpus(spark):
    return spark.createDataFrame([
        (1, "t1", "good news", "http://u/1", "china", "M1", "text", None, JAN, 0, 0),
        (2, "t2", "bad news", "http://u/2", "china", "M2", "image", "images/t2_1.jpg", JAN, 2, 0),
        (3, "t1", "", "http://u/3", "usa", "M1", "video", None, FEB, 0, 1),
        (4, "", None, "http://u/4", "china", "M1", "text", None, None, 1, 1),
    ], "id long, title string, content string, url string, source string, media_name string, "
       "content_type string, image_url string, publish_date date, image_count int, video_count int")


@pytest.fixture
def scores(spark):
    # article 1 is scored twice, article 3 not at all
    return spark.createDataFrame([
        (1, "positive", Decimal("9.00")), (1, "neutral", Decimal("5.00")),
        (2, "negative", Decimal("1.00")), (4, "neutral", Decimal("4.00")),
    ], "corpus_id long, sentiment string, sentiment_score decimal(4,2)")


def sql(spark, corpus, scores, text):
    corpus.createOrReplaceTempView("c")
    scores.createOrReplaceTempView("s")
    return spark.sql(text)


def test_views_equal_the_plain_left_join(spark, corpus, scores):
    plain = sql(spark, corpus, scores, """
        SELECT date_format(publish_date, 'yyyy-MM') month, source, count(*) total_articles,
          count_if(sentiment = 'positive') positive_count, count_if(sentiment = 'neutral') neutral_count,
          count_if(sentiment = 'negative') negative_count, cast(avg(sentiment_score) as double) avg_sentiment_score
        FROM c LEFT JOIN s ON c.id = s.corpus_id WHERE publish_date IS NOT NULL GROUP BY 1, 2""")
    ours = R.sentiment_overview(corpus, scores)
    assert rows(ours, *plain.columns) == rows(plain)
    assert rows(ours, "month", "source", "positive_rate") == [("2024-01", "china", 33.33), ("2024-02", "usa", 0.0)]
    plain = sql(spark, corpus, scores, """SELECT source, sentiment, count(*) n, cast(avg(sentiment_score) as double) avg_score
        FROM c LEFT JOIN s ON c.id = s.corpus_id GROUP BY 1, 2""")
    assert rows(R.sentiment_statistics(corpus, scores), *plain.columns) == rows(plain)
    assert ("usa", None, 1, None) in rows(plain)


def test_monthly_statistics(corpus, scores):
    r = R.monthly_statistics(corpus, scores, "2024-01").first()
    # joined rows: article 1 twice, article 2 once
    assert (r.stat_date, r.source, r.total_articles, r.text_articles, r.image_articles, r.total_images) == (
        JAN, "china", 3, 2, 1, 2)
    assert (r.positive_articles, r.neutral_articles, r.negative_articles, r.avg_sentiment_score) == (1, 1, 1, 5.0)
    assert R.monthly_statistics(corpus, scores, "2030-01").count() == 0
    assert rows(R.monthly_statistics(corpus, scores), "stat_month", "source", "video_articles") == [
        ("2024-01", "china", 0), ("2024-02", "usa", 1)]


def test_replacing_a_month_keeps_the_others(spark, corpus, scores, tmp_path):
    path = str(tmp_path / "stats")
    R.replace_months(R.monthly_statistics(corpus, scores), path)
    status = R.update_month(corpus.where("id <> 2"), scores, "2024-01", path).first().result
    assert status.endswith("2024-01")
    assert rows(spark.read.parquet(path).select(F.col("stat_month").cast("string"), "total_articles")) == [
        ("2024-01", 2), ("2024-02", 1)]
    # a month without articles goes, the other stays
    R.update_month(corpus.where("id > 2"), scores, "2024-01", path)
    assert rows(spark.read.parquet(path).select(F.col("stat_month").cast("string"))) == [("2024-02",)]


def test_other_rollups(corpus, scores):
    assert ("china", "text", None, 1) in rows(R.corpus_statistics(corpus), "source", "content_type", "month", "n")
    assert rows(R.content_type_stats(corpus), "month", "content_type", "n", "avg_images", "media_count") == [
        ("2024-01", "image", 1, 2.0, 1), ("2024-01", "text", 1, 0.0, 1), ("2024-02", "video", 1, 0.0, 1)]
    assert rows(R.monthly_sentiment(corpus, scores)) == [
        (None, "neutral", 1), ("2024-01", "negative", 1), ("2024-01", "neutral", 1), ("2024-01", "positive", 1)] or len(
        rows(R.monthly_sentiment(corpus, scores))) == 4
    daily = {(r.stat_date, r.source): r for r in R.daily_statistics(corpus, scores).collect()}
    assert daily[(JAN, "china")].total_count == 2 and daily[(JAN, "china")].avg_sentiment == 5.0
    assert daily[(FEB, "usa")].avg_sentiment is None and daily[(FEB, "usa")].positive_count == 0
    assert rows(R.media_activity(corpus), "media_name", "stat_month", "article_count", "activity_score") == [
        ("M1", "2024-01", 1, 100.0), ("M1", "2024-02", 1, 100.0), ("M2", "2024-01", 1, 100.0)]


def test_child_counts(spark, corpus):
    children = spark.createDataFrame([(1, "image"), (1, "image"), (1, "video"), (9, "image")], "corpus_id long, kind string")
    got = rows(R.child_counts(corpus, children), "id", "image_count", "video_count")
    assert got == [(1, 2, 1), (2, 0, 0), (3, 0, 0), (4, 0, 0)]


def test_hot_keywords(spark):
    tokens = spark.createDataFrame(
        [("a", "china")] * 4 + [("b", "china")] + [("b", "usa")] * 2 + [("c", "usa")], "word string, source string"
    ).withColumn("stat_date", F.lit("2024-01-01").cast("date"))
    full = R.hot_keywords(tokens)
    got = {(r.keyword, r.source): (r.n, r.heat_score) for r in full.collect()}
    assert got == {("a", "china"): (4, 100.0), ("b", "china"): (1, 25.0), ("b", "usa"): (2, 100.0), ("c", "usa"): (1, 50.0),
                   ("a", "all"): (4, 100.0), ("b", "all"): (3, 75.0), ("c", "all"): (1, 25.0)}
    everywhere = sum(n for (k, s), (n, _) in got.items() if s == "all")
    assert everywhere == sum(n for (k, s), (n, _) in got.items() if s != "all")
    top = rows(R.hot_keywords(tokens, 1), "source", "keyword", "heat_score")
    assert top == [("all", "a", 100.0), ("china", "a", 100.0), ("usa", "b", 100.0)]


def test_hot_keywords_of_tokens_counted_by_article(spark):
    from newslens.operators import terms

    day = F.col("d").cast("date").alias("stat_date")
    docs = spark.createDataFrame(
        [("Bank bank river", "china", "2024-01-01"), ("Bank bank river", "china", "2024-01-01"), ("river", None, "2024-01-01"),
         ("bank", "all", "2024-01-01"), ("bank", "usa", "2024-01-02"), ("bank", "usa", None), (None, "usa", "2024-01-02"),
         ("", "usa", "2024-01-02"), ("the a", "usa", "2024-01-03")], "text string, source string, d string"
    ).select("text", "source", day)
    keep = ["source", "stat_date"]
    counted, one_by_one = terms.english_tokens(docs, "text", keep, counted=True), terms.english_tokens(docs, "text", keep)
    columns = ["stat_date", "source", "keyword", "n", "heat_score"]
    got = rows(R.hot_keywords(counted), *columns)
    assert got == rows(R.hot_keywords(one_by_one), *columns)
    assert {(r[2], r[3]) for r in got if r[1] == "all" and str(r[0]) == "2024-01-01"} == {("bank", 1), ("bank", 5), ("river", 3)}
    assert rows(R.hot_keywords(counted, 1), *columns) == rows(R.hot_keywords(one_by_one, 1), *columns)
    # no table of all keywords in a task: one shuffle, one sort, no hash aggregate
    plan = R._added_by_source(counted)._jdf.queryExecution().executedPlan().toString()
    assert (plan.count("Exchange"), plan.count("Sort "), plan.count("HashAggregate")) == (1, 1, 0)


def test_quality(corpus, scores, spark):
    assert Q.counters(corpus, scores).first().asDict() == {
        "n_articles": 4, "n_with_content": 2, "n_with_date": 3, "n_with_image": 1, "n_blank_title": 1, "n_scores": 4}
    c = Q.coverage(corpus, scores).first()
    assert (c.total_corpus, c.with_sentiment, c.without_sentiment, c.coverage_pct, c.n_distinct_articles) == (5, 4, 1, 80.0, 4)
    empty = Q.coverage(corpus.limit(0), scores).first()
    assert empty.total_corpus == 0 and empty.coverage_pct is None
    assert [tuple(r) for r in Q.duplicate_titles(corpus).collect()] == [("t1", 2)]
    assert [tuple(r) for r in Q.score_by_sentiment(scores.unionByName(
        spark.createDataFrame([(9, None, None)], scores.schema))).collect()] == [
        ("neutral", 2, 4.5), ("negative", 1, 1.0), ("positive", 1, 9.0)]
    assert [r.published for r in Q.latest(corpus, 2).collect()] == ["无日期", "2024-02-01"]
    assert rows(Q.sample(corpus, scores), "id", "sentiment", "content_length") == [
        (1, "neutral", 9), (1, "positive", 9), (2, "negative", 8), (3, None, 0)]


def test_constraints(spark, corpus):
    odd = spark.createDataFrame([(1, None, "mars", "audio"), (2, "x" * 501, "usa", "text"), (3, "x" * 500, "usa", "text")],
                                "id long, title string, source string, content_type string").withColumns(
        {"url": F.lit("u"), "media_name": F.lit(None).cast("string")})
    assert rows(schema.violations(odd, schema.corpus_rules())) == [
        (1, "source_not_allowed"), (1, "title_missing"), (1, "type_not_allowed"), (2, "title_too_long")]
    bad = spark.createDataFrame([(1, None, "happy", Decimal("10.00"))],
                                "id long, corpus_id long, sentiment string, sentiment_score decimal(4,2)")
    assert {r.rule for r in schema.violations(bad, schema.sentiment_rules()).collect()} == {
        "corpus_id_missing", "sentiment_not_allowed", "score_does_not_fit"}
    children = spark.createDataFrame([(1,), (77,), (77,)], "corpus_id long")
    assert rows(schema.orphans(children, corpus, "corpus_id")) == [(77, 2)]
    assert rows(schema.duplicate_keys(corpus, ["title"])) == [("t1", 2)]
    assert rows(schema.latest_per_key(corpus, ["title"], [F.desc("id")]), "id") == [(2,), (3,), (4,)]
    assert schema.as_corpus_v1(schema.conform(corpus, schema.CORPUS)).columns[5] == "type"


def test_keywords_and_topics(spark, corpus, scores):
    docs = spark.createDataFrame([(1, "apple apple pear"), (2, "apple plum plum"), (3, "pear pear apple")], "id long, content string")
    words = W.document_keywords(docs, k=2)
    assert rows(words, "id", "rank_no", "keyword", "frequency", "df") == [
        (1, 1, "apple", 2, 3), (1, 2, "pear", 1, 2), (2, 1, "plum", 2, 1), (2, 2, "apple", 1, 3),
        (3, 1, "pear", 2, 2), (3, 2, "apple", 1, 3)]
    topics = rows(W.hot_topics(words, scores), "topic_name", "article_count", "avg_sentiment_score", "topic_keywords",
                  "heat_score")
    assert topics == [("apple", 1, 7.0, '["apple","pear"]', 100.0), ("pear", 1, None, '["apple","pear"]', 100.0),
                      ("plum", 1, 1.0, '["apple","plum"]', 100.0)]


def brute_bigrams(text):
    words = "".join(c if c.isalnum() else " " for c in text.lower()).split()
    return {w[i:i + 2] for w in words for i in range(len(w) - 1)}


def test_search_three_ways(spark, tmp_path):
    texts = [(1, "Rocket launch", "into space"), (2, "None", "rock et"), (3, "中国发射", "火箭 rocket_x"), (4, None, "ROCKET!"), (5, "a", "b")]
    corpus = spark.createDataFrame(texts, "id long, title string, content string")
    grams = brute_bigrams("rocket")
    expected = sorted((i, len(grams & brute_bigrams((t or "") + "\n" + c))) for i, t, c in texts)
    expected = [(i, n, n == len(grams)) for i, n in expected if n]
    assert rows(X.search(corpus, "Rocket")) == expected
    assert rows(X.matching(X.postings(corpus), "Rocket")) == expected
    path = str(tmp_path / "postings")
    X.write_postings(corpus, path, buckets=8)
    stored = X.matching(spark.read.parquet(path), "Rocket", buckets=8)
    assert rows(stored) == expected
    assert rows(X.search(corpus, "发射"), "id") == [(3,)]


def test_url_intake(spark):
    sheet = spark.createDataFrame([
        (1, "a", "http://u/1"), (2, None, "http://u/2"), (3, "c", None), (4, "d", "ftp://u/4"), (5, "e", "https://u/5"),
        (6, "f", "http://u/1"), (7, None, None), (8, "h", "http://done")], "position long, title string, url string")
    done = spark.createDataFrame([("http://done",)], "url string")
    assert rows(Y.unprocessed(sheet, done), "position", "url") == [(1, "http://u/1"), (5, "https://u/5")]
    assert rows(Y.merge_processed(done, Y.valid_urls(sheet))) == [
        ("http://done",), ("http://u/1",), ("https://u/5",)]


def test_retention(spark):
    articles = spark.createDataFrame([
        (1, "http://x/2014-12/31/c.htm"), (2, "http://x/2015-01/01/c.htm"), (3, "http://x/none"),
        (4, "http://x/2014-13/45/c.htm"), (5, "http://x/a/201401/05/d.html")], "id long, url string")
    keep, purge = Y.retention_split(articles)
    assert rows(purge, "id") == [(1,)] and rows(keep, "id") == [(2,), (3,), (4,), (5,)]
    keep, purge = Y.retention_split(articles, extended=True)
    assert rows(purge, "id") == [(1,), (5,)] and keep.count() + purge.count() == 5
    children = spark.createDataFrame([(1, "x"), (2, "y"), (1, "z"), (None, "n")], "corpus_id long, f string")
    kept, deleted = Y.cascade(children, purge)
    assert rows(deleted, "f") == [("x",), ("z",)] and rows(kept, "f") == [("n",), ("y",)]


def test_last_write_wins(spark):
    files = spark.createDataFrame([(1, "a.txt", "old"), (3, "a.txt", "new"), (2, "b.txt", "b")], "position long, file_name string, value string")
    assert rows(Y.last_write_wins(files), "file_name", "value") == [("a.txt", "new"), ("b.txt", "b")]


def test_processing_log(spark):
    status = spark.createDataFrame([("success",), ("success",), ("failed",)], "status string")
    r = R.processing_log(R.load_counters(status), "crawl").first()
    assert (r.status, r.processed_count, r.details) == ("success", 2, '{"processed":2,"failed":1}')
    assert R.processing_log(R.load_counters(status.where("status = 'failed'")), "crawl").first().status == "failed"


def plain_text(*fields):
    return " \x01 ".join(" ".join("".join(c if c.isalnum() else " " for c in (f or "").lower()).split()) for f in fields)


def phrase_places(text, phrase):
    """Starts of a phrase by looking everywhere; words of one letter stand alone."""
    padded = f" {text} "
    words = phrase.split(" ")
    found = 0
    for i in range(len(padded) - len(phrase) + 1):
        if padded.startswith(phrase, i):
            ok = True
            if len(words[0]) == 1 and padded[i - 1] not in " \x01":
                ok = False
            if len(words[-1]) == 1 and padded[i + len(phrase)] not in " \x01":
                ok = False
            found += ok
    return found


def test_phrases_against_looking_everywhere(spark, tmp_path):
    import random

    r = random.Random(8)
    texts = [(i, " ".join(r.choices(["an", "ana", "b", "a", "banana", "né", "国中", "x1"], k=r.randint(0, 9))),
              "".join(r.choice(["an ", "ana, ", "a-", "b ", "banan", "\n", "É", "中国 "]) for _ in range(r.randint(0, 60))))
             for i in range(60)]
    texts += [(100, None, None), (101, "of", "the"), (102, "", "word " * 3000 + "of the end" + " word" * 3000),
              (103, None, "x" * 9000 + "anan")]
    corpus = spark.createDataFrame(texts, "id long, title string, content string")
    path = str(tmp_path / "positions")
    X.write_positions(corpus, path, buckets=8)
    stored = spark.read.parquet(path)
    for phrase in ("an", "anan", "a", "b a", "an ana", "of the", "word word of", "国中", "中国 an", "né", "banana b", "xx"):
        expected = sorted(((i, n) for i, t, c in texts if (n := phrase_places(plain_text(t, c), phrase))), key=repr)
        assert rows(X.phrase(stored, phrase.title(), buckets=8)) == expected, phrase
    with pytest.raises(ValueError):
        X.phrase(stored, " - ")


def test_phrase_reads_only_its_grams(spark, tmp_path):
    corpus = spark.createDataFrame([(1, "t", "some words")], "id long, title string, content string")
    path = str(tmp_path / "positions")
    X.write_positions(corpus, path, buckets=64)
    plan = X.phrase(spark.read.parquet(path), "some", buckets=64)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "bucket" in plan.split("PartitionFilters")[1][:200]


def test_phrases_share_one_pass(spark, tmp_path):
    texts = ("of the", "the and", "a", "of the", "xx", "né")
    corpus = spark.createDataFrame(
        [(1, "of the and of", "a the, and: né"), (1, "of the and of", "a the, and: né"), (2, None, "of the of-the a a"),
         (3, "the", "and"), (4, None, None), (None, "A", "often; the And."), (5, "", "the an of th")],
        "id long, title string, content string")
    path = str(tmp_path / "positions")
    X.write_positions(corpus, path, buckets=8)
    stored = spark.read.parquet(path)
    found = X.phrase(stored, texts, buckets=8)
    assert found.columns == ["phrase", "id", "n_places"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    alone = [(t, *r) for t in sorted(set(texts)) for r in rows(X.phrase(stored, t, buckets=8))]
    assert rows(found) == sorted(alone, key=repr) and {t for t, *_ in alone} == {"of the", "the and", "a", "né"}
    assert rows(X.phrase(X.positions(corpus), texts)) == rows(found)
    with pytest.raises(ValueError):
        X.phrase(stored, ["of the", " - "])


def test_dated_topics(spark, scores):
    words = spark.createDataFrame(
        [(1, "x", 1), (1, "y", 2), (2, "x", 1), (3, "z", 1), (4, "y", 1), (5, "y", 1), (6, "q", 1)],
        "id long, keyword string, rank_no int")
    dates = spark.createDataFrame([(1, "d1"), (2, "d1"), (3, "d1"), (4, "d2"), (5, "d1")], "id long, stat_date string")
    got = rows(W.hot_topics_by_date(words, dates, scores, k=2), "stat_date", "rank_no", "topic_name", "article_count",
               "heat_score", "topic_keywords")
    assert got == [("d1", 1, "x", 2, 100.0, '["x","y"]'), ("d1", 2, "y", 1, 50.0, '["y"]'), ("d2", 1, "y", 1, 100.0, '["y"]')]


def test_log_names_the_first_problems(spark):
    found = spark.createDataFrame([("b", "bad"), ("a", None), ("c", "worse"), ("a", "bad")], "path string, problem string")
    one = spark.range(1)
    assert one.select(R.error_message(found)).first()[0] == "a: bad\nb: bad\nc: worse"
    assert one.select(R.error_message(found, shown=1)).first()[0] == "a: bad"
    assert one.select(R.error_message(found.where("false"))).first()[0] is None


def test_rules_of_every_table(spark):
    def broken(rules, schema_, *cells):
        return {r.rule for r in schema.violations(spark.createDataFrame(list(cells), schema_), rules).collect()}

    assert broken(schema.image_rules(), "id long, corpus_id long, file_name string, file_path string, format string, width int, height int",
                  (1, None, None, "x" * 501, "bmp", 0, 5), (2, 1, "a", "b", None, None, None)) == set(schema.image_rules())
    assert broken(schema.video_rules(), "id long, corpus_id long, file_name string, video_url string, duration int",
                  (1, None, None, None, -1), (2, 1, "f", "u" * 1001, None)) == set(schema.video_rules())
    assert broken(schema.keyword_rules(), "id long, corpus_id long, keyword string, keyword_type string, weight double",
                  (1, None, None, "no", 1000.0), (2, 1, "k" * 101, None, 1.0)) == set(schema.keyword_rules())
    assert broken(schema.log_rules(), "id long, process_type string, status string, processed_count long, start_time int, end_time int",
                  (1, "fly", None, -1, 2, 1), (2, "crawl", "running", 0, 1, None)) == set(schema.log_rules())


def test_month_parts_follow_changes(spark):
    import datetime
    import random

    r = random.Random(6)
    cells = [(i, r.choice("ab"), r.choice(["text", "image"]), r.randint(0, 2), r.randint(0, 2),
              datetime.date(2024, r.randint(1, 3), 5)) for i in range(80)]
    marks = [(r.randrange(90), r.choice(["positive", "negative", None]), r.choice([None, 1, 7])) for _ in range(120)]
    corpus = spark.createDataFrame(cells, "id long, source string, content_type string, image_count int, video_count int, publish_date date")
    scores = spark.createDataFrame(marks, "corpus_id long, sentiment string, n int").withColumn(
        "sentiment_score", F.col("n").cast("decimal(4,2)"))
    from newslens.session import fresh_path

    table = R.month_parts_table(spark, fresh_path(spark, "parts"))
    groups = [corpus.where(f"id % 3 = {k}") for k in range(3)]
    for g in groups:
        R.change_months(table, R.monthly_parts(g, scores), None)
    R.change_months(table, None, R.monthly_parts(groups[1], scores))
    names = sorted(R.monthly_statistics(corpus, scores).columns)
    assert rows(R.statistics_of(table.read()), *names) == rows(R.monthly_statistics(corpus.where("id % 3 <> 1"), scores), *names)
    R.change_months(table, None, R.monthly_parts(groups[0].unionByName(groups[2]), scores))
    assert table.read().count() == 0


def test_sketches_stay_within_their_error(spark):
    import datetime

    corpus = spark.range(40_000).select(
        F.lit(datetime.date(2024, 1, 1)).alias("publish_date"), F.lit("text").alias("content_type"),
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("source"), F.concat(F.lit("m"), F.col("id") % 9000).alias("media_name"))
    r = R.merged_reach(R.media_reach(corpus), F.substring("month", 1, 4).alias("year")).first()
    assert abs(r.media_estimate - 9000) <= R.SKETCH_ERROR * 9000


def test_words_are_counted_inside_rows(spark):
    from newslens.operators import terms

    texts = ["b a, b; A the", "", None, "né a1 Kelvin kelvin X", "one", "two one two"]
    docs = spark.createDataFrame([(None if i == 4 else i % 3, t) for i, t in enumerate(texts * 2)], "id long, content string")
    plain = docs.select("id", F.monotonically_increasing_id().alias("row"), "content")
    per_row = terms.english_counts(plain, "content", ["row"])
    assert "Exchange" not in per_row._jdf.queryExecution().executedPlan().toString()
    tokens = terms.english_tokens(plain, "content", ["row"])
    assert rows(per_row, "row", "word", "frequency") == rows(tokens.groupBy("row", "word").count(), "row", "word", "count")
    # rows that share a key, or have none, are one document
    words = terms.english_tokens(docs, "content", ["id"]).groupBy("id", "word").count()
    assert rows(W.document_keywords(docs), "id", "keyword", "frequency") == rows(words, "id", "word", "count")


def test_children_of_deleted_articles_in_one_join(spark):
    gone = spark.createDataFrame([(1,), (1,), (5,), (None,)], "id long")
    children = spark.createDataFrame([(1, "x"), (2, "y"), (1, "z"), (None, "n")], "corpus_id long, f string")
    marked = Y.marked(children, gone)
    assert rows(marked, "f", "is_gone") == [("n", False), ("x", True), ("y", False), ("z", True)]
    assert marked._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    keep, delete = Y.cascade(children, gone)
    assert rows(marked.where("is_gone"), "f") == rows(delete, "f") and rows(marked.where("not is_gone"), "f") == rows(keep, "f")


def test_stored_postings_share_rows(spark, tmp_path):
    corpus = spark.createDataFrame([(None if i == 7 else i % 50, "same title", "a text " * (i % 3)) for i in range(60)],
                                   "id long, title string, content string").coalesce(1)
    X.write_postings(corpus, str(tmp_path / "postings"), buckets=4)
    stored = spark.read.parquet(str(tmp_path / "postings"))
    assert stored.count() == stored.select("gram").distinct().count()
    assert rows(X.matching(stored, "same text", buckets=4)) == rows(X.matching(X.postings(corpus), "same text"))
    X.write_positions(corpus, str(tmp_path / "positions"), buckets=4)
    stored = spark.read.parquet(str(tmp_path / "positions"))
    assert stored.count() == stored.select("gram").distinct().count()
    for phrase in ("title", "text a", "e t"):
        assert rows(X.phrase(stored, phrase, buckets=4)) == rows(X.phrase(X.positions(corpus), phrase))


def test_titles_are_cut_ahead_of_the_join(spark, tmp_path):
    from newslens.plans import bindings as B

    spark.createDataFrame([(1, "T\nbody", "en", "s")], "doc_id long, text string, lang string, source string").write.parquet(
        str(tmp_path / "documents.parquet"))
    spark.sql("select 1L o_orderkey, timestamp'2024-01-02' o_orderdate, '1-URGENT' o_orderpriority, 'F' o_orderstatus, 1D o_totalprice"
              ).write.parquet(str(tmp_path / "orders.parquet"))
    titles = B.corpus(spark, str(tmp_path)).select("id", "title")
    assert rows(titles) == [(1, "T")]
    plan = titles._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join ") < plan.index("substring_index")


def test_videos_are_parsed_once(spark, tmp_path):
    from newslens.plans.article_queries import video_rows

    spark.sql("select 1L doc_id, 'T\\nbody' text, 'en' lang, 's' source").write.parquet(str(tmp_path / "documents.parquet"))
    spark.sql("select 1L o_orderkey, timestamp'2024-01-02' o_orderdate, '1-URGENT' o_orderpriority, 'F' o_orderstatus, 20000D o_totalprice"
              ).write.parquet(str(tmp_path / "orders.parquet"))
    spark.sql("select 1L l_orderkey, 2 l_linenumber, 7L l_suppkey, 'A' l_returnflag, 1D l_quantity").write.parquet(
        str(tmp_path / "lineitem.parquet"))
    got = video_rows(spark, str(tmp_path))
    assert rows(got, "corpus_id", "pos", "video_url") == [
        (1, 1, "https://player7.example.com/v?src=1_2"), (1, 2, "videos/T_2_link.txt")]
    assert "documents.parquet" not in got._jdf.queryExecution().executedPlan().toString()
