"""Readers, writers and streaming jobs on small folders."""

import os

import pytest
from pyspark.sql import functions as F

from newslens.operators import terms
from newslens.session import SETTINGS, fresh_path, shared_folder, spread
from newslens.sources import articles as A, sinks
from newslens.streaming import jobs

from .conftest import rows
from .test_text import FULL


def test_article_folder(spark, tmp_path):
    (tmp_path / "A big day.txt").write_text(FULL, encoding="utf-8")
    (tmp_path / "100% a+b 中.txt").write_text("odd name", encoding="utf-8")
    (tmp_path / "bare.txt").write_text("no header at all", encoding="utf-8")
    (tmp_path / "skip.log").write_text("x", encoding="utf-8")
    files = A.read_articles(spark, str(tmp_path))
    assert rows(files, "file_name") == [("100% a+b 中.txt",), ("A big day.txt",), ("bare.txt",)]
    parsed = {r.file_name: r for r in A.with_defaults(A.parse_articles(files)).collect()}
    full, bare = parsed["A big day.txt"], parsed["bare.txt"]
    assert full.title == 'A: "big" day?' and full.has_images and full.image_url == 'images/A: "big" day?_1.jpg'
    assert str(full.publish_date) == "2024-01-15" and str(full.url_date) == "2024-01-15" and len(full.media) == 3
    assert (bare.title, bare.url, bare.content, bare.image_url) == ("bare.txt", "", "no header at all", None)
    assert (full.source, full.media_name, full.content_type, full.video_url) == ("china", "China Daily", "text", None)


@pytest.mark.parametrize("header", ["标题,网址", "title,Link", "Title,URL,extra", "字段1_文本_文本,字段1_链接_链接"])
def test_sheet_aliases(spark, tmp_path, header):
    path = tmp_path / "sheet.csv"
    path.write_text(f"{header}\nA,http://u\n,http://v\n", encoding="utf-8")
    sheet = A.read_sheet(spark, str(path))
    assert sheet.columns[:2] == ["title", "url"]
    assert rows(sheet, "title", "url") == [("A", "http://u"), (None, "http://v")]


def test_sheet_without_alias_names_its_columns(spark):
    with pytest.raises(ValueError, match="heading"):
        A.resolve_sheet(spark.createDataFrame([("a", "b")], "heading string, url string"))


def test_first_alias_wins(spark):
    df = spark.createDataFrame([("second", "first", "u")], ["title", "标题", "url"])
    assert A.resolve_sheet(df).first().title == "first"


def test_video_links(spark, tmp_path):
    (tmp_path / "v_1_link.txt").write_text(
        "视频链接: https://player.example.com/player.html?src=//host/stream/1.m3u8&c=abc", encoding="utf-8")
    r = A.read_video_links(spark, str(tmp_path)).first()
    assert (r.file_name, r.host, r.src, r.c) == ("v_1_link.txt", "player.example.com", "//host/stream/1.m3u8", "abc")


def test_sheets_are_written_and_read_back(spark, tmp_path):
    docs = spark.createDataFrame([("pear pear pear plum plum plum 中国 中国 中国",)], "body string")
    report = terms.mixed_report(docs)
    sinks.write_sheets(terms.sheets(report), str(tmp_path / "out"))
    got = A.read_sheet_rows(spark, str(tmp_path / "out" / "all"), "en").collect()
    assert [(r.word, r.n) for r in got] == [("pear", 3), ("plum", 3)]
    sinks.write_sheets(terms.sheets(report), str(tmp_path / "csv"), as_csv=True)
    assert spark.read.csv(str(tmp_path / "csv" / "zh"), header=True).first().word == "中国"


def test_article_files_as_text_and_table(spark, tmp_path):
    files = spark.createDataFrame([("a.txt", "标题: a\n网址: u\n\nbody"), ("b.txt", "x")], "file_name string, value string")
    sinks.write_article_files(files, str(tmp_path / "table"))
    assert rows(spark.read.parquet(str(tmp_path / "table"))) == rows(files)
    sinks.write_article_files(files, str(tmp_path / "text"), as_text=True)
    back = spark.read.text(str(tmp_path / "text"), wholetext=True)
    assert rows(back.select("file_name", F.rtrim(F.regexp_replace("value", "\\n\\z", "")))) == rows(files)


def test_append_assigns_consecutive_ids(spark, tmp_path):
    path = str(tmp_path / "corpus")
    new = spark.createDataFrame([(f"t{i}", f"http://u/{i:02d}") for i in range(20)], "title string, url string").withColumns(
        {"source": F.lit("china"), "content_type": F.lit("text")})
    sinks.append_corpus(new.where("title < 't15'"), path, [F.col("url")])
    stored = spark.read.parquet(path)
    n = stored.count()
    sinks.append_corpus(new.where("title >= 't15'"), path, [F.col("url")], stored)
    ids = [r.id for r in spark.read.parquet(path).orderBy("id").collect()]
    assert ids == list(range(1, 21)) and 0 < n < 20
    scores = spark.createDataFrame([("positive", 3, "a"), ("neutral", None, "b")], "sentiment string, corpus_id long, title string")
    sinks.append_sentiment(scores, str(tmp_path / "scores"), [F.col("title")])
    assert rows(spark.read.parquet(str(tmp_path / "scores")), "id", "corpus_id") == [(1, 3)]


def test_processed_urls(spark, tmp_path):
    old, new = [spark.createDataFrame([(u,) for u in us], "url string") for us in (["a", "b"], ["b", "c"])]
    sinks.save_processed(str(tmp_path / "p"), old, new)
    assert rows(spark.read.parquet(str(tmp_path / "p"))) == [("a",), ("b",), ("c",)]


def test_shared_folder_comes_from_the_session(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_folder(spark) == named and fresh_path(spark, "x").startswith(named)
    assert fresh_path(spark, "x") != fresh_path(spark, "x") and SETTINGS["spark.sql.adaptive.enabled"] == "true"


def test_spread_leaves_wide_scans_alone(spark):
    wide = spark.range(100, numPartitions=8)
    assert spread(wide, "id") is wide
    narrow = spark.range(100, numPartitions=1)
    assert spread(narrow, "id").rdd.getNumPartitions() == 4


def put(spark, folder, name, data, schema):
    spark.createDataFrame(data, schema).coalesce(1).write.parquet(os.path.join(folder, name))


def test_ingest_resumes_and_skips_known_urls(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "title string, url string, position long"
    put(spark, source, "1", [("a", "http://1", 1), ("b", "http://2", 2), ("a2", "http://1", 3), ("x", "ftp://x", 4)], schema)

    def run():
        stream = spark.readStream.schema(schema).parquet(f"{source}/*")
        return rows(jobs.ingest(stream, out, state), "url", "title")

    assert run() == [("http://1", "a"), ("http://2", "b")]
    put(spark, source, "2", [("again", "http://2", 5), ("c", "http://3", 6)], schema)
    assert run() == [("http://1", "a"), ("http://2", "b"), ("http://3", "c")]
    assert run() == [("http://1", "a"), ("http://2", "b"), ("http://3", "c")]


def test_child_counts_stay_current(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "corpus_id long, kind string"
    put(spark, source, "1", [(1, "image"), (1, "video"), (2, "image")], schema)

    def run():
        stream = spark.readStream.schema(schema).parquet(f"{source}/*")
        return rows(jobs.child_counts(stream, out, state), "corpus_id", "image_count", "video_count")

    assert run() == [(1, 1, 1), (2, 1, 0)]
    put(spark, source, "2", [(1, "image"), (3, "video")], schema)
    assert run() == [(1, 2, 1), (2, 1, 0), (3, 0, 1)]


def test_only_touched_months_are_recomputed(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    fields = "id long, source string, content_type string, image_count int, video_count int, publish_date date"
    scores = spark.createDataFrame([], "corpus_id long, sentiment string, sentiment_score decimal(4,2)")

    def article(i, day):
        import datetime
        return (i, "china", "text", 0, 0, datetime.date.fromisoformat(day))

    first = [article(1, "2024-01-05"), article(2, "2024-02-05")]
    second = [article(3, "2024-02-06")]
    put(spark, source, "1", first, fields)

    def run(corpus):
        stream = spark.readStream.schema(fields).parquet(f"{source}/*")
        return rows(jobs.refresh_months(stream, spark.createDataFrame(corpus, fields), scores, out, state).select(
            F.col("stat_month").cast("string"), "total_articles"))

    assert run(first) == [("2024-01", 1), ("2024-02", 1)]
    put(spark, source, "2", second, fields)
    # January is absent from the table now, but is not touched by the new batch
    assert run(first[1:] + second) == [("2024-01", 1), ("2024-02", 2)]


def article(folder, name, title, url, body, images=0):
    listed = "".join(f"{i}. {title}_{i}.jpeg - 尺寸: 465x296\n" for i in range(1, images + 1))
    (folder / name).write_text(f"标题: {title}\n网址: {url}\n\n{body}" + (f"\n\n图片列表:\n{listed}" if images else ""),
                               encoding="utf-8")


@pytest.fixture
def folder(tmp_path):
    path = tmp_path / "texts"
    path.mkdir()
    article(path, "Great day.txt", "Great day?", "http://x/2014-05/06/c.htm", "A great, great success.", images=2)
    article(path, "Sad war.txt", "Sad war", "http://x/2016-05/06/c.htm", "Horrible war. Worst war.\n\n2016-05-06")
    article(path, "Plain.txt", "Plain", "http://x/a/202001/02/c.html", "A table. A table. A table.")
    return path


def test_whole_load(spark, tmp_path, folder):
    from newslens.plans import corpus_jobs as J

    report, out = str(tmp_path / "report"), str(tmp_path / "out")
    ranked = J.write_score_report(spark, str(folder), report)
    assert rows(ranked, "title", "sentiment", "rank_no") == [
        ("Great day", "positive", 1), ("Plain", "neutral", 1), ("Sad war", "negative", 1)]
    J.load_all(spark, str(folder), report, out)
    corpus, scores = spark.read.parquet(f"{out}/corpus"), spark.read.parquet(f"{out}/sentiment")
    assert sorted(r.id for r in corpus.collect()) == [1, 2, 3]
    joined = corpus.join(scores.drop("id"), corpus.id == scores.corpus_id)
    assert rows(joined, "title", "sentiment") == [
        ("Great day?", "positive"), ("Plain", "neutral"), ("Sad war", "negative")]
    assert rows(corpus, "title", F.col("publish_date").cast("string"), "image_url") == [
        ("Great day?", None, "images/Great day?_1.jpg"), ("Plain", None, None), ("Sad war", "2016-05-06", None)]
    assert rows(spark.read.parquet(f"{out}/logs"), "process_type", "status", "processed_count") == [
        ("crawl", "success", 3), ("keyword_extraction", "success", 6), ("sentiment_analysis", "success", 3)]
    assert rows(corpus, "title", "image_count", "video_count") == [
        ("Great day?", 2, 0), ("Plain", 0, 0), ("Sad war", 0, 0)]
    assert corpus.where("create_time is null or crawl_date is null").count() == 0
    great = corpus.where("title like 'Great%'").first().id
    images, videos = spark.read.parquet(f"{out}/images"), spark.read.parquet(f"{out}/videos")
    assert rows(images, "id", "corpus_id", "file_name", "width", "format") == [
        (1, great, "Great day?_1.jpeg", 465, "jpeg"), (2, great, "Great day?_2.jpeg", 465, "jpeg")]
    assert videos.count() == 0
    words = spark.read.parquet(f"{out}/keywords")
    assert sorted(r.id for r in words.collect()) == [*range(1, words.count() + 1)]
    assert rows(words.where(F.col("corpus_id") == great).where("keyword = 'great'"), "keyword_type", "frequency") == [
        ("other", 2)]
    before = {name: rows(spark.read.parquet(f"{out}/{name}")) for name in ("corpus", "sentiment", "images", "keywords")}
    # the same load again adds nothing; a file that is no text counts as failed
    (folder / "Broken.txt").write_bytes(b"\xff\xfe no text")
    J.load_all(spark, str(folder), report, out)
    assert {name: rows(spark.read.parquet(f"{out}/{name}")) for name in before} == before
    last = spark.read.parquet(f"{out}/logs").where("process_type = 'crawl'").orderBy(F.desc("start_time")).first()
    assert (last.status, last.processed_count, last.details) == ("failed", 0, '{"processed":0,"failed":1}')
    # a second load adds new files only
    article(folder, "New.txt", "New", "u", "more")
    J.load_articles(spark, str(folder), f"{out}/corpus", corpus)
    again = spark.read.parquet(f"{out}/corpus")
    assert rows(again.where("id > 3"), "id", "title") == [(4, "New")]
    # a strict comparison misses the title with a refused character
    strict = J.load_scores(spark, report, corpus, str(tmp_path / "strict"), strict_title=True)
    assert rows(strict.where("status = 'failed'"), "title") == [("Great day",)]


def test_term_reports_of_a_folder(spark, tmp_path, folder):
    from newslens.plans import corpus_jobs as J

    J.write_term_reports(spark, str(folder), str(tmp_path / "terms"))
    assert rows(spark.read.parquet(str(tmp_path / "terms" / "english_by_word")), "word", "n") == [("table", 3)]
    assert rows(spark.read.parquet(str(tmp_path / "terms" / "en")), "word", "n") == [("table", 3)]
    assert spark.read.parquet(str(tmp_path / "terms" / "zh")).count() == 0


def test_retention_of_a_folder(spark, folder):
    from newslens.plans import corpus_jobs as J

    keep, purge, media = J.split_by_age(spark, str(folder))
    assert rows(purge, "title") == [("Great day?",)] and keep.count() == 2
    assert rows(media, "kind", "file_name") == [("image", "Great day?_1.jpeg"), ("image", "Great day?_2.jpeg")]


def test_line_ends_of_other_systems(spark, tmp_path):
    for name, end in (("a", "\n"), ("b", "\r\n"), ("c", "\r")):
        (tmp_path / f"{name}.txt").write_bytes("标题: T\n网址: u\n\nBody line\n".replace("\n", end).encode())
    from newslens.sources import articles

    parsed = articles.parse_articles(articles.read_articles(spark, str(tmp_path)))
    assert len({tuple(r) for r in parsed.select("title", "url", "content", "body").collect()}) == 1


def test_titles_match_in_any_case(spark):
    from newslens.operators import sentiment

    scores = spark.createDataFrame([("HELLO",), ("none",)], "title string")
    corpus = spark.createDataFrame([(3, "Hello"), (2, "hello")], "id long, title string")
    assert rows(sentiment.match_by_title(scores, corpus), "title", "corpus_id") == [("HELLO", 2), ("none", None)]
    assert rows(sentiment.match_by_title(scores, corpus, fold=False), "corpus_id") == [(None,), (None,)]


def test_no_character_of_a_document_is_lost(spark, tmp_path):
    """The counted bodies hold whole texts, single lines and first lines included."""
    from newslens.plans import bindings as B
    from newslens.functions.text import body_by_lines

    docs = [(1, "one line only"), (2, "first\nsecond\n\nthird"), (3, ""), (4, "  \n tail"), (5, None)]
    spark.createDataFrame(docs, "doc_id long, text string").withColumns(
        {"lang": F.lit("en"), "source": F.lit("s")}).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i,) for i in range(1, 6)], "o_orderkey long").withColumns({
        "o_orderdate": F.lit("1998-02-03").cast("date"), "o_orderpriority": F.lit("1-URGENT"),
        "o_orderstatus": F.lit("F"), "o_totalprice": F.lit(0.0)}).write.parquet(str(tmp_path / "orders.parquet"))
    files = B.article_files(spark, str(tmp_path)).select("id", body_by_lines(F.col("value")).alias("body"))
    got = {r.id: r.body for r in files.collect()}
    for i, text in docs:
        if text and text.strip(" "):
            assert got[i].endswith(text)


def test_load_names_what_is_wrong_with_files(spark, tmp_path, folder):
    from newslens.plans import corpus_jobs as J

    (folder / "Bytes.txt").write_bytes(b"\xff\xfe no text")
    (folder / "Bare.txt").write_text("only a body", encoding="utf-8")
    loaded = J.load_folder(spark, str(folder), str(tmp_path / "corpus"))
    assert (loaded.processed, loaded.failed) == (4, 1)
    assert [(p.rsplit("/", 1)[1], why) for p, why in rows(loaded.problems, "path", "problem")] == [
        ("Bare.txt", "no title line"), ("Bytes.txt", "not UTF-8 text")]
    report, out = str(tmp_path / "report"), str(tmp_path / "out")
    J.write_score_report(spark, str(folder), report)
    J.load_all(spark, str(folder), report, out)
    log = spark.read.parquet(f"{out}/logs").where("process_type = 'crawl'").first()
    assert (log.status, log.processed_count) == ("success", 4)
    assert [x.rsplit("/", 1)[1] for x in log.error_message.split("\n")] == ["Bare.txt: no title line", "Bytes.txt: not UTF-8 text"]
    assert spark.read.parquet(f"{out}/problems").count() == 2
