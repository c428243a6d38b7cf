"""Streams over several micro-batches, with repeats and restarts."""

import glob

from pyspark.sql import functions as F

from newslens.operators import rollups as R
from newslens.streaming import jobs

from .conftest import rows


def article_file(folder, name, url, body="text", title="T"):
    (folder / name).write_text(f"标题: {title}\n网址: {url}\n\n{body}", encoding="utf-8")


def test_texts_of_a_folder_are_taken_once(spark, tmp_path):
    folder, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    folder.mkdir()

    def drain():
        return rows(jobs.ingest_texts(jobs.stream_articles(spark, str(folder), per_batch=1), out, state), "url", "title")

    for i in range(3):  # three micro-batches of one file each
        article_file(folder, f"a{i}.txt", f"http://u/{i}", title=f"T{i}")
    assert drain() == [(f"http://u/{i}", f"T{i}") for i in range(3)]
    # a restart: known URLs come again in new files, one twice in a batch; one text has no URL
    article_file(folder, "b1.txt", "http://u/1", title="other")
    article_file(folder, "b2.txt", "http://u/7", title="T7")
    (folder / "b3.txt").write_text("no header", encoding="utf-8")
    article_file(folder, "b4.txt", "http://u/7", title="T7")
    expected = [*[(f"http://u/{i}", f"T{i}") for i in range(3)], ("http://u/7", "T7")]
    assert drain() == expected
    assert drain() == expected  # nothing new


def test_bundles_of_texts(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    texts = [f"标题: T{i}\r\n网址: http://u/{i}\r\n\r\nbody {i}" for i in range(4)]
    (folder / "one.txt").write_bytes("\x1e".join(texts[:3]).encode())
    (folder / "two.txt").write_bytes("\x1e".join(texts[2:]).encode())
    got = jobs.ingest_texts(jobs.stream_articles(spark, str(folder), "\x1e"), str(tmp_path / "out"), str(tmp_path / "state"))
    assert rows(got, "url", "value") == [(f"http://u/{i}", texts[i].replace("\r\n", "\n")) for i in range(4)]


def test_counts_stay_small_over_many_batches(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "corpus_id long, kind string"
    batches = 50
    for i in range(batches):
        spark.createDataFrame([(i % 7, "image"), (i % 3, "video"), (i % 3, "video")], schema).coalesce(1).write.parquet(
            f"{source}/{i:03}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{source}/*")
    got = jobs.child_counts(stream, out, state, every=10)
    expected = [(k, sum(i % 7 == k for i in range(batches)), 2 * sum(i % 3 == k for i in range(batches))) for k in range(7)]
    assert rows(got, "corpus_id", "image_count", "video_count") == expected
    assert len(glob.glob(f"{out}/log/batch_no=*")) < 10
    assert len(glob.glob(f"{out}/counts/rows/gen=*")) <= 2
    # a batch that is repeated after the table took it in changes nothing
    held = jobs.counts_table(spark, out).snapshot().upto
    assert held >= batches - 10
    assert rows(jobs.current_counts(spark, out), "corpus_id", "image_count", "video_count") == expected


def test_months_add_up_over_batches(spark, tmp_path):
    import datetime

    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    cells = [(i, "ab"[i % 2], "text", i % 3, 0, datetime.date(2024, 1 + i % 4, 3) if i % 5 else None) for i in range(30)]
    corpus = spark.createDataFrame(cells, "id long, source string, content_type string, image_count int, video_count int, publish_date date")
    scores = spark.createDataFrame([(i % 33, "positive", i) for i in range(50)], "corpus_id long, sentiment string, n int").select(
        "corpus_id", "sentiment", (F.col("n") / 10).cast("decimal(4,2)").alias("sentiment_score"))
    for k in range(3):
        corpus.where(f"id % 3 = {k}").select("id").coalesce(1).write.parquet(f"{source}/{k}")
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"{source}/*")
    got = jobs.accumulate_months(stream, corpus, scores, out, state)
    names = sorted(got.columns)
    assert rows(got, *names) == rows(R.monthly_statistics(corpus, scores), *names)
    assert R.month_parts_table(spark, out).snapshot().upto == 2


def test_a_table_may_be_a_file_or_a_folder_of_files(spark, tmp_path):
    spark.range(6).repartition(3).write.parquet(str(tmp_path / "many.parquet"))
    spark.range(4).coalesce(1).write.parquet(str(tmp_path / "written"))
    (part,) = (tmp_path / "written").glob("*.parquet")
    (tmp_path / "one.parquet").write_bytes(part.read_bytes())
    spark.range(5, 6).write.parquet(str(tmp_path / "other.parquet"))
    for name, n in (("many.parquet", 6), ("one.parquet", 4)):
        seen = []
        stream = jobs.stream_table(spark, str(tmp_path), name)
        jobs._drain(stream.writeStream.foreachBatch(lambda batch, _: seen.extend(r["id"] for r in batch.collect())),
                    str(tmp_path / f"state-{name}"))
        assert sorted(seen) == list(range(n))
