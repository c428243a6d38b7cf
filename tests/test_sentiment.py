import math
import re

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from newslens.operators import lexicon as L, sentiment as S
from newslens.session import fresh_path
from newslens.sources import report as R

from .conftest import rows


def model(text):
    """The published rules over our lexicon, word by word."""
    words = re.findall(r"(?:[^\W]|')+", text)
    lower = [w.lower() for w in words]
    but = lower.index("but") if "but" in lower else None
    total = 0.0
    for i, w in enumerate(lower):
        if w not in L.WORDS:
            continue
        v = L.WORDS[w]
        sign = 1 if v > 0 else -1
        if words[i] == words[i].upper() and re.search("[a-z]", text):
            v += sign * 0.733
        near = [lower[i - n] if i >= n else "" for n in (1, 2, 3)]
        for weight, n in zip((0.293, 0.293 * 0.95, 0.293 * 0.9), near):
            v += sign * weight * ((n in L.STRONGER) - (n in L.WEAKER))
        if any(n in L.NEGATIONS for n in near):
            v *= -0.74
        if but is not None:
            v *= 0.5 if i < but else 1.5 if i > but else 1
        total += v
    asks = text.count("?")
    emphasis = min(text.count("!"), 4) * 0.292 + (0.96 if asks > 3 else asks * 0.18 if asks > 1 else 0)
    total += math.copysign(emphasis, total) if abs(total) > 1e-12 else 0
    return round(total / math.sqrt(total * total + 15), 4)


TEXTS = [
    "", "nothing here", "a good day", "a GOOD day", "ALL GOOD", "not good", "not a very good day",
    "barely good", "so so good", "bad but good", "good but bad", "terrible!!!!! really?", "why? why? good?",
    "isn't it great", "worst worst worst worst worst", "good bad", "but", "Very HAPPY! but never sad??",
]


def test_scores_match_the_model(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, t string")
    got = {r.id: r.compound for r in S.score_documents(df, "id", "t").collect()}
    assert got == {i: model(t) for i, t in enumerate(TEXTS)}


VOCABULARY = st.sampled_from(["good", "bad", "GREAT", "not", "very", "hardly", "but", "table", "Worst", "!", "??", "don't", "happy"])


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(VOCABULARY, max_size=12).map(" ".join), min_size=30, max_size=50))
def test_scores_match_on_random_texts(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    for r in S.score_documents(df, "id", "t").collect():
        assert abs(r.compound - model(texts[r.id])) < 1.01e-4


def test_null_text_and_kept_columns(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "good", "b")], "id int, t string, k string")
    got = rows(S.score_documents(df, "id", "t", ["k"]), "id", "k", "n_hits")
    assert got == [(1, "a", 0), (2, "b", 1)]


def test_lexicon_of_any_size(spark, monkeypatch):
    texts = ["VERY good day, but not a bad war!", "nothing here", "", None, "good good " * 50, "never so good?? GOOD"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    few = sorted(map(tuple, S.score_documents(df, "id", "t").collect()))
    monkeypatch.setattr(S, "LISTED_WORDS", 1)
    assert sorted(map(tuple, S.score_documents(df, "id", "t").collect())) == few


def test_own_lexicon(spark):
    lexicon = {"table": 3.0}
    df = spark.createDataFrame([(1, "good table")], "id int, t string")
    assert S.score_documents(df, "id", "t", lexicon=lexicon).first().compound == round(3 / math.sqrt(24), 4)


def test_scoring_shuffles_only_sums(spark, tmp_path):
    path = str(tmp_path / "d")
    spark.createDataFrame([(1, "good")], "id int, t string").write.parquet(path)
    plan = S.score_documents(spark.read.parquet(path), "id", "t")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Window" not in plan
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_class_limits(spark):
    values = [0.05, 0.0499, -0.5, -0.4999, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "c double").select(S.classify(F.col("c")))
    assert [r[0] for r in df.collect()] == ["positive", "neutral", "negative", "neutral", "neutral"]


SCORED = [(1, "b", 0.9), (2, "a", 0.9), (3, "c", 0.991), (4, "n1", -0.6), (5, "n2", -0.742), (6, "z", -0.3),
          (7, "y", 0.0), (8, "(得分: 1.0) odd", 0.04), (9, "", 0.0), (10, " padded ", 0.01)]


def scored(spark):
    return spark.createDataFrame(SCORED, "id int, title string, compound double").withColumn(
        "sentiment", S.classify(F.col("compound")))


def test_ranks(spark):
    got = {r.id: (r.sentiment, r.rank_no) for r in S.rank_documents(scored(spark), partitions=3).collect()}
    assert got == {3: ("positive", 1), 2: ("positive", 2), 1: ("positive", 3), 5: ("negative", 1),
                   4: ("negative", 2), 9: ("neutral", 1), 7: ("neutral", 2), 10: ("neutral", 3),
                   8: ("neutral", 4), 6: ("neutral", 5)}
    assert rows(S.extremes(scored(spark), k=1), "id", "rank_no") == [(3, 1), (5, 1)]


def test_totals(spark):
    got = dict(rows(S.class_totals(scored(spark)), "sentiment", "n"))
    assert got == {"positive": 3, "negative": 2, "neutral": 5, "total": 10}


def model_report(text):
    """Sections, then numbered lines, read from top to bottom."""
    section, found = None, []
    for line in text.splitlines():
        heads = [n for n, mark in (("positive", "正向报道列表"), ("negative", "负面报道列表"), ("neutral", "中性报道列表")) if mark in line]
        if heads:
            section = heads[0]
        elif "得分:" in line and section:
            hit = re.search(r"\d+\.\s+(.+?)\s+\(得分:\s+(-?\d+\.\d+)\)", line)
            if hit:
                found.append((hit[1].strip(), section, float(hit[2])))
    return sorted(found)


def test_report_round_trip(spark):
    path = fresh_path(spark, "report")
    R.write_report(S.rank_documents(scored(spark)), path, partitions=5)
    import glob

    text = "\n".join(open(p, encoding="utf-8").read() for p in sorted(glob.glob(f"{path}/part-*")))
    lines = [x for x in text.split("\n")]
    assert [x for x in lines if x][:7] == ["\ufeff情感分析详细结果", "==============", "汇总统计:", "正向报道: 3篇",
                                          "负面报道: 2篇", "中性报道: 5篇", "总计: 10篇"]
    assert "1. c (得分: 0.991)" in lines and "负面报道列表 (共2篇):" in lines
    got = rows(R.read_report(spark, path), "title", "sentiment", "compound")
    assert got == sorted(model_report(text), key=repr) and len(got) == 9  # the blank title cannot be read back


def test_report_with_bom_and_numbered_line_before_any_section(spark, tmp_path):
    path = tmp_path / "r.txt"
    body = "1. early (得分: 0.1)\n正向报道列表 (共1篇):\n1. T (x) (得分: 0.999)\n2. broken\n中性报道列表 (共1篇):\n1. m (得分: 0.000)\n"
    path.write_text(body, encoding="utf-8-sig")
    got = rows(R.read_report(spark, str(path)), "title", "sentiment", "compound")
    assert got == sorted(model_report(body), key=repr)
    assert got == [("T (x)", "positive", 0.999), ("m", "neutral", 0.0)]


def test_headings_carry_over_file_blocks(spark, tmp_path):
    body = "正向报道列表:\n" + "".join(f"{i}. t{i} (得分: 0.500)\n" for i in range(400)) + \
        "负面报道列表:\n" + "".join(f"{i}. u{i} (得分: -0.700)\n" for i in range(400))
    path = tmp_path / "long.txt"
    path.write_text(body, encoding="utf-8")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        lines = R.read_lines(spark, str(path))
        assert lines.rdd.getNumPartitions() > 5
        got = rows(R.parse_report(lines), "title", "sentiment", "compound")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == sorted(model_report(body), key=repr) and len(got) == 800


def test_load_form(spark):
    got = {r.title: r for r in S.load_form(scored(spark)).collect()}
    assert float(got["c"].sentiment_score) == round((0.991 + 1) * 5, 2) and got["c"].fits_v1_schema
    assert float(got["n2"].negative_rate) == 90 and float(got["n2"].emotion_joy) == 10
    assert float(got["y"].positive_rate) == 50 and float(got["y"].emotion_fear) == 70
    top = S.load_form(spark.createDataFrame([("positive", 0.9996)], "sentiment string, compound double")).first()
    assert float(top.sentiment_score) == 10.0 and not top.fits_v1_schema


def test_match_by_title_takes_the_first_id(spark):
    corpus = spark.createDataFrame([(7, "a"), (3, "a"), (5, "b"), (6, None)], "id long, title string")
    scores = spark.createDataFrame([(1, "a"), (2, "x"), (3, None), (4, "a")], "n int, title string")
    got = rows(S.match_by_title(scores, corpus), "n", "corpus_id")
    assert got == [(1, 3), (2, None), (3, None), (4, 3)]
