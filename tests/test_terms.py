import re
from collections import Counter

from pyspark.sql import functions as F

from newslens import constants as K
from newslens.operators import terms

from .conftest import rows

DOCS = [
    (1, "The cat sat; the CAT ran. café CAT's naïve cat_x x1 at3 Cats cats cats"),
    (2, "Weather weather weather! it's 5pm, a b cc cc cc cc 中国发展 good中国good"),
    (3, ""),
    (4, None),
]


def frame(spark):
    return spark.createDataFrame(DOCS, "id int, body string")


def test_english_counts_match_python(spark):
    expected = Counter()
    for _, text in DOCS:
        for w in re.findall(r"\b[a-zA-Z]+\b", text or ""):
            w = w.lower()
            if len(w) > 1 and w not in set(K.STOP_WORDS_EN_EXTENDED):
                expected[w] += 1
    got = dict(rows(terms.count_terms(terms.english_tokens(frame(spark))), "word", "n"))
    assert got == dict(expected)


def test_report_takes_top_k_before_minimum_and_sums_before_rounding(spark):
    docs = spark.createDataFrame([("aa aa aa aa bb bb bb cc cc cc dd dd ee",)], "body string")
    out = [tuple(r) for r in terms.english_report(docs, k=4).orderBy(F.desc("n"), "word").collect()]
    assert out == [("aa", 4, 30.7692, 30.7692), ("bb", 3, 23.0769, 53.8462), ("cc", 3, 23.0769, 76.9231)]


def test_cumulative_share_never_falls(spark):
    docs = spark.createDataFrame([(" ".join(f"w{chr(97 + i)}" for i in range(20) for _ in range(30 - i)),)], "body string")
    shares = [r.cum_freq_pct for r in terms.english_report(docs).orderBy(F.desc("n"), "word").collect()]
    assert shares == sorted(shares) and shares[-1] <= 100


def test_mixed_tokens_keep_case_and_use_bigrams(spark):
    got = Counter(r.word for r in terms.mixed_tokens(frame(spark)).collect())
    assert got["CAT"] == 2 and got["Cats"] == 1 and got["cats"] == 2 and "cc" not in got and "the" not in got
    assert got["中国"] == 2 and got["国发"] == 1 and got["发展"] == 1
    assert got["good"] == 0  # part of a run with Chinese letters


def test_segmentation_by_vocabulary(spark):
    docs = spark.createDataFrame([(1, "中国发展很快, 标题 研究生命起源"), (2, "plain")], "id int, body string")
    words = Counter(r.word for r in terms.mixed_tokens(
        docs, keep=["id"], vocabulary=["中国", "发展", "研究生", "生命", "起源"]).collect())
    # longest match from the left: 研究生 + (命) + 起源; 很快 is unknown
    assert words == Counter({"中国": 1, "发展": 1, "很快": 1, "研究生": 1, "起源": 1, "plain": 1})


def test_bigrams_agree_with_python_segmentation(spark):
    docs = spark.createDataFrame([(1, "我们研究生命起源 和平 中 中国人民")], "id int, body string")
    jvm = Counter(r.word for r in terms.mixed_tokens(docs).collect())
    python = Counter(r.word for r in terms.cjk_tokens(docs, "body", ["id"]).collect())
    assert jvm == python


def test_stop_words_from_a_table(spark):
    stops = spark.createDataFrame([("CAT",), ("weather",)], "word string")
    got = dict(rows(terms.count_terms(terms.english_tokens(frame(spark), stop_words=stops)), "word", "n"))
    assert "cat" not in got and "weather" not in got and got["the"] == 2


def test_totals_and_sheets(spark):
    counts = terms.count_terms(terms.mixed_tokens(frame(spark)))
    total = terms.term_totals(counts).first()
    assert total.total_tokens == sum(r.n for r in counts.collect()) and total.distinct_tokens == counts.count()
    report = counts.withColumn("lang", terms.token_language(F.col("word")))
    parts = terms.sheets(report)
    assert parts["zh"].count() + parts["en"].count() == parts["all"].count()
    assert terms.first_rows_per_sheet(report, 1).count() == 2


def test_total_is_computed_from_the_shared_shuffle(spark, tmp_path):
    path = str(tmp_path / "docs")
    frame(spark).write.parquet(path)
    df = terms.english_report(spark.read.parquet(path))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan or "ReusedSubquery" in plan or plan.count("TableCacheQueryStage") > 0 or \
        "ShuffleQueryStage" in plan


def cut_plainly(run, vocabulary):
    """Longest known word at each place, unknown stretches in pairs."""
    out, unknown, at = [], "", 0

    def pairs(part):
        return [part] if len(part) == 1 else [part[i:i + 2] for i in range(len(part) - 1)]

    while at < len(run):
        size = max((len(w) for w in vocabulary if len(w) > 1 and run.startswith(w, at)), default=0)
        if size:
            out += (pairs(unknown) if unknown else []) + [run[at:at + size]]
            unknown = ""
            at += size
        else:
            unknown += run[at]
            at += 1
    return out + (pairs(unknown) if unknown else [])


def test_segments_by_a_table_equal_the_plain_walk(spark):
    import random

    r = random.Random(12)
    vocabulary = {"".join(r.choices("中国发展生", k=r.randint(1, 5))) for _ in range(40)}
    runs = {"".join(r.choices("中国发展生命", k=r.randint(0, 14))) for _ in range(300)} | {"", "中", "命命命"}
    words = spark.createDataFrame([(w,) for w in vocabulary], "word string")
    got = terms.segment(spark.createDataFrame([(x,) for x in [*runs, None, "中国"]], "run string"), words)
    assert {x.run: list(x.words) for x in got.collect()} == {x: cut_plainly(x, vocabulary) for x in {*runs, "中国"}}
    none = terms.segment(spark.createDataFrame([("中国发",)], "run string"), words.where("false"))
    assert list(none.first().words) == ["中国", "国发"]
