from decimal import Decimal

from pyspark.sql import functions as F

from newslens.functions.numbers import exact_round, percent, ten_point


def test_exact_round_equals_python(spark):
    raw = [i / 1000 for i in range(-1000, 1001)]
    df = spark.createDataFrame([(x, (x + 1) * 5) for x in raw], "x double, y double")
    for r in df.select("x", "y", exact_round(F.col("y"), 2).alias("two")).collect():
        assert r.two == round(r.y, 2)
    odd = [i / 10000 + 0.00005 for i in range(-9999, 9999, 7)] + [0.9915, -0.2675, 2.675, 1.005, 0.0]
    for r in spark.createDataFrame([(x,) for x in odd], "x double").select(
            "x", exact_round(F.col("x"), 3).alias("three"), exact_round(F.col("x"), 4).alias("four")).collect():
        assert r.three == round(r.x, 3) and r.four == round(r.x, 4)


def test_ten_point(spark):
    df = spark.createDataFrame([(0.999,), (1.0,), (-1.0,), (0.991,), (0.0,)], "c double")
    got = [r[0] for r in df.select(ten_point(F.col("c"))).collect()]
    assert got == [Decimal(str(f"{round((x + 1) * 5, 2):.2f}")) for x in (0.999, 1.0, -1.0, 0.991, 0.0)]
    assert got[0] == Decimal("10.00")  # does not fit DECIMAL(3,2)


def test_percent(spark):
    df = spark.createDataFrame([(1, 3), (2, 3), (1, 8), (0, 5), (7, 0), (10**13, 3 * 10**13)], "a long, b long")
    got = [r[0] for r in df.select(percent(F.col("a"), F.col("b"), 4)).collect()]
    assert got == [33.3333, 66.6667, 12.5, 0.0, None, 33.3333]
