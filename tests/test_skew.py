from pyspark.sql import functions as F

from newslens.operators.ranking import first_per_group, number_rows, top_per_group
from newslens.operators.skew import bounded_broadcast, lookup
from newslens.session import written

from .conftest import rows


def test_lookup_with_hot_keys_equals_left_join(spark):
    left = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(
        F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("key"))
    right = spark.createDataFrame([("hot", 1, "h")] + [(f"k{i}", i, str(i)) for i in range(0, 50, 2)], "key string, v int, w string")
    plain = rows(left.join(right, "key", "left"), "id", "key", "v", "w")
    assert rows(lookup(left, right, "key", hot_rows=100), "id", "key", "v", "w") == plain
    assert rows(lookup(left, right, "key", hot_rows=1, hot_keys=5), "id", "key", "v", "w") == plain
    assert rows(lookup(left, right.where("key <> 'hot'"), "key", hot_rows=100), "id", "v") == rows(
        left.join(right.where("key <> 'hot'"), "key", "left"), "id", "v")


def test_hot_rows_are_not_shuffled(spark, tmp_path):
    spark.range(8000).select("id", F.when(F.col("id") % 3 < 2, "hot").otherwise(F.col("id").cast("string")).alias("key")
                             ).write.parquet(str(tmp_path / "left"))
    left = spark.read.parquet(str(tmp_path / "left"))
    right = spark.createDataFrame([("hot", 1), ("2", 2)], "key string, v int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup(left, right, "key", hot_rows=100)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        hot_rows = joined.where("v = 1").count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # of the two exchanges one carries the right side, the other the left rows of ordinary keys
    assert plan.count("Exchange hashpartitioning") == 2 and "SortMergeJoin" in plan and "LeftAnti" in plan
    assert hot_rows == 5333 or hot_rows == 5334


def test_number_rows_is_dense_under_hot_values(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 10 < 8, 0).otherwise(F.col("id") % 10).alias("v"),
                                  F.when(F.col("id") % 5 < 4, "big").otherwise("small").alias("g"))
    got = number_rows(df, [F.col("v"), F.desc("id")], "no", partitions=7).orderBy("no").collect()
    assert [r.no for r in got] == list(range(1, 5001))
    assert [(r.v, -r.id) for r in got] == sorted((r.v, -r.id) for r in got)
    for g, n in (("big", 4000), ("small", 1000)):
        part = number_rows(df, [F.col("v"), F.col("id")], "no", ["g"], 7).where(F.col("g") == g).orderBy("no").collect()
        assert [r.no for r in part] == list(range(1, n + 1))
        assert [(r.v, r.id) for r in part] == sorted((r.v, r.id) for r in part)


def test_number_rows_keeps_null_groups_and_empty_input(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "id int, g string")
    assert rows(number_rows(df, [F.col("id")], "no", ["g"]), "id", "no") == [(1, 1), (2, 2), (3, 1)]
    assert number_rows(df.where("id > 9"), [F.col("id")], "no").count() == 0


def test_group_limit_runs_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "g")
    spark.range(100).select("id", F.lit("one").alias("g")).write.parquet(path)
    df = top_per_group(spark.read.parquet(path), ["g"], [F.col("id")], 3)
    plan = df._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below and "Partial" in below
    assert rows(df, "id", "rank_no") == [(0, 1), (1, 2), (2, 3)]
    assert first_per_group(spark.read.parquet(path), ["g"], [F.desc("id")]).first().id == 99


def test_broadcast_only_below_the_bound(spark):
    small, large = spark.range(10), spark.range(50)
    assert "broadcast" in bounded_broadcast(small, 20)._jdf.queryExecution().toString().lower()
    assert "broadcast" not in bounded_broadcast(large, 20)._jdf.queryExecution().toString().lower()


def test_lookup_computes_the_table_once_without_hot_keys(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    left = written(spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, n int"), "left")
    right = spark.createDataFrame([("a", 10), ("c", 30)], "k string, v int").coalesce(1).mapInArrow(counted, "k string, v int")
    got = lookup(left, right, "k")
    assert rows(got, "n", "v") == [(1, 10), (2, 10), (3, None), (4, None)]
    assert got.columns == ["k", "n", "v"]
    assert seen.value == 2
