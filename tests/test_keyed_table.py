"""Stored tables that change by key."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from newslens.sources.keyed_table import KeyedTable

from .conftest import rows

SCHEMA = "k long, part string, n long"


def table_of(spark, path, keys=("k", "part"), **more):
    return KeyedTable(spark, str(path), spark.createDataFrame([], SCHEMA).schema, list(keys), **{"buckets": 8, "parts": 2, **more})


def frame(spark, *cells):
    return spark.createDataFrame(list(cells), SCHEMA)


def files(path):
    return {os.path.relpath(f, path): os.path.getmtime(f) for f in glob.glob(f"{path}/rows/**/*.parquet", recursive=True)}


def test_empty_table(spark, tmp_path):
    table = table_of(spark, tmp_path)
    assert table.read().count() == 0 and table.read().columns == ["k", "part", "n"]
    table.upsert(frame(spark))
    table.delete(frame(spark, (1, "a", 0)))
    table.compact()
    assert table.read().count() == 0


def test_upsert_replaces_keys_and_leaves_other_buckets_alone(spark, tmp_path):
    table = table_of(spark, tmp_path, buckets=16)
    table.upsert(frame(spark, *[(i, "a", i) for i in range(60)], (None, None, 5)))
    before = files(tmp_path)
    table.upsert(frame(spark, (3, "a", 300), (3, "b", 301), (None, None, 6)))
    expected = sorted([*[(i, "a", i) for i in range(60) if i != 3], (3, "a", 300), (3, "b", 301), (None, None, 6)], key=repr)
    assert rows(table.read()) == expected
    touched = set(table.touched(frame(spark, (3, "a", 0), (3, "b", 0), (None, None, 0))))
    kept = {f: t for f, t in before.items() if f"/bucket={'x'}/" not in f and int(f.split("bucket=")[1].split("/")[0]) not in touched}
    assert kept and kept.items() <= files(tmp_path).items()
    live = table.snapshot().live
    assert {b for b, gens in live.items() if gens == [2]} == touched


def test_reads_scan_chosen_buckets_only(spark, tmp_path):
    table = table_of(spark, tmp_path)
    table.upsert(frame(spark, *[(i, "a", i) for i in range(40)]))
    some = table.read([1, 2])
    assert 0 < some.count() < 40 and set(table.touched(some)) == {1, 2}
    assert "PartitionFilters" in some._jdf.queryExecution().executedPlan().toString()


def test_deletions_hide_older_rows_until_compacted(spark, tmp_path):
    table = table_of(spark, tmp_path, keys=["k"])
    table.append(frame(spark, *[(i % 10, "a", i) for i in range(50)], (None, "x", 1)))
    before = files(tmp_path)
    table.delete(frame(spark, (3, None, None), (7, None, None), (99, None, None), (None, None, None)))
    assert files(tmp_path) == before  # no file with rows is written
    left = sorted([(i % 10, "a", i) for i in range(50) if i % 10 not in (3, 7)], key=repr)
    assert rows(table.read()) == left
    # a key may come back: the deletion is older
    table.append(frame(spark, (3, "new", 1)))
    assert rows(table.read()) == sorted([*left, (3, "new", 1)], key=repr)
    table.compact()
    assert rows(table.read()) == sorted([*left, (3, "new", 1)], key=repr) and table.snapshot().gone == {}
    stored = spark.read.parquet(f"{tmp_path}/rows")
    live = {(g, b) for b, gens in table.snapshot().live.items() for g in gens}
    kept = [r for r in stored.collect() if (r.gen, r.bucket) in live]
    assert not [r for r in kept if r.k == 7]


def test_a_change_that_broke_down_does_not_count(spark, tmp_path, monkeypatch):
    table = table_of(spark, tmp_path)
    table.upsert(frame(spark, (1, "a", 1), (2, "a", 2)))
    with monkeypatch.context() as m:
        def fail(*_):
            raise RuntimeError("lost")
        m.setattr(KeyedTable, "_commit", fail)
        with pytest.raises(RuntimeError):
            table.upsert(frame(spark, (1, "a", 10), (3, "a", 3)))
    assert rows(table.read()) == [(1, "a", 1), (2, "a", 2)]
    table.upsert(frame(spark, (2, "a", 20)))  # the same generation, written over the leftovers
    assert rows(table.read()) == [(1, "a", 1), (2, "a", 20)]


def test_add_up_and_take_away(spark, tmp_path):
    table = table_of(spark, tmp_path)
    alive = F.col("n") != 0
    table.add_up(frame(spark, (1, "a", 5), (1, "a", 2), (2, "a", 1)), upto=4, alive=alive)
    table.add_up(frame(spark, (1, "a", -3), (2, "a", -1), (3, "a", 9)), upto=7, alive=alive)
    assert rows(table.read()) == [(1, "a", 4), (3, "a", 9)] and table.snapshot().upto == 7


def test_old_generations_are_dropped(spark, tmp_path):
    table = table_of(spark, tmp_path, buckets=1, parts=1)
    for i in range(6):
        table.upsert(frame(spark, (1, "a", i)))
    assert rows(table.read()) == [(1, "a", 5)]
    assert len(glob.glob(f"{tmp_path}/rows/gen=*")) <= 2 and len(glob.glob(f"{tmp_path}/snapshots/gen=*")) <= 2


def test_appends_are_merged_when_many(spark, tmp_path):
    table = table_of(spark, tmp_path, buckets=2)
    for i in range(6):
        table.append(frame(spark, *[(k, "a", i) for k in range(4)]))
    table.compact(most=4)
    assert all(len(gens) == 1 for gens in table.snapshot().live.values()) and table.read().count() == 24
