"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newslens.session import written

BROADCAST_ROWS = 100_000
HOT_ROWS = 1_000_000
HOT_KEYS = 1_000


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast only after its size has been checked.

    Beyond the bound the frame is returned unmarked and Spark shuffles both
    sides, splitting skewed partitions at run time.
    """
    seen = df.limit(max_rows + 1).count()
    return F.broadcast(df) if seen <= max_rows else df


def lookup(left: DataFrame, right: DataFrame, key: str, hot_rows: int = HOT_ROWS,
           hot_keys: int = HOT_KEYS) -> DataFrame:
    """Left join to a table that is unique on ``key``, even for hot left keys.

    The (at most ``hot_keys``) keys that own ``hot_rows`` left rows or more are
    hot; a key beyond these holds less than 1/``hot_keys`` of the rows. See
    ``join_around`` for the join. ``left`` should be a stored table. Without a
    hot key ``right`` is computed once, else twice.
    """
    heavy = written(
        left.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
        .where(F.col("_n") >= hot_rows).orderBy(F.desc("_n"), key).limit(hot_keys).select(key), "heavy-keys")
    if heavy.isEmpty():
        return left.where(F.col(key).isNotNull()).join(right, key, "left").unionByName(_without_key(left, right, key))
    return join_around(left, right, heavy.join(right, key, "left"), key)


def _without_key(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    values = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema if f.name != key]
    return left.where(F.col(key).isNull()).select("*", *values)


def join_around(left: DataFrame, right: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """Left join in which rows of hot keys are answered without a shuffle.

    ``hot`` holds the right rows of the hot keys; it comes from a limit, hence
    the broadcast. All other rows take a shuffled join, rows without a key take
    none. Every left row comes out exactly once. ``left`` is read three times,
    so it should be a stored table.
    """
    hot = written(hot, "hot-keys")
    busy = left.join(F.broadcast(hot), key)
    others = left.where(F.col(key).isNotNull()).join(
        F.broadcast(hot.select(key)), key, "left_anti").join(right, key, "left")
    return busy.unionByName(others).unionByName(_without_key(left, right, key))
