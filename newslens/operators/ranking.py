"""Row numbers over groups of any size.

A plain ``row_number()`` sends a whole group to one task. The functions here
keep that window only where Spark can cut each task's rows to ``k`` before the
shuffle, and number unbounded groups by range partitions instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from newslens.operators.skew import bounded_broadcast
from newslens.session import written

_SLOT_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int,
                  rank: str = "rank_no") -> DataFrame:
    """The first ``k`` rows of each group.

    The rank filter lets Spark plan a group limit ahead of the shuffle, so a
    group that holds a third of the table leaves each task as ``k`` rows.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def first_per_group(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return top_per_group(df, keys, order, 1, "_first").drop("_first")


def number_rows(df: DataFrame, order: list[Column], out: str, within: list[str] | None = None,
                partitions: int | None = None) -> DataFrame:
    """Consecutive numbers from 1 in ``order``, restarting for each ``within`` group.

    ``order`` must be total (end it with a unique column). Rows are laid out by
    range, so neither a hot group nor a hot sort value meets in one task; the
    only thing that is summed up centrally is one row per partition and group.
    Laying out by range reads the input twice (once to sample it), hence the
    input is stored first and never computed twice.
    """
    within = within or []
    keys = [F.col(c) for c in within] + order
    df = written(df, "unnumbered")
    spread = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    slots = written(
        spread.sortWithinPartitions(*keys).withColumn("_slot", F.monotonically_increasing_id()),
        "numbered",
    ).withColumn("_part", F.shiftright("_slot", _SLOT_BITS))
    low = F.col("_slot").bitwiseAND(2 ** _SLOT_BITS - 1)
    runs = slots.groupBy("_part", *within).agg(
        F.count("*").alias("_n"), F.min(low).alias("_low"))
    before = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    before = before.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        F.col("_part").alias("_p"), *[F.col(c).alias(f"_g_{c}") for c in within],
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_low") + 1).alias("_shift"),
    )
    match = slots["_part"] == starts["_p"]
    for c in within:
        match = match & slots[c].eqNullSafe(starts[f"_g_{c}"])
    # one row per partition and one per group boundary, so few unless groups are many
    joined = slots.join(bounded_broadcast(starts), match)
    return joined.select(*df.columns, (low + F.col("_shift")).alias(out))


def number_wide(df: DataFrame, order: list[Column], out: str, partitions: int | None = None) -> DataFrame:
    """``number_rows`` for rows with long texts: only the keys are laid out by range.

    The rows are stored once, each with its slot; the numbers come back to the
    slots, by broadcast where there are few.
    """
    stored = written(df.withColumn("_slot_no", F.monotonically_increasing_id()), "wide")
    keys = [F.col(f"_key_{i}") for i in range(len(order))]
    narrow = stored.select("_slot_no", *[c.alias(f"_key_{i}") for i, c in enumerate(order)])
    numbered = number_rows(narrow, [*keys, F.col("_slot_no")], out, partitions=partitions).select("_slot_no", out)
    return stored.join(bounded_broadcast(written(numbered, "numbers")), "_slot_no").drop("_slot_no")
