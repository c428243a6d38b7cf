"""Exact deduplication with a heavy-hitter split.

A Misra-Gries summary per partition finds digests that may be frequent. Their
exact counts decide which really are; these few winners are broadcast and their
copies settled in the map task. All other digests hold a small share of the rows
each and take an ordinary shuffle.

Texts are equal when identical after each run of white space is replaced by one
space. Null counts as an empty text. The row with the smallest doc_id stays
(rows without one come last); of repeated rows with that doc_id exactly one stays.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from newslens.llm.common import WHITE_SPACE, columns_of, free, stored, tie_order

COUNTERS = 1024  # bound of each summary and of the broadcast


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, " ")


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


def misra_gries(batches: Iterable[pa.RecordBatch], counters: int) -> Iterator[pa.RecordBatch]:
    """The summary of one partition: at most ``counters`` (digest, n), n never too high.

    Whole batches are added at once; the decrement then takes the value of the
    largest counter that does not fit, which keeps the bound rows / (counters + 1).
    """
    kept: Counter = Counter()
    for batch in batches:
        kept.update(batch.column(0).to_pylist())
        if len(kept) > counters:
            cut = sorted(kept.values(), reverse=True)[counters]
            kept = Counter({k: n - cut for k, n in kept.items() if n > cut})
    if kept:
        yield pa.RecordBatch.from_arrays(
            [pa.array(kept.keys(), pa.binary()), pa.array(kept.values(), pa.int64())],
            names=["digest", "n"])


def heavy_digests(keyed: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Digests that own more than 1/counters of the rows, with exact count and smallest id.

    ``keyed`` has (doc_id, digest) and is read three times: store it first. The
    result has at most ``counters`` rows whatever the input.
    """
    total = keyed.count()
    candidates = stored(
        keyed.select("digest").mapInArrow(lambda it: misra_gries(it, counters), "digest binary, n long")
        .groupBy("digest").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "digest").limit(counters).select("digest"), "heavy-candidates")
    return stored(
        keyed.join(F.broadcast(candidates), "digest")
        .groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .where(F.col("group_size") > total / counters), "heavy-digests")


def mark_copies(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """(doc_id, digest, keep_id, group_size, kept) for every row of ``docs``."""
    keyed = stored(docs.select("doc_id", digest(F.col("text")).alias("digest")), "digests")
    heavy = heavy_digests(keyed, counters)
    hot = keyed.join(F.broadcast(heavy), "digest")
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    # the rows of a winner's own id: usually one, repeats are counted before they move
    own = (
        hot.where(stays).groupBy("doc_id", "digest", "keep_id", "group_size").agg(F.count("*").alias("_n"))
        .select("doc_id", "digest", "keep_id", "group_size",
                F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))).alias("_i"))
        .select("doc_id", "digest", "keep_id", "group_size", (F.col("_i") == 1).alias("kept"))
    )
    gone = hot.where(~stays).select("doc_id", "digest", "keep_id", "group_size", F.lit(False).alias("kept"))
    group = Window.partitionBy("digest")
    first = F.row_number().over(group.orderBy(F.asc_nulls_last("doc_id"))) == 1
    rest = keyed.join(F.broadcast(heavy.select("digest")), "digest", "left_anti").select(
        "doc_id", "digest", F.min("doc_id").over(group).alias("keep_id"),
        F.count("*").over(group).alias("group_size"), first.alias("kept"))
    return rest.unionByName(gone).unionByName(own)


def drop_copies(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Copies of heavy digests are dropped before the shuffle; of each other digest
    a task sends on one row at most.
    """
    keyed = stored(docs.select("doc_id", digest(F.col("text")).alias("digest")), "digests")
    key, keep, no = free(docs, "_digest", "_keep", "_no")
    heavy = heavy_digests(keyed, counters).select(
        F.col("digest").alias(key), F.struct("keep_id").alias(keep))
    marked = docs.withColumn(key, digest(F.col("text"))).join(F.broadcast(heavy), key, "left")
    left = marked.where(F.col(keep).isNull() | F.col("doc_id").eqNullSafe(F.col(keep)["keep_id"]))
    order = Window.partitionBy(key).orderBy(*tie_order(docs))
    return left.withColumn(no, F.row_number().over(order)).where(F.col(no) == 1).select(*columns_of(docs))
