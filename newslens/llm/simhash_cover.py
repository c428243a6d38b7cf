"""SimHash near-duplicates by anchor-point covering.

Two fingerprints that differ in at most 3 bits differ in at most 1 bit in one of
their 32-bit halves. The anchors of a half are the words of a covering code: on
bits 1..31 the perfect Hamming code (every word lies within 1 bit of an anchor),
bit 0 as it is. A fingerprint goes to every anchor within covering radius plus
threshold (1 + 1 = 2 bits, 16.5 on average); a pair therefore meets at the anchor
next to either of its ends. Whole fingerprints are compared there.

Equal fingerprints are one node. Anchors that hold many fingerprints are refined
by a second covering (Hamming code on 15 bits, again radius plus threshold) of
the quarters of the other half, so that no anchor's list grows with the corpus.
Each anchor returns a spanning forest of its links, never all pairs.

Words are runs without ASCII white space after lower-casing A-Z; shingles are
three words joined by a space (repeats count; fewer words: all of them). Null
counts as empty, and texts without a word have fingerprint zero.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from newslens.llm.common import as_bytes, by_group, columns_of, free, stored, tie_order
from newslens.llm.components import components

SHINGLE = 3
SEED = 42
MAX_BITS = 3
HOT_ANCHOR = 4096  # fingerprints at one anchor beyond which it is refined
_BLOCK = 200_000   # rows that a comparing task holds at once


def shingles(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """Hashes of all shingles of a text, in order."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()]
    if len(words) <= shingle:
        spans = [(0, len(joined))]
    else:
        spans = zip(starts, (ends[shingle - 1:] - 1).tolist())
    return np.array([xxhash.xxh64_intdigest(joined[s:e], SEED) for s, e in spans], np.uint64)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    h = shingles(text, shingle)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 65_536):  # bounded memory for very long texts
        bits = np.unpackbits(h[i:i + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(ones * 2 > len(h)).tolist())


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in as_bytes(batch.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


class Cover:
    """Anchors of the words of ``width`` (a power of two) bits within 2 bits.

    The Hamming code's syndrome is the xor of the positions of the set bits;
    position 0 adds nothing, so that bit is kept as it is. The anchors of x are
    x ^ v for the patterns v of up to two bits with the syndrome of x.
    """

    def __init__(self, width: int):
        self.width = width
        rows: list[list[int]] = [[] for _ in range(width)]
        for n in range(3):
            for bits in combinations(range(width), n):
                s = 0
                for b in bits:
                    s ^= b
                rows[s].append(sum(1 << b for b in bits))
        self.most = max(map(len, rows))
        self.patterns = np.zeros((width, self.most), np.uint64)
        self.real = np.zeros((width, self.most), bool)
        for s, row in enumerate(rows):
            self.patterns[s, :len(row)], self.real[s, :len(row)] = row, True

    def anchors(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row number, anchor) of every anchor of every word."""
        syndrome = np.zeros(len(words), np.int64)
        for b in range(1, self.width):
            syndrome ^= np.where((words >> np.uint64(b)) & np.uint64(1), b, 0)
        rows, which = np.nonzero(self.real[syndrome])
        return rows, words[rows] ^ self.patterns[syndrome[rows], which]


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


def to_anchors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """fp -> (half, anchor, sub, fp); ``sub`` is 0 until an anchor is refined."""
    cover = Cover(32)
    for batch in batches:
        signed = _column(batch, "fp")
        for begin in range(0, len(signed), 20_000):
            part = signed[begin:begin + 20_000]
            fp = part.view(np.uint64)
            for half in (0, 1):
                rows, anchor = cover.anchors((fp >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), half, np.int32)), pa.array(anchor.astype(np.int64)),
                     pa.array(np.zeros(len(rows), np.int64)), pa.array(part[rows])],
                    names=["half", "anchor", "sub", "fp"])


def to_sub_anchors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Refine rows of a hot anchor by the two quarters of the other half."""
    cover = Cover(16)
    for batch in batches:
        half, anchor, signed = (_column(batch, c) for c in ("half", "anchor", "fp"))
        other = signed.view(np.uint64) >> np.where(half == 0, 32, 0).astype(np.uint64)
        for quarter in (0, 1):
            rows, sub = cover.anchors((other >> np.uint64(16 * quarter)) & np.uint64(0xFFFF))
            yield pa.RecordBatch.from_arrays(
                [pa.array(half[rows].astype(np.int32)), pa.array(anchor[rows]),
                 pa.array(sub.astype(np.int64) + ((quarter + 1) << 16)), pa.array(signed[rows])],
                names=["half", "anchor", "sub", "fp"])


def forest(fps: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Spanning forest of the links among distinct fingerprints (positions)."""
    edges, left = [], np.arange(len(fps))
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            node = queue.pop()
            near = np.bitwise_count(fps[left] ^ fps[node]) <= bits
            if near.any():
                found = left[near]
                edges += [(int(node), int(x)) for x in found]
                queue += found.tolist()
                left = left[~near]
    return edges


def link(batches: Iterable[pa.RecordBatch], bits: int = MAX_BITS) -> Iterator[pa.RecordBatch]:
    """Links inside each (half, anchor, sub) group; rows come sorted by group."""
    for part in by_group(batches, ["half", "anchor", "sub"], _BLOCK):
        fp = _column(part, "fp")
        n = len(fp)
        same = np.ones(max(n - 1, 0), bool)
        for c in ("half", "anchor", "sub"):
            k = _column(part, c)
            same &= k[1:] == k[:-1]
        start = np.flatnonzero(np.concatenate(([True], ~same)))
        size = np.diff(np.append(start, n))
        u = fp.view(np.uint64)
        a, b = [], []
        small = np.repeat(size <= 8, size)
        left = np.repeat(start + size, size) - np.arange(n)  # rows to the end of the group
        for shift in range(1, 8):
            i = np.flatnonzero(small & (left > shift))
            i = i[np.bitwise_count(u[i] ^ u[i + shift]) <= bits]
            a.append(fp[i])
            b.append(fp[i + shift])
        for s, z in zip(start[size > 8], size[size > 8]):
            e = forest(u[s:s + z], bits)
            if e:
                x = np.array(e)
                a.append(fp[s + x[:, 0]])
                b.append(fp[s + x[:, 1]])
        a, b = np.concatenate(a), np.concatenate(b)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def links(fps: DataFrame, hot: int = HOT_ANCHOR) -> DataFrame:
    """(a, b): links between distinct fingerprints that join all within MAX_BITS.

    ``fps`` is a stored table of distinct values ``fp``.
    """
    key, schema = ["half", "anchor"], "half int, anchor long, sub long, fp long"
    # the list of fingerprints is short beside the work on it: more tasks than its files
    rows = fps.repartition("fp").mapInArrow(to_anchors, schema)
    crowded = stored(rows.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > hot).select(*key), "hot-anchors")
    plain = rows.join(crowded, key, "left_anti")
    refined = rows.join(crowded, key, "left_semi").select("half", "anchor", "fp").mapInArrow(to_sub_anchors, schema)
    met = plain.select("half", "anchor", "sub", "fp").unionByName(refined)
    return met.repartition("half", "anchor", "sub").sortWithinPartitions("half", "anchor", "sub").mapInArrow(
        link, "a long, b long").distinct()


def classes(keyed: DataFrame, hot: int = HOT_ANCHOR, edges: DataFrame | None = None) -> DataFrame:
    """(fp, root, component_id) for every fingerprint of the stored table (doc_id, fp).

    ``edges`` (a, b) are the links; by default those between near fingerprints.
    """
    distinct = stored(keyed.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    if edges is None:
        edges = links(distinct.select("fp"), hot)
    roots = components(stored(edges, "links"))
    of = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    least = of.groupBy("root").agg(F.min("least").alias("component_id"))
    return stored(of.join(least, "root").select("fp", "root", "component_id"), "classes")


def near_groups(docs: DataFrame, shingle: int = SHINGLE, hot: int = HOT_ANCHOR) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest doc_id reachable by links.

    Rows without a doc_id take part; they get the id of their group, null if it has none.
    """
    keyed = stored(fingerprints(docs, shingle), "fingerprints")
    return keyed.join(classes(keyed, hot), "fp").select("doc_id", "fp", "component_id")


def drop_near_copies(docs: DataFrame, shingle: int = SHINGLE, hot: int = HOT_ANCHOR) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of each group.

    It is the row with the smallest doc_id (none counts as last); ties go by
    fingerprint and then by the other columns.
    """
    fp, = free(docs, "_fp")
    schema = StructType([*docs.schema.fields, StructField(fp, LongType())])
    at = docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in as_bytes(batch.column(at))], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(fps.view(np.int64))], names=[*batch.schema.names, fp])

    marked = stored(docs.mapInArrow(run, schema), "marked-documents")
    return one_of_each(docs, marked, fp, classes(marked.select("doc_id", F.col(fp).alias("fp")), hot))


def one_of_each(docs: DataFrame, marked: DataFrame, fp: str, named: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay; ``marked`` has them with ``fp``, ``named`` the groups."""
    no, = free(marked, "_no")
    keyed = marked.select("doc_id", F.col(fp).alias("fp"))
    winners = keyed.join(named, "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(
        F.min("fp").alias("fp"), F.min("doc_id").alias("id"))
    kept = marked.join(winners.select(F.col("fp").alias("_w"), "id"),
                       (marked[fp] == F.col("_w")) & marked["doc_id"].eqNullSafe(F.col("id")), "left_semi")
    once = Window.partitionBy("doc_id", fp).orderBy(*tie_order(docs))
    return kept.withColumn(no, F.row_number().over(once)).where(F.col(no) == 1).select(*columns_of(docs))
