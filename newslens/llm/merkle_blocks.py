"""Merkle manifest of a dataset in blocks that are laid out recursively.

Every document is a leaf, every ``FAN`` consecutive nodes become their hash, per source first, then over the sources'
roots. The tree is stored in aligned subtrees of ``HEIGHT`` levels of hashing. Inside a block the nodes lie in van
Emde Boas order: the upper half of the levels first, then each subtree below it, every part laid out likewise. One
address function serves the building of a block, and finding a node's siblings. The roots of the blocks are the
leaves of the next layer of blocks, so a layer has 4,096 times fewer rows than the one below, and each block, however
large its source is, is a task's work of bounded size.

Texts are hashed where they are read; only digests travel.

Nulls: a null source is a source of its own, before all others; a null doc_id comes before all others and is never
tampered with. Rows that share a doc_id are ordered by their leaf, fully equal rows are leaves of their own. An empty
table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from newslens.llm.common import batch_of, stored
from newslens.operators.ranking import number_rows

FAN = 16
HEIGHT = 3
BLOCK = FAN ** HEIGHT
DIGEST = 32
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def nodes_in(levels: int) -> int:
    return (FAN ** levels - 1) // (FAN - 1)


def address(levels: int, level: int, index):
    """Place of node ``index`` of ``level`` (the root's is 0) in a tree of ``levels`` levels; also for arrays."""
    if levels == 1:
        return index * 0
    top = levels // 2
    if level < top:
        return address(top, level, index)
    width = FAN ** (level - top)
    return nodes_in(top) + (index // width) * nodes_in(levels - top) + address(levels - top, level - top, index % width)


@lru_cache(maxsize=HEIGHT * 4)
def _places(height: int, level: int) -> np.ndarray:
    return address(height + 1, level, np.arange(FAN ** level))


def height_of(n: int, alone: bool) -> int:
    """Levels of hashing in a block of ``n`` nodes; a source's only block is as low as it can be."""
    height = 0
    while FAN ** height < n:
        height += 1
    return height if alone else HEIGHT


def lay_out(digests: list[bytes], height: int) -> bytes:
    """The nodes above (and with) these leaves in van Emde Boas order, cut behind the last one."""
    last = max(int(_places(height, level)[max(0, -(-len(digests) // FAN ** (height - level)) - 1)])
               for level in range(height + 1))
    nodes = [bytes(DIGEST)] * (last + 1)
    n = len(digests)
    for place, digest in zip(_places(height, height)[:n].tolist(), digests):
        nodes[place] = digest
    for level in range(height, 0, -1):
        below = _places(height, level)[:n].tolist()
        n = -(-n // FAN)
        for i, place in enumerate(_places(height, level - 1)[:n].tolist()):
            run = b"".join([nodes[p] for p in below[i * FAN:(i + 1) * FAN]])
            nodes[place] = sha256(run.hex().encode()).digest()
    return b"".join(nodes)


def node_at(nodes: bytes, height: int, level: int, index: int) -> bytes:
    place = int(_places(height, level)[index]) * DIGEST
    return nodes[place:place + DIGEST]


def path(nodes: bytes, height: int, n: int, slot: int) -> list[tuple[bytes, bytes]]:
    """Siblings on the left and on the right of a leaf's ancestors, level by level, without the root."""
    out = []
    for level in range(height, 0, -1):
        first = slot - slot % FAN
        places = _places(height, level)[first:min(first + FAN, n)].tolist()
        run = b"".join([nodes[p * DIGEST:(p + 1) * DIGEST] for p in places])
        at = (slot - first) * DIGEST
        out.append((run[:at], run[at + DIGEST:]))
        slot, n = slot // FAN, -(-n // FAN)
    return out


def packed(levels: list[tuple[bytes, bytes]]) -> bytes:
    return b"".join([bytes((len(a) // DIGEST, len(b) // DIGEST)) + a + b for a, b in levels])


def unpacked(data: bytes) -> list[tuple[bytes, bytes]]:
    out, at = [], 0
    while at < len(data):
        left, right = data[at] * DIGEST, data[at + 1] * DIGEST
        at += 2
        out.append((data[at:at + left], data[at + left:at + left + right]))
        at += left + right
    return out


def fold(digest: bytes, levels: list[tuple[bytes, bytes]]) -> bytes:
    """The root that this node and its siblings give."""
    for left, right in levels:
        digest = sha256((left + digest + right).hex().encode()).digest()
    return digest


BLOCKS = "source string, block long, n int, height int, nodes binary, root binary"
BLOCK_TYPES = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]


def build_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (source, block, digest), sorted by block and slot, to one row per block."""
    def out(done: list) -> pa.RecordBatch:
        return batch_of(["source", "block", "n", "height", "nodes", "root"], list(zip(*done)), BLOCK_TYPES)

    def block(key, digests):
        # the first block of a source is its only one unless it is full, and then its height is the same
        height = height_of(len(digests), key[1] == 0)
        nodes = lay_out(digests, height)
        return (*key, len(digests), height, nodes, nodes[:DIGEST])

    done, digests, last = [], [], None
    for batch in batches:
        for source, number, digest in zip(*(batch.column(c).to_pylist() for c in range(3))):
            if (source, number) != last and digests:
                done.append(block(last, digests))
                digests = []
                if len(done) >= 64:
                    yield out(done)
                    done = []
            last = source, number
            digests.append(digest)
    if digests:
        done.append(block(last, digests))
    if done:
        yield out(done)


def layers_over(nodes: DataFrame, label: str) -> list[DataFrame]:
    """Block tables over ``nodes`` (source, number from 0, digest), the lowest layer first.

    Ends when every source has one block; the number of layers is the logarithm of the largest source to base 4,096.
    """
    layers = []
    while True:
        blocks = stored(
            nodes.select("source", (F.col("number") / BLOCK).cast("long").alias("block"),
                         F.col("digest"), (F.col("number") % BLOCK).alias("slot"))
            .repartition("source", "block").sortWithinPartitions("source", "block", "slot")
            .mapInArrow(build_blocks, BLOCKS), f"{label}-{len(layers)}")
        layers.append(blocks)
        split = blocks.where("block > 0").select("source").distinct()
        if split.isEmpty():
            return layers
        nodes = same_source(blocks.select("source", "block", "root"), split, "left_semi").select(
            "source", F.col("block").alias("number"), F.col("root").alias("digest"))


def same_source(left: DataFrame, right: DataFrame, how: str, *more: str) -> DataFrame:
    """Join on source (null is one too) and on columns ``more``; columns of ``right`` keep other names."""
    right = right.withColumnsRenamed({c: f"_r_{c}" for c in ("source", *more)})
    match = F.col("source").eqNullSafe(F.col("_r_source"))
    for c in more:
        match = match & (F.col(c) == F.col(f"_r_{c}"))
    joined = left.join(right, match, how)
    return joined if how == "left_semi" else joined.drop("_r_source", *[f"_r_{c}" for c in more])


def hand_down(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The way to the root for every node below a block: (source, block, upper)."""
    for batch in batches:
        for source, block, n, height, nodes, upper in zip(*(c.to_pylist() for c in batch.columns)):
            ways = [packed(path(nodes, height, n, slot)) + upper for slot in range(n)]
            yield batch_of(["source", "block", "upper"],
                           [[source] * n, range(block * BLOCK, block * BLOCK + n), ways],
                           [pa.string(), pa.int64(), pa.binary()])


WAYS = "source string, block long, upper binary"


def ways_down(layers: list[DataFrame], above: DataFrame, label: str) -> DataFrame:
    """(source, block, upper) for the lowest layer; ``above`` has a source's way from its root on."""
    ways = None
    for depth in range(len(layers) - 1, -1, -1):
        blocks = layers[depth]
        # a source's top block is the only one of its layer, and has no block above
        most = blocks.groupBy("source").agg(F.max("block").alias("_most")).where("_most = 0").select("source")
        tops = same_source(same_source(blocks.select("source", "block"), most, "left_semi"), above, "inner")
        mine = tops.select("source", "block", "upper")
        ways = stored(mine if ways is None else mine.unionByName(ways), f"{label}-{depth}")
        if depth:
            ways = same_source(blocks, ways, "inner", "block").select(
                "source", "block", "n", "height", "nodes", "upper").mapInArrow(hand_down, WAYS)
    return ways


@dataclass(frozen=True)
class Manifest:
    """Stored tree: leaves (source, number, doc_id, tampered), blocks by layer, roots of sources, ways to the root."""

    leaves: DataFrame
    layers: list[DataFrame]
    sources: list[DataFrame]
    roots: DataFrame
    ways: DataFrame
    root: bytes | None


def field(column: str) -> Column:
    value = F.col(column).cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(text: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(c) for c in ("doc_id", "source", "lang", "n_chars")], text), 256))


def text_field(text: Column) -> Column:
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def build(docs: DataFrame) -> Manifest:
    """Hash all documents and store their tree in the shared folder."""
    tampers = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    leaves = docs.select(
        F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("doc_id"),
        leaf(text_field(F.col("text"))).alias("digest"),
        F.when(tampers, leaf(text_field(F.translate(F.col("text"), _UPPER, _LOWER)))).alias("tampered"))
    numbered = number_rows(leaves, [F.asc_nulls_first("doc_id"), F.asc("digest")], "number", ["source"])
    numbered = stored(numbered.withColumn("number", F.col("number") - 1), "merkle-leaves")
    layers = layers_over(numbered.select("source", "number", "digest"), "merkle-blocks")
    finished = None
    for blocks in layers:
        alone = blocks.groupBy("source").agg(F.max("block").alias("_most"), F.min_by("root", "block").alias("subroot"))
        one = alone.where("_most = 0").select("source", "subroot")
        finished = one if finished is None else finished.unionByName(one)
    roots = number_rows(finished, [F.asc_nulls_first("source")], "number")
    roots = stored(roots.withColumn("number", F.col("number") - 1), "merkle-roots")
    over = layers_over(roots.select(F.lit(None).cast("string").alias("source"), "number",
                                    F.col("subroot").alias("digest")), "merkle-sources")
    root = over[-1].select("root").first()
    none = over[-1].select("source", F.lit(b"").alias("upper"))
    outer = ways_down(over, none, "merkle-outer")
    # the ways of single sources: one step below the lowest layer over sources
    single = same_source(over[0], outer, "inner", "block").select(
        "source", "block", "n", "height", "nodes", "upper").mapInArrow(hand_down, WAYS)
    above = single.select(F.col("block").alias("number"), "upper").join(roots, "number").select("source", "upper")
    ways = ways_down(layers, stored(above, "merkle-above"), "merkle-ways")
    return Manifest(numbered, layers, over, roots, ways, root[0] if root else None)


PROOFS = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
          "verified boolean")
PROOF_TYPES = [pa.int64(), *[pa.string()] * 5, pa.bool_()]


def _proofs(root: bytes):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each block comes ahead of its leaves."""
        nodes, height, n, upper, subroot, rest = b"", 0, 0, [], b"", b""
        for batch in batches:
            done = []
            for slot, doc_id, tampered, *block in zip(*(c.to_pylist() for c in batch.columns)):
                if slot < 0:
                    nodes, height, n, way, subroot = block
                    upper = unpacked(way)
                    rest = b"".join([a + b for a, b in upper]).hex().encode()
                    continue
                own = path(nodes, height, n, slot)
                digest = node_at(nodes, height, height, slot)
                siblings = sha256(b"".join([a + b for a, b in own]).hex().encode() + rest)
                folded = fold(fold(tampered or digest, own), upper)
                done.append((doc_id, digest.hex(), subroot.hex(), root.hex(), siblings.hexdigest(), folded.hex(),
                             folded == root))
            if done:
                yield batch_of(["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
                               list(zip(*done)), PROOF_TYPES)

    return run


def prove(manifest: Manifest) -> DataFrame:
    """Every leaf with its siblings' digest and the root that it, or its tampered form, folds to."""
    if manifest.root is None:
        return manifest.leaves.sparkSession.createDataFrame([], PROOFS)
    way = same_source(manifest.ways, manifest.roots.select("source", "subroot"), "inner")
    blocks = same_source(manifest.layers[0], way, "inner", "block").select(
        "source", "block", F.lit(-1).cast("long").alias("slot"), F.lit(None).cast("long").alias("doc_id"),
        F.lit(None).cast("binary").alias("tampered"), "nodes", "height", "n", "upper", "subroot")
    empty = [F.lit(None).cast(kind).alias(c) for c, kind in blocks.dtypes[5:]]
    rows = manifest.leaves.select(
        "source", (F.col("number") / BLOCK).cast("long").alias("block"), (F.col("number") % BLOCK).alias("slot"),
        "doc_id", "tampered", *empty)
    return (
        rows.unionByName(blocks).repartition("source", "block").sortWithinPartitions("source", "block", "slot")
        .drop("source", "block").mapInArrow(_proofs(manifest.root), PROOFS))


def document_proofs(docs: DataFrame) -> DataFrame:
    return prove(build(docs))
