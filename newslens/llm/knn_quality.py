"""Quality scores by the votes of near labelled documents in a latent semantic space.

Terms are hashed words, hashed forms of words (first and last kinds of sign) and levels of a document's shape. Their
document frequencies come from all documents. A bounded sample of labelled documents gives the term-document matrix
whose truncated singular vectors span the space; its vectors are broadcast. Every document is projected, and its
cosines with all labelled vectors are computed block by block as exact products; the ``NEIGHBOURS`` nearest ones (ties
with the last one included) vote with a power of their similarity.

The sample has at most ``LABELLED`` documents of each label, taken by hash; votes are weighted back to the labels' real
shares. Only rows whose crc32(doc_id) is not divisible by 5 may be sampled.

Nulls: a null text is empty, which has a shape and so a vector; a null doc_id counts as held out. A document with
several label rows has the label that most of them say (1 on a tie). Without any usable label all scores are 0.5.
Repeated rows get a score each. An empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from math import log2
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from newslens.llm.common import as_bytes, batch_of, stored
from newslens.operators.ranking import top_per_group

LABELLED = 2048     # sampled documents of each label, the bound of the fit and of the broadcast
NEIGHBOURS = 25
POWER = 4           # of the similarity in a vote
DIMENSIONS = 64
ROUNDS = 3          # of the power iteration
KEEP_FROM = 0.3

_PLACES = 1 << 40

WORDS, FORMS, LEVELS = 4096, 512, 16     # term spaces: hashed words, hashed forms, levels of each shape
SHAPES = 7
TERMS = WORDS + FORMS + LEVELS * SHAPES
SPACES = ((0, WORDS), (WORDS, WORDS + FORMS), (WORDS + FORMS, TERMS))

_KIND = bytes(ord("A") if 65 <= i <= 90 else ord("a") if 97 <= i <= 122 or i >= 128 else ord("0") if 48 <= i <= 57
              else i for i in range(256))
_LETTERS = bytes(i for i in range(256) if chr(i).isalnum() and i < 128 or i >= 128)
_SPACE = b" \t\n\r\x0b\x0c"


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5, F.lit(0)) == 0


def _level(share: float) -> int:
    return min(LEVELS - 1, int(share * LEVELS))


def shapes(text: bytes, words: list[bytes], distinct: int) -> list[int]:
    """One level for each shape: length, repetition, signs, capitals, length of words, repeated lines, stutter."""
    n, size = len(words), max(1, len(text))
    lines = [x for x in text.split(b"\n") if x.strip()]
    signs = len(text.translate(None, _LETTERS + _SPACE)) / size
    capitals = (len(text) - len(text.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))) / size
    return [
        min(LEVELS - 1, int(log2(n + 1))),
        _level(1 - distinct / n if n else 1.0),
        _level(min(1.0, signs * 3)),
        _level(capitals),
        min(LEVELS - 1, int(sum(map(len, words)) / n) if n else 0),
        _level(1 - len(set(lines)) / len(lines) if lines else 0.0),
        _level(sum(map(eq, words, words[1:])) / n if n else 0.0),
    ]


def terms(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Term numbers, ascending, and how often each occurs."""
    words = text.split()
    counted = Counter(text.lower().split())
    hashed = np.fromiter((crc32(w) % WORDS for w in counted), np.int64, len(counted))
    tf = np.bincount(hashed, np.fromiter(counted.values(), np.float64, len(counted)), TERMS)
    for form, n in Counter(text.translate(_KIND).split()).items():
        tf[WORDS + crc32(form[:1] + form[-3:]) % FORMS] += n
    for shape, level in enumerate(shapes(text, words, len(counted))):
        first = WORDS + FORMS + shape * LEVELS
        tf[first:first + level + 1] = 1  # a level holds all below it, so that near levels are near
    at = np.flatnonzero(tf)
    return at.astype(np.int16), tf[at].astype(np.float32)


TERM_ROWS = "doc_id long, held_out boolean, at array<short>, tf array<float>"


def term_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for start in range(0, whole.num_rows, 256):
            batch = whole.slice(start, 256)
            at, tf = zip(*map(terms, as_bytes(batch.column(2))))
            ends = pa.array(np.cumsum([0, *map(len, at)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.ListArray.from_arrays(ends, pa.array(np.concatenate(at))),
                 pa.ListArray.from_arrays(ends, pa.array(np.concatenate(tf)))],
                names=["doc_id", "held_out", "at", "tf"])


def _lists(column: pa.Array) -> Iterator[np.ndarray]:
    flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return (flat[a:b] for a, b in zip(ends[:-1], ends[1:]))


def frequencies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The document frequencies of one task."""
    df = np.zeros(TERMS, np.int64)
    rows = 0
    for batch in batches:
        column = batch.column(0)
        ends = column.offsets.to_numpy()
        df += np.bincount(column.values.to_numpy(zero_copy_only=False)[ends[0]:ends[-1]], minlength=TERMS)
        rows += batch.num_rows
    yield batch_of(["term", "n"], [range(-1, TERMS), [rows, *df.tolist()]], [pa.int32(), pa.int64()])


def weights(rows: int, df: np.ndarray) -> np.ndarray:
    return np.log((1 + rows) / (1 + df)) + 0.1


def vector(at: np.ndarray, tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Weights of a document's terms; each space of terms has length 1, or 0 without terms."""
    value = np.log1p(tf) * idf[at]
    for low, high in SPACES:
        a, b = np.searchsorted(at, (low, high))
        length = np.sqrt(np.dot(value[a:b], value[a:b]))
        if length > 0:
            value[a:b] /= length
    return value


def latent_space(rows: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Right singular vectors of ``rows``, by power iteration from a seeded start."""
    size = min(dimensions + 16, *rows.shape)
    basis = rows @ np.random.default_rng(20).standard_normal((rows.shape[1], size)).astype(np.float32)
    for _ in range(ROUNDS):
        basis = rows @ (rows.T @ np.linalg.qr(basis)[0])
    _, _, vectors = np.linalg.svd(np.linalg.qr(basis)[0].T @ rows, full_matrices=False)
    return np.ascontiguousarray(vectors[:dimensions].T, dtype=np.float32)


def unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length > 0, length, 1)


def votes(vectors: np.ndarray, known: np.ndarray, label: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Share of label 1 among the votes of the nearest ``known`` vectors; ties with the last neighbour vote too."""
    cosine = unit(vectors) @ known.T
    k = min(NEIGHBOURS, cosine.shape[1])
    last = np.partition(cosine, cosine.shape[1] - k, axis=1)[:, cosine.shape[1] - k, None]
    vote = np.where(cosine >= last - 1e-6, np.maximum(cosine, 1e-6) ** POWER, 0) * weight
    return (vote @ label) / vote.sum(axis=1)


def sampled(rows: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """Labelled rows that may be learnt from, at most ``LABELLED`` of each label, and how many there are in all."""
    usable = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").where(~held_out(F.col("doc_id")))
    one = usable.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        (F.avg("quality") >= 0.5).cast("int").alias("label"))
    known = stored(one.join(rows.select("doc_id").distinct(), "doc_id", "left_semi"), "labelled-ids")
    totals = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    # hashes below a share that leaves twice the sample; the rank then picks the smallest ones from that few
    place = F.pmod(F.xxhash64("doc_id"), F.lit(_PLACES))
    low = F.lit(False)
    for label, total in totals.items():
        low = low | ((F.col("label") == label) & (place < int(_PLACES * min(1, 2 * LABELLED / total))))
    chosen = top_per_group(known.where(low), ["label"], [place, F.col("doc_id")], LABELLED, "_rank").drop("_rank")
    found = rows.join(F.broadcast(stored(chosen, "labelled-sample")), "doc_id")
    return top_per_group(found, ["doc_id"], [F.hash("at", "tf"), F.col("at"), F.col("tf")], 1, "_rank").drop("_rank"), totals


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    spark = docs.sparkSession
    rows = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"),
                              "text").mapInArrow(term_rows, TERM_ROWS), "terms")
    out = "doc_id long, held_out boolean, score double, predicted int"
    counts = rows.select("at").mapInArrow(frequencies, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = counts.toArrow()
    all_counts = np.zeros(TERMS + 1, np.int64)
    all_counts[found.column("term").to_numpy() + 1] = found.column("n").to_numpy()
    idf = weights(all_counts[0], all_counts[1:]).astype(np.float32)
    sample, totals = sampled(rows, labels)
    learnt = sample.orderBy("doc_id").select("at", "tf", "label").toArrow().combine_chunks()
    model = None
    if learnt.num_rows:
        matrix = np.zeros((learnt.num_rows, TERMS), np.float32)
        at_column, tf_column = (learnt.column(c).combine_chunks() for c in ("at", "tf"))
        for row, at, tf in zip(matrix, _lists(at_column), _lists(tf_column)):
            row[at] = vector(at, tf, idf)
        label = learnt.column("label").to_numpy().astype(np.float32)
        space = latent_space(matrix)
        share = np.array([totals.get(c, 0) / max(1, int((label == c).sum())) for c in (0, 1)], np.float32)
        model = idf, space, unit(matrix @ space).astype(np.float32), label, share[label.astype(int)]
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                if shared.value is None:
                    found = np.full(batch.num_rows, 0.5)
                else:
                    idf, space, *known = shared.value
                    placed = np.stack([vector(at, tf, idf) @ space[at] for at, tf in
                                       zip(_lists(batch.column("at")), _lists(batch.column("tf")))])
                    found = np.round(votes(placed, *known).astype(np.float64), 6)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("held_out"), pa.array(found),
                     pa.array((found >= KEEP_FROM).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(run, out)
