"""Repeated passages by column-wise construction of collection BWT and common prefixes.

A byte is removed if a LENGTH-byte string that covers it also starts anywhere else.
Passages that repeat but are too short for that are reported: the runs of bytes which
SHORT-byte strings that start anywhere else cover, if they hold PASSAGE_WORDS whole words.

1. Anchors. Of every SHORT-byte window the GRAM-byte string with the least hash
   (the leftmost of equals) is an anchor. Equal windows choose the same anchor at
   the same distance, so whatever repeats does so around a repeated anchor.
2. The collection. Around each repeated anchor the text that a window may cover is
   one document of the collection, aligned on the anchor. Documents that are equal
   as a whole repeat as a whole; one of each kind goes on, the others are settled.
3. Construction. From the last column to the first, every document inserts one
   symbol. The symbols before the sorted suffixes are that round's part of the
   Burrows-Wheeler transform; a stable sort by them sorts the longer suffixes, and
   the common prefix of two neighbours is the least one between their old places,
   plus the symbol. As windows are only compared at equal columns, suffixes of
   one column form one part of the order, and each part is made once, in
   sequence. Blocks of documents are bounded, so their columns lie in memory, as do
   the order and the common prefixes; a file would have to be the executor's own.
4. Neighbours that share LENGTH symbols are repeats to remove, those that share SHORT
   symbols repeats to report. A string of LENGTH bytes begins with one of SHORT bytes, so
   both stand around the same anchors and come from one construction.

Documents of one anchor meet in one task. An anchor with more than HOT different
documents is settled by the digests of all its windows instead, counted in an
ordinary shuffle, so that no task's share grows with a frequent passage.

Texts count in UTF-8 bytes; null counts as empty. Rows alike in doc_id and text
repeat each other.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from newslens.llm.common import as_bytes, by_group, stored
from newslens.operators.skew import join_around

LENGTH = 400
SHORT = 256          # 51 words with their spaces at 5 bytes each
PASSAGE_WORDS = 51   # over 50 words
GRAM = 64
HOT = 60_000
_PIECE = 1 << 19     # windows that are hashed at once
_BLOCK = 20_000      # documents of the collection that a task holds at once
_STRIP = 64          # columns that are turned at once
_HOT_KEYS = 1000     # most frequent anchors, whose rows are marked by broadcast and take no shuffle
_PAD = 0xFF          # beyond a text's ends; never part of UTF-8
_ODD = np.array(0x9E3779B97F4A7C15, np.uint64)
_BYTE = np.random.default_rng(400).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` (a power of two) bytes from each position on."""
    h, width, power = _BYTE[data], 1, _ODD[None]
    while width < gram:
        h = h[:-width] * power + h[width:]
        power = power * power
        width *= 2
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Least of ``width`` values from each position on, by running minima of blocks."""
    n = len(values)
    full = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    full[:n] = values
    rows = full.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def choose_anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple:
    """(position, hash) of the anchors of all windows inside the texts [start, end) of ``data``."""
    if len(data) < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h = gram_hashes(data, gram)
    low = np.uint64((1 << 21) - 1)
    least = window_minima((h & ~low) | np.arange(len(h), dtype=np.uint64), length - gram + 1)
    inside = np.zeros(len(least) + 1, np.int32)  # windows that do not cross texts
    ok = ends - starts >= length
    np.add.at(inside, starts[ok], 1)
    np.add.at(inside, ends[ok] - length + 1, -1)
    at = (least[np.cumsum(inside[:-1]) > 0] & low).astype(np.int64)
    at = at[np.concatenate(([True], at[1:] != at[:-1]))] if len(at) else at
    return at, h[at]


def _pieces(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, int]]]:
    """Parts (text, from, to) that are hashed together; long texts overlap by a window less one."""
    now, size = [], 0
    for k, text in enumerate(texts):
        for s in range(0, max(len(text) - length + 1, 0), _PIECE):
            e = min(len(text), s + _PIECE + length - 1)
            now.append((k, s, e))
            size += e - s
            if size >= _PIECE:
                yield now
                now, size = [], 0
    if now:
        yield now


def anchors_of(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[int, int, int]]:
    """(text, position, hash as a signed long)."""
    last = (-1, -1)
    for part in _pieces(texts, length):
        data = np.frombuffer(b"".join(texts[k][s:e] for k, s, e in part), np.uint8)
        sizes = np.array([e - s for _, s, e in part])
        ends = np.cumsum(sizes)
        at, h = choose_anchors(data, ends - sizes, ends, length, gram)
        which = np.searchsorted(ends, at, side="right")
        for i, a, x in zip(which.tolist(), at.tolist(), h.view(np.int64).tolist()):
            k, s, _ = part[i]
            here = (k, a - int(ends[i] - sizes[i]) + s)
            if here > last:  # where pieces overlap both may choose it
                yield (*here, x)
                last = here


ANCHORS = "h long, id long, th long, pos long, before int, after int, sh long"


def anchor_rows(docs: DataFrame, length: int, short: int, gram: int) -> DataFrame:
    """One row per anchor: its hash, the text, place, bytes before and after that windows
    may cover, and a digest of these."""
    reach = short - gram

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column("text"))
            ids, hashes = batch.column("id").to_pylist(), batch.column("th").to_pylist()
            rows: list[tuple] = []
            for k, at, h in anchors_of(texts, short, gram):
                text = texts[k]
                before, after = min(reach, at), min(length, len(text) - at)
                digest = xxhash.xxh3_64_intdigest(text[at - before:at + after], before << 20 | after)
                rows.append((h, ids[k], hashes[k], at, before, after, digest - (digest >> 63 << 64)))
                if len(rows) >= 50_000:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                          names=["h", "id", "th", "pos", "before", "after", "sh"])

    return docs.mapInArrow(run, ANCHORS)


class Columns:
    """Documents of equal length, read column by column from the last to the first."""

    def __init__(self, documents: np.ndarray):
        self.n, self.width = documents.shape
        self.documents = documents

    def backwards(self) -> Iterator[tuple[int, np.ndarray]]:
        for c in reversed(range(0, self.width, _STRIP)):
            strip = np.ascontiguousarray(self.documents[:, c:c + _STRIP].T)
            for i in reversed(range(len(strip))):
                yield c + i, strip[i]


def construct(columns: Columns) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(column, order, shared, bwt) for each round, from the last column to the first.

    order: documents sorted by their suffix from that column on; shared: for each
    place the column where the common prefix with the place before ends; bwt: the
    symbols that this round inserted, in the order of the round before.
    """
    n, width = columns.n, columns.width
    order = np.arange(n, dtype=np.int32)
    shared = np.full(n + 1, width, np.int16)  # one more, as an end for the last range
    for c, symbols in columns.backwards():
        bwt = symbols[order]
        place = np.argsort(bwt, kind="stable")
        sorted_ = bwt[place]
        same = np.flatnonzero(sorted_[1:] == sorted_[:-1])
        new = np.full(n + 1, c, np.int16)
        if len(same):
            # the least common prefix between the old places of neighbours with one symbol
            ranges = np.empty(2 * len(same), np.intp)
            ranges[0::2], ranges[1::2] = place[same] + 1, place[same + 1] + 1
            new[same + 1] = np.minimum.reduceat(shared, ranges)[0::2]
        order, shared = order[place], new
        yield c, order, shared[:n], bwt


def repeats(documents: np.ndarray, before: np.ndarray, after: np.ndarray, sizes: list[int], reach: int) -> list[tuple]:
    """For each of ``sizes`` (first, last) start of repeated windows of that size in each document,
    as columns; first > last: none.

    Windows lie inside the text: columns reach - before up to reach + after.
    """
    out = [(np.full(len(documents), 1 << 14), np.full(len(documents), -1)) for _ in sizes]
    for c, order, shared, _ in construct(Columns(documents)):
        if c > reach:
            continue
        for size, (first, last) in zip(sizes, out):
            twin = np.flatnonzero(shared[1:] >= c + size)
            found = np.concatenate((order[twin], order[twin + 1]))
            found = found[(c >= reach - before[found]) & (c + size <= reach + after[found])]
            first[found] = c
            last[found] = np.maximum(last[found], c)
    return out


def _aligned(part: pa.Table, length: int, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    before, after = part.column("before").to_numpy(), part.column("after").to_numpy()
    out = np.full((part.num_rows, reach + length), _PAD, np.uint8)
    for i, piece in enumerate(part.column("piece").to_pylist()):
        out[i, reach - before[i]:reach + after[i]] = np.frombuffer(piece, np.uint8)
    return out, before, after


SPANS = "id long, th long, at long, end long, cut boolean"


def _span_batch(part: pa.Table, first: np.ndarray, last: np.ndarray, size: int, reach: int, cut: bool) -> pa.RecordBatch:
    keep = np.flatnonzero((first <= last) & part.column("single").to_numpy(zero_copy_only=False))
    at = part.column("pos").to_numpy()[keep] - reach
    return pa.RecordBatch.from_arrays([
        pa.array(part.column("id").to_numpy()[keep]), pa.array(part.column("th").to_numpy()[keep]),
        pa.array(at + first[keep]), pa.array(at + last[keep] + size), pa.array(np.full(len(keep), cut))],
        names=["id", "th", "at", "end", "cut"])


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, short: int = SHORT) -> DataFrame:
    """(id, th, at, end, cut): spans of repeated windows, in bytes; spans may overlap.

    cut: the windows have ``length`` bytes; all spans together are covered by windows of ``short`` bytes.
    ``docs`` has (id, th, text), th a hash of the text: rows with one (id, th) are alike.
    """
    short = min(short, length)
    reach, sizes = short - gram, sorted({short, length})
    rows = stored(anchor_rows(docs, length, short, gram), "anchors")
    again = stored(rows.groupBy("h").agg(F.count("*").alias("n"), (F.min("sh") != F.max("sh")).alias("mixed")).where("n > 1"),
                   "anchor-counts")
    hot_keys = again.orderBy(F.desc("n"), "h").limit(_HOT_KEYS).select("h", "mixed")
    repeated = stored(join_around(rows, again.select("h", "mixed"), hot_keys, "h").where("mixed IS NOT NULL"), "repeated-anchors")
    cover = [(F.col("pos") - F.col("before")).alias("at"), (F.col("pos") + F.col("after")).alias("end"),
             (F.col("before") + F.col("after") >= length).alias("cut")]
    whole = repeated.where(~F.col("mixed")).select("id", "th", *cover)

    # documents of the collection that differ around an anchor: one of each kind, and how many it stands for
    mixed = repeated.where("mixed")
    kinds = stored(mixed.groupBy("h", "sh").agg(
        F.count("*").alias("n"), F.min(F.struct("id", "th", "pos", "before", "after")).alias("r")), "kinds")
    copies = mixed.join(kinds.where("n > 1").select("h", "sh"), ["h", "sh"], "left_semi").select("id", "th", *cover)
    crowded = stored(kinds.groupBy("h").agg(F.count("*").alias("k")).where(F.col("k") > hot).select("h"), "crowded")

    places = kinds.select("r.*", "h", (F.col("n") == 1).alias("single")).groupBy("id", "th").agg(
        F.collect_list(F.struct("h", "pos", "before", "after", "single")).alias("places"))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["h", "single", "id", "th", "pos", "before", "after", "piece"]
        types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        for batch in batches:
            rows: list[tuple] = []
            for text, id_, th, found in zip(as_bytes(batch.column("text")), *(
                    batch.column(c).to_pylist() for c in ("id", "th", "places"))):
                for p in found:
                    a, b, z = p["pos"], p["before"], p["after"]
                    rows.append((p["h"], p["single"], id_, th, a, b, z, text[a - b:a + z]))
                    if len(rows) >= 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    # of rows alike in (id, th) each gives its pieces; none of them is single, so that changes nothing
    pieces = docs.join(places, ["id", "th"]).mapInArrow(
        cut, "h long, single boolean, id long, th long, pos long, before int, after int, piece binary")

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_group(batches, ["h"], _BLOCK):
            part = part.combine_chunks()
            for size, (first, last) in zip(sizes, repeats(*_aligned(part, length, reach), sizes, reach)):
                yield _span_batch(part, first, last, size, reach, size == length)

    def near(some: DataFrame) -> DataFrame:
        return some.repartition("h").sortWithinPartitions("h").mapInArrow(build, SPANS)

    settled = whole.unionByName(copies)
    if crowded.isEmpty():
        return settled.unionByName(near(pieces))

    def windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for single, id_, th, pos, before, after, piece in zip(*(batch.column(c).to_pylist() for c in (
                    "single", "id", "th", "pos", "before", "after", "piece"))):
                for size in sizes:  # windows that begin ahead of the anchor; others have anchors of their own
                    n = max(min(before, before + after - size) + 1, 0)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([xxhash.xxh3_128_digest(piece[i:i + size]) for i in range(n)], pa.binary()),
                        pa.array([single] * n, pa.bool_()), pa.array([id_] * n, pa.int64()), pa.array([th] * n, pa.int64()),
                        pa.array(range(pos - before, pos - before + n), pa.int64()), pa.array([size] * n, pa.int32())],
                        names=["digest", "single", "id", "th", "at", "size"])

    pieces = stored(pieces, "pieces")
    every = pieces.join(crowded, "h", "left_semi").mapInArrow(
        windows, "digest binary, single boolean, id long, th long, at long, size int")
    twice = every.groupBy("digest").agg(F.min(F.struct("id", "th", "at")).alias("a"),
                                        F.max(F.struct("id", "th", "at")).alias("b")).where("a != b").select("digest")
    dense = every.where("single").join(twice, "digest", "left_semi").select(
        "id", "th", "at", (F.col("at") + F.col("size")).alias("end"), (F.col("size") == length).alias("cut"))
    return settled.unionByName(near(pieces.join(crowded, "h", "left_anti"))).unionByName(dense)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of sorted spans."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def whole_words(text: bytes, at: int, end: int) -> int:
    """Words that lie in [at, end) as a whole."""
    inside = text[at:end]
    n = len(inside.split())  # white space of bytes is 20 and 09 to 0D
    for i in (at, end):
        if at < end and 0 < i < len(text) and text[i - 1:i + 1].split() == [text[i - 1:i + 1]]:
            n -= 1
    return max(n, 0)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, short: int = SHORT,
                   passage_words: int = PASSAGE_WORDS) -> DataFrame:
    """(doc_id, n_bytes, spans, passages, kept) for every row of ``docs``: removed runs, passages that
    repeat, whether removed or not, and the bytes that stay."""
    text = F.coalesce("text", F.lit(""))
    # both joins below shuffle these rows by the same keys, so Spark shuffles them once: keep the columns alike
    keyed = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-1 << 63)).alias("id"),
                        F.xxhash64(text).alias("th"), text.alias("text"))
    spans = repeated_spans(keyed, length, gram, hot, short)
    by_text = spans.groupBy("id", "th").agg(F.collect_list(F.struct("at", "end", "cut")).alias("found"))
    joined = keyed.join(by_text, ["id", "th"], "left").select("doc_id", "text", "found")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("at", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            sizes, removed, passages, kept = [], [], [], []
            for text, found in zip(as_bytes(batch.column("text")), batch.column("found").to_pylist()):
                runs = merged([(s["at"], s["end"]) for s in found or () if s["cut"]])
                sizes.append(len(text))
                removed.append([{"at": a, "end": b} for a, b in runs])
                passages.append([{"at": a, "end": b} for a, b in merged([(s["at"], s["end"]) for s in found or ()])
                                 if whole_words(text, a, b) >= passage_words])
                edges = [0, *(x for r in runs for x in r), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[0::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, span), pa.array(passages, span),
                pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "spans", "passages", "kept"])

    run_of = "array<struct<at: long, end: long>>"
    return joined.withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(
        run, f"doc_id long, n_bytes long, spans {run_of}, passages {run_of}, kept binary")


def _digest_columns() -> list[Column]:
    total = F.aggregate(F.transform("spans", lambda s: s["end"] - s["at"]), F.lit(0).cast("long"), lambda a, x: a + x)
    return [F.col("doc_id"), F.col("n_bytes"), total.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
            F.sha2("kept", 256).alias("kept_sha256")]


def digests(removed: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    return removed.select(*_digest_columns())


def report(removed: DataFrame) -> DataFrame:
    """The digests and n_passages, the number of repeated passages of over 50 words."""
    return removed.select(*_digest_columns(), F.size("passages").cast("long").alias("n_passages"))
