"""Which filter removes what, in every order: duplicates by radix tries, then counts of failure masks.

Each task inserts the texts it reads into a compressed trie whose terminals hold the smallest doc_id. Rows above
that minimum are duplicates for certain and go on without their text; of each text one row per smallest id travels.
These rows are dealt by ranges of adaptive prefixes: a prefix whose texts outgrow ``BUCKET_BYTES`` or ``BUCKET_ROWS`` is cut again
behind the longest prefix that all of them share, unless they are all equal, which settles them by one minimum. A
second set of tries, one per prefix, then holds the minimum over the whole table.

A mask of five bits per document, counted per part, holds all that the 120 orders ask for.

Nulls: a null text is empty, a null source the part '', a null doc_id larger than all others. Repeated rows with one
doc_id are no duplicates of each other. A document with several label rows has a label if one of them says 1. An
empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from newslens.llm.common import as_bytes, batch_of, stored
from newslens.operators.skew import bounded_broadcast

FILTERS = "ABCDE"
DUPLICATE = 16
BUCKET_BYTES = 16 << 20   # texts of one trie
BUCKET_ROWS = 2048
RANGE_BYTES = 64 << 20    # texts of one range, which may hold many tries
MAX_RANGES = 20_000
ROW_BYTES = 64            # of a row without its text
CHUNK = 8                 # bytes of the first prefix, four times as many each round

_UPPER = bytes(range(65, 91))
_INNER = bytes(range(0x80, 0xC0))  # all bytes of a sign but its first
_SYMBOLS = b"#$%&*|"


class Trie:
    """Compressed trie of byte strings; ``add`` returns the number of a text's terminal."""

    def __init__(self):
        self.label = [b""]
        self.below: list[dict[int, int]] = [{}]
        self.terminal = [-1]
        self.size = 0

    def _node(self, label: bytes, below: dict[int, int], terminal: int) -> int:
        self.label.append(label)
        self.below.append(below)
        self.terminal.append(terminal)
        return len(self.label) - 1

    def _end(self, node: int) -> int:
        if self.terminal[node] < 0:
            self.terminal[node] = self.size
            self.size += 1
        return self.terminal[node]

    def add(self, text: bytes) -> int:
        node = at = 0
        while at < len(text):
            child = self.below[node].get(text[at])
            if child is None:
                self.below[node][text[at]] = child = self._node(text[at:], {}, -1)
                return self._end(child)
            label = self.label[child]
            if not text.startswith(label, at):
                same = shared(label, text[at:at + len(label)])
                rest = self._node(label[same:], self.below[child], self.terminal[child])
                self.label[child], self.below[child], self.terminal[child] = label[:same], {label[same]: rest}, -1
                label = label[:same]
            node, at = child, at + len(label)
        return self._end(node)


def shared(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def text_mask(text: bytes) -> int:
    """Bits of the failure conditions A to D."""
    words = text.split()
    n = len(words)
    upper = len(text) - len(text.translate(None, _UPPER))
    points = len(text.translate(None, _INNER))
    return ((n < 50) | (100 * len(set(words)) < 65 * n) << 1 | (100 * upper > 5 * points) << 2
            | (len(text.translate(None, _SYMBOLS)) < len(text)) << 3)


def later(a: int | None, b: int | None) -> bool:
    """``a`` is the larger id; null is larger than all."""
    return b is not None and (a is None or a > b)


class Group:
    """Rows (doc_id, part, mask, n) of one trie, with the smallest id at each terminal."""

    def __init__(self):
        self.trie, self.rows, self.first, self.bytes = Trie(), [], [], 0

    def add(self, text: bytes, doc_id: int | None, part: str, mask: int | None, n: int) -> None:
        end = self.trie.add(text)
        if end == len(self.first):
            self.first.append((doc_id, text_mask(text) if mask is None else mask))
            self.bytes += len(text)
        least, known = self.first[end]
        if later(least, doc_id):
            self.first[end] = (doc_id, known)
        self.bytes += ROW_BYTES
        self.rows.append((end, doc_id, part, known, n))

    def marked(self) -> Iterator[tuple]:
        for end, doc_id, part, mask, n in self.rows:
            yield end, doc_id, part, mask | DUPLICATE if later(doc_id, self.first[end][0]) else mask, n


ENTRY = "doc_id long, part string, mask int, n long, text binary"
ENTRY_TYPES = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.binary()]


def near_at_hand(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Duplicates within a task lose their text; equal rows of one doc_id become one with a count."""
    def out(group: Group, texts: dict[int, bytes]) -> pa.RecordBatch:
        rows = Counter()
        for end, doc_id, part, mask, n in group.marked():
            rows[(doc_id, part, mask, None if mask & DUPLICATE else end)] += n
        cells = [(i, part, mask, n, None if end is None else texts[end]) for (i, part, mask, end), n in rows.items()]
        return batch_of(["doc_id", "part", "mask", "n", "text"], list(zip(*cells)), ENTRY_TYPES)

    group, texts = Group(), {}
    for batch in batches:
        for doc_id, part, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), as_bytes(batch.column(2))):
            group.add(text, doc_id, part, None, 1)
            texts.setdefault(group.rows[-1][0], text)
            if group.bytes > BUCKET_BYTES:
                yield out(group, texts)
                group, texts = Group(), {}
    if group.rows:
        yield out(group, texts)


def by_tries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (node, chunk), marked against the minimum of all equal texts."""
    def out(group: Group) -> pa.RecordBatch:
        rows = list(group.marked())
        return batch_of(["doc_id", "part", "mask", "n"], list(zip(*rows))[1:], ENTRY_TYPES[:4])

    group, last = Group(), None
    for batch in batches:
        for node, chunk, doc_id, part, mask, n, text in zip(*(c.to_pylist() for c in batch.columns)):
            if (node, chunk) != last and group.rows and group.bytes > BUCKET_BYTES // 4:
                yield out(group)
                group = Group()
            last = node, chunk
            group.add(text, doc_id, part, mask, n)
    if group.rows:
        yield out(group)


def ends_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Least and greatest text and least id of each (node, chunk) of a task."""
    ends: dict[tuple, tuple] = {}
    for batch in batches:
        for node, chunk, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
            low, high, least = ends.get((node, chunk), (text, text, doc_id))
            ends[node, chunk] = min(low, text), max(high, text), doc_id if later(least, doc_id) else least
    if ends:
        cells = [(*k, *v) for k, v in ends.items()]
        yield batch_of(["node", "chunk", "low", "high", "least"], list(zip(*cells)),
                       [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64()])


def depth_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        node, chunk, low, high, least = (c.to_pylist() for c in batch.columns)
        depth = [-1 if a == b else shared(a, b) for a, b in zip(low, high)]
        yield batch_of(["node", "chunk", "depth", "least"], [node, chunk, depth, least],
                       [pa.int64(), pa.binary(), pa.int64(), pa.int64()])


def adaptive_prefixes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` with (node, chunk), and the rows of crowded equal texts with their ``least`` id instead.

    The crowded prefixes of a round are one per ``BUCKET_ROWS`` rows or ``BUCKET_BYTES`` of text at most, so their table
    is small beside the rows; it is broadcast where its size allows.
    """
    open_ = rows.select("*", F.lit(0).cast("long").alias("node"), F.expr(f"substring(text, 1, {CHUNK})").alias("chunk"))
    closed, settled = None, None
    width, number = CHUNK, 0
    while True:
        size = F.sum(F.octet_length("text") + ROW_BYTES)
        crowded = stored(open_.groupBy("node", "chunk").agg(size.alias("_size"), F.count("*").alias("_rows"))
                         .where((F.col("_size") > BUCKET_BYTES) | (F.col("_rows") > BUCKET_ROWS))
                         .select("node", "chunk"), "crowded-prefixes")
        if crowded.isEmpty():
            closed = open_ if closed is None else closed.unionByName(open_)
            return closed, settled
        number, width = number + 1, width * 4
        found = (
            open_.join(bounded_broadcast(crowded), ["node", "chunk"]).select("node", "chunk", "doc_id", "text")
            .mapInArrow(ends_of, "node long, chunk binary, low binary, high binary, least long")
            .groupBy("node", "chunk").agg(F.min("low"), F.max("high"), F.min("least"))
            .mapInArrow(depth_of, "node long, chunk binary, depth long, least long"))
        ends = stored(found.withColumn("_child", F.monotonically_increasing_id() + F.lit(number << 56)), "prefix-ends")
        joined = open_.join(bounded_broadcast(ends), ["node", "chunk"], "left")
        left = joined.where("_child IS NULL").select(*open_.columns)
        closed = left if closed is None else closed.unionByName(left)
        equal = joined.where("depth < 0").select(*rows.columns, "least")
        settled = equal if settled is None else settled.unionByName(equal)
        open_ = joined.where("depth >= 0").select(
            *rows.columns, F.col("_child").alias("node"), F.expr(f"substring(text, depth + 1, {width})").alias("chunk"))


def failure_masks(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask, n): which filters each document fails, ``n`` rows of a kind together."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"), "text")
    entries = stored(rows.mapInArrow(near_at_hand, ENTRY), "trie-entries")
    plain = ["doc_id", "part", "mask", "n"]
    known = entries.where(F.col("mask") >= DUPLICATE).select(*plain)
    open_, settled = adaptive_prefixes(entries.where(F.col("mask") < DUPLICATE))
    total = entries.agg(F.sum(F.octet_length("text") + ROW_BYTES)).first()[0] or 0
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(MAX_RANGES, max(partitions, total // RANGE_BYTES))
    dealt = (
        open_.select("node", "chunk", *plain, "text").repartitionByRange(ranges, "node", "chunk")
        .sortWithinPartitions("node", "chunk").mapInArrow(by_tries, "doc_id long, part string, mask int, n long"))
    masks = known.unionByName(dealt)
    if settled is not None:
        after = F.col("least").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") > F.col("least")))
        masks = masks.unionByName(settled.select(
            "doc_id", "part", F.when(after, F.col("mask").bitwiseOR(DUPLICATE)).otherwise(F.col("mask")).alias("mask"), "n"))
    return masks


def mask_counts(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, hits): the number of rows, good and toxic rows of each mask, 32 at most a part."""
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("bad"))
    has_id = masks.where("doc_id IS NOT NULL").join(marks, "doc_id", "left").select("part", "mask", "n", "good", "bad")
    no_id = masks.where("doc_id IS NULL").select("part", "mask", "n", F.lit(None).cast("int").alias("good"),
                                                 F.lit(None).cast("int").alias("bad"))
    n = F.col("n")
    return has_id.unionByName(no_id).groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good") == 1, n).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("bad") == 1, n).otherwise(0)).alias("bad"),
    ).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "bad")).alias("hits"))


def _bits(letters) -> F.Column:
    known = F.filter(F.split(letters, ""), lambda c: c != "")
    return F.aggregate(known, F.lit(0), lambda bits, c: bits.bitwiseOR(F.call_function(
        "shiftleft", F.lit(1), F.call_function("locate", c, F.lit(FILTERS)) - 1)))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What each filter does at each step of each order, per part."""
    orders = F.array(*[F.lit("".join(o)) for o in permutations(FILTERS)])
    steps = (
        mask_counts(failure_masks(docs), labels)
        .select("part", "hits", F.explode(orders).alias("filter_order"))
        .select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
        .withColumn("bit", _bits(F.expr("substring(filter_order, step, 1)")))
        .withColumn("before", _bits(F.expr("substring(filter_order, 1, step - 1)"))))
    bit, before = F.col("bit"), F.col("before")

    def total(chosen, amount=lambda h: h["n"]):
        return F.aggregate("hits", F.lit(0).cast("long"), lambda a, h: a + F.when(chosen(h["mask"]), amount(h)).otherwise(0))

    def fails(mask):
        return mask.bitwiseAND(bit) != 0

    def removed(mask):
        return fails(mask) & (mask.bitwiseAND(before) == 0)

    # of all orders, a document is removed by each of its k failing filters in one of k
    share = 1
    for k in range(2, len(FILTERS) + 1):
        share *= k
    return steps.select(
        "part", "filter_order", "step",
        total(lambda m: m.bitwiseAND(bit.bitwiseOR(before)) == 0).alias("kept"),
        total(removed).alias("removed"),
        total(lambda m: fails(m) & (m.bitwiseAND(before) != 0)).alias("redundant"),
        total(lambda m: m == bit).alias("unique_fails"),
        total(removed, lambda h: h["good"]).alias("good_lost"),
        total(removed, lambda h: h["bad"]).alias("toxic_lost"),
        total(fails, lambda h: (h["n"] * share / F.bit_count(h["mask"])).cast("long")).alias("shapley"))
