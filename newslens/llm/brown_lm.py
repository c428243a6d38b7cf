"""Class-based bigram model (Brown et al.): every training word is clustered by exchange.

The words exchange classes in sweeps that raise the likelihood of class bigrams over all training tokens. Within a sweep
the ``CORE`` most frequent words (the end of a text is one) move one after the other, with all counts brought up to date
after each move; the classes of all other words stand beside them as units that stay. All other words then move at once,
each to the class that its neighbours' classes make most likely: exactly for words with many neighbours, to first order
for the others. After the first sweep one half of them moves, then the other, by turns. A sweep after which the
likelihood is lower is taken back, and from then on fewer words move at a time; so the likelihood never falls. The core
alone is clustered first, and its classes give all other words their first one. Words never seen in training take the
class that most words with the same last two bytes have. The model is

    P(w | v) = LAMBDA * P(class(w) | h(v)) * (c(w) + 0.5) / (N(class(w)) + 0.5 * (V(class(w)) + 1))
             + (1 - LAMBDA) * (c(w) + 0.5) / (N + 0.5 * (V + 1))

where N, V and c are training tokens, distinct words and counts, in all or in a class, every class keeps room for one
unseen word, and h(v) is the class of the word before, or one history for unseen words and those over ``LONGEST`` bytes.

Texts are cut into tokens once and kept in blocks, as numbers of a dictionary of the block's own. Words are dealt out in
shares by a hash; a share knows which of its words are which in each block. In a sweep every block sends to each share
the classes around its words, and each share sends back the classes of its words there: a few bytes a token and a
word, in one row for each block and share, and no table of all words is ever in one place.

Tokens are runs without ASCII white space after lower-casing A-Z, and one end for each text (the empty word here);
null counts as an empty text. A text is held out if crc32 of its doc_id as text leaves 1 divided by 5; rows without an
id train. Repeated rows are texts of their own; an empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from newslens.llm.common import as_bytes, stored

FOLDS, HELD = 5, 1
FREQUENT_BITS = 20   # core words have c >= N / 2^20
LONGEST = 64         # longer words are one history together, and no core words (bytes)
CORE = 1024          # words that move one after the other; their pairs are a table of CORE squared
SUFFIXES = 251       # last bytes of unseen words
CLASSES = 128
ROUNDS = 8           # sweeps at most; fewer once all words had their turn and added no more than STILL to the information
LAMBDA = 0.95
EXACT = 1024         # neighbours from which on a word's gain is taken exactly
STILL = 0.005        # ... of neighbouring classes
PARTS = 8            # a sweep that lowers the likelihood is tried again with half as many words, down to an eighth
_NONE = 255          # no class yet
_FLUSH = 300_000     # distinct words of a block
_DENSE = 1024        # places of a word in a block from which on counts are no longer than the places
_TOKENS = 400_000    # tokens that are cut at once
_RANGES = 128        # pairs of units are added up in so many parts
_ROWS = "share int, block long, n long, a binary, b binary, c binary, d binary"


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD


def tokens(text: bytes) -> list[bytes]:
    return [*text.lower().split(), b""]


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list[bytes], list[tuple]]]:
    """Tokens of whole texts, many texts at once, and (doc_id, number of tokens, whether it trains) of each."""
    words: list[bytes] = []
    docs: list[tuple] = []
    for batch in batches:
        ids, trains = batch.column("doc_id").to_pylist(), batch.column("trains").to_pylist()
        for doc, train, text in zip(ids, trains, as_bytes(batch.column("text"))):
            new = tokens(text)
            words += new
            docs.append((doc, len(new), train))
            if len(words) >= _TOKENS:
                yield words, docs
                words, docs = [], []
    if docs:
        yield words, docs


def _before(x: np.ndarray) -> np.ndarray:
    """Each token's predecessor; all texts end with an end, so the one before a run of texts is an end too."""
    return np.concatenate((x[-1:], x[:-1]))


def _shut(x: np.ndarray) -> bytes:
    """The array compressed, all first bytes ahead of all second ones, and so on."""
    planes = np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T).tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _open(data: bytes, kind: type) -> np.ndarray:
    planes = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd")
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _order(x: np.ndarray) -> np.ndarray:
    """Stable order of numbers below 2^32, by their lower and then their upper 16 bits (each a radix sort)."""
    lower = np.argsort(x.astype(np.uint16), kind="stable")
    return lower[np.argsort((x >> 16).astype(np.uint16)[lower], kind="stable")] if x.max(initial=0) >> 16 else lower


def _rows(rows: list[tuple]) -> pa.Table:
    """Rows of ``_ROWS``; what is left out at their end is null."""
    kinds = [pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 4]
    full = [(*r, *[None] * (7 - len(r))) for r in rows]
    return pa.table([pa.array([r[i] for r in full], kind) for i, kind in enumerate(kinds)],
                    names=["share", "block", "n", "a", "b", "c", "d"])


def _sorted(table: pa.Table, by: str) -> list[dict]:
    return table.sort_by(by).to_pylist()


def _strings(data: bytes, lengths: bytes) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(_open(lengths, np.int32)))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(_open(data, np.uint8))])


def _packed(words: list[bytes]) -> tuple[bytes, bytes]:
    """Bytes and lengths of the words: what ``_strings`` reads."""
    return _shut(np.frombuffer(b"".join(words), np.uint8)), _shut(np.fromiter(map(len, words), np.int32, len(words)))


def _lengths(words: pa.Array) -> np.ndarray:
    return pc.binary_length(words).to_numpy(zero_copy_only=False)


@dataclass(frozen=True)
class Blocks:
    """Texts as numbers of their block's words, by block, and these words by share.

    A text row has the number of training tokens, the numbers of all tokens (training texts first), and by text the
    number of tokens, the doc_id and whether that is null. A word row has the words, the most frequent ahead, their
    lengths, how often they occur in training texts and how often behind themselves. The block numbers the first words
    of all shares, then their second ones, and so on, so that small numbers are frequent; ``_numbers`` undoes that.
    """

    texts: DataFrame
    words: DataFrame
    shares: int

    def done(self) -> None:
        self.texts.unpersist()


def _turns(sizes: np.ndarray) -> np.ndarray:
    """Places of words that stand share by share, taken by turns: the first of each share, the second of each, and so on."""
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return np.argsort(within, kind="stable").astype(np.int32)


def _numbers(text: dict, sizes: Iterable[int]) -> np.ndarray:
    """Places of a block's tokens among its words as they stand share by share, if the shares have so many each."""
    return _turns(np.array([*sizes], np.int64))[_open(text["a"], np.int32)]


def encode(docs: DataFrame, shares: int | None = None) -> Blocks:
    """``docs`` (doc_id, text, trains) in blocks."""
    shares = shares or max(PARTS, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def block(number: int, local: dict, runs: list, texts: list) -> pa.RecordBatch:
        names, ids = list(local), np.concatenate(runs)
        sizes, trains = np.array([n for _, n, _ in texts]), np.array([t for *_, t in texts])
        learnt = np.repeat(trains, sizes)
        hashes = np.fromiter(map(zlib.crc32, names), np.uint32, len(names)) % shares
        order = np.lexsort((-np.bincount(ids, minlength=len(names)), hashes))
        sent, begin, size = np.unique(hashes[order], return_index=True, return_counts=True)
        rank, number_of = np.empty((2, len(order)), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        number_of[_turns(size)] = np.arange(len(order), dtype=np.int32)
        ids = rank[np.concatenate((ids[learnt], ids[~learnt]))]
        training = ids[:learnt.sum()]
        n = np.bincount(training, minlength=len(names)).astype(np.int32)
        selfs = np.bincount(training[training == _before(training)], minlength=len(names)).astype(np.int32)
        first = np.argsort(~trains, kind="stable")
        docs = [texts[i][0] for i in first.tolist()]
        out = [(-1, number, len(training), _shut(number_of[ids]), _shut(sizes[first].astype(np.int64)),
                _shut(np.array([d or 0 for d in docs], np.int64)), _shut(np.array([d is None for d in docs])))]
        names = [names[i] for i in order.tolist()]
        for share, a, m in zip(sent.tolist(), begin.tolist(), size.tolist()):
            own = names[a:a + m]
            out.append((share, number, m, *_packed(own), _shut(n[a:a + m]), _shut(selfs[a:a + m])))
        return _rows(out).combine_chunks().to_batches()[0]

    def fresh() -> tuple[dict, list, list]:
        local: defaultdict = defaultdict()
        local.default_factory = local.__len__  # a new word gets the next number
        return local, [], []

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        local, runs, texts = fresh()
        for words, docs in _chunks(batches):
            runs.append(np.fromiter(map(local.__getitem__, words), np.int32, len(words)))
            texts += docs
            if len(local) > _FLUSH or sum(map(len, runs)) > 10 * _FLUSH:
                yield block(number, local, runs, texts)
                number, (local, runs, texts) = number + 1, fresh()
        if texts:
            yield block(number, local, runs, texts)

    rows = stored(docs.select("doc_id", "text", "trains").mapInArrow(run, _ROWS), "blocks")
    texts = rows.where("share < 0").repartition(shares, "block").persist(StorageLevel.DISK_ONLY)
    return Blocks(texts, rows.where("share >= 0"), shares)


def vocabulary(blocks: Blocks) -> DataFrame:
    """Training words by share.

    The row of block -1 has the share's words, their lengths, counts, and counts behind themselves. Those of the blocks
    have the place there of each word of the block (-1 if it does not train), and its count in the block.
    """

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        n, selfs = (np.concatenate([_open(r[x], np.int32) for r in rows]) for x in "cd")
        words = pa.concat_arrays([_strings(r["a"], r["b"]) for r in rows]).filter(pa.array(n > 0)).dictionary_encode()
        at = np.full(len(n), -1, np.int32)
        at[n > 0] = words.indices.to_numpy(zero_copy_only=False)
        size = len(words.dictionary)
        sums = [np.bincount(at[n > 0], x[n > 0], size).astype(np.int64) for x in (n, selfs)]
        share, out, a = rows[0]["share"], [], 0
        out.append((share, -1, size, *_packed(words.dictionary.to_pylist()), *map(_shut, sums)))
        for r in rows:
            out.append((share, r["block"], r["n"], _shut(at[a:a + r["n"]]), r["c"]))
            a += r["n"]
        return _rows(out)

    return stored(blocks.words.repartition(blocks.shares, "share").groupBy("share").applyInArrow(run, _ROWS), "vocabulary")


def word_counts(shares: DataFrame, core: int) -> tuple[int, int, DataFrame]:
    """Training tokens, distinct words, and (word, c) of the end and of all words that can be core words."""
    heads = shares.where("block < 0").select("a", "b", "c")

    def able(row: dict) -> tuple[pa.Array, np.ndarray]:
        words, c = _strings(row["a"], row["b"]), _open(row["c"], np.int64)
        fits = _lengths(words) <= LONGEST
        return words.filter(pa.array(fits)), c[fits]

    def largest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                c, (_, top) = _open(r["c"], np.int64), able(r)
                yield pa.RecordBatch.from_arrays([
                    pa.array([int(c.sum())]), pa.array([len(c)]), pa.array([_shut(np.sort(top)[-core:])], pa.binary())],
                    names=["n", "words", "top"])

    found = heads.mapInArrow(largest, "n long, words long, top binary").collect()
    top = np.sort(np.concatenate([np.empty(0, np.int64), *[_open(r["top"], np.int64) for r in found]]))
    least = int(top[-core:][0]) if len(top) else 0

    def frequent(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                words, c = able(r)
                here = pa.array((c >= least) | (_lengths(words) == 0))
                words, c = words.filter(here), pa.array(c).filter(here)
                table = pa.table({"word": words, "c": c, "end": pc.equal(pc.binary_length(words), 0)})
                first = table.sort_by([("end", "descending"), ("c", "descending"), ("word", "ascending")]).slice(0, core + 1)
                yield from first.drop_columns("end").to_batches()

    words = stored(heads.mapInArrow(frequent, "word binary, c long"), "words")
    return sum(r["n"] for r in found), sum(r["words"] for r in found), words


def is_frequent(total: int, bits: int = FREQUENT_BITS) -> Column:
    return (F.length("word") <= LONGEST) & (F.shiftleft("c", bits) >= total)


def core_words(words: DataFrame, core: int = CORE) -> list[tuple[bytes, int]]:
    """The end and the most frequent words with their counts, at most ``core``: those that move one after the other."""
    end = [(b"", r["c"]) for r in words.where(F.length("word") == 0).collect()]
    top = words.where((F.length("word") > 0) & (F.length("word") <= LONGEST)).orderBy(F.desc("c"), "word").limit(core - 1)
    return end + [(bytes(r["word"]), r["c"]) for r in top.collect()]


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def likelihood(pairs: np.ndarray) -> float:
    """The part of the log likelihood that depends on the classes."""
    return float(_xlogx(pairs).sum() - _xlogx(pairs.sum(axis=0)).sum() - _xlogx(pairs.sum(axis=1)).sum())


def information(pairs: np.ndarray) -> float:
    """Mutual information of neighbouring classes in bits."""
    n = pairs.sum()
    return (likelihood(pairs) / n + np.log(n)) / np.log(2) if n else 0.0


def gains(left: np.ndarray, right: np.ndarray, self_: float, pairs: np.ndarray) -> np.ndarray:
    """What the likelihood gains if a word that ``pairs`` does not hold joins each class.

    left, right: how often each class comes before and after the word, without itself; self_: how often it follows
    itself.
    """
    before, after = pairs + left[:, None], pairs + right[None, :]  # column b, row b: with the word in class b
    base = _xlogx(pairs)
    gain = (_xlogx(before) - base).sum(axis=0) + (_xlogx(after) - base).sum(axis=1)
    d = np.diag(pairs)
    # the corner (b, b) takes both sides and the word's own pairs at once
    gain += _xlogx(d + left + right + self_) - _xlogx(d) - (
        _xlogx(d + left) - _xlogx(d)) - (_xlogx(d + right) - _xlogx(d))
    # the word's neighbours keep their own pairs with it wherever it goes
    for sums, n in ((pairs.sum(axis=1) + left, right.sum() + self_), (pairs.sum(axis=0) + right, left.sum() + self_)):
        gain -= _xlogx(sums + n) - _xlogx(sums)
    return gain


def exchange(words: np.ndarray, n_classes: int = CLASSES, rounds: int = ROUNDS, start: np.ndarray | None = None,
             movable: int | None = None) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """Classes of the units, the counts of class pairs, and the likelihood at the start and after each sweep.

    ``words`` counts pairs of units. Starts from ``start``, or from turns by frequency; each of the first ``movable``
    units (all, if not given) in turn leaves its class and joins the one with the highest gain, which may be the old
    one, so no move lowers the likelihood.
    """
    size = len(words)
    classes = np.arange(size) % n_classes if start is None else start.copy()
    one = np.eye(n_classes)[classes]
    left, right = words.T @ one, words @ one  # of each word: classes before it and after it
    pairs = one.T @ right
    course = [likelihood(pairs)]
    for _ in range(rounds):
        moved = 0
        for u in range(size if movable is None else movable):
            a, own = classes[u], words[u, u]
            l, r = left[u].copy(), right[u].copy()
            l[a] -= own
            r[a] -= own
            pairs[:, a] -= l
            pairs[a, :] -= r
            pairs[a, a] -= own
            gain = gains(l, r, own, pairs)
            b = int(gain.argmax())
            b = b if gain[b] > gain[a] + 1e-9 else a
            pairs[:, b] += l
            pairs[b, :] += r
            pairs[b, b] += own
            if b != a:
                classes[u], moved = b, moved + 1
                left[:, a] -= words[u]
                left[:, b] += words[u]
                right[:, a] -= words[:, u]
                right[:, b] += words[:, u]
        course.append(likelihood(pairs))
        if not moved:
            break
    return classes, pairs, course


def _counted(rows: list[list[bytes]]) -> np.ndarray:
    """Classes before and after each word, as (words, 2, 256)."""
    out = np.zeros((len(rows), 2, 256))
    few = [(i, x[1:]) for i, parts in enumerate(rows) for x in parts if x[0] == 0]
    if few:
        codes = np.frombuffer(b"".join([x for _, x in few]), np.uint8).reshape(-1, 2).astype(np.int64)
        owner = np.repeat([i for i, _ in few], [len(x) // 2 for _, x in few])
        for side in (0, 1):
            out[:, side] += np.bincount(owner * 256 + codes[:, side], minlength=len(rows) * 256).reshape(-1, 256)
    for i, parts in enumerate(rows):
        for x in parts:
            if x[0] == 1:
                out[i] += np.frombuffer(x, "<u4", offset=1).reshape(2, 256)
    return out


def _pull(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What each class before and after a word adds to the gain of each class, to first order, and what all words add."""
    smooth = pairs + 0.1
    first, second = smooth.sum(axis=1, keepdims=True), smooth.sum(axis=0, keepdims=True)
    pull = np.log(smooth * smooth.sum() / (first * second))
    # words without neighbours that have a class join the largest one
    return np.concatenate((pull, pull.T)), 1e-6 * np.log(second[0])


def classes_of(around: np.ndarray, pairs: np.ndarray, own: np.ndarray | None = None, selfs: np.ndarray | None = None,
               pull: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """The class of each word by its neighbours; ``pairs`` are the counts of class pairs, ``pull`` comes of them.

    With ``own``, the words are in these classes and stay unless they gain; selfs: how often each follows itself.
    """
    k = len(pairs)
    by_side, prior = pull or _pull(pairs)
    around = around[:, :, :k]
    gain = around.reshape(len(around), 2 * k) @ by_side + prior
    out = gain.argmax(axis=1)
    if own is not None:
        at = np.arange(len(own))
        out = np.where(gain[at, out] > gain[at, own] + 1e-9, out, own)
    for i in np.flatnonzero(around.sum(axis=(1, 2)) >= EXACT):
        left, right, without, twice = around[i, 0].copy(), around[i, 1].copy(), pairs, 0.0
        if own is not None:
            a, twice, without = own[i], float(selfs[i]), pairs.copy()
            left[a] -= twice
            right[a] -= twice
            without[:, a] -= left
            without[a, :] -= right
            without[a, a] -= twice
        gain = gains(left, right, twice, without)
        out[i] = gain.argmax()
        if own is not None and gain[out[i]] <= gain[own[i]] + 1e-9:
            out[i] = own[i]
    return out


@dataclass(frozen=True)
class Units:
    """What blocks count pairs of: the core words, the other words by class, those over ``LONGEST`` by class, all without one."""

    core: list[bytes]
    k: int

    @property
    def none(self) -> int:
        return len(self.core) + 2 * self.k

    def of(self, words: pa.Array, classes: np.ndarray) -> np.ndarray:
        """Units of words; one more answers for -1. Classes are -1 where there is none yet."""
        at = self.places(words)
        others = np.where(classes < 0, self.none, len(self.core) + classes + self.k * (_lengths(words) > LONGEST))
        return np.append(np.where(at < 0, others, at), self.none).astype(np.uint16)

    def places(self, words: pa.Array) -> np.ndarray:
        """Number of each core word, -1 for others."""
        at = pc.index_in(words, value_set=pa.array(self.core, pa.binary()))
        return pc.fill_null(at, -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def classes(self, core: np.ndarray) -> np.ndarray:
        """The class of each unit."""
        own = np.arange(self.k)
        return np.concatenate((core, own, own, [_NONE])).astype(np.int64)

    def histories(self, core: np.ndarray) -> np.ndarray:
        """The history of each unit; words over ``LONGEST`` are number k."""
        return np.concatenate((core, np.arange(self.k), np.full(self.k + 1, self.k))).astype(np.int64)


def _added(pairs: np.ndarray, first: np.ndarray, second: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """Counts of unit pairs as counts of what ``first`` and ``second`` make of the units."""
    half = np.zeros((shape[0], pairs.shape[1]))
    np.add.at(half, first, pairs)
    out = np.zeros(shape)
    np.add.at(out.T, second, half.T)
    return out


def _both(blocks: Blocks, replies: DataFrame, run, schema: str) -> DataFrame:
    """``run`` over the text row of each block and the replies to it, sorted by share."""

    def one(left: pa.Table, right: pa.Table) -> pa.Table:
        return run(left.to_pylist()[0], _sorted(right, "share"))

    return blocks.texts.groupBy("block").cogroup(replies.where("block >= 0").groupBy("block")).applyInArrow(one, schema)


def unit_pairs(blocks: Blocks, replies: DataFrame, units: Units) -> np.ndarray:
    """How often unit b follows unit a in training texts; pairs with words that have no class are left away."""
    size = units.none + 1

    def count(text: dict, sent: list[dict]) -> pa.Table:
        unit = np.concatenate([_open(r["a"], np.uint16) for r in sent]).astype(np.int64)
        x = unit[_numbers(text, (r["n"] for r in sent))[:text["n"]]]
        n = np.bincount(_before(x) * size + x, minlength=-(-size * size // _RANGES) * _RANGES)
        out = []
        for part, own in enumerate(np.ascontiguousarray(n.reshape(-1, _RANGES).T)):
            at = np.flatnonzero(own)
            full, rest = np.divmod(own[at] - 1, 255)
            # a byte each: what is over 255 stands there more than once
            ends = np.cumsum(full + 1)
            counts = np.full(ends[-1] if len(at) else 0, 255, np.uint8)
            counts[ends - 1] = rest + 1
            out.append((part, None, None, _shut(np.diff(np.repeat(at, full + 1), prepend=0).astype(np.uint32)), _shut(counts)))
        return _rows(out)

    def add(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        at = np.concatenate([np.cumsum(_open(r["a"], np.uint32).astype(np.int64)) for r in rows])
        sums = np.bincount(at, np.concatenate([_open(r["b"], np.uint8) for r in rows])).astype(np.int64)
        at = np.flatnonzero(sums)
        return _rows([(rows[0]["share"], None, None, _shut(at * _RANGES + rows[0]["share"]), _shut(sums[at]))])

    found = _both(blocks, replies, count, _ROWS).groupBy("share").applyInArrow(add, _ROWS).select("a", "b").collect()
    out = np.zeros(size * size)
    for r in found:
        out[_open(r["a"], np.int64)] = _open(r["b"], np.int64)
    return out.reshape(size, size)


def contexts(blocks: Blocks, replies: DataFrame, units: Units, core: np.ndarray, parts: int = 1, turn: int = 0) -> DataFrame:
    """Classes around the training places of all words but the core, from each block to each share.

    Only shares that leave ``turn`` divided by ``parts`` get messages: those whose words move. Two bytes for each place
    of words with few, all places of a word side by side; the counts of classes before and after words with more than
    ``_DENSE``.
    """
    size, of = len(units.core), units.classes(core).astype(np.uint8)

    def send(text: dict, sent: list[dict]) -> pa.Table:
        unit = np.concatenate([_open(r["a"], np.uint16) for r in sent])
        ids = _numbers(text, (r["n"] for r in sent))[:text["n"]]
        classes = of[unit[ids]]
        places = np.stack((_before(classes), np.concatenate((classes[1:], classes[:1]))), axis=1).view(np.uint16).ravel()
        moves = (unit >= size) & np.repeat([r["share"] % parts == turn for r in sent], [r["n"] for r in sent])
        here = moves[ids]
        ids, places = ids[here], places[here]
        places = places[_order(ids)]
        n = np.bincount(ids, minlength=len(unit))
        ends = np.append(0, np.cumsum(n))
        few = np.repeat(n <= _DENSE, n)
        out, a = [], 0
        for r in sent:
            b = a + r["n"]
            if r["share"] % parts != turn:
                a = b
                continue
            part = slice(ends[a], ends[b])
            many = [np.bincount(places[ends[w]:ends[w + 1]].view(np.uint8)[side::2], minlength=256).astype("<u4")
                    for w in (a + np.flatnonzero(n[a:b] > _DENSE)).tolist() for side in (0, 1)]
            out.append((r["share"], text["block"], None, _shut(places[part][few[part]]),
                        _shut(np.concatenate([np.empty(0, "<u4"), *many]))))
            a = b
        return _rows(out)

    return _both(blocks, replies, send, _ROWS)


def _moved(own: np.ndarray, selfs: np.ndarray, is_core: np.ndarray, known: list[dict], sent: dict[int, dict],
           pairs: np.ndarray) -> np.ndarray:
    """New classes of a share's words by what the blocks have sent."""
    owners, places, dense = [np.empty(0, np.int64)], [np.empty((0, 2), np.uint8)], {}
    for r in known:
        if r["block"] not in sent:
            continue
        at, n = _open(r["a"], np.int32), _open(r["b"], np.int32)
        takes = (n > 0) & ~np.append(is_core, False)[at]
        at, n, message = at[takes], n[takes], sent[r["block"]]
        owners.append(np.repeat(at[n <= _DENSE], n[n <= _DENSE]))
        places.append(_open(message["a"], np.uint16).view(np.uint8).reshape(-1, 2))
        if (n > _DENSE).any():
            counts = _open(message["b"], np.uint32).reshape(-1, 512)
            for i, w in enumerate(at[n > _DENSE].tolist()):
                dense.setdefault(w, []).append(b"\1" + counts[i].tobytes())
    owner, place = np.concatenate(owners), np.concatenate(places)
    order = _order(owner)
    owner, place = owner[order], place.view(np.uint16).ravel()[order].view(np.uint8).reshape(-1, 2)
    new, k, pull = own.copy(), len(pairs), _pull(pairs)
    for a in range(0, len(own), 512):
        b = min(a + 512, len(own))
        part = slice(*np.searchsorted(owner, (a, b)))
        around = np.zeros((b - a, 2, k))
        for side in (0, 1):
            has = place[part, side] < k
            around[:, side] = np.bincount((owner[part][has] - a) * k + place[part, side][has], minlength=(b - a) * k).reshape(-1, k)
        more = [w for w in range(a, b) if w in dense] if dense else []
        if more:
            around[np.array(more) - a] += _counted([dense[w] for w in more])[:, :, :k]
        free = np.flatnonzero(~is_core[a:b])
        fresh = own[a:b][free] < 0
        for which, has in ((free[fresh], False), (free[~fresh], True)):
            if len(which):
                mine = (own[a + which], selfs[a + which]) if has else (None, None)
                new[a + which] = classes_of(around[which], pairs, *mine, pull)
    return new


def replies(shares: DataFrame, units: Units, old: DataFrame | None = None, messages: DataFrame | None = None,
            pairs: np.ndarray | None = None) -> DataFrame:
    """Units of each block's words by share, and in the row of block -1 the classes of the share's words.

    The words of shares with ``messages`` move.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, sent = _sorted(left, "block"), {r["block"]: r for r in right.to_pylist()}
        head, known = rows[0], rows[1:]
        words, selfs = _strings(head["a"], head["b"]), _open(head["d"], np.int64)
        own = _open(sent[-1]["a"], np.int16).astype(np.int64) if -1 in sent else np.full(len(words), -1)
        if sent.keys() - {-1}:
            own = _moved(own, selfs, units.places(words) >= 0, known, sent, pairs)
        unit = units.of(words, own)
        return _rows([(head["share"], -1, len(own), _shut(own.astype(np.int16)))] + [
            (head["share"], r["block"], r["n"], _shut(unit[_open(r["a"], np.int32)])) for r in known])

    spark = shares.sparkSession
    news = spark.createDataFrame([], _ROWS) if old is None else old.where("block < 0")
    if messages is not None:
        news = news.unionByName(messages)
    return stored(shares.groupBy("share").cogroup(news.groupBy("share")).applyInArrow(run, _ROWS), "replies")


@dataclass(frozen=True)
class Model:
    """Fitted model: words by share (words, lengths, counts, classes), and logarithms by (history, class).

    ``course`` has the likelihood of all classes after every step, ``pairs`` the final counts of class pairs.
    ``core_size``: the most frequent words whose class is a history; all, up to ``LONGEST`` bytes.
    """

    words: DataFrame
    shares: int
    steps: np.ndarray
    suffixes: list[int]
    total: int
    least: float
    course: list[float]
    pairs: np.ndarray
    core_size: int

    @property
    def known(self) -> DataFrame:
        """(word, class, c) of all training words."""

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in batch.to_pylist():
                    yield pa.RecordBatch.from_arrays([
                        _strings(r["a"], r["b"]), pa.array(_open(r["d"], np.uint8).astype(np.int32)),
                        pa.array(_open(r["c"], np.int64))], names=["word", "class", "c"])

        return self.words.mapInArrow(run, "word binary, class int, c long")


def _suffixes(words: pa.Array) -> np.ndarray:
    """Number of each word's last two bytes; -1 for the end."""
    words = pa.concat_arrays([words])
    length = _lengths(words)
    data = np.concatenate(([0, 0], np.frombuffer(words.buffers()[2] or b"", np.uint8))).astype(np.int64)
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset:][1:len(words) + 1] + 1  # data begins two bytes ahead
    return np.where(length == 0, -1, (data[ends] + np.where(length > 1, 256 * data[ends - 1], 0)) % SUFFIXES)


def _final_words(shares: DataFrame, last: DataFrame, units: Units, core: np.ndarray) -> DataFrame:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        head = left.to_pylist()[0]
        words, own = _strings(head["a"], head["b"]), _open(right.to_pylist()[0]["a"], np.int16).astype(np.int64)
        at = units.places(words)
        own = np.where(at >= 0, np.append(core, 0)[at], own)
        return _rows([(head["share"], -1, len(own), head["a"], head["b"], head["c"], _shut(own.astype(np.uint8)))])

    heads = shares.where("block < 0").groupBy("share").cogroup(last.where("block < 0").groupBy("share"))
    return stored(heads.applyInArrow(run, _ROWS), "word-classes")


def _kinds(words: DataFrame, k: int) -> np.ndarray:
    """Distinct words by last bytes and class; the last row is for the end."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((SUFFIXES + 1) * k, np.int64)
        for batch in batches:
            for r in batch.to_pylist():
                suffix = _suffixes(_strings(r["a"], r["b"]))
                suffix[suffix < 0] = SUFFIXES
                sums += np.bincount(suffix * k + _open(r["d"], np.uint8), minlength=len(sums))
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(sums[at])], names=["at", "n"])

    found = words.mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros((SUFFIXES + 1) * k)
    out[found.column("at").to_numpy()] = found.column("n").to_numpy()
    return out.reshape(-1, k)


def cluster(blocks: Blocks, shares: DataFrame, units: Units, rounds: int) -> tuple[DataFrame, np.ndarray, np.ndarray, list[float]]:
    """Replies with the last classes, classes of the core, counts of unit pairs, and the course of the likelihood."""
    k, size = units.k, len(units.core)
    now = replies(shares, units)
    counts = unit_pairs(blocks, now, units)
    core, pairs, _ = exchange(counts[:size, :size], k, rounds)
    now = replies(shares, units, now, contexts(blocks, now, units, core), pairs)
    counts = unit_pairs(blocks, now, units)

    def by_class(counts: np.ndarray, core: np.ndarray) -> np.ndarray:
        return _added(counts[:-1, :-1], units.classes(core)[:-1], units.classes(core)[:-1], (k, k))

    one_each = np.concatenate((np.arange(size), size + np.arange(k), size + np.arange(k)))  # long words beside others
    course, parts, turn = [likelihood(by_class(counts, core))], 1, 0
    least = -_xlogx(counts.sum())  # the likelihood of a single class, where neighbours tell nothing
    for _ in range(rounds):
        if turn == 0:
            before = course[-1]
        rigid = _added(counts[:-1, :-1], one_each, one_each, (size + k, size + k))
        units_, pairs, steps = exchange(rigid, k, 1, np.concatenate((core, np.arange(k))), size)
        core = units_[:size]
        course.append(steps[-1])
        tried = replies(shares, units, now, contexts(blocks, now, units, core, parts, turn), pairs)
        recount = unit_pairs(blocks, tried, units)
        found = likelihood(by_class(recount, core))
        if found < course[-1]:
            parts, turn = 2 * parts, 0
            if parts > PARTS:
                break
            continue
        now, counts, turn = tried, recount, (turn + 1) % parts
        course.append(found)
        if turn == 0 and found - before <= STILL * (before - least):
            break
        parts = max(parts, 2)
    return now, core, counts, course


def fit(training: DataFrame, rounds: int = ROUNDS, n_classes: int = CLASSES, weight: float = LAMBDA, core: int = CORE,
        bits: int = FREQUENT_BITS) -> Model:
    """Learn from all rows of ``training`` (text)."""
    blocks = encode(training.select(F.lit(None).cast("long").alias("doc_id"), "text", F.lit(True).alias("trains")))
    try:
        return fit_blocks(blocks, rounds, n_classes, weight, core, bits)
    finally:
        blocks.done()


def fit_blocks(blocks: Blocks, rounds: int, n_classes: int, weight: float, core: int, bits: int) -> Model:
    """Learn from the training texts of ``blocks``."""
    shares = vocabulary(blocks).repartition(blocks.shares, "share").persist(StorageLevel.DISK_ONLY)
    try:
        total, distinct, words = word_counts(shares, core)
        frequent = words.where((F.length("word") == 0) | is_frequent(total, bits))
        units = Units([w for w, _ in core_words(frequent, core)], n_classes)
        last, core_classes, pairs, course = cluster(blocks, shares, units, rounds if total else 0)
        final = _final_words(shares, last, units, core_classes)
    finally:
        shares.unpersist()
    classes, histories = units.classes(core_classes)[:-1], units.histories(core_classes)[:-1]
    counts = _added(pairs[:-1, :-1], histories, classes, (n_classes + 1, n_classes))
    tokens_, kinds = counts.sum(axis=0), _kinds(final, n_classes)
    least = total + 0.5 * (distinct + 1)
    steps = np.log10(factors(counts, tokens_, kinds.sum(axis=0), weight) + (1 - weight) / least)
    fallback = int(tokens_.argmax())
    suffixes = [int(x.argmax()) if x.any() else fallback for x in kinds[:-1]]
    of_classes = _added(pairs[:-1, :-1], classes, classes, (n_classes, n_classes))
    return Model(final, blocks.shares, steps, suffixes, total, least, course, of_classes, distinct)


def score(docs: DataFrame, rounds: int = ROUNDS, n_classes: int = CLASSES, weight: float = LAMBDA, core: int = CORE,
          bits: int = FREQUENT_BITS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    blocks = encode(docs.withColumn("trains", ~held_out(F.col("doc_id"))))
    try:
        return _score_blocks(blocks, fit_blocks(blocks, rounds, n_classes, weight, core, bits))
    finally:
        blocks.done()


def score_with(docs: DataFrame, model: Model) -> DataFrame:
    blocks = encode(docs.select(F.col("doc_id").cast("long"), "text", F.lit(False).alias("trains")), model.shares)
    try:
        return _score_blocks(blocks, model)
    finally:
        blocks.done()


def _score_blocks(blocks: Blocks, model: Model) -> DataFrame:
    steps, suffixes, k = model.steps, np.array(model.suffixes), model.steps.shape[1]

    def look_up(left: pa.Table, right: pa.Table) -> pa.Table:
        """Classes, histories and counts of each block's words; words that did not train have count 0 and history k."""
        rows, known = left.to_pylist(), right.to_pylist()
        if not rows:
            return _rows([])
        names = pa.concat_arrays([_strings(r["a"], r["b"]) for r in rows])
        c, own = np.zeros(len(names), np.int64), suffixes[_suffixes(names)]
        if known:
            words = _strings(known[0]["a"], known[0]["b"])
            at = pc.fill_null(pc.index_in(names, value_set=words), -1).to_numpy(zero_copy_only=False)
            here = at >= 0
            c[here], own[here] = _open(known[0]["c"], np.int64)[at[here]], _open(known[0]["d"], np.uint8)[at[here]]
        history = np.where((c == 0) | (_lengths(names) > LONGEST), k, own)
        out, a = [], 0
        for r in rows:
            b = a + r["n"]
            out.append((r["share"], r["block"], r["n"], *(_shut(x[a:b].astype(np.uint8)) for x in (own, history)), _shut(c[a:b])))
            a = b
        return _rows(out)

    def add(text: dict, sent: list[dict]) -> pa.Table:
        own, history = (np.concatenate([_open(r[x], np.uint8) for r in sent]) for x in "ab")
        c = np.concatenate([_open(r["c"], np.int64) for r in sent])
        ids, sizes = _numbers(text, (r["n"] for r in sent)), _open(text["b"], np.int64)
        begin = np.cumsum(sizes) - sizes
        by_text = lambda x: pa.array(np.add.reduceat(x, begin))
        none = _open(text["d"], bool)
        return pa.table([
            pa.array(_open(text["c"], np.int64), mask=none), pa.array(sizes), by_text((c > 0).astype(np.int64)[ids]),
            by_text(np.log10(c + 0.5)[ids]), by_text(steps[_before(history[ids]), own[ids]])],
            names=["doc_id", "n_tokens", "n_known", "seen", "steps"])

    dealt = blocks.words.repartition(blocks.shares, "share").groupBy("share")
    found = dealt.cogroup(model.words.groupBy("share")).applyInArrow(look_up, _ROWS)
    sums = stored(_both(blocks, found, add, "doc_id long, n_tokens long, n_known long, seen double, steps double"), "scores")
    return sums.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("seen") - F.col("n_tokens") * F.log10(F.lit(float(model.least)))).alias("base_score"),
        (F.col("seen") + F.col("steps")).alias("score"))


def factors(counts: np.ndarray, tokens_: np.ndarray, distinct: np.ndarray, weight: float = LAMBDA) -> np.ndarray:
    """weight * P(class | history) / (N + 0.5 * (V + 1)) of the class, by (history, class).

    Each history is smoothed by one pair that follows the classes' shares.
    """
    share = (tokens_ + 1) / (tokens_.sum() + len(tokens_))
    chance = (counts + share) / (counts.sum(axis=1, keepdims=True) + 1)
    return weight * chance / (tokens_ + 0.5 * (distinct + 1))


def perplexity(scored: DataFrame) -> DataFrame:
    """Perplexity of the model and of the base, for training and held-out texts."""
    return scored.groupBy("held_out").agg(
        F.pow(10.0, -F.sum("score") / F.sum("n_tokens")).alias("perplexity"),
        F.pow(10.0, -F.sum("base_score") / F.sum("n_tokens")).alias("base_perplexity"))
