"""BPE encoding by speculation: propose greedily, verify pairs, merge only what fails.

For a word, the longest vocabulary token at each place is proposed. A row of
tokens is the merge procedure's own result exactly when every token merges to
itself and every adjacent pair of tokens, joined and merged afresh, gives that
pair again. So tokens that cannot be reached by merges are never proposed, all
pairs of a batch of words are checked at once against a table of known pairs,
and only words with a failing pair go through the exact merges.

The tokenizer is a JSON file of the public ``tokenizers`` format: BPE with a
word-end mark, NFC and lower case, words cut by a pattern, bytes as printable
signs. It is read by the driver and sent to the tasks (a few MB). White space
belongs to no word, so texts are cut at ASCII white space first and each such
piece is looked up among the pieces met before; null counts as an empty text.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from newslens.llm.common import as_bytes

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
MAX_PIECES = 150_000  # pieces that a worker remembers; then it starts anew
_DOOR = 1 << 20       # only pieces met before are remembered: one byte for each hash
MAX_PAIRS = 2_000_000
_END = "\uFFFF"       # stands for the word-end mark, which then is one sign


def byte_signs() -> list[str]:
    """The printable sign of each byte: itself where printable, else the next free one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class PairTable:
    """Merge rank and merged id of many token pairs at once: open addressing in arrays."""

    NONE = np.int64(1) << 40

    def __init__(self, codes: np.ndarray, ranks: np.ndarray, merged: np.ndarray):
        self.bits = max(8, int(len(codes) * 8 - 1).bit_length())
        size = 1 << self.bits
        self.codes = np.full(size, -1, np.int64)
        self.ranks = np.full(size, self.NONE, np.int64)
        self.merged = np.zeros(size, np.int32)
        left, slot = np.arange(len(codes)), self._slot(codes)
        while len(left):  # whoever finds a free slot takes it, the others step on
            free = self.codes[slot] == -1
            self.codes[slot[free]] = codes[left[free]]
            won = self.codes[slot] == codes[left]
            self.ranks[slot[won]], self.merged[slot[won]] = ranks[left[won]], merged[left[won]]
            left, slot = left[~won], (slot[~won] + 1) & (size - 1)

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        mixed = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, codes: np.ndarray) -> np.ndarray:
        """Slots of the codes; a code that is not there gets an empty slot."""
        slot = self._slot(codes)
        there = self.codes[slot]
        open_ = np.flatnonzero((there != codes) & (there != -1))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (len(self.codes) - 1)
            there = self.codes[slot[open_]]
            open_ = open_[(there != codes[open_]) & (there != -1)]
        return slot


class SpeculativeBpe:
    def __init__(self, spec: str):
        spec = json.loads(spec)
        model = spec["model"]
        self.mark = model["end_of_word_suffix"]
        inner = self._inner
        self.ids = {inner(t): i for t, i in model["vocab"].items()}
        self.names = {i: t for t, i in model["vocab"].items()}
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
        pairs = [(inner(a), inner(b)) for a, b in pairs]
        self.ranks = {(self.ids[a], self.ids[b]): (rank, self.ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.pairs = PairTable(
            np.array([(a << 20) | b for a, b in self.ranks], np.int64),
            np.array([r for r, _ in self.ranks.values()], np.int64),
            np.array([m for _, m in self.ranks.values()], np.int32))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names |= {i: t for t, i in self.special.items()}
        self.shown = {i: (b"%d" % i, t.encode()) for i, t in self.names.items()}
        self.cut_special = regex.compile("|".join(
            map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # white space by its Unicode property, as that library has it
        self.words = regex.compile(split.replace(r"\s", r"\p{White_Space}"))
        # a piece of ASCII letters is one word, unless the pattern or a special token cuts it
        self.letters_whole = self.words.findall("abyz") == ["abyz"] and not any(
            t.encode().isalpha() for t in self.special)
        signs = byte_signs()
        self.table = dict(enumerate(signs))
        self.sign_id = np.zeros(0x10000, np.int64)
        self.last_id = np.zeros(0x10000, np.int64)
        for sign in signs:
            self.sign_id[ord(sign)] = self.ids[sign]
            self.last_id[ord(sign)] = self.ids[sign + _END]
        # only tokens that the merges reach may be proposed
        tokens = [*self.ids]
        reached = self.merge_all(tokens)
        self.reachable = {t: self.ids[t] for t, got in zip(tokens, reached) if got == [self.ids[t]]}
        self.longest: dict[str, int] = {}  # by the first four signs; what is not here has three at most
        for t in self.reachable:
            if len(t) > 3:
                self.longest[t[:4]] = max(self.longest.get(t[:4], 0), len(t))
        # known pairs: sorted codes and their verdicts
        self.codes = np.empty(0, np.int64)
        self.good = np.empty(0, bool)
        self.door, self.inside = bytearray(_DOOR), 0
        self.known_pieces: dict[bytes, tuple[bytes, int, bytes] | None] = {}
        self.merged_words = self.seen_words = 0

    def _inner(self, token: str) -> str:
        return token[:-len(self.mark)] + _END if token.endswith(self.mark) else token

    def first_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of single signs of all words in a row, and the words' lengths."""
        sign = np.frombuffer("".join(words).encode("utf-16-le"), np.uint16)
        end = sign == ord(_END)
        ids = self.sign_id[sign]
        before = np.flatnonzero(end) - 1
        ids[before] = self.last_id[sign[before]]
        sizes = np.fromiter((len(w) - (w[-1] == _END) for w in words), np.int64, len(words))
        return ids[~end], sizes

    def merge_all(self, words: list[str]) -> list[list[int]]:
        """The merge procedure's result for each word: lowest rank first, leftmost first."""
        flat, sizes = self.first_ids(words)
        begin = np.cumsum(sizes) - sizes
        out: list = [None] * len(words)
        low = 0
        for high in (4, 8, 12, 16, 24, 40):
            rows = np.flatnonzero((sizes > low) & (sizes <= high))
            for part in range(0, len(rows), 50_000):
                self._merge_block(flat, begin, sizes, rows[part:part + 50_000], high, out)
            low = high
        for k in np.flatnonzero(sizes > low).tolist():
            out[k] = self._merge_long(flat[begin[k]:begin[k] + sizes[k]].tolist())
        return out

    def _merge_block(self, flat, begin, sizes, rows, width, out) -> None:
        n, none = len(rows), PairTable.NONE
        if not n:
            return
        place = np.arange(width)
        ids = np.full((n, width), -1, np.int64)
        real = place < sizes[rows][:, None]
        ids[real] = flat[(begin[rows][:, None] + place)[real]]
        size = sizes[rows].copy()
        rank = np.full((n, width), none, np.int64)  # of the pair that begins here
        two = real[:, 1:]
        rank[:, :-1][two] = self.pairs.ranks[self.pairs.find((ids[:, :-1][two] << 20) | ids[:, 1:][two])]
        index = np.arange(n)
        while len(index):
            at = rank.argmin(axis=1)
            line = np.arange(len(index))
            go = rank[line, at] < none
            if not go.all():  # finished words leave
                for k in np.flatnonzero(~go).tolist():
                    out[rows[index[k]]] = ids[k, :size[k]].tolist()
                index, ids, rank, size, at = index[go], ids[go], rank[go], size[go], at[go]
                line = np.arange(len(index))
                if not len(index):
                    break
            slot = self.pairs.find((ids[line, at] << 20) | ids[line, at + 1])
            take = np.minimum(place + (place > at[:, None]), width - 1)
            ids = np.take_along_axis(ids, take, 1)
            rank = np.take_along_axis(rank, take, 1)
            ids[line, at] = self.pairs.merged[slot]
            size -= 1
            ids[line, size] = -1
            for shift in (-1, 0):  # the two pairs that hold the new token
                left = at + shift
                ok = (left >= 0) & (left + 1 < size)
                fresh = np.full(len(index), none, np.int64)
                x, y = line[ok], left[ok]
                fresh[ok] = self.pairs.ranks[self.pairs.find((ids[x, y] << 20) | ids[x, y + 1])]
                put = left >= 0
                rank[line[put], left[put]] = fresh[put]
            rank[line, size - 1] = none
            rank[line, np.minimum(size, width - 1)] = none

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same for one long word, by a heap over a linked list."""
        n = len(ids)
        after, before, ranks = [*range(1, n), -1], [*range(-1, n - 1)], self.ranks
        heap = [(ranks[p][0], i, *p) for i, p in enumerate(zip(ids, ids[1:])) if p in ranks]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue  # one of the two has been merged meanwhile
            ids[i], ids[j] = ranks[a, b][1], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x in (before[i], i):
                y = after[x] if x >= 0 else -1
                if y >= 0 and (ids[x], ids[y]) in ranks:
                    heapq.heappush(heap, (ranks[ids[x], ids[y]][0], x, ids[x], ids[y]))
        return [i for i in ids if i >= 0]

    def propose(self, word: str) -> list[int]:
        """Greedy longest match; every sign alone, and every last sign with the mark, is a token."""
        out, at, n, ids, longest = [], 0, len(word), self.reachable, self.longest
        while at < n:
            end = min(n, at + longest.get(word[at:at + 4], 3))
            while True:
                if end != n - 1:  # the mark is never alone
                    token = ids.get(word[at:end])
                    if token is not None:
                        break
                end -= 1
                if end == at:  # the last sign and its mark
                    token, end = ids[word[at:at + 2]], at + 2
                    break
            out.append(token)
            at = end
        return out

    def _verdicts(self, codes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.codes, codes)
        hit = at < len(self.codes)
        hit[hit] = self.codes[at[hit]] == codes[hit]
        new = np.unique(codes[~hit])
        if len(new):
            names = self.names
            pairs = [(code >> 20, code & 0xFFFFF) for code in new.tolist()]
            merged = self.merge_all([names[a] + self._inner(names[b]) for a, b in pairs])
            fresh = np.fromiter((m == [*p] for m, p in zip(merged, pairs)), bool, len(pairs))
            both = np.concatenate((self.codes, new))
            order = np.argsort(both, kind="stable")
            self.codes, self.good = both[order], np.concatenate((self.good, fresh))[order]
            if len(self.codes) > MAX_PAIRS:
                self.codes, self.good = new, fresh
                return self._verdicts(codes)
            at = np.searchsorted(self.codes, codes)
        return self.good[at]

    def learn(self, words: list[str]) -> dict[str, list[int]]:
        """Ids of words (signs, then the mark)."""
        if not words:
            return {}
        proposals = [self.propose(w) for w in words]
        sizes = np.fromiter(map(len, proposals), np.int64, len(proposals))
        flat = np.fromiter(chain.from_iterable(proposals), np.int64, int(sizes.sum()))
        begin = np.cumsum(sizes) - sizes
        inside = np.ones(len(flat), bool)
        inside[begin] = False  # no pair reaches back over a word's first token
        right = np.flatnonzero(inside)
        bad = np.zeros(len(words), bool)
        if len(right):
            failing = ~self._verdicts((flat[right - 1] << 20) | flat[right])
            bad[np.searchsorted(begin, right[failing], side="right") - 1] = True
        found = dict(zip(words, proposals))
        failed = [words[k] for k in np.flatnonzero(bad).tolist()]
        if failed:
            found.update(zip(failed, self.merge_all(failed)))
        self.seen_words += len(words)
        self.merged_words += len(failed)
        return found

    def lowered(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text)
        # the library lowers sign by sign: no final form of sigma
        return "".join(map(str.lower, text)) if "Σ" in text else text.lower()

    def cut(self, piece: bytes) -> list[str | int]:
        """A piece without ASCII white space as words (signs and mark) and ids of special tokens."""
        text, out, at = piece.decode(), [], 0

        def plain(part: str) -> None:
            for word in self.words.findall(self.lowered(part)):
                out.append(word.encode().decode("latin-1").translate(self.table) + _END)

        if self.cut_special:
            for m in self.cut_special.finditer(text):
                plain(text[at:m.start()])
                out.append(self.special[m[0]])
                at = m.end()
        plain(text[at:])
        return out

    def know(self, pieces: Iterable[bytes]) -> None:
        """Add pieces to ``known_pieces``: (ids as text, their number, decoded text), None without tokens."""
        plain, new = {}, {}
        for p in pieces:
            if self.letters_whole and p.isalpha():
                plain[p] = p.lower().decode() + _END
            else:
                new[p] = self.cut(p)
        words = dict.fromkeys(plain.values())
        words.update(dict.fromkeys(w for cut in new.values() for w in cut if isinstance(w, str)))
        found = self.learn([*words])
        shown, known = self.shown, self.known_pieces

        def remember(piece: bytes, ids: list[int]) -> None:
            rows = [shown[i] for i in ids]
            known[piece] = (b" ".join([r[0] for r in rows]), len(ids), b" ".join([r[1] for r in rows])) if ids else None

        for piece, word in plain.items():
            remember(piece, found[word])
        for piece, cut in new.items():
            remember(piece, [i for w in cut for i in ((w,) if isinstance(w, int) else found[w])])

    def forget(self, pieces: Iterable[bytes]) -> None:
        """Keep only those of the new pieces that were new before, as most are met once."""
        door, known = self.door, self.known_pieces
        for p in pieces:
            at = hash(p) & (_DOOR - 1)
            if not door[at]:
                door[at] = 1
                self.inside += 1
                del known[p]
        if self.inside > _DOOR // 2:
            self.door, self.inside = bytearray(_DOOR), 0
        if len(known) > MAX_PIECES:
            known.clear()

    def encode_all(self, texts: list[bytes]) -> Iterator[tuple[bytes, int, bytes]]:
        """(ids as text, number of ids, decoded text) of each text."""
        gc.disable()  # nothing here has cycles, and the tables of known pieces are long to walk
        block = 200  # documents whose new pieces are learnt together
        for begin in range(0, len(texts), block):
            cut = [t.split() for t in texts[begin:begin + block]]
            known = self.known_pieces
            missing = {p for pieces in cut for p in pieces if p not in known}
            if missing:
                self.know(missing)
            for pieces in cut:
                got = [x for x in map(known.__getitem__, pieces) if x]
                yield (b" ".join([x[0] for x in got]), sum([x[1] for x in got]), b" ".join([x[2] for x in got]))
            self.forget(missing)


_MODELS: dict[str, SpeculativeBpe] = {}


def model_of(spec: str, name: str) -> SpeculativeBpe:
    """One model for each Python worker, kept from task to task."""
    if name not in _MODELS:
        _MODELS.clear()
        _MODELS[name] = SpeculativeBpe(spec)
    return _MODELS[name]


def _slices(batches: Iterable[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Fewer rows at once, as their texts are held as Python values."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _read(docs: DataFrame, path: str):
    """The tokenizer file as a broadcast value and its digest; the path need only exist on the driver."""
    with open(path, encoding="utf-8") as f:
        spec = f.read()
    return docs.sparkSession.sparkContext.broadcast(spec), hashlib.sha256(spec.encode()).hexdigest()


def encode(docs: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """(doc_id, ids, decoded) of every row: token ids and their decoded text."""
    spec, name = _read(docs, path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(spec.value, name)
        for batch in _slices(batches):
            got = [*model.encode_all(as_bytes(batch.column("text")))]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([[*map(int, g[0].split())] for g in got], pa.list_(pa.int32())),
                pa.array([g[2].decode() for g in got], pa.string())], names=["doc_id", "ids", "decoded"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(
        run, "doc_id long, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): the same without moving ids out of the task."""
    spec, name = _read(docs, path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(spec.value, name)
        for batch in _slices(batches):
            n, a, b = [], [], []
            for ids, size, decoded in model.encode_all(as_bytes(batch.column("text"))):
                n.append(size)
                a.append(hashlib.sha256(ids).hexdigest())
                b.append(hashlib.sha256(decoded).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
