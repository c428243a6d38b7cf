"""Bigram full-text search over title and content (T12): grams in any order, and whole phrases by position."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from newslens.functions.text import let

_SEPARATORS = r"[^\p{L}\p{N}]+"


def bigrams(text: Column) -> Column:
    """Distinct pairs of neighbouring letters inside words, in lower case."""
    words = F.filter(F.split(F.lower(text), _SEPARATORS), lambda w: F.length(w) > 1)
    pairs = F.transform(F.array_distinct(words), lambda w: F.transform(
        F.sequence(F.lit(1), F.length(w) - 1), lambda i: F.substr(w, i, F.lit(2))))
    return F.array_distinct(F.flatten(pairs))


def postings(corpus: DataFrame, key: str = "id") -> DataFrame:
    """One (gram, document) row per distinct bigram. Narrow: nothing is shuffled."""
    text = F.concat_ws("\n", "title", "content")
    return corpus.select(key, F.explode(bigrams(text)).alias("gram"))


def _gram_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (key, grams) to one row per gram and batch, with the keys of all its documents there."""
    for batch in batches:
        keys, lists = batch.columns
        owner = np.repeat(np.arange(len(keys)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
        coded = lists.flatten().dictionary_encode()
        codes = coded.indices.to_numpy()
        ends = np.cumsum(np.bincount(codes, minlength=len(coded.dictionary)))
        held = keys.take(pa.array(owner[np.argsort(codes, kind="stable")]))
        yield pa.RecordBatch.from_arrays(
            [coded.dictionary, pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), held)], names=["gram", "keys"])


def _by_bucket(rows: DataFrame, buckets: int) -> DataFrame:
    """Rows laid out by buckets of grams, each sorted by gram.

    Adaptive execution sizes the tasks: small buckets are written together, and
    one that a frequent gram fills is split, so files fit the data. Sorting lets
    a search skip the row groups that hold other grams.
    """
    bucket = F.pmod(F.xxhash64("gram"), F.lit(buckets)).cast("int")
    return rows.withColumn("bucket", bucket).hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", "gram")


def write_postings(corpus: DataFrame, path: str, buckets: int = 64, key: str = "id") -> None:
    """Store postings so that a search reads only the folders of its grams.

    A row holds the documents of a gram among those that a task saw together,
    so neither the shuffle nor the sort repeats the gram for each document.
    """
    rows = corpus.select(key, bigrams(F.concat_ws("\n", "title", "content")).alias("grams"))
    kind = rows.schema[key].dataType.simpleString()
    packed = rows.mapInArrow(_gram_rows, f"gram string, keys array<{kind}>")
    _by_bucket(packed, buckets).write.mode("overwrite").partitionBy("bucket").parquet(path)


def matching(rows: DataFrame, term: str, key: str = "id", buckets: int | None = None) -> DataFrame:
    """Documents holding any gram of ``term``, by the share of grams they hold.

    The handful of query grams is a literal filter that reaches the scan.
    ``rows`` are postings, one by one or as they are stored.
    """
    grams = _grams(term)
    if buckets:
        wanted = F.array(*[F.pmod(F.xxhash64(F.lit(g)), F.lit(buckets)).cast("int") for g in grams])
        rows = rows.where(F.array_contains(wanted, F.col("bucket")))
    rows = rows.where(F.col("gram").isin(*grams))
    if "keys" in rows.columns:
        rows = rows.select("gram", F.explode("keys").alias(key))
    found = rows.groupBy(key).agg(F.count("*").alias("n_grams"))
    return found.withColumn("is_full", F.col("n_grams") == len(grams))


def search(corpus: DataFrame, term: str, key: str = "id") -> DataFrame:
    """Search without a stored index: every document is read, none is shuffled.

    Two neighbouring letters always belong to one word, so a gram is held
    exactly when the lower-cased text contains it.
    """
    grams = _grams(term)
    held = let(F.lower(F.concat_ws("\n", "title", "content")), lambda text: sum(
        (text.contains(g).cast("long") for g in grams), F.lit(0).cast("long")))
    return corpus.select(key, held.alias("n_grams")).where("n_grams > 0").withColumn(
        "is_full", F.col("n_grams") == len(grams))


def _grams(term: str) -> list[str]:
    return sorted({w[i:i + 2] for w in _split(term) for i in range(len(w) - 1)})


def _split(term: str) -> list[str]:
    word = "".join(c if c.isalnum() else " " for c in term.lower())
    return word.split()


BLOCK = 4096  # signs of text that one posting covers; places are counted from its start
_PLACES = 1_000_000  # places that are laid side by side at once
_FIELD_END = "\x01"
_LOW = (1 << 21) - 1  # a code point has 21 bits


def _plain_text(text: Column) -> Column:
    """Words in lower case, one blank between them."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), _SEPARATORS, " "))


def places_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(gram, place) as two arrays: pairs of letters inside words, a word's last letter with the blank behind it, and
    words of one letter."""
    signs = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    letter = np.concatenate([[False], (signs != 32) & (signs != 1), [False]])
    before, here, after = letter[:-2], letter[1:-1], letter[2:]
    following = np.append(signs[1:], 0)
    pairs, alone = np.flatnonzero(here & (after | (following == 32))), np.flatnonzero(here & ~before & ~after)
    grams = np.concatenate([signs[pairs] << 21 | following[pairs], signs[alone] << 21])
    return grams, np.concatenate([pairs, alone])


def _gram(code: int) -> str:
    return chr(code >> 21) + (chr(code & _LOW) if code & _LOW else "")


def _place_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (key, text) to rows of places, one per gram and run of documents.

    A place list follows from each start on for one block of a document: its
    key, its block and the sorted places in that block.
    """

    def rows(batch: pa.RecordBatch, docs: list, grams: list, places: list) -> pa.RecordBatch:
        doc, gram, place = map(np.concatenate, (docs, grams, places))
        order = np.lexsort((place, doc, gram))
        doc, gram, place = doc[order], gram[order], place[order]
        block = place // BLOCK
        new_gram = np.append(True, gram[1:] != gram[:-1])
        new = new_gram | np.append(True, (doc[1:] != doc[:-1]) | (block[1:] != block[:-1]))
        first, at = np.flatnonzero(new), np.flatnonzero(new_gram)
        lists = pa.array(np.append(np.searchsorted(first, at), len(first)), pa.int32())  # of each gram
        starts = first - np.repeat(at, np.diff(lists.to_numpy()))
        return pa.RecordBatch.from_arrays(
            [pa.array([_gram(c) for c in gram[at].tolist()], pa.string()),
             pa.ListArray.from_arrays(lists, batch.column(0).take(pa.array(doc[first]))),
             pa.ListArray.from_arrays(lists, pa.array(block[first].astype(np.int32))),
             pa.ListArray.from_arrays(lists, pa.array(starts.astype(np.int32))),
             pa.ListArray.from_arrays(pa.array(np.append(at, len(gram)), pa.int32()), pa.array((place % BLOCK).astype(np.int16)))],
            names=["gram", "keys", "blocks", "starts", "places"])

    for batch in batches:
        docs, grams, places, held = [], [], [], 0
        for i, text in enumerate(batch.column(1)):
            if text := text.as_py():
                gram, place = places_of(text)
                docs.append(np.full(len(gram), i))
                grams.append(gram)
                places.append(place)
                held += len(gram)
            if held > _PLACES:
                yield rows(batch, docs, grams, places)
                docs, grams, places, held = [], [], [], 0
        if held:
            yield rows(batch, docs, grams, places)


def _packed_positions(corpus: DataFrame, key: str) -> DataFrame:
    text = F.concat_ws(f" {_FIELD_END} ", _plain_text(F.col("title")), _plain_text(F.col("content")))
    rows = corpus.select(key, text.alias("_text"))
    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(
        _place_rows, f"gram string, keys array<{kind}>, blocks array<int>, starts array<int>, places array<short>")


def _unpacked(rows: DataFrame, key: str) -> DataFrame:
    places, starts = F.col("places"), F.col("starts")
    lists = F.transform("keys", lambda k, i: F.struct(
        k.alias(key), F.get(F.col("blocks"), i).alias("block"), F.slice(
            places, F.get(starts, i) + 1, F.coalesce(F.get(starts, i + 1), F.size(places)) - F.get(starts, i)).alias("places")))
    # the outer form, since the plain one would evaluate the lists again as a filter; no row is without a list
    return rows.select("gram", F.explode_outer(lists).alias("_p")).select("_p.*", "gram").select(key, "gram", "block", "places")


def positions(corpus: DataFrame, key: str = "id") -> DataFrame:
    """One row per gram and block of a document: (key, gram, block, places). Narrow.

    Places count the signs of title and content with one blank between words.
    They are kept as distances from the start of their block, so that they stay
    small, and no array grows with the length of a text.
    """
    return _unpacked(_packed_positions(corpus, key), key)


def write_positions(corpus: DataFrame, path: str, buckets: int = 64, key: str = "id") -> None:
    """Store positional postings so that a search reads only the folders, and in them the row groups, of its grams.

    A row holds a gram's places in many documents, about ``_PLACES`` places of all grams together.
    """
    _by_bucket(_packed_positions(corpus, key), buckets).write.mode("overwrite").partitionBy("bucket").parquet(path)


def phrase_grams(phrase: str) -> list[tuple[str, int]]:
    """(gram, distance from the start) of a phrase."""
    grams, places = places_of(" ".join(_split(phrase)))
    return sorted(zip(map(_gram, grams.tolist()), places.tolist()), key=lambda x: x[1])


def phrase(rows: DataFrame, text: str | Sequence[str], key: str = "id", buckets: int | None = None) -> DataFrame:
    """Documents that hold ``text`` as one stretch, with the number of its places.

    Any sign that is no letter or digit parts words, and parted words must
    follow one another. The first word may end a longer one and the last may
    begin one, except for words of one letter, which stand alone. Each gram's
    places are moved back by its distance from the start; where all grams meet,
    the phrase begins. Only the rows of the phrase's grams are read, and only
    their places, as short as they are stored, are shuffled, by document.

    Several texts are looked up in one pass, which reads a gram that they share
    once; a first column ``phrase`` then names the text. Each text of a document
    is a group of its own, no larger than when it is looked up alone.
    """
    texts = [text] if isinstance(text, str) else list(dict.fromkeys(text))
    grams_of = {t: phrase_grams(t) for t in texts}
    if not all(grams_of.values()):
        raise ValueError("a phrase needs a letter or digit")
    steps: dict[str, list[Column]] = {}
    for t, grams in grams_of.items():
        for i, (gram, distance) in enumerate(grams):
            steps.setdefault(gram, []).append(F.struct(
                F.lit(t).alias("phrase"), F.lit(i).alias("no"), F.lit(distance).cast("int").alias("distance")))
    if buckets:
        wanted = F.array(*[F.pmod(F.xxhash64(F.lit(g)), F.lit(buckets)).cast("int") for g in sorted(steps)])
        rows = rows.where(F.array_contains(wanted, F.col("bucket")))
    rows = rows.where(F.col("gram").isin(sorted(steps)))
    rows = _unpacked(rows, key) if "starts" in rows.columns else rows
    steps_of = F.create_map(*[c for gram, found in steps.items() for c in (F.lit(gram), F.array(*found))])
    moved = rows.select(
        key, "places", (F.col("block") * BLOCK).alias("_base"), F.explode_outer(steps_of[F.col("gram")]).alias("s"))
    starts = moved.select(
        "s.phrase", key, F.col("s.no").alias("no"), (F.col("_base") - F.col("s.distance")).alias("shift"), "places")

    def of(number: Column) -> Column:
        return F.flatten(F.transform(F.filter("found", lambda f: f["no"] == number), lambda f: F.transform(
            f["places"], lambda p: p.cast("int") + f["shift"])))

    n_grams = F.create_map(*[F.lit(x) for t, grams in grams_of.items() for x in (t, len(grams))])[F.col("phrase")]
    others = F.when(n_grams > 1, F.sequence(F.lit(1), n_grams - 1)).otherwise(F.array().cast("array<int>"))
    met = F.aggregate(others, of(F.lit(0)), lambda a, n: F.array_intersect(a, of(n)))
    found = starts.groupBy("phrase", key).agg(F.collect_list(F.struct("no", "shift", "places")).alias("found"))
    # most documents lack a gram; Spark runs a filter on n_places by a second evaluation, so few should come that far
    complete = found.where(F.size(F.array_distinct("found.no")) == n_grams)
    names = [key] if isinstance(text, str) else ["phrase", key]
    return complete.select(*names, F.size(met).cast("long").alias("n_places")).where("n_places > 0")
