"""License scan: exact phrases, and short notices with a bounded number of edits.

Texts become words (ASCII letters and digits after lower-casing A-Z, and all
signs beyond ASCII) joined by single spaces. A notice that may have e edits is
cut into e + 1 pieces; by the pigeonhole principle one of them stands unchanged
in every match. One automaton finds all pieces and phrases in one pass; around
each piece the ``regex`` library matches the whole notice with at most e edits
and reports span and edits. Null counts as an empty text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from newslens.llm.common import as_bytes

# Phrases of the base scan
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# (label, notice, edits)
NOTICES = [
    ("gpl-notice", "licensed under the gnu general public license", 4),
    ("gpl-notice", "this program is free software you can redistribute it and or modify it", 5),
    ("lgpl-notice", "gnu lesser general public license", 2),
    ("apache-notice", "licensed under the apache license version 2 0", 4),
    ("mit-notice", "released under the mit license", 2),
    ("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy", 5),
    ("bsd-notice", "redistribution and use in source and binary forms with or without modification", 5),
    ("isc-notice", "permission to use copy modify and or distribute this software for any purpose", 5),
    ("mpl-notice", "subject to the terms of the mozilla public license", 4),
    ("cc-by-notice", "licensed under cc by", 1),
    ("cc-notice", "licensed under a creative commons attribution", 3),
    ("unlicense-notice", "this is free and unencumbered software released into the public domain", 5),
    ("reserved", "all rights reserved", 1),
]

_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def pieces(notice: str, edits: int) -> list[tuple[int, str]]:
    """(offset, piece): edits + 1 parts of about equal length."""
    cuts = [round(i * len(notice) / (edits + 1)) for i in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


@cache
def _automaton(notices: tuple) -> tuple:
    hits: dict[str, list] = {}
    for phrase, label in PHRASES.items():
        hits.setdefault(f" {phrase} ", []).append((None, label, 0))
    for k, (label, notice, edits) in enumerate(notices):
        for at, piece in pieces(notice, edits):
            hits.setdefault(piece, []).append((k, label, at))
    search = ahocorasick.Automaton()
    for word, found in hits.items():
        search.add_word(word, (len(word), found))
    search.make_automaton()
    patterns = [regex.compile(f"(?b)(?:{regex.escape(n, literal_spaces=True)}){{e<={e}}}") for _, n, e in notices]
    return search, patterns


def scan(text: bytes, notices: tuple) -> tuple[int, list[tuple[int, str]], list[tuple[str, int, int, int, int]]]:
    """(number of words, base places (word, label), notices (label, first word, last word, edits, its length))."""
    words = text.translate(_TABLE).split()
    if not words:
        return 0, [], []
    joined = b" %b " % b" ".join(words)
    line = joined.decode()
    search, patterns = _automaton(notices)
    base, near = [], {}
    for end, (size, found) in search.iter(line):
        for k, label, at in found:
            if k is None:
                base.append((end - size + 1, label))
            else:
                near.setdefault(k, []).append(end - size + 1 - at)
    spans = []
    for k, starts in near.items():
        label, notice, edits = notices[k]
        done = -1
        for start in sorted(set(starts)):
            if start + len(notice) // 2 < done:  # inside a match that is already reported
                continue
            low, high = max(0, start - edits, done), start + len(notice) + edits
            m = patterns[k].search(line, low, min(high, len(line)))
            if m:
                a, b = m.span()
                spans.append((label, a + (line[a] == " "), b - (line[b - 1] == " "), sum(m.fuzzy_counts), len(notice)))
                done = b
    # places in signs become numbers of words in one walk
    marks = sorted({p for p, _ in base} | {p for _, a, b, *_ in spans for p in (a, b - 1)})
    number, at, n = {}, 0, -1
    for p in marks:
        n += line.count(" ", at, p + 1)
        at = p + 1
        number[p] = n
    return (len(words), sorted((number[p], label) for p, label in base),
            sorted((label, number[a], number[b - 1], e, size) for label, a, b, e, size in spans))


def find_licenses(docs: DataFrame, notices: list[tuple[str, str, int]] = NOTICES) -> DataFrame:
    """(doc_id, n_words, places, notices) of every row of ``docs``.

    places: base phrases with the number of their first word; notices: label,
    first and last word, edits and the length of the notice in signs.
    """
    listed = tuple(notices)
    schema = ("doc_id long, n_words long, places array<struct<word: long, label: string>>, "
              "notices array<struct<label: string, first: long, last: long, edits: long, length: long>>")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))
        notice = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()),
                                     ("edits", pa.int64()), ("length", pa.int64())]))
        for batch in batches:
            got = [scan(t, listed) for t in as_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([g[0] for g in got], pa.int64()),
                pa.array([[dict(zip(("word", "label"), x)) for x in g[1]] for g in got], place),
                pa.array([[dict(zip(("label", "first", "last", "edits", "length"), x)) for x in g[2]] for g in got], notice),
            ], names=["doc_id", "n_words", "places", "notices"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def summary(found: DataFrame) -> DataFrame:
    """One line per document: counts, labels and the best similarity (1 for a base phrase, 0 for nothing).

    The similarity of a notice is 1 - edits / length of the notice that was matched.
    """
    base = F.transform("places", lambda p: p["label"])
    join = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    near = F.array_max(F.transform("notices", lambda n: 1 - n["edits"] / n["length"]))
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(F.transform("places", lambda p: p["word"])).alias("first_word"),
        F.array_max(F.transform("places", lambda p: p["word"])).alias("last_word"),
        join(base).alias("base_labels"),
        join(F.concat(base, F.transform("notices", lambda n: n["label"]))).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(near, F.lit(0.0))).alias("score"))
