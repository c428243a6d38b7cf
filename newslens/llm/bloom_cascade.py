"""URL filtering by rules and, where no rule fits, by a Bloom filter cascade.

The cascade holds a list of keys against the corpus's complete key universe. Its
first level encodes the listed keys; the second the unlisted keys that the first
lets through by mistake; the third the listed keys that the second lets through;
and so on until no mistake is left. Over the keys of that universe the answer is
exact: the first level that a key does not pass tells its side. Each level is one
array of words that reaches the expression as a scalar, so pages are judged
where they are, without a join. All of it is DataFrame expressions.

A list whose levels would outgrow ``max_words`` is cut into slices by a hash of the
key. Each slice has a cascade of its own over its own part of the universe and
judges its own pages, in one plan; so lists of any size go through cascades, and
no expression ever holds more than one slice's words.

Host: after the first "://" up to "/", "?", "#" or the end, A-Z lower-cased;
path: then up to "?", "#" or the end. Null urls and urls without "://" have
empty host and path, which no rule fits.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from newslens.llm.common import stored

# Fixed values: (verdict, host, path)
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]

MAX_WORDS = 1 << 20  # 8 MB of filter for each slice
_SLICE = -1           # seed of the slices' hash, apart from those of the levels


_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    host, path = (F.coalesce(F.regexp_extract(url, _PARTS, i), F.lit("")) for i in (1, 2))
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule = verdict = F.lit(None).cast("string")
    # shorter rules first: each longer one wraps them and so goes before
    for word, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1:])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(word)).otherwise(verdict)
    return rule, verdict


@dataclass
class Level:
    """One Bloom filter: ``words`` is a stored one-row table of its 64-bit words."""
    words: DataFrame
    bits: int
    hashes: int
    seed: int

    def passes(self, key: Column) -> Column:
        words, out = self.words.scalar(), F.lit(True)
        for h in range(self.hashes):
            at = F.pmod(F.xxhash64(key, F.lit(self.seed), F.lit(h)), F.lit(self.bits))
            word = F.get(words, F.floor(at / 64).cast("int"))
            out = out & (word.bitwiseAND(_bit(at)) != 0)
        return out


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(64)).cast("int"))


def _size(n: int, others: int) -> tuple[int, int]:
    """(hashes, words) of a filter of ``n`` keys; as many mistakes among ``others`` as half the keys are fine."""
    rate = min(0.5, n / (2 * max(others, 1)))
    hashes = max(1, round(math.log2(1 / rate)))
    return hashes, max(1, math.ceil(n * hashes / math.log(2) / 64))


def slices_for(n: int, others: int, max_words: int = MAX_WORDS) -> int:
    """Slices of which none should need more than ``max_words``: all levels take about twice the first one's words."""
    return max(1, math.ceil(2 * _size(n, others)[1] / max_words)) if n else 1


def _level(keys: DataFrame, n: int, others: int, seed: int) -> Level:
    """A filter of the ``n`` keys."""
    hashes, words = _size(n, others)
    bits = 64 * words
    at = F.explode(F.array(*[F.pmod(F.xxhash64("key", F.lit(seed), F.lit(h)), F.lit(bits)) for h in range(hashes)]))
    table = keys.select(at.alias("at")).groupBy(F.floor(F.col("at") / 64).alias("i")).agg(
        F.bit_or(_bit(F.col("at"))).alias("w"))
    full = keys.sparkSession.range(words).withColumnRenamed("id", "i").join(table, "i", "left")
    packed = full.agg(F.transform(F.sort_array(F.collect_list(F.struct("i", F.coalesce("w", F.lit(0)).alias("w")))),
                                  lambda x: x["w"]).alias("words"))
    return Level(stored(packed, f"level-{seed}"), bits, hashes, seed)


def cascade(listed: DataFrame, universe: DataFrame) -> list[Level]:
    """Levels that tell listed keys from all other keys of ``universe``.

    Both have one column ``key`` of distinct values; listed keys belong to the universe.
    """
    inside = stored(listed.select("key"), "listed")
    outside = stored(universe.select("key").join(inside, "key", "left_anti"), "unlisted")
    n, m, levels = inside.count(), outside.count(), []
    while n:
        level = _level(inside, n, m, len(levels))
        levels.append(level)
        wrong = stored(outside.where(level.passes(F.col("key"))), "mistakes")
        inside, outside, n, m = wrong, inside, wrong.count(), n
    return levels


def is_listed(key: Column, levels: list[Level]) -> Column:
    """Exact for keys of the universe that the levels were made from."""
    out = F.lit(len(levels) % 2 == 1)
    for i in reversed(range(len(levels))):
        out = F.when(levels[i].passes(key), out).otherwise(F.lit(i % 2 == 1))
    return out


def judge_urls(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]] = RULES,
               max_words: int = MAX_WORDS) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages`` (page_id, url).

    ``listed`` has a column ``key``, host plus path, of the keys to block where no
    rule fits; all other keys are allowed.
    """
    host, path = host_and_path(F.col("url"))
    split = stored(pages.select("page_id", host.alias("host"), path.alias("path")), "hosts")
    key = F.concat("host", "path")
    universe = stored(split.select(key.alias("key")).distinct(), "universe")
    known = stored(listed.select("key").distinct().join(universe, "key", "left_semi"), "known")
    n = known.count()
    slices = slices_for(n, universe.count() - n, max_words)
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    judged = None
    for i in range(slices):
        def own(rows: DataFrame, of: Column, i: int = i) -> DataFrame:
            return rows.where(F.pmod(F.xxhash64(of, F.lit(_SLICE)), F.lit(slices)) == i) if slices > 1 else rows

        levels = cascade(own(known, F.col("key")), own(universe, F.col("key")))
        part = own(split, key).select("page_id", "host", "path", rule.alias("rule"), F.coalesce(
            verdict, F.when(is_listed(key, levels), "block").otherwise("allow")).alias("verdict"))
        judged = part if judged is None else judged.unionByName(part)
    return judged


def paged_keys(pages: DataFrame) -> DataFrame:
    """Keys that some url of the corpus pages through (a ``page`` parameter): lists, not articles."""
    host, path = host_and_path(F.col("url"))
    query = F.regexp_extract("url", r"(?s)^[^?#]*\?([^#]*)", 1)
    return pages.where(query.rlike(r"(^|&)page=")).select(F.concat(host, path).alias("key")).distinct()
