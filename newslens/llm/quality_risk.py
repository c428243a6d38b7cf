"""Quality rules whose cutoffs keep the risk of rejecting a good document bounded.

Rules compare a score of the text with a cutoff. For each stratum (language) the
rejections of labelled good documents are tested from the loosest cutoff of a fixed
grid to the strictest: it is safe if k or fewer rejections among n would have
probability p or less were the true risk above the bound (exact binomial tail).
Rejections are nested along a grid, so the first test that fails ends its sequence
and no test pays for the others of the sequence. Half of DELTA goes to sequences of
all sets of rules that tighten together, each bounded by ALPHA; half to sequences
of single rules, each bounded by its share of ALPHA (Bonferroni over sequences and
strata). Of the safe cutoffs those are taken that reject the largest share of bad
documents beyond COST times the share of good ones, by one set or by single rules,
whichever does better. So with probability 1 - DELTA no stratum loses more than
ALPHA of its good documents to these rules. All of it is DataFrame expressions.

Words are runs without ASCII white space. Null texts have none, fail the base
rule and are not kept. Languages with too few labels for any cutoff (null among
them) are judged by one pooled stratum, which takes in the next smallest language
while it has too few itself; without enough labels in all only the base rule rejects.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from newslens.llm.common import WHITE_SPACE, columns_of, free, stored

ALPHA = 0.02      # share of good documents that a stratum may lose
DELTA = 0.05      # probability that some stratum loses more
COST = 10.0       # one good document weighs as much as so many bad ones (as shares)
MIN_LABELS = 300  # labelled good documents that a stratum of its own needs, or as many as a cutoff needs
MAX_STRATA = 256
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
_PLACE_BITS = 24  # places of words beside 40 bits of hash, for the first look only

# cutoffs tried, from the loosest on; a document is rejected beyond a cutoff
GRID = {
    "symbols": [0.5, 0.3, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03, 0.02, 0.01],
    "dup_lines": [0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1],
    "repeats": [0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05],
    "long_words": [40.0, 30.0, 20.0, 15.0, 12.0, 10.0, 9.0, 8.0],
    "short_words": [-1.2, -1.5, -2.0, -2.5, -3.0, -3.5, -4.0],
}
_SUBSETS = [rules for n in range(1, len(GRID) + 1) for rules in combinations(GRID, n)]  # single rules first
_LEVELS = max(map(len, GRID.values()))


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once, not again for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _places(found: Column, place: Column) -> Column:
    """Words covered by three-word windows that begin at the sorted places."""
    return F.aggregate(
        F.transform(found, lambda x, i: F.when(i == 0, F.lit(3)).otherwise(
            F.least(F.lit(3), x - F.get(found, i - 1)))), F.lit(0), lambda a, x: a + x.cast("int"))


def repeat_words(words: Column) -> Column:
    """Words in three-word windows that the text has twice or more, in about n log n steps.

    A sort by a short hash finds the windows that may repeat; only these are
    compared by their words.
    """
    low = (1 << _PLACE_BITS) - 1

    def twins(sorted_: Column, same: Callable[[Column, Column], Column]) -> Column:
        return F.filter(sorted_, lambda x, i: F.coalesce(
            same(x, F.get(sorted_, i + 1)), F.lit(False)) | F.when(
            i > 0, same(x, F.get(sorted_, i - 1))).otherwise(F.lit(False)))

    def count(w: Column) -> Column:
        window = lambda i: [F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)]
        hashed = F.sort_array(F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.xxhash64(*window(i)).bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("long"))))
        maybe = _with(hashed, lambda s: F.transform(
            twins(s, lambda a, b: F.shiftright(a, _PLACE_BITS) == F.shiftright(b, _PLACE_BITS)),
            lambda x: x.bitwiseAND(F.lit(low)).cast("int")))
        exact = F.array_sort(F.transform(maybe, lambda i: F.struct(
            F.concat_ws(" ", *window(i)).alias("k"), i.alias("i"))))
        found = _with(exact, lambda s: F.sort_array(F.transform(
            twins(s, lambda a, b: a["k"] == b["k"]), lambda x: x["i"])))
        return _with(found, lambda p: _places(p, p))

    return _with(words, lambda w: F.when(F.size(w) >= 4, count(w)).otherwise(0))


def features(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a struct ``name`` of the base counts."""
    words, = free(docs, "_words")
    text = F.coalesce("text", F.lit(""))
    blank = " \t\n\x0b\x0c\r"
    trimmed = F.btrim(text, F.lit(blank))
    marked = docs.withColumn(words, F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(
        F.split(trimmed, WHITE_SPACE)))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(blank))) > 0)
    counted = _with(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"),
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    return marked.withColumn(name, F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        counted.alias("lines"),
        repeat_words(F.col(words)).cast("long").alias("n_repeat_words"),
    )).drop(words)


def flat(df: DataFrame, name: str, *keep: str) -> DataFrame:
    f = F.col(name)
    return df.select(
        *[F.col(f"`{c}`") for c in keep], f["n_words"].alias("n_words"), f["word_chars"].alias("word_chars"),
        f["n_symbols"].alias("n_symbols"), f["lines"]["n_lines"].alias("n_lines"),
        f["lines"]["n_dup_lines"].alias("n_dup_lines"), f["n_repeat_words"].alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def scores() -> dict[str, Column]:
    """A score for each rule; higher is worse, zero where there is nothing to measure."""
    def share(a: Column, b: str) -> Column:
        return F.when(F.col(b) > 0, a / F.col(b)).otherwise(0.0)

    return {
        "symbols": share(F.col("n_symbols"), "word_chars"),
        "dup_lines": share(F.col("n_dup_lines"), "n_lines"),
        "repeats": share(F.col("n_repeat_words"), "n_words"),
        "long_words": share(F.col("word_chars"), "n_words"),
        "short_words": -F.when(F.col("n_words") > 0, F.col("word_chars") / F.col("n_words")).otherwise(1e9),
    }


def log_binomial_tail(n: Column, k: Column, risk: float) -> Column:
    """ln P(at most k of n) where each happens with probability ``risk``; k below n * risk.

    Summed in logarithms, term by term, so it holds for any n.
    """
    start = n * F.log1p(F.lit(-risk))
    step = F.log(F.lit(risk / (1 - risk)))

    def add(acc: Column, i: Column) -> Column:
        term = acc["term"] + F.log((n - i + 1) / i) + step
        return F.struct(term.alias("term"), (
            F.greatest(acc["sum"], term) + F.log1p(F.exp(-F.abs(acc["sum"] - term)))).alias("sum"))

    return F.aggregate(
        F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>")),
        F.struct(start.alias("term"), start.alias("sum")), add, lambda acc: acc["sum"])


def least_labels(strata: int, alpha: float = ALPHA, delta: float = DELTA) -> int:
    """Good labels from which a stratum can have a cutoff at all (no good document beyond it)."""
    return math.ceil(math.log(delta / (2 * len(_SUBSETS) * strata)) / math.log1p(-alpha))


def own_strata(sizes: list[int], rest: int, alpha: float = ALPHA, delta: float = DELTA,
               min_labels: int = MIN_LABELS) -> int:
    """How many of the languages (good labels, most first) are strata of their own.

    ``rest`` counts the good labels of all other languages. The pool takes these and
    small languages; while it has too few labels for a cutoff it takes the next one.
    """
    for m in range(len(sizes), 0, -1):
        least, pool = least_labels(m + 1, alpha, delta), rest + sum(sizes[m:])
        if sizes[m - 1] >= max(least, min_labels) and (pool == 0 or pool >= least):
            return m
    return 0


def cutoffs(labelled: DataFrame, alpha: float = ALPHA, delta: float = DELTA, cost: float = COST,
            min_labels: int = MIN_LABELS) -> tuple[DataFrame, DataFrame]:
    """Strata (lang) and cutoffs (stratum, rule, cutoff, n, k) from counts with ``quality``.

    ``labelled`` has lang, quality and the base counts. Both results have a
    bounded number of rows (MAX_STRATA strata, one cutoff for each rule); k is the
    number of good documents that all cutoffs of the stratum reject together.
    """
    spark, score = labelled.sparkSession, scores()
    # the level of a rule is the first cutoff of its grid that rejects; rejections are nested along a grid
    level = {r: sum((F.when(score[r] > c, 0).otherwise(1) for c in grid), F.lit(0)) for r, grid in GRID.items()}
    levels = stored(labelled.where(~base_failed()).groupBy("lang", *[level[r].alias(r) for r in GRID]).agg(
        F.sum("quality").alias("good"), F.sum(1 - F.col("quality")).alias("bad")), "levels")
    sizes = levels.where("lang is not null").groupBy("lang").agg(F.sum("good").alias("n")).where("n > 0").orderBy(
        F.desc("n"), "lang").limit(MAX_STRATA).collect()
    rest = (levels.agg(F.sum("good")).first()[0] or 0) - sum(r["n"] for r in sizes)
    own = own_strata([r["n"] for r in sizes], rest, alpha, delta, min_labels)
    strata = spark.createDataFrame([(r["lang"],) for r in sizes[:own]], "lang string")
    named = levels.join(F.broadcast(strata.withColumn("stratum", F.col("lang"))), "lang", "left").groupBy(
        "stratum", *GRID).agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    named = stored(named, "stratum-levels")
    totals = named.groupBy(F.col("stratum").alias("_s")).agg(F.sum("good").alias("n_good"), F.sum("bad").alias("n_bad"))

    def with_gain(df: DataFrame) -> DataFrame:
        share = F.when(F.col("n_bad") > 0, F.col("hits") / F.col("n_bad")).otherwise(0.0)
        return df.join(F.broadcast(totals), F.col("stratum").eqNullSafe(F.col("_s"))).drop("_s").withColumn(
            "gain", share - cost * F.col("k") / F.col("n_good"))

    def first_level(rules: tuple[str, ...]) -> Column:
        return F.least(F.lit(_LEVELS), *[F.when(F.col(r) < len(GRID[r]), F.col(r)).otherwise(_LEVELS) for r in rules])

    def safe(df: DataFrame, risk: float, tests: int) -> DataFrame:
        tail = F.when(F.col("k") < F.col("n_good") * risk, log_binomial_tail(F.col("n_good"), F.col("k"), risk))
        return df.where(tail <= F.log(F.lit(delta / (2 * tests * (own + 1))))).where("gain > 0")

    steps = named.select("stratum", "good", "bad", F.explode(F.array(*[F.struct(
        F.lit(i).alias("subset"), first_level(rules).alias("first")) for i, rules in enumerate(_SUBSETS)])).alias("t")).select(
        "stratum", "good", "bad", "t.*").where(F.col("first") < _LEVELS).groupBy("stratum", "subset", "first").agg(
        F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    steps = stored(with_gain(steps.withColumn("step", F.explode(F.sequence("first", F.lit(_LEVELS - 1)))).groupBy(
        "stratum", "subset", "step").agg(F.sum("good").alias("k"), F.sum("bad").alias("hits"))), "steps")

    # one set of rules, tightened step by step, with all of ALPHA
    cut = spark.createDataFrame([(i, t, r, grid[min(t, len(grid) - 1)]) for i, rules in enumerate(_SUBSETS)
                                 for t in range(_LEVELS) for r, grid in GRID.items() if r in rules],
                                "subset int, step int, rule string, cutoff double")
    best = Window.partitionBy("stratum").orderBy(F.desc("gain"), "step", "subset")
    joint = safe(steps, alpha, len(_SUBSETS)).withColumn("no", F.row_number().over(best)).where("no = 1").join(
        F.broadcast(cut), ["subset", "step"]).select("stratum", "gain", F.col("n_good").alias("n"), "k", "rule", "cutoff")

    # every rule at a cutoff of its own, each with its share of ALPHA
    best = Window.partitionBy("stratum", "subset").orderBy(F.desc("gain"), "step")
    single = stored(safe(steps.where(F.col("subset") < len(GRID)), alpha / len(GRID), len(GRID)).withColumn(
        "no", F.row_number().over(best)).where("no = 1").join(F.broadcast(cut), ["subset", "step"]).select(
        "stratum", "rule", "step", "cutoff"), "single-cutoffs")
    chosen = single.groupBy(F.col("stratum").alias("_t")).agg(*[
        F.max(F.when(F.col("rule") == r, F.col("step"))).alias(f"_{r}") for r in GRID])
    rejects = F.lit(False)
    for r, grid in GRID.items():
        rejects = rejects | F.coalesce((F.col(r) < len(grid)) & (F.col(r) <= F.col(f"_{r}")), F.lit(False))
    together = with_gain(named.join(F.broadcast(chosen), F.col("stratum").eqNullSafe(F.col("_t"))).where(rejects).groupBy(
        "stratum").agg(F.sum("good").alias("k"), F.sum("bad").alias("hits"))).select(
        F.col("stratum").alias("_t"), "gain", F.col("n_good").alias("n"), "k")
    apart = single.join(F.broadcast(together), F.col("stratum").eqNullSafe(F.col("_t"))).select(
        "stratum", "gain", "n", "k", "rule", "cutoff")

    # both hold at once, so the better one may be taken
    both = joint.withColumn("way", F.lit(1)).unionByName(apart.withColumn("way", F.lit(0)))
    better = Window.partitionBy("stratum").orderBy(F.desc("gain"), "way")
    return strata, stored(both.withColumn("no", F.dense_rank().over(better)).where("no = 1").select(
        "stratum", "rule", "cutoff", "n", "k"), "cutoffs")


def verdicts(counts: DataFrame, strata: DataFrame, chosen: DataFrame) -> tuple[Column, Column, DataFrame]:
    """(base_failed, kept, ``counts`` with one column ``_cut`` of the stratum's cutoffs)."""
    wide = chosen.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("_cut"))
    table = strata.select("lang", F.col("lang").alias("stratum")).unionByName(
        strata.sparkSession.createDataFrame([(None, None)], "lang string, stratum string"))
    table = table.join(wide, table["stratum"].eqNullSafe(wide["stratum"]), "left").select(
        table["lang"].alias("_lang"), "_cut")
    # languages without a stratum of their own take the pooled row, whose key is null
    known = counts.join(F.broadcast(strata.select(F.col("lang").alias("_own"))), F.col("lang") == F.col("_own"), "left")
    joined = known.join(F.broadcast(table), F.col("_own").eqNullSafe(F.col("_lang")), "left").drop("_own", "_lang")
    fails = F.lit(False)
    for rule, score in scores().items():
        fails = fails | F.coalesce(score > F.col("_cut")[rule], F.lit(False))
    failed = base_failed()
    return failed, ~failed & ~fails, joined


def label_counts(counts: DataFrame, labels: DataFrame) -> DataFrame:
    """``counts`` of labelled documents; a document labelled twice has its lower quality."""
    one = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    return counts.join(one, "doc_id")


def judge(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """(doc_id, base counts, base_failed, kept) for every row of ``docs``."""
    counts = stored(flat(features(docs.select("doc_id", "lang", "text"), "_f"), "_f", "doc_id", "lang"), "counts")
    failed, kept, joined = verdicts(counts, *cutoffs(label_counts(counts, labels), **options))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         failed.alias("base_failed"), kept.alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    name, row = free(docs, "_f", "_row")
    marked = stored(features(docs, name), "judged-documents")
    counts = flat(marked, name, "doc_id", "lang")
    strata, chosen = cutoffs(label_counts(counts, labels), **options)
    nested = flat(marked.withColumn(row, F.struct(*columns_of(docs))), name, "lang", row)
    _, kept, joined = verdicts(nested, strata, chosen)
    return joined.where(kept).select(*[F.col(row)[c].alias(c) for c in docs.columns])
