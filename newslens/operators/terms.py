"""Tokens and term frequencies."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from newslens import constants as K
from newslens.functions.numbers import percent
from newslens.functions.text import has_cjk, let
from newslens.operators.ranking import top_per_group
from newslens.operators.skew import bounded_broadcast, lookup
from newslens.session import written

# A whole run of word characters that consists of ASCII letters only. Equal to
# Python's \b[a-zA-Z]+\b, where \b knows all letters ("café" yields nothing).
_LATIN_WORD = rf"(?<!{K.WORD})[a-zA-Z]++(?!{K.WORD})"
_CJK_RUN = rf"{K.CJK}+"


def latin_words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_LATIN_WORD), F.lit(0))


def without_stop_words(tokens: DataFrame, stop_words: Iterable[str] | DataFrame,
                       word: str = "word") -> DataFrame:
    """Drop tokens whose lower case is a stop word.

    A list becomes a hash-set filter ahead of the shuffle; a table (one
    ``word`` column) becomes an anti join.
    """
    if isinstance(stop_words, DataFrame):
        listed = bounded_broadcast(stop_words.select(F.lower("word").alias("_stop")).distinct())
        return tokens.join(listed, F.lower(tokens[word]) == listed["_stop"], "left_anti")
    return tokens.where(~F.lower(word).isin(*stop_words))


def english_tokens(docs: DataFrame, text: str = "body", keep: list[str] | None = None,
                   stop_words: Iterable[str] | DataFrame = K.STOP_WORDS_EN_EXTENDED, counted: bool = False) -> DataFrame:
    """Lower-cased English words longer than one letter.

    With ``counted``, a word comes once for each row that holds it, with its ``frequency`` there.
    """
    if counted:
        return english_counts(docs, text, keep, stop_words)
    words = docs.select(*(keep or []), F.explode(latin_words(F.col(text))).alias("_w"))
    words = words.select(*(keep or []), F.lower("_w").alias("word")).where(F.length("word") > 1)
    return without_stop_words(words, stop_words)


def english_counts(docs: DataFrame, text: str = "body", keep: list[str] | None = None,
                   stop_words: Iterable[str] | DataFrame = K.STOP_WORDS_EN_EXTENDED) -> DataFrame:
    """Counts of ``english_tokens`` by row: one row per row of ``docs`` and word, with its ``frequency``.

    The words of a row are sorted in its array and counted by runs, so a task
    holds one row's words at a time and nothing is shuffled.
    """
    def counted(words: Column) -> Column:
        starts = F.filter(F.transform(words, lambda w, i: F.when((i == 0) | (F.get(words, i - 1) != w), i)),
                          lambda i: i.isNotNull())
        return let(starts, lambda s: F.transform(s, lambda i, n: F.struct(
            F.get(words, i).alias("word"),
            (F.coalesce(F.get(s, n + 1), F.size(words)) - i).cast("long").alias("frequency"))))

    words = F.sort_array(F.transform(latin_words(F.col(text)), F.lower))
    # the outer form, since the plain one would evaluate the words again as a filter
    rows = docs.select(*(keep or []), F.explode_outer(let(words, counted)).alias("_w")).select(*(keep or []), "_w.*")
    return without_stop_words(rows.where(F.length("word") > 1), stop_words)


def _pairs(run: Column) -> Column:
    """Pairs of neighbouring signs; a single sign stays as it is."""
    return F.when(F.length(run) < 2, F.array(run)).otherwise(F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(run) - 1, F.lit(1))), lambda i: F.substr(run, i, F.lit(2))))


def _cuts(best: Column, size: Column) -> Column:
    """Fold over places: the longest word that starts at the first free place is taken, what lies between stays unknown.

    ``best`` has the length of the longest word at each place, 0 without one. The result lists (start, size, known).
    """
    cut = "struct<start:int,size:int,known:boolean>"

    def piece(start: Column, length: Column, known: bool) -> Column:
        return F.struct(start.cast("int").alias("start"), length.cast("int").alias("size"), F.lit(known).alias("known"))

    def state(free: Column, unknown: Column, cuts: Column) -> Column:
        return F.struct(free.cast("int").alias("free"), unknown.cast("int").alias("unknown"), cuts.alias("cuts"))

    def unknown_to(s: Column, end: Column) -> Column:
        return F.when(s["unknown"] < end, F.array(piece(s["unknown"], end - s["unknown"], False))).otherwise(
            F.array().cast(f"array<{cut}>"))

    def step(s: Column, place: Column) -> Column:
        at, length = place["at"], place["size"]
        end = at + length
        taken = F.concat(s["cuts"], unknown_to(s, at), F.array(piece(at, length, True)))
        return F.when((at < s["free"]) | (length == 0), s).otherwise(state(end, end, taken))

    places = F.transform(best, lambda n, i: F.struct(i.alias("at"), n.alias("size")))
    start = state(F.lit(0), F.lit(0), F.array().cast(f"array<{cut}>"))
    return F.aggregate(places, start, step, lambda s: F.concat(s["cuts"], unknown_to(s, size)))


def segment(runs: DataFrame, vocabulary: DataFrame, run: str = "run") -> DataFrame:
    """Distinct runs with their ``words`` by longest match from the left.

    ``vocabulary`` is a table with a column ``word``, of any size. It is kept as
    an array of the word lengths that occur behind each pair of first signs;
    places of a run are joined to it, and only substrings of such lengths are
    then looked up among the words. Unknown stretches fall into pairs of signs.
    """
    words = written(vocabulary.select("word").where(F.length("word") > 1).distinct(), "vocabulary")
    heads = words.groupBy(F.substring("word", 1, 2).alias("head")).agg(
        F.sort_array(F.collect_set(F.length("word"))).alias("sizes"))
    distinct = written(runs.select(F.col(run).alias("run")).where("run IS NOT NULL").distinct(), "runs")
    text, size = F.col("run"), F.length("run")
    heads_at = distinct.where(size > 1).select("run", F.posexplode(_pairs(text)).alias("at", "head"))
    tries = heads_at.join(heads, "head").select("run", "at", F.explode("sizes").alias("size")).where(
        F.col("at") + F.col("size") <= size)
    found = tries.withColumn("word", F.substr(text, F.col("at") + 1, F.col("size"))).join(words, "word")
    longest = found.groupBy("run", "at").agg(F.max("size").alias("size")).groupBy("run").agg(
        F.map_from_entries(F.collect_list(F.struct("at", "size"))).alias("best"))
    best = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.coalesce(F.col("best")[i], F.lit(0)))
    pieces = F.flatten(F.transform(_cuts(best, size), lambda c: let(
        F.struct(F.substr(text, c["start"] + 1, c["size"]).alias("text"), c["known"].alias("known")),
        lambda x: F.when(x["known"], F.array(x["text"])).otherwise(_pairs(x["text"])))))
    plain = F.when(size > 0, _pairs(text)).otherwise(F.array().cast("array<string>"))
    return distinct.join(longest, "run", "left").select(
        "run", F.when(F.col("best").isNull(), plain).otherwise(pieces).alias("words"))


def cjk_tokens(docs: DataFrame, text: str, keep: list[str], vocabulary: Iterable[str] | DataFrame = ()) -> DataFrame:
    """Chinese words longer than one sign.

    Each run of signs is cut once, however many texts hold it; a run that is
    very frequent takes no part in the shuffle that brings its words back.
    """
    if not isinstance(vocabulary, DataFrame):
        vocabulary = docs.sparkSession.createDataFrame([(w,) for w in vocabulary], "word string")
    runs = written(
        docs.where(has_cjk(F.col(text)))
        .select(*keep, F.explode(F.regexp_extract_all(F.col(text), F.lit(_CJK_RUN), F.lit(0))).alias("run"))
        .where(F.length("run") > 1), "cjk-runs")
    words = lookup(runs, segment(runs, vocabulary), "run").select(*keep, F.explode("words").alias("word"))
    return words.where((F.length("word") > 1) & ~F.col("word").isin(*K.STOP_WORDS_ZH))


def _cjk_bigrams(text: Column) -> Column:
    runs = F.filter(F.regexp_extract_all(text, F.lit(_CJK_RUN), F.lit(0)), lambda run: F.length(run) > 1)
    return F.flatten(F.transform(runs, lambda run: F.transform(
        F.sequence(F.lit(1), F.length(run) - 1), lambda i: F.substr(run, i, F.lit(2)))))


def mixed_tokens(docs: DataFrame, text: str = "body", keep: list[str] | None = None,
                 vocabulary: Iterable[str] | DataFrame = ()) -> DataFrame:
    """Chinese words and Latin words longer than two letters, case kept.

    Without a vocabulary Chinese runs fall into bigrams, and one pass of
    built-in functions yields both kinds of words. With one, a table or a few
    words, the runs are cut by longest match.
    """
    keep, t = keep or [], F.col(text)
    if isinstance(vocabulary, DataFrame) or vocabulary:
        latin = docs.select(*keep, F.explode(latin_words(t)).alias("word"))
        latin = without_stop_words(latin.where(F.length("word") > 2), K.STOP_WORDS_EN)
        return latin.unionByName(cjk_tokens(docs, text, keep, vocabulary))
    words = docs.select(*keep, F.explode(F.concat(latin_words(t), F.when(
        has_cjk(t), _cjk_bigrams(t)).otherwise(F.array().cast("array<string>")))).alias("word"))
    is_latin = F.col("word").rlike("^[a-zA-Z]")
    return words.where(F.when(is_latin, (F.length("word") > 2) & ~F.lower("word").isin(*K.STOP_WORDS_EN))
                       .otherwise(~F.col("word").isin(*K.STOP_WORDS_ZH)))


def token_language(word: Column) -> Column:
    return F.when(has_cjk(word), "zh").otherwise("en")


def count_terms(tokens: DataFrame, by: list[str] | None = None) -> DataFrame:
    return tokens.groupBy(*(by or []), "word").agg(F.count("*").alias("n"))


def term_totals(counts: DataFrame) -> DataFrame:
    """Tokens and distinct tokens."""
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_tokens"),
        F.count("*").alias("distinct_tokens"))


def top_terms(counts: DataFrame, k: int, min_count: int = K.MIN_TERM_COUNT) -> DataFrame:
    """The ``k`` most frequent terms, then the minimum count.

    ``freq_pct`` divides by all tokens. The total is a scalar subquery over the
    same aggregate, whose shuffle Spark runs once and reads twice.
    """
    total = counts.agg(F.sum("n")).scalar()
    top = counts.orderBy(F.desc("n"), "word").limit(k).where(F.col("n") >= min_count)
    return top.withColumn("total_n", total).withColumn(
        "freq_pct", percent(F.col("n"), F.col("total_n"), 4))


def with_cumulative(top: DataFrame) -> DataFrame:
    """Running share, summed before rounding (W1); at most ``k`` rows by then."""
    order = Window.orderBy(F.desc("n"), "word").rowsBetween(Window.unboundedPreceding, 0)
    return top.withColumn("cum_freq_pct", percent(F.sum("n").over(order), F.col("total_n"), 4))


def english_report(docs: DataFrame, text: str = "body", k: int = K.ENGLISH_TOP_TERMS) -> DataFrame:
    top = top_terms(count_terms(english_tokens(docs, text)), k)
    return with_cumulative(top).select("word", "n", "freq_pct", "cum_freq_pct")


def mixed_report(docs: DataFrame, text: str = "body", k: int = K.MIXED_TOP_TERMS,
                 vocabulary: Iterable[str] | DataFrame = ()) -> DataFrame:
    top = top_terms(count_terms(mixed_tokens(docs, text, vocabulary=vocabulary)), k)
    return top.select("word", "n", "freq_pct", token_language(F.col("word")).alias("lang"))


def sheets(report: DataFrame) -> dict[str, DataFrame]:
    """The three sheets of the mixed report."""
    return {"all": report, "zh": report.where("lang = 'zh'"), "en": report.where("lang = 'en'")}


def first_rows_per_sheet(report: DataFrame, k: int = K.SHEET_ROWS) -> DataFrame:
    return top_per_group(report, ["lang"], [F.desc("n"), F.col("word")], k, "row_no")
