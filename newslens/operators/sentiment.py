"""Document polarity, classes, ranking and loading."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from newslens import constants as K
from newslens.functions.numbers import exact_round, percent, ten_point
from newslens.functions.text import let
from newslens.operators import lexicon as L
from newslens.operators.ranking import number_rows, top_per_group
from newslens.operators.skew import lookup

_TOKEN = r"[\p{L}\p{N}_']+"


LISTED_WORDS = 50_000  # a lexicon up to this size is a list in the plan, so that only hits become rows


def lexicon_table(spark: SparkSession, words: dict[str, float]) -> DataFrame:
    """(word, valence in 10^-8 units), for broadcast: the driver holds it already, so it has a driver's size."""
    return F.broadcast(spark.createDataFrame(
        pa.table({"_entry": list(words), "_valence": [round(v * L.UNIT) for v in words.values()]})))


def _count_char(text: Column, char: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))).cast("long")


def score_documents(docs: DataFrame, key: str, text: str, keep: list[str] | None = None,
                    lexicon: dict[str, float] | None = None) -> DataFrame:
    """Compound polarity in -1..1 for each document (T23); ``key`` must be unique.

    Lexicon words are picked out of a document's token array together with the
    three words before them, so neither a window nor a sort is needed and only
    hits become rows. They meet their valence by a broadcast join in the map
    stage; what is shuffled is one partial sum per document. All sums are
    integers in 10^-8 units: the order of addition cannot matter.

    A lexicon of more than LISTED_WORDS words is too long for a list in the
    plan: then all tokens become rows, but still meet it in the map stage.
    """
    keep, words = keep or [], L.WORDS if lexicon is None else lexicon
    valences = lexicon_table(docs.sparkSession, words)
    t = F.col(text)

    def hits_of(tokens: Column) -> Column:
        lowered = F.transform(tokens, F.lower)

        def pick(low: Column) -> Column:
            listed = (lambda w: w.isin(*words)) if len(words) <= LISTED_WORDS else (lambda w: F.lit(True))
            places = F.filter(F.transform(low, lambda w, i: F.when(listed(w), i)), lambda i: i.isNotNull())
            return F.transform(places, lambda i: F.struct(
                i.alias("pos"), F.get(tokens, i).alias("word"), F.get(low, i).alias("low"),
                *[F.get(low, i - n).alias(f"w{n}") for n in L.BOOST]))

        return let(lowered, lambda low: F.struct(
            F.array_position(low, "but").alias("but"), pick(low).alias("found")))

    parts = docs.select(
        key, *keep, t.rlike("[a-z]").alias("_has_small"),
        _count_char(t, "!").alias("_bangs"), _count_char(t, "?").alias("_asks"),
        let(F.regexp_extract_all(t, F.lit(_TOKEN), F.lit(0)), hits_of).alias("_hits"))
    # the outer form keeps documents without a hit
    seen = parts.select(key, *keep, "_has_small", "_bangs", "_asks", F.col("_hits.but").alias("_but"),
                        F.explode_outer("_hits.found").alias("_hit")).select("*", "_hit.*").drop("_hit")
    hits = seen.join(valences, F.col("low") == F.col("_entry"), "left")

    before = {n: F.col(f"w{n}") for n in L.BOOST}
    sign = F.signum("_valence").cast("long")
    capitals = (F.upper("word") == F.col("word")) & (F.col("low") != F.col("word")) & F.col("_has_small")
    strength = F.when(capitals, F.lit(L.CAPITALS)).otherwise(0)
    for n, weight in L.BOOST.items():
        strength = strength + F.when(before[n].isin(*L.STRONGER), F.lit(weight)).when(
            before[n].isin(*L.WEAKER), F.lit(-weight)).otherwise(0)
    negated = F.lit(False)
    for n in before:
        negated = negated | F.coalesce(before[n].isin(*L.NEGATIONS), F.lit(False))
    percent_kept = F.when(negated, F.lit(L.NEGATION_PERCENT)).otherwise(100)
    place, but = F.col("pos") + 1, F.col("_but")
    tenths_kept = F.when((but > 0) & (place < but), F.lit(L.BEFORE_BUT)).when(
        (but > 0) & (place > but), F.lit(L.AFTER_BUT)).otherwise(10)
    value = F.when(F.col("_valence").isNotNull(), F.call_function(
        "div", (F.col("_valence") + sign * strength) * percent_kept * tenths_kept, F.lit(1000)))

    # carried columns are grouping keys: first(string) would force a sort
    summed = hits.groupBy(key, *keep, "_bangs", "_asks").agg(
        F.coalesce(F.sum(value), F.lit(0)).alias("_sum"), F.count("_valence").alias("n_hits"))
    asks = F.col("_asks")
    emphasis = F.least("_bangs", F.lit(L.MAX_EXCLAMATIONS)) * L.EXCLAMATION + F.when(
        asks > 3, F.lit(L.MANY_QUESTIONS)).when(asks > 1, asks * L.QUESTION).otherwise(0)
    x = F.col("_x")
    return (
        summed
        .withColumn("_x", (F.col("_sum") + F.signum("_sum").cast("long") * emphasis).cast("double") / float(L.UNIT))
        .withColumn("_ratio", x / F.sqrt(x * x + F.lit(float(L.NORMALISER))))
        .select(key, *keep, "n_hits", exact_round(F.col("_ratio"), 4).alias("compound"))
    )


def classify(compound: Column) -> Column:
    """Positive from 0.05 on, negative only from -0.5 down."""
    return (F.when(compound >= K.POSITIVE_FROM, "positive")
            .when(compound <= K.NEGATIVE_TO, "negative").otherwise("neutral"))


def class_totals(scored: DataFrame) -> DataFrame:
    """Documents per class with their share, and the total."""
    counted = scored.groupBy("sentiment").agg(F.count("*").alias("n"))  # three rows
    total = F.sum("n").over(Window.partitionBy())
    classes = counted.select("sentiment", "n", percent(F.col("n"), total, 2).alias("share_pct"))
    whole = counted.agg(F.lit("total").alias("sentiment"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return classes.unionByName(whole.withColumn("share_pct", F.when(F.col("n") > 0, F.lit(100.0))))


def rank_key(sentiment: Column, compound: Column) -> Column:
    """Ascending sort key: best first, worst first, most neutral first (O3)."""
    return (F.when(sentiment == "positive", -compound).when(sentiment == "negative", compound)
            .otherwise(F.abs(compound)))


def rank_documents(scored: DataFrame, title: str = "title", tie: str = "id",
                   partitions: int | None = None) -> DataFrame:
    """Place of every document in its class list (W2), also when one class is huge."""
    keyed = scored.withColumn("_key", rank_key(F.col("sentiment"), F.col("compound")))
    return number_rows(keyed, [F.col("_key"), F.col(title), F.col(tie)], "rank_no",
                       ["sentiment"], partitions).drop("_key")


def extremes(scored: DataFrame, title: str = "title", tie: str = "id", k: int = 5) -> DataFrame:
    """The ``k`` leading documents of the positive and negative lists."""
    keyed = scored.where(F.col("sentiment").isin("positive", "negative"))
    key = rank_key(F.col("sentiment"), F.col("compound"))
    return top_per_group(keyed, ["sentiment"], [key, F.col(title), F.col(tie)], k)


def load_form(scored: DataFrame) -> DataFrame:
    """Columns of the score table for (…, sentiment, compound) rows."""
    names = ("confidence", "positive_rate", "negative_rate", "neutral_rate", "emotion_joy",
             "emotion_trust", "emotion_fear", "emotion_surprise")
    rows = ", ".join(f"('{c[0]}', {', '.join(map(str, c[1:]))})" for c in K.CLASS_RATES)
    rates = scored.sparkSession.sql(
        f"SELECT sentiment, {', '.join(f'CAST({n} AS DECIMAL(5,2)) {n}' for n in names)} "
        f"FROM VALUES {rows} AS rates(sentiment, {', '.join(names)})")
    shown = exact_round(F.col("compound"), 3)
    return (
        scored.withColumn("report_score", shown)
        .withColumn("sentiment_score", ten_point(F.col("report_score")))
        .withColumn("fits_v1_schema", F.col("sentiment_score") < 10)
        .join(F.broadcast(rates), "sentiment")  # three rows
    )


def match_by_title(scores: DataFrame, corpus: DataFrame, key: str = "title", fold: bool = True) -> DataFrame:
    """Attach the first corpus id with the same title; NULL marks a miss.

    Case does not count, unless ``fold`` is off. One title may own a large share
    of the scores. ``scores`` should be stored.
    """
    def folded(df: DataFrame) -> DataFrame:
        return df.withColumn("_folded", F.lower(key) if fold else F.col(key))

    first = folded(corpus.where(F.col(key).isNotNull())).groupBy("_folded").agg(F.min("id").alias("corpus_id"))
    return lookup(folded(scores), first, "_folded").drop("_folded")
