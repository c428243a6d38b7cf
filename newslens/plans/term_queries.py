"""Term frequency: tokens, stop words, top-k, shares, sheets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newslens import constants as K
from newslens.functions.text import body_by_lines, has_cjk
from newslens.operators import terms
from newslens.plans import bindings as B, oracles as O


def bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = B.article_files(spark, sf_dir)
    return files.select("id", "value", body_by_lines(F.col("value")).alias("body"))


def english_term_frequency(spark, sf_dir):
    return terms.english_report(bodies(spark, sf_dir))


def mixed_term_frequency(spark, sf_dir):
    return terms.mixed_report(bodies(spark, sf_dir).where(has_cjk(F.col("value"))))


def term_totals(spark, sf_dir):
    docs = bodies(spark, sf_dir)
    totals = terms.term_totals(terms.count_terms(terms.english_tokens(docs)))
    return totals.withColumn("n_documents", docs.agg(F.count_if(F.col("body") != "")).scalar())


def english_terms_alphabetical(spark, sf_dir):
    return terms.english_report(bodies(spark, sf_dir)).orderBy("word").select("word", "n")


def top40_by_lang(spark, sf_dir):
    counts = terms.count_terms(terms.mixed_tokens(bodies(spark, sf_dir)))
    tagged = counts.withColumn("lang", terms.token_language(F.col("word")))
    return terms.first_rows_per_sheet(tagged).select("lang", "row_no", "word", "n")


def terms_by_document_language(spark, sf_dir):
    docs = B.texts(spark, sf_dir, "documents", "doc_id")
    counts = terms.count_terms(terms.english_tokens(docs, "text", ["lang"]), ["lang"])
    return terms.first_rows_per_sheet(counts).select("lang", "row_no", "word", "n")


def stop_word_table(spark, sf_dir):
    """Stop words given as a table: the words of the benchmark passages."""
    listed = B.table(spark, sf_dir, "benchmark").select(
        F.explode(terms.latin_words(F.col("text"))).alias("word"))
    docs = B.texts(spark, sf_dir, "documents", "doc_id")
    counts = terms.count_terms(terms.english_tokens(docs, "text", stop_words=listed))
    return counts.where(F.col("n") >= K.MIN_TERM_COUNT)


_BODIES = (O.DOCS, O.FILES, O.BODIES)

QUERIES = {
    "english_term_frequency": (english_term_frequency, O.with_(
        *_BODIES, f"words AS ({O.english_words('bodies', 'body')})", O.counts(), O.top(K.ENGLISH_TOP_TERMS),
        final=f"""SELECT word, n, {O.pct('n', 'total', 4)} AS freq_pct, {O.pct('running', 'total', 4)} AS cum_freq_pct
FROM (SELECT *, sum(n) OVER (ORDER BY n DESC, word)::BIGINT AS running FROM tops)""")),
    "mixed_term_frequency": (mixed_term_frequency, O.with_(
        *_BODIES, O.MIXED_WORDS, O.counts(), O.top(K.MIXED_TOP_TERMS),
        final=f"""SELECT word, n, {O.pct('n', 'total', 4)} AS freq_pct,
CASE WHEN regexp_matches(word, '[\\x{{4e00}}-\\x{{9fa5}}]') THEN 'zh' ELSE 'en' END AS lang FROM tops""")),
    "term_totals": (term_totals, O.with_(
        *_BODIES, f"words AS ({O.english_words('bodies', 'body')})", O.counts(),
        final="""SELECT sum(n)::BIGINT AS total_tokens, count(*) AS distinct_tokens,
(SELECT count(*) FROM bodies WHERE body <> '') AS n_documents FROM counts""")),
    "english_terms_alphabetical": (english_terms_alphabetical, O.with_(
        *_BODIES, f"words AS ({O.english_words('bodies', 'body')})", O.counts(), O.top(K.ENGLISH_TOP_TERMS),
        final="SELECT word, n FROM tops ORDER BY word")),
    "top40_by_lang": (top40_by_lang, O.with_(
        *_BODIES, O.MIXED_WORDS, O.counts(),
        final="""SELECT lang, row_no, word, n FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS row_no
FROM (SELECT *, CASE WHEN regexp_matches(word, '[\\x{4e00}-\\x{9fa5}]') THEN 'zh' ELSE 'en' END AS lang FROM counts))
WHERE row_no <= 40""")),
    "terms_by_document_language": (terms_by_document_language, O.with_(
        f"words AS ({O.english_words('documents', 'text', 'lang')})",
        "counts AS (SELECT lang, word, count(*) AS n FROM words GROUP BY ALL)",
        final="""SELECT lang, row_no, word, n FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS row_no
FROM counts) WHERE row_no <= 40""")),
    "stop_word_table": (stop_word_table, O.with_(
        r"stops AS (SELECT DISTINCT lower(w) AS word FROM (SELECT unnest(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS w FROM benchmark))",
        r"""words AS (SELECT lower(w) AS word FROM (SELECT unnest(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS w FROM documents)
WHERE regexp_full_match(w, '[a-zA-Z]+') AND length(w) > 1)""",
        "counts AS (SELECT word, count(*) AS n FROM words ANTI JOIN stops USING (word) GROUP BY 1)",
        final=f"SELECT word, n FROM counts WHERE n >= {K.MIN_TERM_COUNT}")),
}
