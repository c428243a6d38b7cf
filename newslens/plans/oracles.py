"""The registered queries as plain SQL over the same tables.

Written from the rules, not from the Spark plans: texts are parsed by list and
RE2 functions, scores by unnesting tokens.
"""

from __future__ import annotations

from newslens import constants as K
from newslens.operators import lexicon as L


def _list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def with_(*ctes: str, final: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + final


def pct(part: str, whole: str, digits: int) -> str:
    scale = 10 ** digits
    return (f"CASE WHEN ({whole}) <> 0 THEN ((CAST({part} AS HUGEINT) * {200 * scale} + ({whole})) // "
            f"(CAST({whole} AS HUGEINT) * 2))::DOUBLE / {scale}.0 END")


def exact(x: str, digits: int) -> str:
    """Rounding by exact binary value, ties to even."""
    coarse = f"(abs({x}) * {2 ** 30}.0::DOUBLE)"
    n = (f"((floor({coarse})::HUGEINT * {2 ** 45} + floor(({coarse} - floor({coarse})) * {2 ** 45}.0::DOUBLE)::HUGEINT)"
         f" * {10 ** digits})")
    unit = f"{2 ** 75}::HUGEINT"
    return f"(sign({x}) * (({n} + {2 ** 74 - 1}::HUGEINT + ({n} // {unit}) % 2) // {unit})::DOUBLE / {10 ** digits}.0)"


BLANK = r"[\s\x0B\x1c-\x1f\x{85}\p{Z}]"


def strip(x: str) -> str:
    return rf"regexp_replace(regexp_replace({x}, '^{BLANK}+', ''), '{BLANK}+$', '')"


DOCS = """docs AS (
  SELECT d.doc_id AS id, d.text, d.lang, d.source AS medium, o.o_orderdate, o.o_orderpriority, o.o_orderstatus,
    (floor(o.o_totalprice / 1000)::BIGINT % 4)::INT AS n_images,
    (floor(o.o_totalprice / 10000)::BIGINT % 3)::INT AS n_videos,
    trim(split_part(d.text, chr(10), 1)) AS title,
    CASE WHEN o.o_orderpriority IN ('1-URGENT', '3-MEDIUM')
      THEN 'http://news.example.com/a/' || strftime(o.o_orderdate, '%Y%m/%d') || '/' || d.doc_id || '.html'
      ELSE 'http://news.example.com/' || strftime(o.o_orderdate, '%Y-%m/%d') || '/content_' || d.doc_id || '.htm' END AS url
  FROM documents d JOIN orders o ON d.doc_id = o.o_orderkey)"""

CORPUS = """corpus AS (
  SELECT id, title, text AS content, url, lang AS source, medium AS media_name,
    CASE o_orderstatus WHEN 'F' THEN 'text' WHEN 'O' THEN 'image' ELSE 'video' END AS content_type,
    CASE WHEN n_images > 0 THEN 'images/' || title || '_1.jpg' END AS image_url,
    CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate::DATE END AS publish_date
  FROM docs)"""

CHILDREN = """children AS (
  SELECT l_orderkey AS corpus_id, l_linenumber AS pos,
    CASE WHEN l_linenumber % 2 = 1 THEN 'image' ELSE 'video' END AS kind,
    CASE WHEN l_linenumber % 2 = 1 THEN l_orderkey || '_' || l_linenumber ||
        CASE l_returnflag WHEN 'A' THEN '.png' WHEN 'R' THEN '.jpeg' ELSE '.bmp' END
      ELSE l_orderkey || '_' || l_linenumber || '_link.txt' END AS file_name,
    CASE WHEN l_linenumber % 2 = 0 THEN 'https://player' || l_suppkey || '.example.com/v?src=' ||
        l_orderkey || '_' || l_linenumber END AS video_url,
    CASE WHEN l_linenumber % 2 = 1 THEN floor(l_quantity * 20)::INT END AS width,
    CASE WHEN l_linenumber % 2 = 1 THEN floor(l_quantity * 15)::INT END AS height
  FROM lineitem)"""

COUNTED = """counted AS (
  SELECT corpus.*, coalesce(n_image, 0) AS image_count, coalesce(n_video, 0) AS video_count
  FROM corpus LEFT JOIN (SELECT corpus_id, count(*) FILTER (kind = 'image') AS n_image,
      count(*) FILTER (kind = 'video') AS n_video FROM children GROUP BY 1) k ON k.corpus_id = corpus.id)"""

FILES = """files AS (
  SELECT id, title, stem, url, stem || '.txt' AS file_name, n_images, n_videos,
    '标题: ' || title || chr(10) || '网址: ' || url || chr(10) || chr(10) || body ||
    CASE WHEN n_images > 0 THEN chr(10) || chr(10) || '图片列表:' || chr(10) || array_to_string(
      list_transform(range(1, n_images + 1), lambda i: i || '. ' || stem || '_' || i || '.jpeg - 尺寸: '
        || (i * 160) || 'x' || (i * 120) || chr(10)), '') ELSE '' END ||
    CASE WHEN n_videos > 0 THEN chr(10) || chr(10) || '视频列表:' || chr(10) || array_to_string(
      list_transform(range(1, n_videos + 1), lambda i: i || '. ' || stem || '_' || i || '_link.txt' || chr(10)), '')
      ELSE '' END AS value
  FROM (SELECT docs.*, regexp_replace(title, '[\\\\/*?:"<>|]', '', 'g') AS stem,
      CASE WHEN trim(text) <> '' THEN
        CASE o_orderpriority
          WHEN '1-URGENT' THEN year(o_orderdate) || '年' || month(o_orderdate) || '月' || day(o_orderdate) || '日'
          WHEN '2-HIGH' THEN year(o_orderdate) || '-' || month(o_orderdate) || '-' || day(o_orderdate)
          WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%m/%d/%Y')
          WHEN '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%Y.%m.%d')
          ELSE year(o_orderdate) || '-02-30' END
        || chr(10) || chr(10) || text ELSE '' END AS body
    FROM docs))"""

BODIES = rf"""lined AS (SELECT *, string_split(value, chr(10)) AS lines FROM files),
bounds AS (SELECT *,
    coalesce(list_position(list_transform(lines, lambda x: regexp_matches(x, '[^\s\x0B\x1c-\x1f\x{{85}}\p{{Z}}]')
      AND NOT starts_with(x, '标题:') AND NOT starts_with(x, '网址:')), true), 0) AS opens,
    coalesce(list_position(list_transform(lines, lambda x: contains(x, '图片列表:') OR contains(x, '视频列表:')), true), 0) AS closes
  FROM lined),
bodies AS (SELECT id, file_name, value, array_to_string(lines[greatest(opens, 1):CASE WHEN closes > 0
    THEN closes - 1 ELSE len(lines) END], chr(10)) AS body FROM bounds)"""

PARSED = rf"""parsed AS (SELECT id, file_name, value,
    CASE WHEN regexp_extract(value, '标题: ([^\n]+)', 1) = '' THEN file_name
      ELSE {strip("regexp_extract(value, '标题: ([^\\n]+)', 1)")} END AS title,
    {strip("regexp_extract(value, '网址: ([^\\n]+)', 1)")} AS url,
    regexp_replace(regexp_replace(regexp_replace(value, '标题: [^\n]+\n网址: [^\n]+\n\n', '', 'g'),
      '(?s)图片列表:.*', ''), '(?s)\n(?:Specials|Videos)\n.*', '') AS raw_content
  FROM files)"""


def english_words(source: str, column: str, keep: str = "") -> str:
    """Body of a CTE with one lower-cased word per row."""
    keep = f"{keep}, " if keep else ""
    return rf"""SELECT {keep}lower(w) AS word FROM (SELECT {keep}unnest(regexp_extract_all({column}, '[\p{{L}}\p{{N}}_]+')) AS w
    FROM {source}) WHERE regexp_full_match(w, '[a-zA-Z]+') AND length(w) > 1
    AND lower(w) NOT IN ({_list(K.STOP_WORDS_EN_EXTENDED)})"""


MIXED_WORDS = rf"""words AS (SELECT w AS word FROM (SELECT unnest(regexp_extract_all(body, '[\p{{L}}\p{{N}}_]+')) AS w FROM bodies)
    WHERE regexp_full_match(w, '[a-zA-Z]+') AND length(w) > 2 AND lower(w) NOT IN ({_list(K.STOP_WORDS_EN)})
    UNION ALL
    SELECT w FROM (SELECT unnest(list_transform(range(1, length(run)), lambda i: substr(run, i, 2))) AS w FROM (
      SELECT unnest(regexp_extract_all(body, '[\x{{4e00}}-\x{{9fa5}}]+')) AS run FROM bodies) WHERE length(run) > 1)
    WHERE w NOT IN ({_list(K.STOP_WORDS_ZH)}))"""


def counts(words: str = "words", name: str = "counts") -> str:
    return f"{name} AS (SELECT word, count(*) AS n FROM {words} GROUP BY 1)"


def top(k: int, minimum: int = K.MIN_TERM_COUNT) -> str:
    return (f"tops AS (SELECT word, n, (SELECT sum(n) FROM counts)::BIGINT AS total FROM "
            f"(SELECT * FROM counts ORDER BY n DESC, word LIMIT {k}) WHERE n >= {minimum})")


LEXICON = "lexicon(word, valence) AS (VALUES " + ", ".join(
    f"('{w}', {round(v * L.UNIT)}::BIGINT)" for w, v in L.WORDS.items()) + ")"


def scored(source: str, key: str = "id", text: str = "text") -> str:
    """CTEs ending in ``scored(id, n_hits, compound)``."""
    def prior(n: int) -> str:
        return f"lower(w[i - {n}])"

    boosts = " + ".join(
        f"CASE WHEN {prior(n)} IN ({_list(L.STRONGER)}) THEN sg * {b} "
        f"WHEN {prior(n)} IN ({_list(L.WEAKER)}) THEN -sg * {b} ELSE 0 END" for n, b in L.BOOST.items())
    negated = " OR ".join(f"coalesce({prior(n)} IN ({_list(L.NEGATIONS)}), false)" for n in L.BOOST)
    return rf"""{LEXICON},
token_lists AS MATERIALIZED (SELECT {key} AS id, {text} AS doc, regexp_extract_all({text}, '[\p{{L}}\p{{N}}_'']+') AS w,
    regexp_matches({text}, '[a-z]') AS has_small FROM {source}),
places AS (SELECT id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM token_lists),
found AS (SELECT p.*, l.valence, sign(l.valence)::BIGINT AS sg FROM places p JOIN lexicon l ON lower(p.word) = l.word),
buts AS (SELECT id, min(i) AS but_at FROM places WHERE lower(word) = 'but' GROUP BY 1),
raw_hits AS MATERIALIZED (SELECT f.*, w, has_small, coalesce(but_at, 0) AS but_at
  FROM found f JOIN token_lists USING (id) LEFT JOIN buts USING (id)),
boosted AS (SELECT id, i, but_at, {negated} AS negated, valence + {boosts}
    + CASE WHEN upper(word) = word AND lower(word) <> word AND has_small THEN sg * {L.CAPITALS} ELSE 0 END AS v FROM raw_hits),
flipped AS (SELECT id, i, but_at, CASE WHEN negated THEN v * {L.NEGATION_PERCENT} // 100 ELSE v END AS v FROM boosted),
weighed AS (SELECT id, CASE WHEN but_at > 0 AND i < but_at THEN v * {L.BEFORE_BUT} // 10
    WHEN but_at > 0 AND i > but_at THEN v * {L.AFTER_BUT} // 10 ELSE v END AS v FROM flipped),
sums AS (SELECT id, sum(v)::BIGINT AS s, count(*) AS n_hits FROM weighed GROUP BY 1),
marks AS (SELECT id, length(doc) - length(replace(doc, '!', '')) AS bangs, length(doc) - length(replace(doc, '?', '')) AS asks FROM token_lists),
punctuated AS (SELECT m.id, coalesce(n_hits, 0) AS n_hits, coalesce(s, 0) AS s, least(bangs, {L.MAX_EXCLAMATIONS}) * {L.EXCLAMATION}
    + CASE WHEN asks > 3 THEN {L.MANY_QUESTIONS} WHEN asks > 1 THEN asks * {L.QUESTION} ELSE 0 END AS emphasis
    FROM marks m LEFT JOIN sums USING (id)),
totals AS (SELECT id, n_hits, (CASE WHEN s > 0 THEN s + emphasis WHEN s < 0 THEN s - emphasis ELSE 0 END)::DOUBLE / {L.UNIT}.0 AS x FROM punctuated),
curved AS MATERIALIZED (SELECT id, n_hits, x / sqrt(x * x + {float(L.NORMALISER)}::DOUBLE) AS c FROM totals),
scored AS MATERIALIZED (SELECT id, n_hits, {exact("c", 4)} AS compound FROM curved)"""


def label(c: str = "compound") -> str:
    return (f"CASE WHEN {c} >= {K.POSITIVE_FROM} THEN 'positive' WHEN {c} <= {K.NEGATIVE_TO} "
            f"THEN 'negative' ELSE 'neutral' END")


LABELLED = "labelled AS (SELECT doc_id AS id, text FROM documents SEMI JOIN labels USING (doc_id))"

SENTIMENT = LABELLED + ",\n" + scored("labelled") + f""",
shown AS MATERIALIZED (SELECT id, compound, {exact("compound", 3)} AS report_score FROM scored),
ten AS MATERIALIZED (SELECT id, compound, (report_score + 1) * 5 AS raw_ten FROM shown),
sentiment AS MATERIALIZED (SELECT s.id AS corpus_id, {label()} AS sentiment, compound, {exact("raw_ten", 2)}::DECIMAL(4,2) AS sentiment_score
  FROM (SELECT * FROM ten UNION ALL SELECT ten.* FROM ten JOIN labels ON doc_id = id WHERE toxic = 1) s)"""

JOINED = "joined AS (SELECT c.*, s.corpus_id, s.sentiment, s.sentiment_score FROM {0} c LEFT JOIN sentiment s ON s.corpus_id = c.id)"
MEAN = "sum(sentiment_score)::DOUBLE / count(sentiment_score)"


def classes(suffix: str, order=("positive", "neutral", "negative")) -> str:
    return ", ".join(f"count(*) FILTER (sentiment = '{s}') AS {s}_{suffix}" for s in order)
