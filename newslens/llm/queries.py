"""One registered query per operator, over whole tables, with SQL where it can express the result."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newslens.llm import (
    bloom_cascade, bpe_speculate, brown_lm, column_bwt, exact_dedup, knn_quality, license_scan, merkle_blocks, mix_flow,
    pii_votes, quality_risk, simhash_cover, trie_audit,
)
from newslens.llm.common import Build, table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.summary(license_scan.find_licenses(table(spark, sf_dir, "documents")))


def op2_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown_lm.score(table(spark, sf_dir, "documents"))


def op3_mix_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_flow.mix(table(spark, sf_dir, "documents")).drop("digest")


def op4_column_bwt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_bwt.report(column_bwt.remove_repeats(table(spark, sf_dir, "documents")))


def op5_simhash_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_cover.near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_quality_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_risk.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_bpe_speculate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_speculate.encode_digests(table(spark, sf_dir, "documents"))


def op8_pii_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_votes.summary(pii_votes.find_pii(table(spark, sf_dir, "documents")))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = exact_dedup.mark_copies(table(spark, sf_dir, "documents"))
    return marked.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op10_bloom_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages by the rules; where none fits, keys that the corpus pages through are blocked."""
    pages = table(spark, sf_dir, "pages")
    return bloom_cascade.judge_urls(pages, bloom_cascade.paged_keys(pages))


def op11_trie_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_knn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn_quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_merkle_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_blocks.document_proofs(table(spark, sf_dir, "documents"))


OP9_SQL = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""

OP10_SQL = r"""
WITH u AS (
  SELECT page_id, coalesce(url, '') AS url,
         translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path
  FROM pages),
listed AS (
  SELECT DISTINCT host || path AS key FROM u
  WHERE regexp_matches(regexp_extract(url, '^[^?#]*\?([^#]*)', 1, 's'), '(^|&)page=')),
r AS (SELECT * FROM (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')) AS t(verdict, h, p)),
best AS (
  SELECT page_id, max_by(struct_pack(rule := h || p, verdict := verdict), length(h || p)) AS b
  FROM u JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT u.page_id, host, path, b.rule AS rule, coalesce(b.verdict,
         CASE WHEN host || path IN (SELECT key FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM u LEFT JOIN best ON best.page_id = u.page_id
"""

_ORDERS = ", ".join(f"('{''.join(o)}')" for o in permutations("ABCDE"))
_MASK = " + ".join(f"(contains(letters, '{c}'))::INT * {2 ** i}" for i, c in enumerate("ABCDE"))

OP11_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, part, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
             min(doc_id) OVER (PARTITION BY text) AS first FROM d),
f AS (SELECT doc_id, part, (len(words) < 50)::INT + (100 * len(list_distinct(words)) < 65 * len(words))::INT * 2
               + (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text))::INT * 4
               + regexp_matches(text, '[#$%&*|]')::INT * 8
               + coalesce(doc_id > first, first IS NOT NULL)::INT * 16 AS mask FROM w),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS bad FROM labels
      WHERE doc_id IS NOT NULL GROUP BY 1),
m AS (SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(bad, 0)) AS bad
      FROM f LEFT JOIN l USING (doc_id) GROUP BY 1, 2),
o AS (SELECT filter_order, step, substr(filter_order, step, 1) AS letter, substr(filter_order, 1, step - 1) AS letters
      FROM (VALUES {_ORDERS}) AS t(filter_order), (VALUES (1), (2), (3), (4), (5)) AS s(step)),
s AS (SELECT filter_order, step, (2 ** (ascii(letter) - 65))::INT AS bit, {_MASK} AS before FROM o)
SELECT part, filter_order, step,
  coalesce(sum(n) FILTER (mask & (bit | before) = 0), 0)::BIGINT AS kept,
  coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before = 0), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before <> 0), 0)::BIGINT AS redundant,
  coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
  coalesce(sum(good) FILTER (mask & bit <> 0 AND mask & before = 0), 0)::BIGINT AS good_lost,
  coalesce(sum(bad) FILTER (mask & bit <> 0 AND mask & before = 0), 0)::BIGINT AS toxic_lost,
  coalesce(sum(n * 120 // greatest(bit_count(mask), 1)) FILTER (mask & bit <> 0), 0)::BIGINT AS shapley
FROM m, s GROUP BY 1, 2, 3
"""

OP13_SQL = r"""
WITH RECURSIVE
x AS (SELECT row_number() OVER () AS row_no, *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
        || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
        || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered,
      -- crc32, bit by bit: a byte is taken in, 256 stands for one shift
      xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''),
        lambda c: [ascii(c)::BIGINT, 256, 256, 256, 256, 256, 256, 256, 256]))),
        lambda c, b: CASE WHEN b < 256 THEN xor(c, b) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295) AS crc
      FROM documents),
leaves AS (SELECT row_no, doc_id, source, crc % 5 = 0 AS tampers, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
      sha256(head || coalesce(strlen(lowered) || ':' || lowered, '-')) AS other FROM x),
numbered AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
      count(*) OVER (PARTITION BY source) AS n FROM leaves),
tree AS (
  SELECT 0 AS level, source, i, leaf AS h, n FROM numbered
  UNION ALL
  SELECT level + 1, source, i // 16, sha256(string_agg(h, '' ORDER BY i)), (n + 15) // 16 FROM tree WHERE n > 1
  GROUP BY level, source, i // 16, n),
roots AS (SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n
  FROM tree WHERE n = 1),
top AS (
  SELECT 0 AS level, i, h, n FROM (SELECT i, subroot AS h, n FROM roots)
  UNION ALL
  SELECT level + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), (n + 15) // 16 FROM top WHERE n > 1
  GROUP BY level, i // 16, n),
-- every document's way: first in its source, then over the sources
way AS (
  SELECT row_no, 0 AS part, level, source, i // (16 ** level)::BIGINT AS i FROM numbered,
    (SELECT DISTINCT source AS s, level FROM tree WHERE n > 1) WHERE source IS NOT DISTINCT FROM s
  UNION ALL
  SELECT row_no, 1, level, source, roots.i // (16 ** level)::BIGINT FROM numbered JOIN roots USING (source),
    (SELECT DISTINCT level FROM top WHERE n > 1)
  UNION ALL
  SELECT row_no, 1, level, NULL, roots.i // (16 ** level)::BIGINT FROM numbered JOIN roots
    ON numbered.source IS NULL AND roots.source IS NULL, (SELECT DISTINCT level FROM top WHERE n > 1)),
nodes AS (SELECT 0 AS part, level, source, i, h, i // 16 AS run FROM tree WHERE n > 1
  UNION ALL SELECT 1, level, NULL, i, h, i // 16 FROM top WHERE n > 1),
runs AS MATERIALIZED (SELECT w.row_no, w.part, w.level,
    coalesce(string_agg(t.h, '' ORDER BY t.i) FILTER (t.i < w.i), '') AS a,
    coalesce(string_agg(t.h, '' ORDER BY t.i) FILTER (t.i > w.i), '') AS b
  FROM way w JOIN nodes t ON t.part = w.part AND t.level = w.level AND t.run = w.i // 16
    AND (t.part = 1 OR t.source IS NOT DISTINCT FROM w.source) GROUP BY 1, 2, 3),
steps AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY row_no ORDER BY part, level) AS step FROM runs),
folds AS (
  SELECT row_no, 0::BIGINT AS step, CASE WHEN coalesce(tampers, false) THEN other ELSE leaf END AS h FROM numbered
  UNION ALL
  SELECT f.row_no, s.step, sha256(s.a || f.h || s.b) FROM folds f JOIN steps s ON s.row_no = f.row_no AND s.step = f.step + 1),
folded AS (SELECT row_no, max_by(h, step) AS folded_root FROM folds GROUP BY 1),
proofs AS (SELECT row_no, sha256(string_agg(a || b, '' ORDER BY step)) AS proof FROM steps GROUP BY 1)
SELECT doc_id, leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM numbered JOIN roots ON numbered.source IS NOT DISTINCT FROM roots.source JOIN folded USING (row_no)
LEFT JOIN proofs USING (row_no), (SELECT h AS root FROM top WHERE n = 1)
"""

QUERIES: dict[str, Build] = {
    "op1_license_scan": op1_license_scan,
    "op2_brown_lm": op2_brown_lm,
    "op3_mix_flow": op3_mix_flow,
    "op4_column_bwt": op4_column_bwt,
    "op5_simhash_cover": op5_simhash_cover,
    "op6_quality_risk": op6_quality_risk,
    "op7_bpe_speculate": op7_bpe_speculate,
    "op8_pii_votes": op8_pii_votes,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_bloom_cascade": op10_bloom_cascade,
    "op11_trie_audit": op11_trie_audit,
    "op12_knn_quality": op12_knn_quality,
    "op13_merkle_blocks": op13_merkle_blocks,
}

ORACLES: dict[str, str] = {
    "op9_exact_dedup": OP9_SQL,
    "op10_bloom_cascade": OP10_SQL,
    "op11_trie_audit": OP11_SQL,
    "op13_merkle_blocks": OP13_SQL,
}
