"""The registered queries of this subpackage: each applies one operator to its whole table.

``QUERIES`` and ``ORACLES`` are read by ``__spark_entry__``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import bpe, collocations, decontaminate, group_join, language_id, near_dedup, pii, prefix_trie, quality_mcd, quality_mil, secrets, suffix_dedup, toxicity
from quarry.llm.common import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_digest(table(spark, sf_dir, "documents"))


@query
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.round_trip(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), size=4)


@query
def op7_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_mil.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_mcd_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_mcd.judge(table(spark, sf_dir, "documents"))


@query
def op3_toxicity_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return language_id.identify(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op8_pii_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.private_digest(table(spark, sf_dir, "documents"))


@query
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeat_digest(table(spark, sf_dir, "documents"))


@query
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"), period=20)


# crc32 by its table, one byte at a time; turns of one number (none in the given tables) stand in the order of role and text here.
ORACLES["op11_conversation_trie"] = """
WITH crc AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]),
      lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
    FROM range(256) r(i))),
turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
    sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS key,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT x.*, conv_id - conv_id % 20 AS base,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda a, b: xor(a >> 8, t[xor(a, b) % 256 + 1])), 4294967295) % 4 AS h
  FROM (SELECT conv_id, count(*) AS n FROM turns GROUP BY conv_id) x, crc),
sized AS (
  SELECT c.*, least(c.h, coalesce(b.n, 0)) AS hb FROM convs c LEFT JOIN convs b ON b.conv_id = c.base),
rebuilt AS (
  SELECT s.conv_id, t.pos AS d, t.key, t.words FROM sized s JOIN turns t ON t.conv_id = s.base AND t.pos <= s.h
  UNION ALL
  SELECT s.conv_id, t.pos - s.h + s.hb, t.key, t.words FROM sized s JOIN turns t ON t.conv_id = s.conv_id AND t.pos > s.h
  UNION ALL
  SELECT conv_id, 0, '', 0 FROM sized),
paths AS (
  SELECT conv_id, d, words, string_agg(key, '/') OVER w AS path, string_agg(key, '/') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS above,
    d = max(d) OVER (PARTITION BY conv_id) AS is_end
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY d)),
nodes AS (
  SELECT path, any_value(above) AS above, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (is_end), '')) AS ends_sha256
  FROM paths GROUP BY path),
kids AS (SELECT above, count(*) AS n FROM nodes WHERE above IS NOT NULL GROUP BY above),
sums AS (
  SELECT p.path, sum((n.n_convs - 1) * n.words) AS saved, count(*) FILTER (k.n IS NULL) AS leaves
  FROM nodes n LEFT JOIN kids k ON k.above = n.path JOIN paths p ON p.conv_id = n.conv_id AND p.d <= n.depth
  GROUP BY p.path)
SELECT n.conv_id::BIGINT AS conv_id, n.depth::BIGINT AS depth, a.conv_id::BIGINT AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
  coalesce(k.n, 0)::BIGINT AS n_children, s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON s.path = n.path LEFT JOIN kids k ON k.above = n.path LEFT JOIN nodes a ON a.path = n.above
"""


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLES["op12_collocations"] = """
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents WHERE text IS NOT NULL),
pieces AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]'), lambda x: x <> '') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\n\x0B\x0C\r]')) AS piece FROM texts)),
f AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, range(1, 6) r(k))
  GROUP BY ALL HAVING count(*) >= 100),
n AS (SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY lang),
cuts AS (
  SELECT lang, k, phrase, f AS a, c, string_split(phrase, ' ') AS w
  FROM f, range(1, 5) r(c) WHERE c < k),
scored AS (
  SELECT u.lang, u.k, u.phrase, u.a, x.f AS l, y.f AS r, n.n, u.c,
    (1000::HUGEINT * u.a * n.n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts u JOIN n ON n.lang = u.lang
  JOIN f x ON x.lang = u.lang AND x.phrase = array_to_string(u.w[1 : u.c], ' ')
  JOIN f y ON y.lang = u.lang AND y.phrase = array_to_string(u.w[u.c + 1 : u.k], ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
kept AS (
  SELECT * FROM lowest s WHERE NOT EXISTS (
    SELECT 1 FROM f o WHERE o.lang = s.lang AND o.k > s.k AND 100 * o.f >= 100 * s.a
      AND contains(' ' || o.phrase || ' ', ' ' || s.phrase || ' '))),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""


@query
def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_join.jaccard_components(table(spark, sf_dir, "documents"))


ORACLES["op13_jaccard_join"] = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 90 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, e.b FROM reached r JOIN edges e ON e.a = r.b)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN (SELECT a, min(b) AS component_id FROM reached GROUP BY a) ON a = d.doc_id
"""
