"""One query for each operator, with production parameters, over its whole table.

Each query takes its rows from its operator and derives the digest columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.llm import collocations, decontaminate, language_id, line_dedup, ngram_jaccard, packing, prefix_trie, quality_lm, robust_rules, secret_scan, simhash, token_files, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fold(n: int) -> Column:
    """crc32 of the id as text, modulo ``n``."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def language_model(documents: DataFrame) -> dict | None:
    """Language classifiers learned from the rows outside the held-out fold."""
    return language_id.train(documents, _fold(3) != 1)


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.jaccard_classes(_table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held = F.coalesce(_fold(3) == 1, F.lit(False)).alias("held_out")
    return language_id.identify(docs, language_model(docs)).select("doc_id", held, "lang_pred", "score", "ambiguous")


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


def op4_quality_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_lm.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.crc32("text").alias("text_crc32"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_scan.scan(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "start", "length", F.sha2("value", 256).alias("value_sha256"), "score", "is_secret")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return robust_rules.quality_rules(_table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, places = packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return places.withColumnRenamed("crc", "ids_crc32")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"), _fold(5) != 0)
    held = F.coalesce(_fold(5) == 0, F.lit(False)).alias("held_out")
    return toxicity.score_documents(docs, model).select("doc_id", held, "score", "predicted")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.simhash_classes(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = prefix_trie.turns(_table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(prefix_trie.grafted(told))


QUERIES = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_language_id": op2_language_id,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_quality_lm": op4_quality_lm,
    "op5_line_dedup": op5_line_dedup,
    "op6_secret_scan": op6_secret_scan,
    "op7_quality_rules": op7_quality_rules,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_toxicity": op9_toxicity,
    "op10_token_files": op10_token_files,
    "op11_simhash_near_dedup": op11_simhash_near_dedup,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_prefix_trie": op13_prefix_trie,
}

#: Contract of op1 in SQL: shingle sets as text, intersections by a join of equal shingles, components by a recursive union.
_OP1_SQL = """
WITH RECURSIVE low AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
doc AS (
  SELECT rid, doc_id, list_sort(list_distinct(CASE
    WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s FROM low),
same AS (SELECT min(doc_id) AS rep, s, len(s) AS n FROM doc WHERE len(s) > 0 GROUP BY s),
tok AS (SELECT rep, n, unnest(s) AS t FROM same),
link AS (
  SELECT a.rep AS x, b.rep AS y FROM tok a JOIN tok b ON a.t = b.t AND a.rep < b.rep
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
step AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach(rep, root) AS (SELECT rep, rep FROM same UNION SELECT step.y, reach.root FROM reach JOIN step ON step.x = reach.rep),
comp AS (SELECT rep, min(root) AS root FROM reach GROUP BY rep)
SELECT doc.doc_id, CAST(len(doc.s) AS BIGINT) AS n_shingles, coalesce(comp.root, doc.doc_id) AS component_id
FROM doc LEFT JOIN same ON same.s = doc.s LEFT JOIN comp ON comp.rep = same.rep
"""

#: Contract of op3 in SQL: every window of every item, looked up in every document.
_OP3_SQL = """
WITH low AS (
  SELECT doc_id, text, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w FROM documents),
doc AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(w, []) AS w FROM low),
item AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS m, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS k
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
pos AS (
  SELECT rid, i, m, array_to_string(w[i:i + m - 1], ' ') AS k
  FROM (SELECT rid, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM doc, (SELECT DISTINCT m FROM win) WHERE len(w) >= m)),
occ AS (SELECT pos.rid, pos.i, pos.m, win.item_id FROM pos JOIN win ON pos.k = win.k AND pos.m = win.m),
hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT rid, i, m FROM occ)) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS s FROM occ) GROUP BY rid)
SELECT doc.doc_id, CAST(len(doc.w) AS BIGINT) AS n_words, coalesce(hit.n_hit, 0) AS n_hit, coalesce(its.n_items, 0) AS n_items,
       sha256(coalesce(its.ids, '')) AS items_sha256,
       coalesce(hit.n_hit, 0) > 0 AND 20 * coalesce(hit.n_hit, 0) >= len(doc.w) AS contaminated
FROM doc LEFT JOIN hit ON doc.rid = hit.rid LEFT JOIN its ON doc.rid = its.rid
"""

#: Contract of op12 in SQL: every phrase of every piece, counted as text.
_OP12_SQL = """
WITH piece AS (
  SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents)),
pos AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM piece WHERE len(w) > 0),
gram AS (
  SELECT lang, 1 AS m, w[i] AS k FROM pos
  UNION ALL SELECT lang, 2, array_to_string(w[i:i + 1], ' ') FROM pos WHERE i + 1 <= len(w)
  UNION ALL SELECT lang, 3, array_to_string(w[i:i + 2], ' ') FROM pos WHERE i + 2 <= len(w)),
f AS (SELECT lang, m, k, count(*) AS c FROM gram GROUP BY lang, m, k),
total AS (SELECT lang, CAST(sum(c) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
cand AS (SELECT lang, m, k, c AS a, string_split(k, ' ') AS w FROM f WHERE m > 1 AND c >= 10),
cut AS (SELECT lang, m, k, a, i, array_to_string(w[1:i], ' ') AS kl, array_to_string(w[i + 1:m], ' ') AS kr
        FROM (SELECT cand.*, unnest(range(1, m)) AS i FROM cand)),
scored AS (
  SELECT cut.lang, cut.m, cut.k, cut.a, cut.i, x.c AS l, y.c AS r,
         (1000000::HUGEINT * cut.a::HUGEINT * cut.a::HUGEINT) // (x.c::HUGEINT * y.c::HUGEINT) AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.k = cut.kl JOIN f y ON y.lang = cut.lang AND y.k = cut.kr),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, k ORDER BY score, i) AS o FROM scored) WHERE o = 1),
inner_of AS (
  SELECT lang, k2, max(a) AS longer FROM (
    SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS k2 FROM cand WHERE m = 3) GROUP BY lang, k2),
kept AS (
  SELECT best.* FROM best LEFT JOIN inner_of ON best.m = 2 AND inner_of.lang = best.lang AND inner_of.k2 = best.k
  WHERE inner_of.longer IS NULL OR 100 * inner_of.longer < 50 * best.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, k) AS rank FROM kept)
SELECT ranked.lang, ranked.rank, ranked.k AS phrase, ranked.a, ranked.l, ranked.r, total.n, CAST(ranked.score AS BIGINT) AS score
FROM ranked JOIN total ON total.lang = ranked.lang WHERE ranked.rank <= 2000
"""

#: Contract of op13 in SQL: every prefix of every rebuilt conversation, sums over subtrees by the prefixes of a member.
_OP13_SQL = """
WITH RECURSIVE tab(b, k, v) AS (
  SELECT b, 0, b FROM range(256) t(b)
  UNION ALL SELECT b, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM tab WHERE k < 8),
crc(conv_id, s, i, c) AS (
  SELECT conv_id, CAST(conv_id AS VARCHAR), 0, 4294967295 FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)
  UNION ALL SELECT conv_id, s, i + 1, xor(c >> 8, tab.v) FROM crc JOIN tab ON tab.k = 8 AND tab.b = xor(c & 255, CAST(ascii(s[i + 1]) AS BIGINT)) WHERE i < len(s)),
conv AS (SELECT conv_id, xor(c, 4294967295) % 6 AS h, conv_id - conv_id % 100 AS base FROM crc WHERE i = len(s)),
own AS (
  SELECT conv_id, role, text, len(text) AS chars, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, t) AS i
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
               sha256(len(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS t FROM conversations WHERE conv_id IS NOT NULL)),
part AS (
  SELECT conv.conv_id, 0 AS late, own.i, own.role, own.text, own.chars FROM conv JOIN own ON own.conv_id = conv.base AND own.i <= conv.h
  UNION ALL SELECT conv.conv_id, 1, own.i, own.role, own.text, own.chars FROM conv JOIN own ON own.conv_id = conv.conv_id AND own.i > conv.h),
seq AS (SELECT conv_id, chars, sha256(len(role) || ':' || role || text) AS t, row_number() OVER (PARTITION BY conv_id ORDER BY late, i) AS d FROM part),
m AS (
  SELECT conv_id, d, chars, string_agg(t, '') OVER (PARTITION BY conv_id ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p FROM seq
  UNION ALL SELECT conv_id, 0, 0, '' FROM conv),
size AS (SELECT conv_id, max(d) AS n FROM m GROUP BY conv_id),
node AS (
  SELECT m.d, m.p, min(m.conv_id) AS conv_id, count(*) AS n_convs, max(m.chars) AS chars,
         string_agg(CAST(m.conv_id AS VARCHAR), ',' ORDER BY m.conv_id) FILTER (WHERE size.n = m.d) AS ends
  FROM m JOIN size ON size.conv_id = m.conv_id GROUP BY m.d, m.p),
child AS (SELECT d - 1 AS d, p[1:64 * (d - 1)] AS p, count(*) AS n FROM node WHERE d > 0 GROUP BY 1, 2),
sums AS (
  SELECT up.d, up.p, count(*) FILTER (WHERE child.n IS NULL) AS n_leaves, sum((node.n_convs - 1) * node.chars) AS saved
  FROM node JOIN m up ON up.conv_id = node.conv_id AND up.d <= node.d LEFT JOIN child ON child.d = node.d AND child.p = node.p GROUP BY up.d, up.p)
SELECT node.conv_id, CAST(node.d AS BIGINT) AS depth, parent.conv_id AS parent_conv_id, node.n_convs, coalesce(child.n, 0) AS n_children,
       sums.n_leaves, CAST(sums.saved AS BIGINT) AS saved_tokens, sha256(coalesce(node.ends, '')) AS ends_sha256
FROM node JOIN sums ON sums.d = node.d AND sums.p = node.p
LEFT JOIN child ON child.d = node.d AND child.p = node.p
LEFT JOIN node parent ON parent.d = node.d - 1 AND parent.p = node.p[1:64 * (node.d - 1)] AND node.d > 0
"""

ORACLE_SQL = {"op1_ngram_jaccard_join": _OP1_SQL, "op3_benchmark_decontamination": _OP3_SQL, "op12_phrase_collocations": _OP12_SQL, "op13_prefix_trie": _OP13_SQL}
