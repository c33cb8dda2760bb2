"""Registered queries of the corpus operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import alignment, chat_threads, decontamination, exact_dedup, html_text, language_id, merkle, ngram_join, quality, sentencepiece_codec, toxicity, url_filter, warc
from .textops import table


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode_checked(table(spark, sf_dir, "documents"), sentencepiece_codec.default_model())


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op6_chat_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_threads.threads(table(spark, sf_dir, "conversations"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.digest(table(spark, sf_dir, "documents"), *alignment.default_paths())


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"), merkle.FIELDS)


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(table(spark, sf_dir, "pages"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (op1_sentencepiece, op2_ngram_jaccard, op3_decontamination, op4_quality, op5_html_text, op6_chat_threads, op7_language_id, op8_toxicity, op9_exact_dedup, op10_url_filter, op11_token_alignment, op12_merkle_manifest, op13_warc)
    return {f.__name__: f for f in ops}


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) >= 5 THEN list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')))
                      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS sh FROM w),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS t FROM s),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny, count(*) AS c FROM e a JOIN e b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p WHERE 100 * c >= 80 * (nx + ny - c)),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, m.component_id
FROM s JOIN (SELECT x, min(y) AS component_id FROM r GROUP BY x) m ON s.doc_id = m.x
"""

OP3_SQL = rf"""
WITH dw AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
bw AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
win AS (
  SELECT DISTINCT item_id, k, array_to_string(ws[i:i+k-1], ' ') AS t
  FROM (SELECT item_id, ws, least(13, len(ws)) AS k, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS i FROM bw WHERE len(ws) > 0)),
ks AS (SELECT DISTINCT k FROM win),
dwin AS (
  SELECT doc_id, k, i, array_to_string(ws[i:i+k-1], ' ') AS t
  FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM dw, ks WHERE len(ws) >= k)),
hit AS (SELECT DISTINCT doc_id, item_id, d.k, i FROM dwin d JOIN win w ON d.k = w.k AND d.t = w.t),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY 1),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY 1)
SELECT dw.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM dw LEFT JOIN n USING (doc_id) LEFT JOIN it USING (doc_id)
"""

OP9_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""


_PART = "coalesce(strlen({0}) || ':' || {0}, '-')"
_LEAF = "sha256(" + " || ".join(_PART.format(f"CAST({c} AS VARCHAR)") for c in ("doc_id", "source", "lang", "n_chars")) + " || {})"
_RUNS = "list_transform(range(1, len(nodes) + 1, 3), lambda i: sha256(array_to_string(nodes[i:i+2], '')))"
_SIDES = "array_to_string(nodes[i - i % 3 + 1:i], '') || '|' || array_to_string(nodes[i + 2:i - i % 3 + 3], '')"

OP12_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, {_LEAF.format(_PART.format("text"))} AS leaf, {_LEAF.format(_PART.format("replace(text, chr(10), '')"))} AS other,
         list_reduce(flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
                     lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END, CAST(4294967295 AS BIGINT)) & 1 = 1 AS chosen
  FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos FROM d),
t AS (SELECT source, 0 AS level, list(leaf ORDER BY doc_id) AS nodes FROM d GROUP BY source
      UNION ALL SELECT source, level + 1, {_RUNS} FROM t WHERE len(nodes) > 1),
tops AS (SELECT source, nodes[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos FROM t WHERE len(nodes) = 1),
u AS (SELECT 0 AS level, list(subroot ORDER BY pos) AS nodes FROM tops UNION ALL SELECT level + 1, {_RUNS} FROM u WHERE len(nodes) > 1),
w AS (
  SELECT doc_id, level, {_SIDES} AS way FROM (SELECT doc_id, level, nodes, CAST(floor(pos / pow(3, level)) AS BIGINT) AS i FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source WHERE len(nodes) > 1)
  UNION ALL
  SELECT doc_id, 1000 + level, {_SIDES} FROM (SELECT doc_id, level, nodes, CAST(floor(tops.pos / pow(3, level)) AS BIGINT) AS i FROM p JOIN tops ON p.source IS NOT DISTINCT FROM tops.source, u WHERE len(nodes) > 1)),
ways AS (SELECT doc_id, list(way ORDER BY level) AS way FROM w GROUP BY doc_id),
f AS (
  SELECT p.doc_id, leaf, subroot, (SELECT nodes[1] FROM u WHERE len(nodes) = 1) AS root, sha256(replace(array_to_string(coalesce(way, []), ''), '|', '')) AS proof_sha256,
         list_reduce(coalesce(way, []), lambda h, s: sha256(split_part(s, '|', 1) || h || split_part(s, '|', 2)), CASE WHEN chosen THEN other ELSE leaf END) AS folded_root
  FROM p JOIN tops ON p.source IS NOT DISTINCT FROM tops.source LEFT JOIN ways USING (doc_id))
SELECT *, folded_root = root AS verified FROM f
"""


OP13_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
m AS (SELECT *, strlen(h) AS n, max(page_id) OVER (PARTITION BY h) AS last FROM p)
SELECT page_id, n AS payload_bytes, sha1(h) AS payload_digest, CASE WHEN n >= {warc.LEAST_PAYLOAD} AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= {warc.LEAST_PAYLOAD} AND page_id < last THEN last END AS refers_to, true AS intact
FROM m
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_ngram_jaccard": OP2_SQL, "op3_decontamination": OP3_SQL, "op9_exact_dedup": OP9_SQL, "op12_merkle_manifest": OP12_SQL, "op13_warc": OP13_SQL}
