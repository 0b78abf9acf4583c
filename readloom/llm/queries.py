"""The queries opN_<name>: each operator over its whole table, with production parameters; SQL where it can say the same."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import cotraining, importance, license_scan, line_dedup, link_graph, lm_scoring, minhash, nn_descent, packing, positional_index, simhash, substring_dedup, token_links


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_document_fingerprints(spark, sf_dir):
    return minhash.compared_with_next(_table(spark, sf_dir, "documents"))


def op2_license_scans(spark, sf_dir):
    found = license_scan.scan(_table(spark, sf_dir, "documents"))
    words = F.transform("places", lambda p: p["word"])
    base = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    return found.select("doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(words).alias("first_word"), F.array_max(words).alias("last_word"), F.array_join(base, ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")


def op3_packing(spark, sf_dir):
    return packing.pack(_table(spark, sf_dir, "documents"))


def op4_benchmark_decontamination(spark, sf_dir):
    found = positional_index.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated", F.size("near").cast("long").alias("n_near"))


def op5_quality_classifier(spark, sf_dir):
    return cotraining.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_url_filters(spark, sf_dir):
    return link_graph.judged(_table(spark, sf_dir, "pages"))


def op7_line_dedup(spark, sf_dir):
    found = line_dedup.remove_shared_lines(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op8_substring_dedup(spark, sf_dir):
    out = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_lm_scoring(spark, sf_dir):
    return lm_scoring.score(_table(spark, sf_dir, "documents"))


def op10_simhash_near_dedup(spark, sf_dir):
    found = simhash.near_groups(simhash.fingerprints(_table(spark, sf_dir, "documents")))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op11_target_resampling(spark, sf_dir):
    return importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_embedding_near_dedup(spark, sf_dir):
    return nn_descent.near_groups(_table(spark, sf_dir, "embeddings"))


def op13_tokenizer_alignment(spark, sf_dir):
    return token_links.align(_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_document_fingerprints,
        op2_license_scans,
        op3_packing,
        op4_benchmark_decontamination,
        op5_quality_classifier,
        op6_url_filters,
        op7_line_dedup,
        op8_substring_dedup,
        op9_lm_scoring,
        op10_simhash_near_dedup,
        op11_target_resampling,
        op12_embedding_near_dedup,
        op13_tokenizer_alignment,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

# CRC-32 of the UTF-8 bytes of f, byte by byte through the table of its polynomial
_CRC_TABLE = "list_transform(range(256), lambda b: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b))"
_BYTES = "list_transform(range(1, octet_length(encode(f)) + 1), lambda i: CAST('0x' || substr(hex(encode(f)), 2 * i - 1, 2) AS BIGINT))"

_PHRASES = ", ".join(f"('{t.label}', '{t.text}', {len(t.text.split())})" for t in license_scan.BASE)
_PLAIN = [re.findall("[0-9a-z]+", t.text.lower()) for t in license_scan.TEMPLATES]
_TEMPLATES = ", ".join(f"('{t.label}', '{' '.join(w)}', {t.threshold}, {license_scan.block_length(len(w))}, '{t.telling}')" for t, w in zip(license_scan.TEMPLATES, _PLAIN, strict=True))

ORACLE_SQL = {
    "op2_license_scans": rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
p(label, phrase, n) AS (VALUES {_PHRASES}),
t AS (SELECT label, list_distinct(string_split(phrase, ' ')) AS own, CASE WHEN telling = '' THEN [] ELSE string_split(telling, ' ') END AS telling, least, n_block FROM (VALUES {_TEMPLATES}) v(label, phrase, least, n_block, telling)),
z AS (SELECT DISTINCT n_block FROM t),
x AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
f AS (SELECT doc_id, label, i - 1 AS word FROM x JOIN p ON array_to_string(w[i:i + n - 1], ' ') = phrase),
b AS (
  SELECT doc_id, n_block, list_distinct(w[i + 1:i + n_block]) AS block
  FROM (SELECT doc_id, n_block, w, unnest(range(0, len(w), n_block // 2)) AS i FROM d, z) WHERE i = 0 OR len(w) > i + n_block // 2
),
m AS (SELECT doc_id, label, len(list_intersect(own, block)) AS k, len(own) AS n FROM b JOIN t ON b.n_block = t.n_block WHERE len(list_intersect(own, block)) >= least * len(own) - 1e-9 AND len(list_intersect(telling, block)) = len(telling)),
s AS (
  SELECT doc_id, max(c) AS score, array_to_string(list_sort(list_distinct(list(label))), ',') AS labels
  FROM (SELECT doc_id, label, CAST(k AS DOUBLE) / n AS c FROM m UNION ALL SELECT doc_id, label, 1.0 FROM f) GROUP BY doc_id
),
g AS (SELECT doc_id, count(*) AS n_base, min(word) AS first_word, max(word) AS last_word, array_to_string(list_sort(list_distinct(list(label))), ',') AS base_labels FROM f GROUP BY doc_id)
SELECT d.doc_id AS doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN s ON d.doc_id = s.doc_id LEFT JOIN g ON d.doc_id = g.doc_id""",
    "op4_benchmark_decontamination": rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
x AS (SELECT doc_id, p, w[p] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d)),
c AS (SELECT word, count(*) AS n_all FROM x GROUP BY word),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT item, w, least(13, len(w)) AS n, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes)
),
m AS (SELECT doc_id, i, dw.n AS n, item FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
p AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item) AS n_items, array_to_string(list_sort(list_distinct(list(item) FILTER (item IS NOT NULL))), ',') AS items FROM m GROUP BY doc_id),
o AS (SELECT g, n, j, string_split(g, ' ')[j] AS word FROM (SELECT g, n, unnest(range(1, n + 1)) AS j FROM (SELECT DISTINCT g, n FROM bw))),
r AS (SELECT g, n, arg_min(o.word, n_all * 100 + j) AS rarest, arg_min(j, n_all * 100 + j) AS anchor FROM o JOIN c ON o.word = c.word GROUP BY g, n HAVING count(*) = n),
a AS (SELECT g, n, doc_id, p - anchor AS start FROM r JOIN x ON rarest = word),
e AS (
  SELECT a.doc_id AS doc_id, a.g AS g FROM a JOIN o ON a.g = o.g JOIN x ON a.doc_id = x.doc_id AND o.word = x.word AND x.p BETWEEN start + j - {positional_index.SLOP} AND start + j + {positional_index.SLOP}
  GROUP BY a.doc_id, a.g, a.n, start HAVING count(DISTINCT j) = a.n
),
q AS (SELECT doc_id, count(DISTINCT item) AS n_near FROM e JOIN bw ON e.g = bw.g GROUP BY doc_id)
SELECT d.doc_id AS doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near
FROM d LEFT JOIN p ON d.doc_id = p.doc_id LEFT JOIN t ON d.doc_id = t.doc_id LEFT JOIN q ON d.doc_id = q.doc_id""",
    "op7_line_dedup": """
WITH d AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS l FROM documents),
x AS (SELECT doc_id, source, i, l[i] AS line FROM (SELECT doc_id, source, l, unnest(range(1, len(l) + 1)) AS i FROM d)),
s AS (SELECT line, min(doc_id) AS keeper FROM x WHERE trim(line) <> '' GROUP BY line HAVING count(DISTINCT source) >= 10),
k AS (
  SELECT doc_id, count(*) AS n_left, string_agg(line, chr(10) ORDER BY i) AS kept
  FROM (SELECT x.* FROM x LEFT JOIN s ON x.line = s.line WHERE s.line IS NULL OR x.doc_id = s.keeper) GROUP BY doc_id
)
SELECT d.doc_id AS doc_id, CAST(coalesce(len(l), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(l), 0) - coalesce(n_left, 0) AS BIGINT) AS n_removed,
  CASE WHEN text IS NULL THEN NULL ELSE sha256(coalesce(kept, '')) END AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id""",
    "op8_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d)),
m AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY s) AS n FROM g) WHERE n > 1),
h AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 35)) AS p FROM m)),
x AS (SELECT doc_id, p, w[p] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d)),
k AS (SELECT x.doc_id AS doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY x.p) AS kept FROM x LEFT JOIN h ON x.doc_id = h.doc_id AND x.p = h.p WHERE h.p IS NULL GROUP BY x.doc_id)
SELECT d.doc_id AS doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id""",
    "op11_target_resampling": rf"""
WITH crc AS (SELECT {_CRC_TABLE} AS z),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT {_WORDS} AS w FROM benchmark),
n AS (SELECT unnest([1, 2, 3]) AS n),
df AS (SELECT doc_id, array_to_string(w[i:i + n - 1], ' ') AS f FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, n)),
bf AS (SELECT array_to_string(w[i:i + n - 1], ' ') AS f FROM (SELECT w, n, unnest(range(1, len(w) - n + 2)) AS i FROM b, n)),
h AS (SELECT f, xor(list_reduce({_BYTES}, lambda c, x: xor(c >> 8, z[xor(c, x) % 256 + 1]), 4294967295), 4294967295) % 10000 AS k FROM (SELECT f FROM df UNION SELECT f FROM bf), crc),
s AS (SELECT k, count(*) AS n FROM df JOIN h ON df.f = h.f GROUP BY k),
t AS (SELECT k, count(*) AS n FROM bf JOIN h ON bf.f = h.f GROUP BY k),
g AS (
  SELECT r.k AS k, CAST(floor(1000 * ln(CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * CAST((SELECT count(*) FROM df) + 10000 AS DOUBLE) / (CAST(coalesce(s.n, 0) + 1 AS DOUBLE) * CAST((SELECT count(*) FROM bf) + 10000 AS DOUBLE)))) AS BIGINT) AS gain
  FROM (SELECT unnest(range(10000)) AS k) r LEFT JOIN s ON r.k = s.k LEFT JOIN t ON r.k = t.k
),
x AS (SELECT doc_id, count(*) AS n_features, sum(gain) AS weight FROM df JOIN h ON df.f = h.f JOIN g ON h.k = g.k GROUP BY doc_id),
y AS (
  SELECT d.doc_id AS doc_id, len(w) AS n_words, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) AS BIGINT) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || d.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM d LEFT JOIN x ON d.doc_id = x.doc_id
),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM y WHERE n_words >= 20)
SELECT y.doc_id AS doc_id, n_features, weight, score, CASE WHEN rank <= 5 * n // 100 THEN rank END AS rank FROM y LEFT JOIN r ON y.doc_id = r.doc_id""",
    "op12_embedding_near_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a AS a, l.b AS b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, coalesce(component_id, vec_id) AS component_id, vec_id = coalesce(component_id, vec_id) AS kept
FROM embeddings LEFT JOIN c ON vec_id = c.a LEFT JOIN n ON vec_id = n.a""",
}
