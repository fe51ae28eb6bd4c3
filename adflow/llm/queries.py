"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from adflow.llm import (
    decontaminate,
    host_rules,
    html_text,
    language,
    language_model,
    licenses,
    ngram_join,
    notices,
    packing,
    quality,
    repeat_queries,  # noqa: F401  registers its queries
    toxicity,
)
from adflow.llm.registry import ORACLES, QUERIES, query, table

__all__ = ["ORACLES", "QUERIES"]

OP1_SQL = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(
        translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents),
s AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, GREATEST(len(w) - 4, 1) + 1)) AS i
          FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY doc_id),
o AS (
    SELECT a.doc_id AS x, b.doc_id AS y, COUNT(*) AS o
    FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
    SELECT x, y FROM o JOIN n AS p ON p.doc_id = x JOIN n AS q ON q.doc_id = y
    WHERE 100 * o >= 75 * (p.n + q.n - o)),
reach AS (
    SELECT doc_id AS v, doc_id AS c FROM d
    UNION
    SELECT l.y, r.c FROM reach AS r JOIN links AS l ON l.x = r.v)
SELECT d.doc_id, COALESCE(n.n, 0) AS n_shingles, MIN(c) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN reach ON v = d.doc_id GROUP BY d.doc_id, n.n
"""


@query("op1_ngram_join", OP1_SQL)
def op1_ngram_join(spark, sf_dir):
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


@query("op2_language")
def op2_language(spark, sf_dir):
    return language.languages(table(spark, sf_dir, "documents"))


@query("op3_toxicity")
def op3_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op4_pattern_packing")
def op4_pattern_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op5_quality")
def op5_quality(spark, sf_dir):
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_main_text")
def op7_main_text(spark, sf_dir):
    return html_text.page_texts(table(spark, sf_dir, "pages"))


@query("op6_language_model")
def op6_language_model(spark, sf_dir):
    return language_model.score(table(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH d AS (
    SELECT doc_id, source, COALESCE(text, '') AS t,
           regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
lines AS (
    SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
dups AS (
    SELECT doc_id, COUNT(*) AS n_lines, COUNT(*) - COUNT(DISTINCT line) AS n_dup_lines
    FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
tri AS (
    SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
twice AS (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS p
    FROM (SELECT doc_id, i, COUNT(*) OVER (PARTITION BY doc_id, g) AS n FROM tri) WHERE n > 1),
reps AS (SELECT doc_id, COUNT(DISTINCT p) AS n_repeat_words FROM twice GROUP BY doc_id),
m AS (
    SELECT d.doc_id, source, len(w) AS n_words,
           length(array_to_string(w, '')) AS word_chars,
           length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           COALESCE(n_dup_lines, 0) AS n_dup_lines, COALESCE(n_lines, 0) AS n_lines,
           COALESCE(n_repeat_words, 0) AS n_repeat_words
    FROM d LEFT JOIN dups USING (doc_id) LEFT JOIN reps USING (doc_id)),
j AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           n_words < 50 OR 100 * n_repeat_words > 50 * n_words
           OR 100 * n_symbols > 10 * word_chars OR 100 * n_dup_lines > 30 * n_lines AS failed
    FROM m),
hosts AS (
    SELECT source, COUNT(*) AS n, SUM(CASE WHEN failed THEN 1 ELSE 0 END) AS f
    FROM j WHERE source IS NOT NULL GROUP BY source),
prior AS (
    SELECT m * s AS a, (1 - m) * s AS b
    FROM (SELECT m, CASE WHEN v > 0 AND v < m * (1 - m) THEN m * (1 - m) / v - 1 ELSE 1 END AS s
          FROM (SELECT AVG(f / n) AS m, VAR_SAMP(f / n) AS v FROM hosts)))
SELECT j.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT COALESCE((f + a) / (n + a + b) > 0.5, FALSE) AS kept
FROM j LEFT JOIN hosts USING (source) CROSS JOIN prior
"""


@query("op8_host_rules", OP8_SQL)
def op8_host_rules(spark, sf_dir):
    return host_rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


_WORD9 = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_PATH9 = """CASE WHEN doc_id % 1000 = 0 THEN 'd' || (doc_id // 1000) || '/LICENSE'
  WHEN doc_id % 50 = 0 THEN 'd' || (doc_id // 1000) || '/d' || (doc_id // 50) || '/LICENSE'
  ELSE 'd' || (doc_id // 1000) || '/d' || (doc_id // 50) || '/' || doc_id || '.txt' END"""
_LOWER9 = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# The words that the other templates have, besides those written out in the SQL.
_OTHER9 = " ".join(sorted({w for _, t in notices.notices() for w in re.findall(_WORD9, t.lower())}))
OP9_SQL = f"""
WITH templates(k, name, t) AS (VALUES {", ".join(
    f"({k}, '{name}', '{text}')" for k, (name, text) in enumerate(licenses.TEMPLATES))}),
tw AS (SELECT DISTINCT k, unnest(regexp_extract_all({_LOWER9.format("t")}, '{_WORD9}')) AS w FROM templates),
other AS (SELECT unnest(regexp_extract_all('{_OTHER9}', '{_WORD9}')) AS w),
files AS (SELECT doc_id, {_PATH9} AS path, COALESCE(text, '') AS t FROM documents),
passages AS (
    SELECT doc_id, unnest(range(len(string_split(t, chr(10))))) AS part, unnest(string_split(t, chr(10))) AS line FROM files
    UNION ALL SELECT doc_id, -1, t FROM files WHERE path LIKE '%/LICENSE'),
tokens AS (SELECT DISTINCT doc_id, part, unnest(regexp_extract_all({_LOWER9.format("line")}, '{_WORD9}')) AS w FROM passages),
size AS (SELECT COUNT(*) AS n FROM files),
idf AS (
    SELECT w, ln((1 + n) / (1 + COALESCE(d, 0))) + 1 AS x FROM (SELECT w FROM tw UNION SELECT w FROM other)
    LEFT JOIN (SELECT w, COUNT(DISTINCT doc_id) AS d FROM tokens GROUP BY w) USING (w), size),
norms AS (
    SELECT doc_id, part, sqrt(SUM(COALESCE(x, ln(1 + n) + 1) ** 2)) AS norm
    FROM tokens LEFT JOIN idf USING (w), size GROUP BY doc_id, part),
lengths AS (SELECT k, sqrt(SUM(x * x)) AS length FROM tw JOIN idf USING (w) GROUP BY k),
cosines AS (
    SELECT doc_id, k, round(MAX(dot / (norm * length)), 9) AS cosine
    FROM (SELECT doc_id, part, k, SUM(x * x) AS dot FROM tokens JOIN tw USING (w) JOIN idf USING (w) GROUP BY ALL)
    JOIN norms USING (doc_id, part) JOIN lengths USING (k) GROUP BY doc_id, k),
best AS (SELECT doc_id, MAX(cosine) AS cosine, arg_min(k, (-cosine, k)) AS k FROM cosines GROUP BY doc_id),
found AS (
    SELECT doc_id, path, regexp_replace(path, '/[^/]*$', '') AS folder, COALESCE(cosine, 0) AS cosine,
           CASE WHEN cosine >= 0.7 THEN name END AS license
    FROM files LEFT JOIN best USING (doc_id) LEFT JOIN templates USING (k)),
rules AS (SELECT folder, license, path FROM found WHERE license IS NOT NULL AND path LIKE '%/LICENSE')
SELECT doc_id, f.path, COALESCE(f.license, low.license, top.license) AS license, round(f.cosine, 6) AS cosine,
       CASE WHEN f.license IS NOT NULL THEN 'own' WHEN low.path IS NOT NULL OR top.path IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       CASE WHEN f.license IS NOT NULL THEN f.path ELSE COALESCE(low.path, top.path) END AS origin_path
FROM found AS f LEFT JOIN rules AS low ON low.folder = f.folder
LEFT JOIN rules AS top ON top.folder = split_part(f.folder, '/', 1)
"""


@query("op9_licenses", OP9_SQL)
def op9_licenses(spark, sf_dir):
    """Documents as files of a tree: d<id / 1000>/d<id / 50>/<id>.txt. The first of every
    1000 and of every 50 is the LICENSE file of its folder."""
    number = F.col("doc_id")
    top, low = (F.concat(F.lit("d"), F.floor(number / n).cast("string")) for n in (1000, 50))
    path = F.when(number % 1000 == 0, F.concat(top, F.lit("/LICENSE"))).when(
        number % 50 == 0, F.concat_ws("/", top, low, F.lit("LICENSE"))).otherwise(
        F.concat(F.concat_ws("/", top, low, number.cast("string")), F.lit(".txt")))
    docs = table(spark, sf_dir, "documents").select("doc_id", path.alias("path"), "text")
    # Nine digits first, as ties between templates are decided on them.
    return licenses.licenses(docs, key="doc_id").withColumn("cosine", F.round(F.round("cosine", 9), 6))


_LOWERED = ("translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
            "'abcdefghijklmnopqrstuvwxyz')")
OP10_SQL = rf"""
WITH d AS (
    SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents),
b AS (
    SELECT CAST(item_id AS VARCHAR) AS item,
           regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark),
bw AS (
    SELECT item, LEAST(len(w), 10) AS k, unnest(range(1, GREATEST(len(w) - 10, 0) + 2)) AS i, w
    FROM b WHERE len(w) > 0),
phrases AS (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS p FROM bw),
dw AS (
    SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS p
    FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
          FROM d, (SELECT DISTINCT k FROM phrases) WHERE len(w) >= k)),
found AS (SELECT doc_id, i, dw.k, item FROM dw JOIN phrases USING (k, p)),
words AS (
    SELECT doc_id, COUNT(DISTINCT pos) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + k)) AS pos FROM found) GROUP BY doc_id),
items AS (
    SELECT doc_id, COUNT(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
    FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items,
       sha256(COALESCE(list, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op10_decontaminate", OP10_SQL)
def op10_decontaminate(spark, sf_dir):
    return decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
