"""Queries of repeated passages, periodic runs and vector codes, with their check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from adflow.llm import periodic, substring_dedup, vector_codes
from adflow.llm.registry import query, table

_WORD = r"[^\x20\x09-\x0D]+"

OP11_SQL = rf"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(COALESCE(text, ''), '{_WORD}') AS w FROM documents),
g AS (
    SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
f AS (SELECT s, MIN(doc_id) AS m FROM g GROUP BY s HAVING MIN(doc_id) < MAX(doc_id)),
hit AS (
    SELECT doc_id, list(DISTINCT p) AS ps
    FROM (SELECT doc_id, unnest(range(i, i + 13)) AS p FROM g JOIN f USING (s) WHERE doc_id > m)
    GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, COALESCE(len(ps), 0) AS n_removed,
       sha256(array_to_string(CASE WHEN ps IS NULL THEN w ELSE list_transform(
           list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(ps, i)), lambda i: w[i])
           END, ' ')) AS kept_sha256
FROM d LEFT JOIN hit USING (doc_id)
"""


@query("op11_substring_dedup", OP11_SQL)
def op11_substring_dedup(spark, sf_dir):
    found = substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda total, s: total + s["words"])
    return found.select(
        "doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


OP12_SQL = rf"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(COALESCE(text, ''), '{_WORD}') AS w0,
           xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(
               string_split(CAST(doc_id AS VARCHAR), ''),
               lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]))),
               lambda a, s: CASE WHEN s >= 0 THEN xor(a, s)
                   WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS h
    FROM documents),
m AS (
    SELECT doc_id, w0, len(w0) AS n, h % 10 = 0 AND len(w0) > 0 AS chosen,
           CASE WHEN len(w0) > 0 THEN (h // 10) % len(w0) ELSE 0 END AS a, (h // 10) % 8 AS r
    FROM d),
v AS (
    SELECT doc_id, n, CASE WHEN chosen THEN list_transform(range(0, n), lambda i:
               w0[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + r)) END])
           ELSE w0 END AS w
    FROM m),
t AS (SELECT doc_id, n, unnest(range(0, n)) AS i, unnest(w) AS x FROM v),
same AS (
    SELECT a.doc_id, a.i, b.i - a.i AS q FROM t AS a JOIN t AS b
    ON a.doc_id = b.doc_id AND a.x = b.x AND b.i > a.i AND b.i - a.i <= a.n // 2),
islands AS (
    SELECT doc_id, q, MIN(i) AS start, COUNT(*) + q AS length
    FROM (SELECT doc_id, q, i, i - ROW_NUMBER() OVER (PARTITION BY doc_id, q ORDER BY i) AS k
          FROM same) GROUP BY doc_id, q, k HAVING COUNT(*) + q >= GREATEST(12, 2 * q)),
runs AS (SELECT doc_id, start, length, MIN(q) AS q FROM islands GROUP BY doc_id, start, length),
gone AS (
    SELECT doc_id, list(DISTINCT p) AS ps
    FROM (SELECT doc_id, unnest(range(start + q, start + length)) AS p FROM runs) GROUP BY doc_id),
per AS (
    SELECT doc_id, COUNT(*) AS n_runs, arg_min((start, length, q), (-length, start, q)) AS best,
           string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS text
    FROM runs GROUP BY doc_id)
SELECT v.doc_id, COALESCE(n_runs, 0) AS n_runs, CAST(best[1] AS BIGINT) AS start,
       CAST(best[2] AS BIGINT) AS length, CAST(best[3] AS BIGINT) AS period,
       CAST(1000 * best[2] // best[3] AS BIGINT) AS exponent_milli,
       sha256(COALESCE(per.text, '')) AS runs_sha256,
       sha256(array_to_string(CASE WHEN ps IS NULL THEN w ELSE list_transform(
           list_filter(range(0, n), lambda i: NOT list_contains(ps, i)), lambda i: w[i + 1])
           END, ' ')) AS collapsed_sha256
FROM v LEFT JOIN per USING (doc_id) LEFT JOIN gone USING (doc_id)
"""


def _made_periodic(docs):
    """The texts of a tenth of the documents, by crc32 of doc_id, periodic from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(_WORD), 0))
    cut = docs.select("doc_id", "text", g.alias("g"), words.alias("w")).withColumn("n", F.size("w"))
    a = F.pmod("g", "n").cast("int")
    period = (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    made = cut.withColumn("a", F.when(F.col("n") > 0, a)).withColumn("p", period)
    place = lambda i: F.when(i < F.col("a"), i).otherwise(
        F.col("a") + (i - F.col("a")) % F.col("p"))
    text = F.array_join(F.transform(
        F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.element_at("w", place(i) + 1)), " ")
    return made.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))


@query("op12_periodic_runs", OP12_SQL)
def op12_periodic_runs(spark, sf_dir):
    found = periodic.periodic_runs(_made_periodic(table(spark, sf_dir, "documents")))
    order = F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("q")))
    best = F.array_min(order)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(
        ",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.s").alias("start"),
        (-F.col("best.l")).alias("length"), F.col("best.q").alias("period"),
        F.floor(-1000 * F.col("best.l") / F.col("best.q")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def _nearest(book: str) -> str:
    """Every part with the index and distance of its nearest entry."""
    return f"""
    SELECT vec_id, label, p, v, best[2] AS e, best[1] AS far FROM (
        SELECT vec_id, label, p, v, MIN([far, e]) AS best FROM (
            SELECT vec_id, label, x.p, v, e, list_sum(list_transform(
                range(1, len(v) + 1), lambda j: (v[j] - c[j]) * (v[j] - c[j])))::BIGINT AS far
            FROM parts AS x JOIN {book} AS b ON b.p = x.p) GROUP BY ALL)"""


def _moved(book: str, assigned: str) -> str:
    return f"""
    SELECT b.p, b.e, COALESCE(mean, c) AS c FROM {book} AS b LEFT JOIN (
        SELECT p, e, list(mean ORDER BY j) AS mean FROM (
            SELECT p, e, j, floor(SUM(v[j]) / COUNT(*))::BIGINT AS mean
            FROM (SELECT p, e, v, unnest(range(1, len(v) + 1)) AS j FROM {assigned}) GROUP BY p, e, j)
        GROUP BY p, e) AS m ON m.p = b.p AND m.e = b.e"""


OP13_SQL = f"""
WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x)::BIGINT) AS v,
           len(embedding) // 16 AS k
    FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (
    SELECT vec_id, label, p, v[p * k + 1:p * k + k] AS v
    FROM (SELECT *, unnest(range(16)) AS p FROM kept)),
book0 AS (
    SELECT p, ROW_NUMBER() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, v AS c FROM parts
    QUALIFY e < 64),
near0 AS ({_nearest("book0")}),
book1 AS ({_moved("book0", "near0")}),
near1 AS ({_nearest("book1")}),
book2 AS ({_moved("book1", "near1")}),
near2 AS ({_nearest("book2")}),
own AS (
    SELECT vec_id, label, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code,
           SUM(far)::BIGINT AS error
    FROM near2 GROUP BY vec_id, label)
SELECT vec_id, code, error, (SUM(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM book2)
       AS codebooks_sha256
FROM own
"""


@query("op13_vector_codes", OP13_SQL)
def op13_vector_codes(spark, sf_dir):
    return vector_codes.compress(table(spark, sf_dir, "embeddings")).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", "codebooks_sha256")
