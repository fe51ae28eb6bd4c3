"""Quality rules judged per host.

Every text is measured (whole, in numpy over Arrow batches); a host's share of failing
documents is shrunk towards an empirical beta prior over all hosts, and hosts whose
shrunk share is too high are rejected with all their documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adflow.llm.stage import staged, unwrapped, wrapped
from adflow.llm.text import BLANK, CONTINUATION, NEWLINE, Texts, mix, slices, windows

MIN_WORDS = 50
MAX_REPEAT_PCT = 50
MAX_SYMBOL_PCT = 10
MAX_DUP_LINES_PCT = 30
HOST_LIMIT = 0.5
HOST_SALTS = 32

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words")
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))


def _lines(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and how many of them equal an earlier line, per text."""
    lines = texts.words(NEWLINE)
    word = np.concatenate([[0], np.cumsum(~BLANK[texts.data], dtype=np.int64)])
    full = word[lines.end] > word[lines.start]
    rows, hashes = lines.rows()[full], lines.hashes()[full]
    n = len(texts.at) - 1
    keys = np.unique(mix(hashes + rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)),
                     return_index=True)[1]
    count = np.bincount(rows, minlength=n)
    return count, count - np.bincount(rows[keys], minlength=n)


def _repeated(hashes: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Words inside a three-word window that its text has twice or more, per text."""
    at, keys = windows(hashes, rows, 3)
    keys = mix(keys + rows[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    hit = np.zeros(len(hashes), bool)
    for k in range(3):
        hit[at[twice] + k] = True
    return np.bincount(rows[hit], minlength=n)


def measure(column: pa.Array) -> dict[str, np.ndarray]:
    """The measures of each text; a null text has none of anything."""
    texts = Texts.of(column)
    words = texts.words()
    rows, n = words.rows(), len(column)
    lines, dups = _lines(texts)
    return {
        "n_words": words.counts,
        "word_chars": texts.sums(~BLANK[texts.data] & ~CONTINUATION[texts.data]),
        "n_symbols": texts.sums(_SYMBOL[texts.data]),
        "n_dup_lines": dups,
        "n_lines": lines,
        "n_repeat_words": _repeated(words.hashes(), rows, n),
    }


def measures(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns and the measures of ``text`` under ``MEASURES`` names."""
    picked = docs.select(*keep) if text in keep else docs.select(*keep, text)

    def run(batches):
        for batch in slices(batches, text):
            own = measure(batch.column(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in keep]
                + [pa.array(own[m].astype(np.int64)) for m in MEASURES],
                names=[*keep, *MEASURES])

    types = dict(picked.dtypes)
    schema = ", ".join([f"`{k}` {types[k]}" for k in keep] + [f"{m} bigint" for m in MEASURES])
    return picked.mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))


def rule_failed() -> Column:
    """Any rule: the base rules, too many symbols, too many repeated lines."""
    return base_failed() | (
        100 * F.col("n_symbols") > MAX_SYMBOL_PCT * F.col("word_chars")
    ) | (100 * F.col("n_dup_lines") > MAX_DUP_LINES_PCT * F.col("n_lines"))


def host_verdicts(judged: DataFrame, host: str, limit: float = HOST_LIMIT) -> DataFrame:
    """Hosts with their documents, failures, shrunk failure rate and ``host_rejected``.

    The beta prior comes from the hosts' rates by the method of moments (hosts count
    alike). Where the rates do not spread, or there is one host, the prior is that of
    one document at the mean rate.
    """
    hosts = judged.where(F.col(host).isNotNull()).groupBy(host).agg(
        F.count(F.lit(1)).alias("host_docs"),
        F.sum(F.col("rule_failed").cast("long")).alias("host_failures"))
    rate = F.col("host_failures") / F.col("host_docs")
    prior = hosts.agg(F.avg(rate).alias("m"), F.var_samp(rate).alias("v"))
    spread = F.col("m") * (1 - F.col("m"))
    size = F.when((F.col("v") > 0) & (F.col("v") < spread), spread / F.col("v") - 1).otherwise(1.0)
    prior = prior.select((F.col("m") * size).alias("a"), ((1 - F.col("m")) * size).alias("b"))
    # One row, so this adds no pairs.
    return hosts.join(F.broadcast(prior)).select(
        host, "host_docs", "host_failures",
        ((F.col("host_failures") + F.col("a")) / (F.col("host_docs") + F.col("a") + F.col("b")))
        .alias("host_rate"),
    ).withColumn("host_rejected", F.col("host_rate") > limit)


def judge(docs: DataFrame, key: str = "doc_id", host: str = "source",
          text: str = "text", limit: float = HOST_LIMIT) -> DataFrame:
    """One row per input row: key, host, measures, ``base_failed``, ``rule_failed``,
    ``host_rate``, ``host_rejected`` and ``kept``.

    Null or empty text fails the base rules (no words). A null host has no verdict: only
    the base rules decide. Repeated rows each get a row and each count for their host. A
    null key is passed through. Texts are measured whole, however long. Other columns are not
    read, whatever they are called. An empty table gives an empty result.
    """
    own = docs.select(F.col(key).alias("k"), F.col(host).alias("h"), F.col(text).alias("t"))
    judged = staged(measures(own, ["k", "h"], "t").withColumn("base_failed", base_failed())
                    .withColumn("rule_failed", rule_failed()), "host-rules")
    # A hot host's documents meet its verdict in many tasks.
    salt = F.array(*[F.lit(i) for i in range(HOST_SALTS)])
    hosts = host_verdicts(judged, "h", limit).select(
        "h", "host_rate", "host_rejected", F.explode(salt).alias("salt"))
    salted = judged.withColumn("salt", F.pmod(F.xxhash64("k"), F.lit(HOST_SALTS)).cast("int"))
    return salted.join(hosts, ["h", "salt"], "left").select(
        F.col("k").alias(key), F.col("h").alias(host), *MEASURES, "base_failed", "rule_failed",
        "host_rate", F.coalesce("host_rejected", F.lit(False)).alias("host_rejected"),
        (~F.col("base_failed") & ~F.coalesce("host_rejected", F.lit(False))).alias("kept"))


def kept(docs: DataFrame, host: str = "source", text: str = "text",
         limit: float = HOST_LIMIT) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, all columns.

    Texts are measured twice rather than shuffled or written: once for the hosts, once to
    filter. The rejected hosts are written first, so the planner knows their size and only
    broadcasts them below the session's threshold.
    """
    judged = measures(docs.select(F.col(host).alias("h"), F.col(text).alias("t")), ["h"], "t")
    bad = staged(host_verdicts(judged.withColumn("rule_failed", rule_failed()), "h", limit)
                 .where("host_rejected").select(F.col("h").alias("__host")), "rejected-hosts")
    own = measures(wrapped(docs, text), ["row", "t"], "t").where(~base_failed())
    own = own.join(bad, F.col(f"row.{host}") == bad["__host"], "left_anti")
    return unwrapped(own, docs.columns, text)
