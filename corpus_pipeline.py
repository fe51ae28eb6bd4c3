"""A training-corpus pipeline: five stages over ``documents``, each on all that the last kept.

1. toxicity: documents scored as toxic go.
2. quality rules: documents that fail the base rules, or whose host is rejected, go.
3. n-gram Jaccard join: of every component of near duplicates the smallest doc_id stays.
4. benchmark decontamination: passages that benchmark items share are cut out.
5. best-fit packing: what is left is tokenised and packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adflow.llm import decontaminate, host_rules, ngram_join, packing, toxicity as toxic
from adflow.llm.registry import table
from adflow.llm.stage import staged, unwrapped, wrapped


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document without text has no toxic feature and stays."""
    model = toxic.train(docs, table(spark, sf_dir, "labels"))
    kept = toxic.score(wrapped(docs), model, ["row", "t"], "t").where("predicted = 0")
    return unwrapped(kept, docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Null and empty texts fail the base rules and go; a document without a host is judged by
    them alone. Repeated rows are judged alike and all count for their host."""
    return host_rules.kept(docs)


def _one_per_key(docs: DataFrame) -> DataFrame:
    """Of rows that repeat a doc_id the one with the smallest text; rows without one all stay."""
    again = staged(docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"), "repeated")
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
    first = docs.join(again, "doc_id", "left_semi").select(*docs.columns, place.alias("__place")).where(
        "__place = 1")
    return docs.join(again, "doc_id", "left_anti").select(docs.columns).union(first.select(docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document without a doc_id, or without words, is in no group and stays. Rows that repeat a
    doc_id are one document, of which one row stays."""
    found = ngram_join.near_duplicates(docs.select("doc_id", "text"))
    gone = staged(found.where(F.col("component_id") < F.col("doc_id")).select("doc_id"), "copies")
    return _one_per_key(docs.join(gone, "doc_id", "left_anti").select(docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay, without the passages; ``n_chars`` follows the text. A null text stays null,
    an item without words is in no document, repeated rows are cut alike."""
    cut = decontaminate.cut(docs, table(spark, sf_dir, "benchmark"))
    return cut.withColumn("n_chars", F.when(
        F.col("text").isNotNull(), F.length("text")).otherwise(F.col("n_chars")).cast(
        dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else cut


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences; a null text is an empty one."""
    return packing.pack(docs.select("doc_id", "text"))


STAGES = [
    ("toxicity", toxicity),
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packed),
]

# Tokens, fitted scores and packing are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
