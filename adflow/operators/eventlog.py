"""Reading the run log of the data jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adflow.operators.rollup import latest
from adflow.operators.web import expand_json

# The word after the last "of", whole, in quotes or not.
NAMED = r"^.*\bof\s+['\"`]?([^\s'\"`]+)"
DROPPED = "array<struct<dropped_records: bigint>>"


def failed_events(log: DataFrame) -> DataFrame:
    return log.where((F.col("event_type") == "flow_progress") & F.col("error").isNotNull())


def audit(log: DataFrame) -> DataFrame:
    """Who did what, out of the details text."""
    return log.where(F.col("event_type") == "user_action").select(
        "timestamp",
        F.get_json_object("details", "$.user_action.action").alias("action"),
        F.get_json_object("details", "$.user_action.user_name").alias("user_name"),
    )


def latest_update(log: DataFrame) -> DataFrame:
    """Id of the newest run, as a one-row frame."""
    runs = log.where(F.col("event_type") == "create_update")
    return latest(runs, "timestamp", "id").select(F.col("origin.update_id").alias("update_id"))


def lineage(log: DataFrame, update_id: str | None = None) -> DataFrame:
    """Edges from input to output dataset, of one run or of all."""
    flows = log.where(F.col("event_type") == "flow_definition")
    if update_id is not None:
        flows = flows.where(F.col("origin.update_id") == update_id)
    edges = expand_json(
        flows, "details", "$.flow_definition.input_datasets", "array<string>", "input_dataset"
    )
    return edges.select(
        F.col("origin.update_id").alias("update_id"), "input_dataset",
        F.get_json_object("details", "$.flow_definition.output_dataset").alias("output_dataset"),
    )


def dropped_records(log: DataFrame, skip: str = "%_v2%") -> DataFrame:
    """Rows dropped by expectations, per message. The table's name follows ``of`` in the text."""
    flows = log.where((F.col("event_type") == "flow_progress") & ~F.col("message").like(skip))
    rules = expand_json(flows, "details", "$.flow_progress.data_quality", DROPPED, "rule")
    return rules.groupBy("message").agg(
        F.sum("rule.dropped_records").alias("dropped_records")
    ).select(F.regexp_extract("message", NAMED, 1).alias("table_name"), "message", "dropped_records")


def alerts(log: DataFrame, skip: str = "%_v2%") -> DataFrame:
    return dropped_records(log, skip).where("dropped_records > 0")
