"""Shape of the physical plans."""

import re

import pytest

import __spark_entry__ as entry
from adflow.operators.sets import overlay

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def plan(spark):
    """Physical plan text without broadcast joins, as for large inputs."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")

    def text(name):
        df = entry.queries()[name](spark, SF)
        return df._jdf.queryExecution().executedPlan().toString()

    yield text
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def shuffles(text):
    return len(re.findall("Exchange hashpartitioning", text))


@pytest.mark.parametrize("name", ["j2_funnel_rows_hour", "j2_funnel_rows_day", "j6_funnel_gold"])
def test_row_funnel_shuffles_each_input_once(plan, name):
    text = plan(name)
    assert shuffles(text) == 3
    assert text.count("WindowGroupLimit") == 6


def test_web_flatten_shuffles_once_and_never_explodes(plan):
    text = plan("w1_ga4_flatten")
    assert shuffles(text) == 1 and "Generate" not in text


def test_user_agent_needs_no_shuffle(plan):
    assert shuffles(plan("u1_enrich_ua")) == 0


def test_overlay_shuffles_each_side_once(spark, plan):
    raw = spark.range(1000).selectExpr("id % 50 AS k", "id % 7 AS name", "id AS m")
    wash = spark.range(20).selectExpr("id AS k", "id AS m")
    df = overlay(raw, wash, ["k"], ["name"], ["m"])
    assert shuffles(df._jdf.queryExecution().executedPlan().toString()) == 2


def test_overlay_sorts_the_raw_side_once(spark):
    raw = spark.range(1000).selectExpr("id % 50 AS k", "id % 7 AS name", "id AS m")
    wash = spark.range(20).selectExpr("id AS k", "id AS m").hint("merge")
    text = overlay(raw, wash, ["k"], ["name"], ["m"])._jdf.queryExecution().executedPlan().toString()
    left = text[text.index("SortMergeJoin"):].split("SortAggregate")[0].split("HashAggregate")[0]
    assert text.index("SortMergeJoin") < text.index("Window") and left.count("Window [") == 1
    # A sort above the join would be one more.
    assert "Sort [" not in text[:text.index("SortMergeJoin")]


def test_window_filter_reaches_the_scan(plan):
    text = plan("f1_where_window")
    pushed = re.search(r"PushedFilters: \[([^\n]*)\]", text).group(1)
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed


def test_scan_reads_only_what_is_needed(plan):
    text = plan("a18_label_counts")
    assert "ReadSchema: struct<quality:int>" in text


PURE = [
    n for n in sorted(entry.queries())
    if n[0] in "jadfxpcwnle" and not n.startswith(("e5", "j4", "j5", "j15", "j14", "j13", "c15", "c17", "c18", "c24"))
]


@pytest.mark.parametrize("name", PURE)
def test_no_python_and_no_pairwise_join(plan, name):
    text = plan(name)
    assert "Python" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
