"""Validation, expectations, summaries, and re-processing."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from adflow.operators import funnel as fn
from adflow.operators import quality as ql
from adflow.operators import rollup as ru
from adflow.operators.wash import wash
from adflow.plans.funnel_queries import DAY_ROWS, STAT_SELECT, _day_rows, _revenue
from adflow.plans.registry import query
from adflow.plans.views import REPORT_SQL, read, report
from adflow.session import temp_database
from adflow.sources import catalog as ct
from adflow.sources import sinks as sk
from adflow.sources.catalog import detect_date_col

HOLES = "CASE WHEN event_type = 'view' THEN NULL ELSE user_id END AS user_id"


def _holed(spark, sf_dir):
    return read(spark, sf_dir, "events").selectExpr(
        "event_type", HOLES, "CAST(ts AS DATE) AS event_date", "value > 50 AS big"
    )


HOLED_SQL = f"SELECT event_type, {HOLES}, CAST(ts AS DATE) AS event_date, value > 50 AS big FROM events"
NULLS_SQL = "concat('{\"event_type\":', COUNT(*) FILTER (WHERE event_type IS NULL), ',\"user_id\":', COUNT(*) FILTER (WHERE user_id IS NULL), '}')"


@query("a14_date_range", "SELECT MIN(o_orderdate) AS min_date, MAX(o_orderdate) AS max_date FROM orders")
def date_range(spark, sf_dir):
    return ql.date_range(read(spark, sf_dir, "orders"), "o_orderdate")


@query("a15_null_counts", f"SELECT {NULLS_SQL} AS null_exist_cols FROM ({HOLED_SQL})")
def null_counts(spark, sf_dir):
    return ql.null_counts(_holed(spark, sf_dir))


PROFILE_SQL = f"""SELECT COUNT(*) AS total_count, (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM e)) AS distinct_count,
  COUNT(*) FILTER (WHERE event_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-05') AS period_count,
  CAST(MIN(event_date) AS VARCHAR) AS min_date, CAST(MAX(event_date) AS VARCHAR) AS max_date, {NULLS_SQL} AS null_exist_cols FROM e"""


@query("q3_profile", f"WITH e AS ({HOLED_SQL}) {PROFILE_SQL}")
def profile(spark, sf_dir):
    rows = _holed(spark, sf_dir)
    return ql.profile(rows, detect_date_col(rows.schema), "2024-01-03", "2024-01-05")


@query(
    "q10_saved_validation",
    f"""WITH e AS ({HOLED_SQL}) SELECT *, 'events' AS "table", false AS is_washing, '2024-01-03|2024-01-05' AS period,
  TIMESTAMP '2024-01-20 00:00:00' AS validated_at, 'tester' AS validated_by FROM ({PROFILE_SQL})""",
)
def saved_validation(spark, sf_dir):
    database = temp_database(spark, "valid")
    sk.overwrite(_holed(spark, sf_dir), f"{database}.events")
    row = ql.validate(
        spark.table(f"{database}.events"), database, "events", "event_date",
        "2024-01-03", "2024-01-05", datetime(2024, 1, 20), "tester",
    )
    ql.save_validation(row, f"{database}.validation")
    return spark.table(f"{database}.validation").drop("database")


RULES = {"has_value": "value > 10", "known_type": "event_type IN ('view', 'click')", "even_or_null": "nullif(user_id % 2, 1) = 0"}


@query(
    "q9_expectations",
    " UNION ALL ".join(
        f"SELECT '{n}' AS rule, COUNT(*) FILTER (WHERE {r}) AS passed, COUNT(*) - COUNT(*) FILTER (WHERE {r}) AS dropped FROM events"
        for n, r in RULES.items()
    ),
)
def expectations(spark, sf_dir):
    return ql.expectations(read(spark, sf_dir, "events"), RULES)


SUM_COLS = ["p_partkey", "p_name", "p_brand", "p_size"]


@query(
    "q2_date_columns",
    """SELECT 'lineitem' AS "table", 'l_shipdate' AS "column", CAST(MIN(l_shipdate) AS DATE) AS first, CAST(MAX(l_shipdate) AS DATE) AS last, COUNT(*) AS "rows" FROM lineitem
UNION ALL SELECT 'orders', 'o_orderdate', CAST(MIN(o_orderdate) AS DATE), CAST(MAX(o_orderdate) AS DATE), COUNT(*) FROM orders
UNION ALL SELECT "table", NULL, NULL, NULL, "rows" FROM (
  SELECT 'customer' AS "table", COUNT(*) AS "rows" FROM customer UNION ALL SELECT 'documents', COUNT(*) FROM documents UNION ALL SELECT 'events', COUNT(*) FROM events
  UNION ALL SELECT 'nation', COUNT(*) FROM nation UNION ALL SELECT 'part', COUNT(*) FROM part UNION ALL SELECT 'region', COUNT(*) FROM region UNION ALL SELECT 'supplier', COUNT(*) FROM supplier)""",
)
def date_columns(spark, sf_dir):
    """The date column found in each table by its name and type, and the dates it holds."""
    out = None
    for name in ("customer", "documents", "events", "lineitem", "nation", "orders", "part", "region", "supplier"):
        rows = read(spark, sf_dir, name)
        found = ct.detect_date_col(rows.schema)
        day = F.col(found).cast("date") if found else F.lit(None).cast("date")
        one = rows.agg(F.min(day).alias("first"), F.max(day).alias("last"), F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table"), F.lit(found).cast("string").alias("column"), "first", "last", "rows")
        out = one if out is None else out.unionByName(one)
    return out


LINE_COLS = ["l_orderkey", "l_extendedprice", "l_discount", "l_linestatus"]


def _summary_sql(c, table, numbers):
    number = c in numbers
    quartiles = ", ".join(
        (f"CAST(quantile_disc({c}, {q / 100}) AS DOUBLE)" if number else "CAST(NULL AS DOUBLE)") + f" AS p{q}"
        for q in (25, 50, 75)
    )
    mean = f"round(CAST(SUM({c}) AS DOUBLE) / COUNT({c}), 4) AS mean, round(STDDEV_SAMP({c}), 4) AS stddev" if number else (
        "CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS stddev")
    return (
        f"SELECT '{c}' AS \"column\", COUNT({c}) AS \"count\", COUNT(*) - COUNT({c}) AS nulls, (COUNT(*) - COUNT({c})) / COUNT(*) AS null_share, "
        f"COUNT(DISTINCT {c}) AS \"distinct\", CAST(MIN({c}) AS VARCHAR) AS \"min\", CAST(MAX({c}) AS VARCHAR) AS \"max\", {mean}, {quartiles} FROM {table}"
    )


def _summary(df, cols):
    return ql.summarize(df, cols).withColumns({c: F.round(c, 4) for c in ("mean", "stddev")})


@query("q11_summarize", " UNION ALL ".join(_summary_sql(c, "part", ("p_partkey", "p_size")) for c in SUM_COLS))
def summarize(spark, sf_dir):
    return _summary(read(spark, sf_dir, "part"), SUM_COLS)


@query("q11_summarize_lines", " UNION ALL ".join(_summary_sql(c, "lineitem", LINE_COLS[:3]) for c in LINE_COLS))
def summarize_lines(spark, sf_dir):
    """More rows than a sketch would hold."""
    return _summary(read(spark, sf_dir, "lineitem"), LINE_COLS)


# --- re-processing ---------------------------------------------------------

WASHED_SQL = f"SELECT campaignId, adId, segmentsDate, impressions, substring(segmentsDate, 1, 4) AS segmentsYear FROM ({REPORT_SQL})"


def _washable(spark, sf_dir):
    return report(spark, sf_dir).withColumn("segmentsYear", F.substring("segmentsDate", 1, 4)).select(
        "campaignId", "adId", "segmentsDate", "impressions", "segmentsYear"
    )


def _stale_table(spark, sf_dir, label):
    """A table whose rows of the wash range carry wrong numbers."""
    table = f"{temp_database(spark, label)}.ad_wash_stats"
    wrong = F.col("segmentsDate").between("1996-02-01", "1996-04-14")
    stale = _washable(spark, sf_dir).withColumn(
        "impressions", F.when(wrong, F.col("impressions") * 0 - 1).otherwise(F.col("impressions"))
    )
    sk.overwrite(stale, table, ["segmentsYear"])
    return table


def _wash(spark, sf_dir, table, start, end, by, times=1):
    def job(low, high):
        day = F.col("segmentsDate")
        return _washable(spark, sf_dir).where(
            (day >= low.strftime("%Y-%m-%d")) & (day < high.strftime("%Y-%m-%d"))
        )

    out = None
    for _ in range(times):
        out = wash(spark, job, table, "segmentsDate", start, end, by=by)
    return out


@query("o1_wash_interval", WASHED_SQL)
def wash_interval(spark, sf_dir):
    table = _stale_table(spark, sf_dir, "wash")
    _wash(spark, sf_dir, table, datetime(1996, 2, 1), datetime(1996, 4, 15), "interval", times=2)
    return spark.table(table).select("campaignId", "adId", "segmentsDate", "impressions", "segmentsYear")


@query(
    "o1_wash_by_day_validation",
    f"""SELECT COUNT(*) AS total_count, COUNT(*) FILTER (WHERE segmentsDate BETWEEN '1996-04-12' AND '1996-04-14') AS period_count,
  MIN(segmentsDate) AS min_date, MAX(segmentsDate) AS max_date, true AS is_washing, '1996-04-12|1996-04-14' AS period FROM ({WASHED_SQL})""",
)
def wash_by_day(spark, sf_dir):
    table = _stale_table(spark, sf_dir, "washday")
    row = _wash(spark, sf_dir, table, datetime(1996, 4, 12), datetime(1996, 4, 15), "day")
    return row.select("total_count", "period_count", "min_date", "max_date", "is_washing", "period")


@query("z4_restate_days", f"{DAY_ROWS} {STAT_SELECT}")
def restate_days(spark, sf_dir):
    """Daily statistics with a wrong week, recomputed with its late events."""
    table = f"{temp_database(spark, 'restate')}.daily"
    daily = _revenue(ru.stat(_day_rows(spark, sf_dir))).withColumn("day", F.to_date("Date"))
    wrong = F.col("day").between(F.lit("2024-01-08").cast("date"), F.lit("2024-01-14").cast("date"))
    sk.overwrite(daily.withColumn("bid", F.when(wrong, F.lit(-1).cast("long")).otherwise(F.col("bid"))), table, ["day"])
    right = daily.where(wrong)
    sk.replace_window(right, table, wrong)
    return spark.table(table).drop("day")


@query(
    "s4_postback_reload",
    """SELECT event_id, event_type, value, ts AS actiontime FROM events""",
)
def postback_reload(spark, sf_dir):
    """Two months of nested postbacks, unpacked and loaded over what is there."""
    from adflow.operators.sets import append_rows

    events = read(spark, sf_dir, "events").select(
        F.struct("event_id", "event_type", "value").alias("postbackitem"), F.col("ts").alias("actiontime")
    )
    cut = F.lit("2024-01-16").cast("date")
    both = append_rows(events.where(F.to_date("actiontime") < cut), events.where(F.to_date("actiontime") >= cut))
    rows = both.select("postbackitem.*", "actiontime").withColumn("day", F.to_date("actiontime"))
    table = f"{temp_database(spark, 'postback')}.postback"
    sk.overwrite(rows, table, ["day"])
    since = F.col("day") >= F.lit("2024-01-10").cast("date")
    sk.replace_window(rows.where(since), table, since)
    return spark.table(table).drop("day")


@query("q8_daily_numbers_load", "SELECT CAST(CAST(ts AS DATE) AS STRING) AS day, event_type, COUNT(*) AS events FROM events GROUP BY ALL")
def daily_numbers_load(spark, sf_dir):
    """Another team's daily CSV, loaded over the same days of the comparison table."""
    from adflow.functions.names import drop_cols
    from adflow.session import work_dir
    from adflow.sources.readers import read_csv

    path = work_dir(spark, "numbers")
    numbers = read(spark, sf_dir, "events").groupBy(
        F.to_date("ts").cast("string").alias("day"), "event_type"
    ).agg(F.count("*").alias("events"))
    numbers.withColumn("_id", F.lit("x")).write.option("header", True).csv(path)
    rows = drop_cols(read_csv(spark, path), ["_id"]).withColumn("events", F.col("events").cast("long"))
    table = f"{temp_database(spark, 'compare')}.numbers"
    sk.overwrite(rows.withColumn("events", F.col("events") - 1), table, ["day"])
    since = F.col("day") >= "2024-01-01"
    sk.replace_window(rows, table, since)
    return spark.table(table).select("day", "event_type", "events")
