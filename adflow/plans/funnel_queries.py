"""Funnel joins, time-bucket statistics, and first-event de-duplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from adflow.operators import funnel as fn
from adflow.operators import rollup as ru
from adflow.operators.dedup import first_by
from adflow.plans.registry import query
from adflow.plans.views import bronze, first_sql, read, silver_sql

BUCKET = {
    5: "time_bucket(INTERVAL 5 MINUTE, ts)",
    60: "date_trunc('hour', ts)",
}
DIMS = list(fn.STAT_DIMS)
DIM_SQL = ", ".join(DIMS)
GROUP_SQL = f'"Date", {DIM_SQL}'


def _revenue(df, name="Revenue"):
    # Exact decimal sum first, then one conversion: equal on both engines.
    return df.withColumn(name, F.col(name).cast("double"))


def _events(spark, sf_dir, minutes, coarse):
    return [
        fn.silver(bronze(spark, sf_dir, kind, coarse), kind, minutes) for kind in fn.KINDS
    ]


def _counts_cte(minutes, coarse):
    parts = []
    for kind in fn.KINDS:
        price = ", SUM(Revenue) AS Revenue" if kind == "imp" else ""
        parts += [
            f"{kind}_s AS ({silver_sql(kind, BUCKET[minutes], coarse)})",
            f"{kind}_f AS ({first_sql(kind + '_s', kind)})",
            f"{kind}_g AS (SELECT {GROUP_SQL}, COUNT(*) AS {kind}{price} FROM {kind}_f GROUP BY ALL)",
        ]
    return "WITH " + ",\n".join(parts)


def _agg_sql(minutes, how="LEFT", strict=False):
    def eq(left, right, keys):
        return " AND ".join(f'{left}."{k}" = {right}."{k}"' for k in keys)

    keys = ["Date", *DIMS]
    on_imp = eq("bid_g", "imp_g", keys)
    if strict:
        on_clk = (
            eq("bid_g", "clk_g", [k for k in keys if k != "AdExchangeTypes"])
            + " AND bid_g.AdExchangeTypes = imp_g.AdExchangeTypes"
        )
    else:
        on_clk = eq("bid_g", "clk_g", keys)
    anchor = "clk_g" if how == "RIGHT" else "bid_g"
    cols = ", ".join(f'{anchor}."{k}" AS "{k}"' for k in keys)
    return f"""{_counts_cte(minutes, True)}
SELECT {cols}, COALESCE(bid, 0) AS bid, COALESCE(imp, 0) AS imp, COALESCE(clk, 0) AS clk,
       CAST(COALESCE(Revenue, 0) AS DOUBLE) AS Revenue
FROM bid_g {how} JOIN imp_g ON {on_imp} {how} JOIN clk_g ON {on_clk}"""


def _five_minutes(spark, sf_dir, **options):
    return _revenue(fn.funnel_agg(*_events(spark, sf_dir, 5, True), **options))


@query("j1_funnel_5m", _agg_sql(5))
def funnel_5m(spark, sf_dir):
    return _five_minutes(spark, sf_dir)


@query("j1_funnel_5m_strict", _agg_sql(5, strict=True))
def funnel_5m_strict(spark, sf_dir):
    return _five_minutes(spark, sf_dir, strict_reference=True)


@query("j3_funnel_right", _agg_sql(60, how="RIGHT"))
def funnel_right(spark, sf_dir):
    return _revenue(fn.funnel_agg(*_events(spark, sf_dir, 60, True), how="right"))


def _rollup_sql(minutes, kind):
    price = ", CAST(SUM(Revenue) AS DOUBLE) AS Revenue" if kind == "imp" else ""
    return f"""WITH s AS ({silver_sql(kind, BUCKET[minutes])}), f AS ({first_sql('s', kind)})
SELECT {GROUP_SQL}, COUNT(*) AS {kind}{price} FROM f GROUP BY ALL"""


for _kind in fn.KINDS:

    @query(f"a1_rollup_5m_{_kind}", _rollup_sql(5, _kind))
    def rollup_5m(spark, sf_dir, kind=_kind):
        out = fn.bucket_counts(fn.silver(bronze(spark, sf_dir, kind), kind, 5), kind)
        return _revenue(out) if kind == "imp" else out


ROW_COLS = [
    "Date", "bidtime", "imptime", "clktime", *fn.ATTRIBUTES, "tid", "Revenue", "ITCT",
]


def _join_rows_sql(keys, views, date_type="TIMESTAMP"):
    b, i, c = views
    attrs = list(fn.ATTRIBUTES)

    def eq(left, right):
        return " AND ".join(f'{left}."{k}" = {right}."{k}"' for k in [*keys, *attrs])

    cols = ", ".join(f"{b}.{a} AS {a}" for a in attrs)
    return f"""SELECT CAST({b}."Date" AS {date_type}) AS "Date", {b}.bidtime AS bidtime, {i}.imptime AS imptime,
       {c}.clktime AS clktime, {cols}, {b}.tid AS tid, {i}.Revenue AS Revenue,
       {ITCT.format(i=i, c=c)} AS ITCT
FROM {b} LEFT JOIN {i} ON {eq(b, i)} LEFT JOIN {c} ON {eq(b, c)}"""


# Whole seconds, cut toward zero.
ITCT = "CAST(trunc((epoch_us({c}.clktime) - epoch_us({i}.imptime)) / 1000000.0) AS BIGINT)"


def _hour_cte(coarse=True):
    parts = []
    for kind in fn.KINDS:
        parts += [
            f"{kind}_s AS ({silver_sql(kind, BUCKET[60], coarse)})",
            f"{kind}_f AS ({first_sql(kind + '_s', kind)})",
        ]
    return "WITH " + ",\n".join(parts)


HOUR_ROWS = f"""{_hour_cte()}, rows AS ({_join_rows_sql(['Date', 'tid'], ['bid_f', 'imp_f', 'clk_f'])})"""
STAT_SELECT = f"""SELECT "Date", AdExchangeTypes AS ExchangeTypes, {", ".join(DIMS[1:])},
       COUNT(bidtime) AS bid, COUNT(imptime) AS imp, COUNT(clktime) AS clk,
       CAST(COALESCE(SUM(Revenue), 0) AS DOUBLE) AS Revenue FROM rows GROUP BY ALL"""


def _row_oracle(cte):
    cols = ", ".join(f'"{c}"' if c != "Revenue" else "CAST(Revenue AS DOUBLE) AS Revenue" for c in ROW_COLS)
    return f"{cte} SELECT {cols} FROM rows"


@query("j2_funnel_rows_hour", _row_oracle(HOUR_ROWS))
def funnel_rows_hour(spark, sf_dir):
    return _revenue(fn.funnel_rows(*_events(spark, sf_dir, 60, True)))


@query("a2_rollup_hour", f"{HOUR_ROWS} {STAT_SELECT}")
def rollup_hour(spark, sf_dir):
    return _revenue(ru.stat(fn.funnel_rows(*_events(spark, sf_dir, 60, True))))


def _day_cte():
    parts = [f"bid_s AS ({silver_sql('bid', 'CAST(ts AS DATE)')})", f"bid_f AS ({first_sql('bid_s', 'bid')})"]
    for kind in ("imp", "clk"):
        parts += [
            f"{kind}_r AS ({silver_sql(kind, 'CAST(ts AS DATE)')})",
            f'{kind}_s AS (SELECT * REPLACE (CAST("Date" - back AS DATE) AS "Date") '
            f"FROM {kind}_r, (VALUES (0), (1)) AS days(back))",
            f"{kind}_f AS ({first_sql(kind + '_s', kind)})",
        ]
    return "WITH " + ",\n".join(parts)


DAY_ROWS = f"""{_day_cte()}, rows AS ({_join_rows_sql(['Date', 'tid'], ['bid_f', 'imp_f', 'clk_f'])})"""


def _day_rows(spark, sf_dir):
    day = fn.funnel_day(*_events(spark, sf_dir, 60, False))
    return day.withColumn("Date", F.col("Date").cast("timestamp_ntz"))


@query("j2_funnel_rows_day", _row_oracle(DAY_ROWS))
def funnel_rows_day(spark, sf_dir):
    return _revenue(_day_rows(spark, sf_dir))


@query("a3_rollup_day", f"{DAY_ROWS} {STAT_SELECT}")
def rollup_day(spark, sf_dir):
    return _revenue(ru.stat(_day_rows(spark, sf_dir)))


def _gold_cte():
    parts = []
    for kind in fn.KINDS:
        parts += [
            f"{kind}_s AS ({silver_sql(kind, BUCKET[60])})",
            f"{kind}_f AS ({first_sql(kind + '_s', kind, 'tid')})",
        ]
    return "WITH " + ",\n".join(parts)


GOLD_ROWS = f"""{_gold_cte()}, rows AS ({_join_rows_sql(['tid'], ['bid_f', 'imp_f', 'clk_f'])})"""


@query("j6_funnel_gold", _row_oracle(GOLD_ROWS))
def funnel_gold(spark, sf_dir):
    return _revenue(fn.funnel_gold(*_events(spark, sf_dir, 60, False)))


@query("a4_stat_gold", f"{GOLD_ROWS} {STAT_SELECT}")
def stat_gold(spark, sf_dir):
    return _revenue(ru.stat(fn.funnel_gold(*_events(spark, sf_dir, 60, False))))


for _kind in fn.KINDS:
    _cols = ["Date", f"{_kind}time", *fn.ATTRIBUTES, "tid"]
    _price = ", CAST(Revenue AS DOUBLE) AS Revenue" if _kind == "imp" else ""

    @query(
        f"p6_silver_{_kind}",
        f"SELECT {', '.join(chr(34) + c + chr(34) for c in _cols)}{_price} FROM ({silver_sql(_kind, BUCKET[60])})",
    )
    def silver_rows(spark, sf_dir, kind=_kind):
        out = fn.silver(bronze(spark, sf_dir, kind), kind, 60)
        return _revenue(out) if kind == "imp" else out


@query(
    "n1_first_event_per_user",
    """SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events)
WHERE rn = 1""",
)
def first_event(spark, sf_dir):
    return first_by(read(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"])


@query(
    "a1_rollup_events_5m",
    """SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS bucket, event_type, COUNT(*) AS cnt,
  CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS price_sum FROM events GROUP BY ALL""",
)
def rollup_events(spark, sf_dir):
    events = read(spark, sf_dir, "events").withColumn("price", F.expr("CAST(value AS DECIMAL(18,2))"))
    out = ru.rollup_bucket(events, "ts", 5, ["event_type"], "price")
    return _revenue(out, "price_sum")
