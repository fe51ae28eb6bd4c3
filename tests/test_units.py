"""Edge rows that the driver tables do not hold."""

import math
import random
from datetime import date, datetime
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adflow.functions import names as nm
from adflow.functions import recode as rc
from adflow.functions import scalars as sc
from adflow.functions import timewin as tw
from adflow.operators import bidreq as br
from adflow.operators import dedup as dd
from adflow.operators import funnel as fn
from adflow.operators import ml
from adflow.operators import quality as ql
from adflow.operators import rollup as ru
from adflow.operators import sets as st
from adflow.operators import useragent as uag
from adflow.operators import web
from adflow.plans import load_all
from adflow.reports import joined as jn
from adflow.sources import catalog as ct
from adflow.sources import readers as rd


def test_criteria_windows():
    at = datetime(2024, 1, 1, 0, 3)
    assert tw.criteria(at, "5m") == tw.Window(datetime(2023, 12, 31, 23, 55), datetime(2024, 1, 1))
    assert tw.criteria(datetime(2023, 5, 5, 10, 33), "5m").start == datetime(2023, 5, 5, 10, 25)
    assert tw.criteria(at, "1h").start == datetime(2023, 12, 31, 23)
    # January looks back to December of the year before.
    last = tw.preset(at, "last_month")
    assert (last.first_day, last.last_day) == ("2023-12-01", "2023-12-31")
    assert tw.preset(at, "wash_day").first_day == "2023-12-24"
    assert tw.preset(at, "three_weeks").first_day == "2023-12-10"
    assert tw.local_now(datetime(2023, 12, 31, 20)) == datetime(2024, 1, 1, 5)
    with pytest.raises(ValueError):
        tw.criteria(at, "1w")


def test_time_bucket_keeps_null(spark, rows):
    df = spark.createDataFrame([(datetime(2024, 2, 29, 23, 59, 59),), (None,)], "t timestamp_ntz")
    got = rows(df, tw.time_bucket(F.col("t"), 5), tw.time_bucket(F.col("t"), 1440))
    assert got == [(None, None), (datetime(2024, 2, 29, 23, 55), datetime(2024, 2, 29))] or got == [
        (datetime(2024, 2, 29, 23, 55), datetime(2024, 2, 29)), (None, None)
    ]
    with pytest.raises(ValueError):
        tw.time_bucket(F.col("t"), 7)


def test_between_seconds_can_be_negative(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1, 0, 0, 10), datetime(2024, 1, 1, 0, 0, 7))], "a timestamp_ntz, b timestamp_ntz"
    )
    assert df.select(tw.between_seconds(F.col("a"), F.col("b"))).first()[0] == -3


def test_names():
    assert nm.camel("metrics_cost_micros") == "metricsCostMicros"
    assert nm.camel("video_p25_watched_actions") == "videoP25WatchedActions"
    assert nm.snake("clkRequestEvent") == "clk_request_event"
    assert nm.snake("DeviceID") == "device_id"
    for name in ("plain", "two_words", "three_word_name"):
        assert nm.snake(nm.camel(name)) == name


def test_renaming_refuses_collisions(spark):
    with pytest.raises(ValueError):
        nm.snake_to_camel(spark.createDataFrame([(1, 2)], "a_b int, aB int"))


def test_normalize_skips_empty_parents(spark, rows):
    df = spark.createDataFrame(
        [(1, [((1, "x"),), ((2, None),)]), (2, []), (3, None)],
        "id int, data array<struct<m:struct<v:int,w:string>>>",
    )
    assert rows(nm.normalize(df, "data", ["id"])) == [(1, 1, "x"), (1, 2, None)]


def test_null_types_to_string(spark):
    df = nm.null_types_to_string(spark.sql("SELECT 1 AS a, NULL AS b"))
    assert dict(df.dtypes) == {"a": "int", "b": "string"}


def test_recode_outside_table(spark, rows):
    df = spark.createDataFrame([("1",), ("9",), (None,)], "code string")
    assert rows(rc.device_type(df, "code", "d"), "d") == sorted(
        [("Mobile/Tablet",), ("9",), (None,)], key=lambda t: str(t[0])
    )
    by = spark.createDataFrame([(2,), (99,), (None,)], "c int")
    assert rows(by, rc.by_position(F.col("c"), rc.SEGMENT_DEVICE)) == [
        ("Mobile Phones",), (None,), (None,)
    ]


def test_app_category_classes(spark):
    texts = ["Art & Design", "Sports", "스포츠", "Music", "음악", "Food & Drink", "Unknown Kind", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    got = {r["c"]: r["o"] for r in rc.app_category(df, "c", "o").collect()}
    assert got == {
        "Art & Design": "8", "Sports": "8", "스포츠": "19", "Music": "8", "음악": "13",
        "Food & Drink": "7", "Unknown Kind": "UnknownKind", "": "", None: None,
    }


def test_region_spellings_of_the_user(spark):
    texts = ["KR", "11", "kr-26", "Gyeonggi-do", "Chungcheongbuk-do", "Jeju", "99", "haeundae-gu", None]
    df = spark.createDataFrame([(t,) for t in texts], "r string")
    local = spark.createDataFrame([("Haeundae-gu", "KR-99"), ("99", "KR-1")], "spelling string, code string")
    got = {r["r"]: r["o"] for r in rc.recode_region(df, "r", "o", local).collect()}
    assert got == {
        "KR": "KR-0", "11": "KR-11", "kr-26": "KR-26", "Gyeonggi-do": "KR-41",
        "Chungcheongbuk-do": "KR-43", "Jeju": "KR-49", "99": "KR-1", "haeundae-gu": "KR-99", None: None,
    }


def test_scalar_traps(spark):
    df = spark.sql("SELECT array('https://a/?mkt_x_mkt_y') AS u, array('https://a/') AS v, CAST(array() AS array<string>) AS w")
    got = df.select(*[sc.after_marker(F.col(c)) for c in "uvw"]).first()
    assert tuple(got) == ("x_", None, None)
    money = spark.createDataFrame([(2_500_000,), (3_500_000,), (1_234_567_890,)], "m long")
    assert [r[0] for r in money.select(sc.micros_to_currency(F.col("m"))).collect()] == [2, 4, 1235]
    ids = spark.createDataFrame([("1.40000000000000001E17",), ("12",)], "t string")
    assert [r[0] for r in ids.select(sc.id_from_number_text(F.col("t"))).collect()] == [140000000000000001, 12]
    clock = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 10:11:12.345' AS t")
    assert clock.select(tw.clock_time(F.col("t"))).first()[0] == "10:11:12"


def test_number_ids_beyond_a_long_keep_their_rows(spark, rows, tmp_path):
    users = [(1, 7), (2, 9222), (3, 9223), (4, 90_000), (5, None)]
    spark.createDataFrame(users, "event_id long, user_id long").write.parquet(str(tmp_path / "events.parquet"))
    got = rows(load_all().QUERIES["x19_number_ids"](spark, str(tmp_path)))
    assert got == [(1, 7_500_000_000_000_000), (2, 9_222_500_000_000_000_000), (3, None), (4, None), (5, None)]
    with pytest.raises(Exception, match="OVERFLOW"):
        spark.sql("SELECT '9223.5E15' AS t").select(sc.id_from_number_text(F.col("t"))).collect()


def test_user_agents(spark):
    agents = {
        "Mozilla/5.0 (iPhone; CPU iPhone OS 15_2 like Mac OS X) AppleWebKit/605 Version/15.2 Mobile/15E148 Safari/604.1":
            ("Apple", "iPhone", "iPhone", "iOS", "15.2", "Mobile Safari", "15.2", True, False),
        "Mozilla/5.0 (Linux; Android 10; SM-G960N) AppleWebKit/537.36 Chrome/96.0.4664.45 Mobile Safari/537.36":
            ("Samsung", "Samsung SM-G960N", "SM-G960N", "Android", "10", "Chrome Mobile", "96.0.4664", True, False),
        "Mozilla/5.0 (compatible; Googlebot/2.1; +http://www.google.com/bot.html)":
            ("Spider", "Spider", "Desktop", "Other", "", "Googlebot", "2.1", False, True),
        "": ("Unknown", "Other", "Unknown", "Other", "", "Other", "", False, False),
        None: ("Unknown",) * 7 + (False, False),
    }
    df = spark.createDataFrame([(a,) for a in agents], "ua string")
    got = {r["ua"]: tuple(r["p"]) for r in df.select("ua", uag.parse_ua(F.col("ua")).alias("p")).collect()}
    assert got == agents
    joined = uag.enrich_ua(df.union(df), F.col("ua"), "p").collect()
    assert len(joined) == 2 * len(agents) and all(tuple(r["p"]) == agents[r["ua"]] for r in joined)


def test_user_agent_rules_are_rows(spark, monkeypatch):
    texts = [
        "Mozilla/5.0 (X11; Linux x86_64) Gecko/20100101 Firefox/110.0", "a+b Foo/3_1 Chrome/1.2.3",
        "Mozilla/5.0 (Linux; Android 12; SM-S908N Build/X; wv) Chrome/102.0.5005.125 Mobile Safari/537.36",
        "Mozilla/5.0 (iPhone; CPU iPhone OS 16_1 like Mac OS X) Mobile/15E148 Instagram 10.0.5 (x)",
        "Baiduspider/2.0 Daum/1 Trident/7", "Edg", "Version/", "EdgA/ SamsungBrowser/", "x" * 5000, " ",
    ]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "ua string")
    by_rule = uag.parse_ua(F.col("ua")).alias("p")
    want = {r["ua"]: tuple(r["p"]) for r in df.select("ua", by_rule).collect()}

    def read(rules=None):
        return {r["ua"]: tuple(r["p"]) for r in uag.enrich_ua(df, F.col("ua"), "p", rules).collect()}

    assert read() == want
    more = spark.createDataFrame([
        ("ua_browser_family", 5, ["Foo/"], None, "Foo"),
        ("ua_browser_version", 5, ["Foo/"], r"(a\+b) Foo/([0-9_]+)", "v{2}"),
        ("ua_device_brand", 999, ["Foo/"], "no such", "Never"),
        ("ua_is_bot", 5, ["Foo/"], None, "true"),
    ], "field string, rank int, needles array<string>, pattern string, label string")
    got = read(uag.rule_table(spark).union(more))
    row = got.pop(texts[1])
    assert row == (*want[texts[1]][:5], "Foo", "v3.1", False, True)
    assert got == {k: v for k, v in want.items() if k != texts[1]}
    monkeypatch.setattr(uag, "BROADCAST_BYTES", 0)
    assert read() == want
    for bad in (("ua_colour", 1, ["x"], None, "y"), ("ua_is_bot", 1, [], None, "y"),
                ("ua_is_bot", None, ["x"], None, "y"), ("ua_is_bot", 1, ["x"], None, None)):
        with pytest.raises(ValueError):
            read(spark.createDataFrame([bad], more.schema))
    monkeypatch.setattr(uag, "MOST_RULES", 3)
    with pytest.raises(ValueError):
        read(more)
    empty = uag.enrich_ua(df.limit(0), F.col("ua"))
    assert empty.columns == ["ua", "parsed_ua"] and empty.count() == 0


def _flat(spark, data):
    return spark.createDataFrame(
        [((os, ua),) for os, ua in data], "device struct<os:string,ua:string>"
    )


def test_fraud_rules_treat_unknown_as_not_matching(spark):
    df = _flat(spark, [
        ("Linux", "sdk x86 lang:en"), ("Android", "sdk x86 lang:en"),
        ("Linux", "sdk x86 lang:ko"), (None, "sdk x86 lang:en"), ("Linux", None),
    ])
    assert br.fraud(df).count() == 1
    assert br.fraud(df, mode="any").count() == 5
    flags = br.with_rule_flags(df).select(*br.FRAUD_RULES).collect()
    assert all(v is not None for r in flags for v in r)
    assert br.expect_or_drop(df, "device.os = 'Linux'").count() == 3
    with pytest.raises(ValueError):
        br.fraud(df, mode="some")


def test_first_by_counts_null_keys_and_ties(spark, rows):
    df = spark.createDataFrame([("a", 2, 1), ("a", 1, 2), ("a", 1, 1), (None, 5, 1), (None, 4, 1)], "k string, t int, x int")
    assert rows(dd.first_by(df, ["k"], ["t", "x"])) == sorted([("a", 1, 1), (None, 4, 1)], key=lambda t: str(t[0]))


def _event(spark, kind, data):
    """Silver rows from (tid, minute, advertiser, price)."""
    columns = [
        F.expr("TIMESTAMP_NTZ'2024-01-01 10:00:00'").alias("Date"),
        F.expr("TIMESTAMP_NTZ'2024-01-01 10:00:00' + make_dt_interval(0, 0, minute, 0)").alias(f"{kind}time"),
        *[F.col("adv").alias(a) if a == "ad_adv" else F.lit("1").alias(a) for a in fn.ATTRIBUTES],
    ]
    if kind == "imp":
        columns.append(F.col("price").cast("decimal(13,10)").alias("Revenue"))
    df = spark.createDataFrame(data, "tid string, minute int, adv int, price double")
    return df.select(*columns, "tid")


def test_funnel_rows_join_on_attributes(spark, rows):
    bid = _event(spark, "bid", [("t1", 0, 1, 0.0), ("t1", 1, 1, 0.0), ("t2", 0, 1, 0.0), ("t3", 0, None, 0.0)])
    imp = _event(spark, "imp", [("t1", 5, 1, 0.5), ("t1", 6, 1, 9.0), ("t2", 5, 2, 0.5), ("t3", 5, None, 0.5)])
    clk = _event(spark, "clk", [("t1", 4, 1, 0.0), ("t2", 9, 1, 0.0)])
    got = {r["tid"]: r for r in fn.funnel_rows(bid, imp, clk).collect()}
    assert len(got) == 3
    assert got["t1"]["Revenue"] == Decimal("0.5") and got["t1"]["ITCT"] == -60
    # Another advertiser's impression is no match; the click still is one.
    assert got["t2"]["imptime"] is None and got["t2"]["Revenue"] is None
    assert got["t2"]["clktime"] is not None and got["t2"]["ITCT"] is None
    # NULL attributes never match.
    assert got["t3"]["imptime"] is None
    stats = ru.stat(fn.funnel_rows(bid, imp, clk)).where("ad_adv = 1").first()
    assert (stats["bid"], stats["imp"], stats["clk"]) == (2, 1, 2)


def test_funnel_agg_strict_needs_an_impression(spark):
    bid = _event(spark, "bid", [("t1", 0, 1, 0.0)])
    none = _event(spark, "imp", [("t9", 0, 7, 0.1)])
    clk = _event(spark, "clk", [("t1", 1, 1, 0.0)])
    assert fn.funnel_agg(bid, none, clk).first()["clk"] == 1
    assert fn.funnel_agg(bid, none, clk, strict_reference=True).first()["clk"] == 0


def test_hour_is_the_sum_of_its_buckets(spark, rows):
    import __spark_entry__ as entry

    sf = "/root/testdata/sf0.001"
    fine = entry.queries()["j1_funnel_5m"](spark, sf)
    total = fine.agg(F.sum("bid"), F.sum("imp"), F.sum("clk")).first()
    up = ru.rollup_up(fine, 60).agg(F.sum("bid"), F.sum("imp"), F.sum("clk")).first()
    assert tuple(total) == tuple(up)


def test_null_aware_anti_join(spark, rows):
    raw = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    known = spark.createDataFrame([(1,)], "k int")
    with_null = spark.createDataFrame([(1,), (None,)], "k int")
    nothing = known.where("false")
    assert rows(st.anti(raw, known, ["k"])) == [(2,), (None,)]
    assert rows(st.anti(raw, known, ["k"], null_aware=True)) == [(2,)]
    assert rows(st.anti(raw, with_null, ["k"], null_aware=True)) == []
    assert len(rows(st.anti(raw, nothing, ["k"], null_aware=True))) == 3
    with pytest.raises(ValueError):
        st.anti(raw.withColumn("j", F.lit(1)), raw, ["k", "j"], null_aware=True)


def test_overlay(spark, rows):
    raw = spark.createDataFrame(
        [(1, "a", 10), (1, "a", 11), (1, "b", 12), (2, "c", 20), (None, "d", 30)], "k int, name string, m int"
    )
    wash = spark.createDataFrame([(1, 99), (5, 55)], "k int, m int")
    got = rows(st.overlay(raw, wash, ["k"], ["name"], ["m"]), "k", "name", "m")
    assert got == [(1, "a", 99), (1, "b", 99), (2, "c", 20), (None, "d", 30)]
    same = rows(st.overlay(raw, wash.where("false"), ["k"], ["name"], ["m"]), "k", "name", "m")
    assert same == rows(raw)
    twice = wash.union(spark.createDataFrame([(1, 98), (None, 1), (None, 2)], "k int, m int"))
    with pytest.raises(Exception, match="more than one wash row"):
        st.overlay(raw, twice, ["k"], ["name"], ["m"]).collect()
    assert rows(st.overlay(raw, twice, ["k"], ["name"], ["m"], unique=False), "k", "name", "m") == got


def test_overlay_keys_of_other_types_and_nulls(spark, rows):
    raw = spark.createDataFrame(
        [(1, "x", "a", 10), (1, "x", "a", 11), (1, "x", None, 12), (1, "x", None, 13), (1, None, "a", 14), (1, None, "a", 14), (2, "y", "b", 20), (2, "y", "b", 20)],
        "k int, l string, name string, m int",
    )
    wash = spark.createDataFrame([(1, "x", 99), (1, None, 98), (3, "z", 97)], "k long, l string, m int")
    expected = [(1, None, "a", 14), (1, None, "a", 14), (1, "x", "a", 99), (1, "x", None, 99), (2, "y", "b", 20), (2, "y", "b", 20)]
    for other in (wash, wash.withColumn("k", F.col("k").cast("int")), wash.withColumn("k", F.col("k").cast("decimal(20,0)"))):
        assert sorted(map(str, rows(st.overlay(raw, other, ["k", "l"], ["name"], ["m"])))) == sorted(map(str, expected))
    lone = st.overlay(raw, wash.select("k", "m").where("m = 99"), ["k"], ["name"], ["m"])
    assert sorted(map(str, rows(lone))) == sorted(map(str, [(1, "a", 99), (1, None, 99), (2, "b", 20), (2, "b", 20)]))


def test_reconcile_sides(spark):
    a = spark.createDataFrame([("x", 1), ("x", 2), ("y", 5)], "k string, m int")
    b = spark.createDataFrame([("x", 3), ("z", 4)], "k string, m int")
    got = {r["k"]: (r["m_a"], r["m_b"], r["m_diff"], r["agrees"]) for r in st.reconcile(a, b, ["k"], ["m"]).collect()}
    assert got == {"x": (3, 3, 0, True), "y": (5, None, 5, False), "z": (None, 4, -4, False)}


def test_pivot_actions(spark):
    df = spark.createDataFrame(
        [(1, [("link_click", "3"), ("video_view", "7"), ("link_click", "5")]), (2, []), (3, None)],
        "id int, actions array<struct<action_type:string,value:string>>",
    )
    cols = web.pivot_actions("actions", ["link_click", "app_install"], "unique_")
    got = {r[0]: tuple(r[1:]) for r in df.select("id", *[c.alias(n) for n, c in cols.items()]).collect()}
    assert list(cols) == ["uniqueLinkClick", "uniqueAppInstall"]
    assert got == {1: ("5", None), 2: (None, None), 3: (None, None)}


def test_explode_daily_keeps_dates_in_place(spark, rows):
    df = spark.createDataFrame(
        [("a", [1, None, 3], [None, None, 5]), ("b", None, [9]), ("c", None, None)],
        "id string, imps array<bigint>, eng array<bigint>",
    )
    got = rows(web.explode_daily(df, ["id"], {"imps": "imps", "eng": "eng"}, "2024-02-28"))
    assert got == [
        ("a", date(2024, 2, 28), 1.0, 0.0), ("a", date(2024, 3, 1), 3.0, 5.0), ("b", date(2024, 2, 28), 0.0, 9.0),
    ]


def test_ga4_drops_events_without_parameters(spark):
    schema = (
        "event_date string, event_name string, event_timestamp bigint, user_pseudo_id string, user_id string, "
        "stream_id string, platform string, user_first_touch_timestamp bigint, device struct<category:string>, "
        "geo struct<region:string,city:string>, traffic_source struct<name:string,medium:string,source:string>, "
        "event_params array<struct<key:string,value:struct<string_value:string,int_value:bigint>>>"
    )
    base = ("20240101", "view", 1_704_067_200_000_000, "p", None, "s", "WEB", None, ("m",), ("r", "c"), (None, "x", "y"))
    df = spark.createDataFrame([
        (*base, [("campaign", ("a", None)), ("ga_session_id", (None, 3))]),
        (*base, [("campaign", ("b", None)), ("ga_session_id", (None, None))]),
        (*base[:1], "other", *base[2:], []),
    ], schema)
    out = web.ga4_flatten(df).collect()
    assert len(out) == 1
    assert (out[0]["campaign"], out[0]["ga_session_id"]) == ("b", 3)
    assert out[0]["event_time"] == datetime(2024, 1, 1, 9)


def test_profile_of_empty_and_duplicated_rows(spark):
    df = spark.createDataFrame(
        [("a", date(2024, 1, 1), None), ("a", date(2024, 1, 1), None), (None, date(2024, 1, 3), 1.0)],
        "k string, start_date date, v double",
    )
    row = ql.profile(df, ct.detect_date_col(df.schema), "2024-01-01", "2024-01-02").first()
    assert tuple(row) == (3, 2, 2, "2024-01-01", "2024-01-03", '{"k":1,"v":2}')
    empty = ql.profile(df.where("false"), "start_date", "2024-01-01", "2024-01-02").first()
    assert tuple(empty) == (0, 0, 0, None, None, '{"k":0,"v":0}')


def test_detect_date_col():
    schema = T.StructType.fromDDL("update_date int, segmentDate string, start timestamp_ntz")
    assert ct.detect_date_col(schema) == "segmentDate"
    assert ct.detect_date_col(T.StructType.fromDDL("a int")) is None


def test_cardinality_and_summary(spark):
    df = spark.createDataFrame([("a", "x", 1), ("b", "x", None), (None, "x", 3)], "p string, q string, n int")
    assert tuple(ru.cardinality(df).first()) == (2, 1)
    assert tuple(ru.cardinality(df, approx=True).first()) == (2, 1)
    got = {r["column"]: r for r in ql.summarize(df).collect()}
    assert (got["n"]["count"], got["n"]["nulls"], got["n"]["min"], got["n"]["mean"]) == (2, 1, "1", 2.0)


def test_quantiles_are_exact(spark, rng=random.Random(3)):
    values = [(rng.randrange(-500, 30_000) / 4, rng.choice([1, 1, 1, 2, 7])) for _ in range(40_003)]
    df = spark.createDataFrame([*values, (None, None), (float("nan"), None)], "a double, b int").withColumn("c", F.lit(None).cast("int"))
    shares = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {(r["column"], r["share"]): r["value"] for r in ql.quantiles(df, ["a", "b", "c"], shares).collect()}
    for c, own in (("a", sorted(v for v, _ in values) + [math.nan]), ("b", sorted(v for _, v in values))):
        for s in shares:
            want = own[max(math.ceil(len(own) * Fraction(str(s))), 1) - 1]
            assert got[c, s] == want or (math.isnan(want) and math.isnan(got[c, s]))
    assert len(got) == 2 * len(shares)


def test_the_grid_reaches_the_classifiers(spark):
    from pyspark.ml.feature import VectorAssembler

    rows = spark.range(60).selectExpr("CAST(id % 3 AS DOUBLE) AS label", "CAST(id % 7 AS DOUBLE) AS a", "CAST(id % 5 AS DOUBLE) AS b")
    table = VectorAssembler(inputCols=["a", "b"], outputCol=ml.FEATURES).transform(rows)
    for depth, n in ((1, 2), (2, 3)):
        best = ml.fit_gbt_cls(table, depths=(depth,), rounds=(n,), folds=2).bestModel
        assert [m.getNumTrees for m in best.models] == [n] * 3
        assert all(t.depth <= depth for m in best.models for t in m.trees)


def test_decode_codes_of_a_shared_key(spark, rows):
    df = spark.createDataFrame([("zero", [1, 9]), ("zero", [2]), ("zero", [2]), ("u", []), ("v", None)], "id string, a array<int>")
    codes = spark.createDataFrame([(1, "one"), (2, "two")], "code int, label string")
    got = rows(rc.decode_codes(df, ["id"], "a", codes, "names"))
    assert got == [("u", [], []), ("v", None, []), ("zero", [1, 9], ["one"]), ("zero", [2], ["two"])]


def test_jdbc_options():
    whole = rd.jdbc_options("jdbc:x", table="dbo.t", partition=("id", 0, 100, 4))
    assert whole == {
        "url": "jdbc:x", "dbtable": "dbo.t", "partitionColumn": "id", "lowerBound": "0",
        "upperBound": "100", "numPartitions": "4",
    }
    assert rd.jdbc_options("jdbc:x", query="SELECT 1", props={"user": "u"}) == {
        "url": "jdbc:x", "user": "u", "query": "SELECT 1"
    }
    with pytest.raises(ValueError):
        rd.jdbc_options("jdbc:x")
    with pytest.raises(ValueError):
        rd.jdbc_options("jdbc:x", query="SELECT 1", partition=("id", 0, 1, 2))


def test_schema_from_properties():
    schema = rd.schema_from_properties([("a b", "bigint"), ("c", "array<string>")])
    assert [f.name for f in schema.fields] == ["a b", "c"]


def test_diff_schemas():
    a = T.StructType.fromDDL("x int, s struct<p:string,q:double>, gone int")
    b = T.StructType.fromDDL("x bigint, s struct<p:string,q:string>, fresh int")
    assert ct.diff_schemas(a, b) == [
        ("x", "int", "bigint"), ("s.q", "double", "string"), ("gone", "int", None), ("fresh", None, "int"),
    ]


def test_airbridge_and_export_fields(spark):
    from adflow.reports.channels import AIRBRIDGE_METRICS

    ddl = "event_date string, channel string, " + ", ".join(f"{m} int" for m in AIRBRIDGE_METRICS)
    df = spark.createDataFrame([("2024-01-01", "x", *[None] * len(AIRBRIDGE_METRICS))], ddl)
    out = jn.airbridge_stats(df)
    assert "appDeferredDeeplinkInstalls" in out.columns and out.first()["costChannel"] == 0
    fields = spark.createDataFrame([("a", "y"), ("b", "n")], "dimension string, click string")
    assert jn.export_fields(spark.createDataFrame([(1, 2)], "a int, b int"), fields, "click").columns == ["a"]


def test_every_region_spelling_has_its_code(spark):
    table = rc.region_spellings()
    assert len(table) == 345 and len(set(table.values())) == 18
    df = spark.createDataFrame([(k.upper(), v) for k, v in table.items()], "r string, want string")
    assert rc.recode_region(df, "r", "c").where("NOT c <=> want").count() == 0
    some = {
        "KR": "KR-0", "11": "KR-11", "kr-26": "KR-26", "Gangnam-gu": "KR-11", "suwon": "KR-41", "kimje": "KR-45",
        "jeju city": "KR-49", "soeul": "KR-11", "north chungcheong": "KR-44", "cheorwon": "KR-42", "Cheorwon-gun": "KR-43",
        "ulchin": "KR-47", "yongam": "KR-43", "seoul_t'ukpyolsi": "KR-11", "juan-dong": "KR-28", "jinjeop-eup": "KR-41",
        "Suwon-si": None, "nowhere": None, "99": None, None: None,
    }
    df = spark.createDataFrame([(k,) for k in some], "r string")
    assert {r["r"]: r["c"] for r in rc.recode_region(df, "r", "c").collect()} == some



def test_costs_of_all_channels_have_one_unit(spark):
    from adflow.plans.report_queries import cross_channel_fact

    fact = cross_channel_fact(spark, "/root/testdata/sf0.001").where("cost > 0")
    means = {r["channel"]: r["m"] for r in fact.groupBy("channel").agg(F.avg("cost").alias("m")).collect()}
    paid = [means[c] for c in ("google_ad", "facebook_ad", "criteo", "kakao")]
    assert max(paid) / min(paid) < 2
    assert all(m < 1e6 for m in means.values())


def test_a_channel_comes_once_in_the_fact(spark):
    from adflow.reports import channels as ch
    from adflow.reports.engine import union_facts

    empty = spark.createDataFrame([], "a int")
    with pytest.raises(ValueError):
        union_facts([(empty, ch.GOOGLE_AD), (empty, ch.GOOGLE_KEYWORD)], "main")


def test_names_of_tables_in_messages(spark):
    from adflow.operators.eventlog import NAMED

    texts = {
        "Completed a streaming update of 'a_table_with_a_name_of_more_than_26_characters'.": "a_table_with_a_name_of_more_than_26_characters",
        "Completed a streaming update of  t1 and more": "t1", "nothing": "",
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r["t"]: r["n"] for r in df.select("t", F.regexp_extract("t", NAMED, 1).alias("n")).collect()} == texts


def test_category_weights_cover_many_values(spark):
    df = spark.range(3000).selectExpr("CAST(id % 1500 AS STRING) AS c")
    weights = ml.category_weights(df, "c").orderBy("low").collect()
    assert len(weights) == 1500 and weights[0]["low"] == 0 and weights[-1]["high"] == 3000
    assert all(a["high"] == b["low"] for a, b in zip(weights, weights[1:]))
    ids = spark.range(500)
    drawn = ml.draw_category(ids, "c", ml.category_weights(df, "c"), 3)
    assert drawn.count() == 500 and drawn.where("c IS NULL").count() == 0
    assert drawn.select("c").distinct().count() > 300


def test_a_changed_spec_shows_in_its_check(spark, monkeypatch):
    import dataclasses

    from adflow.plans import report_queries as rq
    from check_oracle import compare, connect

    sf = "/root/testdata/sf0.001"
    spec, sql = rq.ch.GOOGLE_SEARCH_TERM, rq.ORACLES["c3_google_search_term"]
    run = lambda own: compare(rq.normalize_report(rq.google_landed(spark, sf), own), connect(sf), sql)
    assert run(spec) is None
    assert run(dataclasses.replace(spec, fields={**spec.fields, "clicks": "metrics.impressions"})) is not None
    assert run(dataclasses.replace(spec, equal={"segments.conversion_action_name": ("purchase",)})) is not None
