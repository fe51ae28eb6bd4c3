"""Advertising views over the driver tables.

The column expressions are written in the SQL both Spark and DuckDB read, so
that the Spark view and its twin in the check SQL share one definition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

KIND_OF = {"bid": "view", "imp": "click", "clk": "purchase"}

HEAD = {
    "tid": "concat(CAST(user_id AS STRING), '-', replace(CAST(CAST(ts AS DATE) AS STRING), '-', ''))",
    "actiontime_local": "ts",
    "actiontime_date": "CAST(ts AS DATE)",
    "actiontime_hour": "CAST(hour(ts) AS INT)",
}

# Payload fields, by the name they carry in a report.
FULL = {
    "AdExchangeTypes": "4",
    "ad_adv": "CAST(user_id % 5 AS INT)",
    "PubId": "CAST(user_id % 13 AS INT)",
    "ad_grp": "CAST(user_id % 11 AS INT)",
    "Width": "320",
    "Height": "CASE WHEN user_id % 2 = 0 THEN 50 ELSE 480 END",
    "ad_crt": "CAST(user_id % 4 AS INT)",
    "url": "concat('app.', CAST(user_id % 17 AS STRING))",
    "InventoryIdx": "CAST(user_id % 3 AS INT)",
    "ad_cam": "CAST(user_id % 7 AS INT)",
    "UserId": "user_id",
    "DeviceId": "concat('d', CAST(user_id AS STRING))",
}
# Short windows find few matching groups with every dimension; see FIXTURES.
COARSE = {
    **FULL,
    "ad_adv": "CAST(user_id % 3 AS INT)",
    "PubId": "1",
    "ad_grp": "1",
    "Height": "50",
    "url": "'app.0'",
    "InventoryIdx": "1",
    "ad_cam": "1",
}
PRICE = "CAST(value / 1000 AS DECIMAL(13,10))"

# User agents, and what they have to be read as: device brand, family and model, operating system
# and its version, browser and its version, mobile, bot.
AGENT_FIELDS = (
    "ua_device_brand", "ua_device_family", "ua_device_model", "ua_os_family", "ua_os_version",
    "ua_browser_family", "ua_browser_version", "ua_is_mobile", "ua_is_bot",
)
AGENTS = [
    ("Mozilla/5.0 (Linux; Android 10; SM-G960N) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/96.0.4664.45 Mobile Safari/537.36",
     "Samsung", "Samsung SM-G960N", "SM-G960N", "Android", "10", "Chrome Mobile", "96.0.4664", True, False),
    ("Mozilla/5.0 (iPhone; CPU iPhone OS 15_2 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/15.2 Mobile/15E148 Safari/604.1",
     "Apple", "iPhone", "iPhone", "iOS", "15.2", "Mobile Safari", "15.2", True, False),
    ("Mozilla/5.0 (Linux; Android 11; LM-Q730N) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/108.0.5359.79 Safari/537.36",
     "LG", "LM-Q730N", "LM-Q730N", "Android", "11", "Chrome", "108.0.5359", True, False),
    ("Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/110.0.0.0 Safari/537.36",
     "Unknown", "Other", "Unknown", "Windows", "10", "Chrome", "110.0.0", False, False),
    ("Dalvik/2.1.0 (Linux; U; Android 9; sdk_gphone_x86 Build/PSR1) lang:en",
     "Generic_Android", "sdk_gphone_x86", "sdk_gphone_x86", "Android", "9", "Android", "9", True, False),
    ("Mozilla/5.0 (iPad; CPU OS 14_8 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Mobile/15E148",
     "Apple", "iPad", "iPad", "iOS", "14.8", "Mobile Safari UI/WKWebView", "", True, False),
    ("sdk_phone_x86 lang:en", "Unknown", "Other", "Unknown", "Other", "", "Other", "", False, False),
    ("Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/16.1 Safari/605.1.15",
     "Apple", "Mac", "Mac", "Mac OS X", "10.15.7", "Safari", "16.1", False, False),
    ("Mozilla/5.0 (compatible; Googlebot/2.1; +http://www.google.com/bot.html)",
     "Spider", "Spider", "Desktop", "Other", "", "Googlebot", "2.1", False, True),
    ("Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/109.0.0.0 Safari/537.36 Edg/109.0.1518.61",
     "Unknown", "Other", "Unknown", "Windows", "10", "Edge", "109.0.1518", False, False),
    ("Mozilla/5.0 (Linux; Android 12; SAMSUNG SM-S908N) AppleWebKit/537.36 (KHTML, like Gecko) SamsungBrowser/19.0 Chrome/102.0.5005.125 Mobile Safari/537.36",
     "Samsung", "SAMSUNG SM-S908N", "SAMSUNG SM-S908N", "Android", "12", "Samsung Internet", "19.0", True, False),
    ("Mozilla/5.0 (X11; Ubuntu; Linux x86_64; rv:109.0) Gecko/20100101 Firefox/110.0",
     "Unknown", "Other", "Unknown", "Ubuntu", "", "Firefox", "110.0", False, False),
    ("Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/108.0.0.0 Safari/537.36 OPR/94.0.0.0",
     "Unknown", "Other", "Unknown", "Windows", "10", "Opera", "94.0.0", False, False),
    ("Mozilla/5.0 (X11; CrOS x86_64 14541.0.0) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/110.0.0.0 Safari/537.36",
     "Unknown", "Other", "Unknown", "Chrome OS", "14541.0.0", "Chrome", "110.0.0", False, False),
    ("Mozilla/5.0 (iPhone; CPU iPhone OS 16_1 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Mobile/15E148 KAKAOTALK 10.0.5",
     "Apple", "iPhone", "iPhone", "iOS", "16.1", "KakaoTalk", "10.0.5", True, False),
    ("Twitterbot/1.0", "Spider", "Spider", "Desktop", "Other", "", "Twitterbot", "1.0", False, True),
]


def agent_case(column: str) -> str:
    """A column of ``AGENTS`` by user; every seventeenth user has no agent."""
    def text(value) -> str:
        return str(value).lower() if isinstance(value, bool) else "'" + value + "'"

    number = ("ua", *AGENT_FIELDS).index(column)
    missing = "NULL" if column == "ua" else "false" if "is_" in column else "'Unknown'"
    whens = " ".join(f"WHEN {k} THEN {text(a[number])}" for k, a in enumerate(AGENTS))
    return f"CASE CAST(user_id % {len(AGENTS) + 1} AS INT) {whens} ELSE {missing} END"


# Request part of the payload.
REQUEST = {
    "bundle": "concat('app.', CAST(user_id % 17 AS STRING))",
    "ua": agent_case("ua"),
    "os": (
        "CASE CAST(user_id % 10 AS INT) WHEN 0 THEN 'Android' WHEN 1 THEN 'iOS' WHEN 2 THEN 'android'"
        " WHEN 3 THEN 'Windows' WHEN 4 THEN 'Linux' WHEN 5 THEN 'ios' WHEN 6 THEN 'unknown' WHEN 7 THEN 'macOS'"
        " WHEN 8 THEN 'Android' ELSE NULL END"
    ),
    "osv": "CAST(user_id % 6 + 8 AS STRING)",
    "model": "concat('M', CAST(user_id % 9 AS STRING))",
    "make": "CASE WHEN user_id % 2 = 0 THEN 'Samsung' ELSE 'Apple' END",
    "devicetype": "CAST(user_id % 9 AS STRING)",
    "ip": "concat('10.0.', CAST(user_id % 256 AS STRING), '.1')",
    "pxratio": "CAST(user_id % 4 AS INT)",
    "country": "'KOR'",
    "region": (
        "CASE CAST(user_id % 12 AS INT) WHEN 0 THEN '11' WHEN 1 THEN 'Seoul' WHEN 2 THEN 'KR-26'"
        " WHEN 3 THEN 'busan' WHEN 4 THEN 'KR' WHEN 5 THEN 'Jeju-do' WHEN 6 THEN 'nowhere'"
        " WHEN 7 THEN 'Gangnam-gu' WHEN 8 THEN 'suwon' WHEN 9 THEN 'Jeju City'"
        " WHEN 10 THEN 'North Chungcheong' ELSE NULL END"
    ),
    "lat": "CAST(user_id % 90 AS DOUBLE)",
    "lon": "CAST(user_id % 180 AS DOUBLE) / 4",
    "tagid": "concat('tag', CAST(user_id % 6 AS STRING))",
    "bidfloor": "CAST(value / 100 AS DOUBLE)",
    "bid_price": "CAST(value / 500 AS DECIMAL(13,10))",
    "bidrequest_type": "CAST(user_id % 5 AS INT)",
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def exprs(columns: dict[str, str]) -> list[str]:
    """Texts for ``selectExpr``: one call for all columns."""
    return [f"{text} AS `{name}`" for name, text in columns.items()]


def struct_text(fields: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"'{n}', {e}" for n, e in fields.items()) + ")"


def sql_cols(columns: dict[str, str]) -> str:
    return ", ".join(f"{text} AS {name}" for name, text in columns.items())


def bronze(spark: SparkSession, sf_dir: str, kind: str, coarse: bool = False) -> DataFrame:
    """Nested event rows, the way they arrive from the exchange."""
    e = {**(COARSE if coarse else FULL), **REQUEST}
    pick = lambda *names: {n: e[n] for n in names}
    banner = struct_text({"w": e["Width"], "h": e["Height"]})
    request = struct_text({
        "app": struct_text(pick("bundle")),
        "imp": f"array({struct_text({'banner': banner, **pick('tagid')})})",
        "device": struct_text({
            **pick("ua", "os", "osv", "model", "make", "devicetype", "ip", "pxratio"),
            "geo": struct_text(pick("country", "region", "lat", "lon")),
        }),
    })
    payload = struct_text({
        **pick("AdExchangeTypes", "ad_adv"), "ad_imp": e["PubId"], **pick("ad_grp"),
        "w": e["Width"], "h": e["Height"], **pick("ad_crt"), "bundle_domain": e["url"],
        **pick("InventoryIdx", "ad_cam", "UserId", "DeviceId"), "win_price": PRICE,
        **pick("bidfloor", "bid_price", "bidrequest_type"), "request": request,
    })
    events = read(spark, sf_dir, "events").where(f"event_type = '{KIND_OF[kind]}'")
    return events.selectExpr(*exprs({**HEAD, "BidStream": payload}))


def flat_sql(kind: str, columns: dict[str, str], extra: str = "") -> str:
    """SELECT text of a flat event view for the check SQL."""
    return f"SELECT {sql_cols(columns)} FROM events WHERE event_type = '{KIND_OF[kind]}' {extra}"


def silver_sql(kind: str, bucket: str, coarse: bool = False) -> str:
    """Twin of ``silver``: report names and a bucket column ``Date``."""
    columns = {
        "Date": bucket,
        f"{kind}time": "ts",
        **(COARSE if coarse else FULL),
        **({"Revenue": PRICE} if kind == "imp" else {}),
        "tid": HEAD["tid"],
    }
    return flat_sql(kind, columns)


def first_sql(view: str, kind: str, keys: str = '"Date", tid') -> str:
    return (
        f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys} "
        f"ORDER BY {kind}time, UserId, url) AS rn FROM {view}) WHERE rn = 1"
    )


# Ad report: line items joined with their orders.
REPORT = {
    "segmentsDate": "CAST(CAST(l_shipdate AS DATE) AS STRING)",
    "customerId": "o_custkey",
    "campaignId": "CAST(o_custkey % 50 AS BIGINT)",
    "campaignName": "concat('campaign ', CAST(o_custkey % 50 AS STRING))",
    "adgroupId": "CAST(l_partkey % 40 AS BIGINT)",
    "adgroupName": "concat('group ', CAST(l_partkey % 40 AS STRING))",
    "adId": "l_suppkey",
    "adName": "concat('ad ', CAST(l_suppkey AS STRING))",
    "impressions": "CAST(l_quantity * 10 AS BIGINT)",
    "clicks": "CAST(l_quantity AS BIGINT)",
    "costMicros": "CAST(round(l_extendedprice * 100) AS BIGINT) * 10000",
    "conversions": "CAST(round(l_discount * 100) AS BIGINT)",
    "deviceCode": "CAST(l_linenumber AS INT)",
    "networkType": "CAST(l_partkey % 8 AS INT)",
    "labelCode": "CASE l_returnflag WHEN 'R' THEN 4 WHEN 'A' THEN 5 ELSE 6 END",
    "status": "l_returnflag",
    "rowNo": "CAST(l_orderkey * 10 + l_linenumber AS BIGINT)",
}


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).selectExpr(*exprs(REPORT))


REPORT_SQL = (
    f"SELECT {sql_cols(REPORT)} FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
)
