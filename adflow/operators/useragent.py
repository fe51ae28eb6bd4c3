"""User agent families by ordered rules.

The rules are a table: ``field``, ``rank``, ``needles``, ``pattern``, ``label``. Of the rules
of a field that match an agent the one with the least rank gives the value, so a family is a
row. ``enrich_ua`` reads every distinct agent once against the table and joins the result
back. ``parse_ua`` is the default table as one JVM expression, for streams, in which distinct
agents cannot be told. Neither runs Python on rows.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adflow.operators.skew import staged

UNKNOWN = "Unknown"

# A rule is (needles, pattern, label). One of the needles has to occur, which is
# a cheap test; then the pattern, if any, has to match. {1} is its first group, {2} its second.
BOTS = (
    "Googlebot", "bingbot", "Yeti", "AdsBot", "facebookexternalhit", "Applebot", "YandexBot",
    "Baiduspider", "DuckDuckBot", "Twitterbot", "AhrefsBot", "SemrushBot", "PetalBot", "Bytespider",
    "Slurp", "Daum/",
)
APPLE_MOBILE = ("iPhone", "iPad", "iPod")
ANDROID = ("Android",)
ANDROID_MODEL = r"Android[^;)]*; ([^;)]+?)(?: Build|\))"
BOT_NAME = (
    r"(Googlebot|bingbot|Yeti|AdsBot|facebookexternalhit|Applebot|YandexBot|Baiduspider|"
    r"DuckDuckBot|Twitterbot|AhrefsBot|SemrushBot|PetalBot|Bytespider|Slurp|Daum)"
)

DEVICE_BRAND = (
    (BOTS, None, "Spider"),
    ((*APPLE_MOBILE, "Macintosh"), None, "Apple"),
    (ANDROID, r"Android[^;)]*; (?:SM-|SHV-|SAMSUNG)", "Samsung"),
    (ANDROID, r"Android[^;)]*; (?:LM-|LG-)", "LG"),
    (ANDROID, r"Android[^;)]*; Pixel", "Google"),
    (ANDROID, None, "Generic_Android"),
)
DEVICE_MODEL = (
    (BOTS, None, "Desktop"),
    (APPLE_MOBILE, r"(iPhone|iPad|iPod)", "{1}"),
    (("Macintosh",), None, "Mac"),
    (ANDROID, ANDROID_MODEL, "{1}"),
)
DEVICE_FAMILY = (
    (BOTS, None, "Spider"),
    (APPLE_MOBILE, r"(iPhone|iPad|iPod)", "{1}"),
    (("Macintosh",), None, "Mac"),
    (ANDROID, r"Android[^;)]*; (SM-[^;)]+?|SHV-[^;)]+?)(?: Build|\))", "Samsung {1}"),
    (ANDROID, ANDROID_MODEL, "{1}"),
)
OS_FAMILY = (
    (APPLE_MOBILE, None, "iOS"),
    (ANDROID, None, "Android"),
    (("Windows",), None, "Windows"),
    (("Mac OS X",), None, "Mac OS X"),
    (("CrOS",), None, "Chrome OS"),
    (("Ubuntu",), None, "Ubuntu"),
    (("Linux",), None, "Linux"),
)
OS_VERSION = (
    (("iPhone OS ", "CPU OS "), r"(?:iPhone OS|CPU OS) ([0-9_]+)", "{1}"),
    (ANDROID, r"Android ([0-9.]+)", "{1}"),
    (("Windows NT ",), r"Windows NT ([0-9]+)", "{1}"),
    (("Mac OS X ",), r"Mac OS X ([0-9_]+)", "{1}"),
    (("CrOS ",), r"CrOS [a-z0-9_]+ ([0-9.]+)", "{1}"),
)
# Browsers built on another name it, so theirs comes first.
BROWSER_FAMILY = (
    (BOTS, BOT_NAME, "{1}"),
    (("KAKAOTALK",), None, "KakaoTalk"),
    (("NAVER(",), None, "NAVER"),
    (("Instagram",), None, "Instagram"),
    (("FBAN", "FBAV"), None, "Facebook"),
    (("EdgA/", "EdgiOS/"), None, "Edge Mobile"),
    (("Edg/", "Edge/"), None, "Edge"),
    (("SamsungBrowser/",), None, "Samsung Internet"),
    (("Whale/",), None, "Whale"),
    (("OPR/",), r"Android.*OPR/", "Opera Mobile"),
    (("OPR/", "Opera/"), None, "Opera"),
    (("FxiOS/",), None, "Firefox iOS"),
    (("Firefox/",), r"(?:Android|Mobile).*Firefox/", "Firefox Mobile"),
    (("Firefox/",), None, "Firefox"),
    (("CriOS/",), None, "Chrome Mobile iOS"),
    (("Chrome/",), r"; wv\).*Chrome/", "Chrome Mobile WebView"),
    (("Chrome/",), r"Chrome/[0-9.]+ Mobile", "Chrome Mobile"),
    (("Chrome/",), None, "Chrome"),
    (("Safari",), r"Version/[0-9.]+ Mobile/[0-9A-Z]+ Safari", "Mobile Safari"),
    (APPLE_MOBILE, r"(?:iPhone|iPad|iPod).*Mobile/", "Mobile Safari UI/WKWebView"),
    (("Safari",), r"Version/[0-9.]+ Safari", "Safari"),
    (("MSIE ", "Trident/"), None, "IE"),
    (("Dalvik", "Android"), None, "Android"),
)
BROWSER_VERSION = (
    (BOTS, BOT_NAME + r"/([0-9.]+)", "{2}"),
    (("KAKAOTALK",), r"KAKAOTALK[ /]([0-9]+(?:\.[0-9]+)*)", "{1}"),
    (("Instagram",), r"Instagram ([0-9]+\.[0-9]+\.[0-9]+)", "{1}"),
    (("FBAV/",), r"FBAV/([0-9]+\.[0-9]+\.[0-9]+)", "{1}"),
    (("Edg", "Whale/", "OPR/", "SamsungBrowser/"),
     r"(?:EdgA|EdgiOS|Edge|Edg|Whale|OPR|SamsungBrowser)/([0-9]+(?:\.[0-9]+){0,2})", "{1}"),
    (("FxiOS/", "Firefox/"), r"(?:FxiOS|Firefox)/([0-9]+(?:\.[0-9]+)*)", "{1}"),
    (("CriOS/", "Chrome/"), r"(?:CriOS|Chrome)/([0-9]+\.[0-9]+\.[0-9]+)", "{1}"),
    (("Version/",), r"Version/([0-9.]+)", "{1}"),
    (ANDROID, r"Android ([0-9.]+)", "{1}"),
)
MOBILE = (*APPLE_MOBILE, "Android")

FIELDS = {
    "ua_device_brand": (DEVICE_BRAND, UNKNOWN),
    "ua_device_family": (DEVICE_FAMILY, "Other"),
    "ua_device_model": (DEVICE_MODEL, UNKNOWN),
    "ua_os_family": (OS_FAMILY, "Other"),
    "ua_os_version": (OS_VERSION, ""),
    "ua_browser_family": (BROWSER_FAMILY, "Other"),
    "ua_browser_version": (BROWSER_VERSION, ""),
}


def _has(ua: Column, needles: tuple) -> Column:
    found = ua.contains(needles[0])
    for needle in needles[1:]:
        found = found | ua.contains(needle)
    return found


def _value(ua: Column, pattern: str | None, label: str) -> Column:
    """The label when the pattern matches, else NULL. A group is matched once."""
    if pattern is None:
        return F.lit(label)
    number = next((n for n in (1, 2) if f"{{{n}}}" in label), None)
    if number is None:
        return F.when(ua.rlike(pattern), label)
    group = F.nullif(F.regexp_extract(ua, pattern, number), F.lit(""))
    return F.concat(F.lit(label.replace(f"{{{number}}}", "")), group)


def _pick(ua: Column, rules: tuple, missing: str) -> Column:
    hits = [F.when(_has(ua, needles), _value(ua, pattern, label)) for needles, pattern, label in rules]
    return F.when(ua.isNull(), UNKNOWN).otherwise(F.coalesce(*hits, F.lit(missing)))


def parse_ua(ua: Column) -> Column:
    """Struct of device, OS and browser; a missing agent gives 'Unknown' and false."""
    fields = []
    for name, (rules, missing) in FIELDS.items():
        value = _pick(ua, rules, missing)
        if name.endswith("version"):
            value = F.replace(value, F.lit("_"), F.lit("."))
        fields.append(value.alias(name))
    fields.append(F.coalesce(_has(ua, MOBILE), F.lit(False)).alias("ua_is_mobile"))
    fields.append(F.coalesce(_has(ua, BOTS), F.lit(False)).alias("ua_is_bot"))
    return F.struct(*fields)


BOOLEANS = {"ua_is_mobile": MOBILE, "ua_is_bot": BOTS}
RULE_TYPE = pa.schema([
    ("field", pa.string()), ("rank", pa.int32()), ("needles", pa.list_(pa.string())),
    ("pattern", pa.string()), ("label", pa.string()),
])
# A rule table travels to every task and meets every distinct agent.
MOST_RULES = 10_000
# Parsed agents up to this size go to every task; beyond it both sides are shuffled.
BROADCAST_BYTES = 64 << 20


def rule_table(spark: SparkSession) -> DataFrame:
    """The default rules. Ranks are ten apart: a new family's row fits between any two."""
    rows = [
        (field, 10 * place, list(needles), pattern, label)
        for field, (rules, _) in FIELDS.items()
        for place, (needles, pattern, label) in enumerate(rules, 1)
    ] + [(field, 10, list(needles), None, "true") for field, needles in BOOLEANS.items()]
    table = pa.Table.from_pylist([dict(zip(RULE_TYPE.names, r)) for r in rows], RULE_TYPE)
    return spark.createDataFrame(table)


def _rule_value(ua: Column) -> Column:
    """What the rule at hand says about the agent; NULL where its pattern does not match."""
    label, pattern = F.col("label"), F.col("pattern")
    group = F.when(label.contains("{1}"), 1).when(label.contains("{2}"), 2)
    found = F.nullif(F.call_function("regexp_extract", ua, pattern, group), F.lit(""))
    plain = F.when(pattern.isNull() | F.rlike(ua, pattern), label)
    return F.when(group.isNull(), plain).otherwise(
        F.replace(label, F.concat(F.lit("{"), group.cast("string"), F.lit("}")), found))


def parse_agents(agents: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """``__ua`` and the struct ``__parsed`` for distinct, non-null agents in ``__ua``.

    One join to the rules on their needles, one fold per agent. Rules of one field with the
    same rank: the least value counts. A rule without needles, or with an unknown field, is
    an error, and so are more than ``MOST_RULES`` rules.
    """
    if rules is None:
        rules = rule_table(agents.sparkSession)
    else:
        _check_rules(rules)
    near = F.exists("needles", lambda needle: F.col("__ua").contains(needle))
    met = agents.join(F.broadcast(rules.select(RULE_TYPE.names)), near, "left").select(
        "__ua", "field", "rank", _rule_value(F.col("__ua")).alias("value"))
    best = {
        field: F.min(F.when((F.col("field") == field) & F.col("value").isNotNull(),
                            F.struct("rank", "value")))["value"].alias(field)
        for field in (*FIELDS, *BOOLEANS)
    }
    fields = []
    for field, (_, missing) in FIELDS.items():
        value = F.coalesce(field, F.lit(missing))
        value = F.replace(value, F.lit("_"), F.lit(".")) if field.endswith("version") else value
        fields.append(value.alias(field))
    fields += [F.col(field).isNotNull().alias(field) for field in BOOLEANS]
    return met.groupBy("__ua").agg(*best.values()).select("__ua", F.struct(*fields).alias("__parsed"))


def _check_rules(rules: DataFrame) -> None:
    known = F.col("field").isin(*FIELDS, *BOOLEANS)
    bad = ~F.coalesce(known & (F.size("needles") > 0), F.lit(False)) | (
        F.col("rank").isNull() | F.col("label").isNull())
    n, wrong = rules.agg(F.count(F.lit(1)), F.count_if(bad)).first()
    if wrong:
        raise ValueError(f"{wrong} user agent rules lack needles, rank or label, or name an unknown field")
    if n > MOST_RULES:
        raise ValueError(f"{n} user agent rules; at most {MOST_RULES}")


def _missing() -> Column:
    """A missing agent: 'Unknown' and false."""
    return F.struct(*[F.lit(UNKNOWN).alias(f) for f in FIELDS],
                    *[F.lit(False).alias(f) for f in BOOLEANS])


def agent_table(df: DataFrame, ua: Column, rules: DataFrame | None = None) -> DataFrame:
    """The distinct agents of ``df``, each parsed once, written to the shared folder.

    So their size is known: up to ``BROADCAST_BYTES`` they go to the rows, beyond it both sides
    are shuffled by agent and a hot agent's rows are split by adaptive execution.
    """
    agents = df.select(ua.alias("__ua")).where("__ua IS NOT NULL").distinct()
    parsed = staged(parse_agents(agents, rules), "agents")
    size = sum((F.octet_length(F.col("__parsed")[f]) for f in FIELDS), F.octet_length("__ua") + 64)
    total = parsed.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(parsed) if total <= BROADCAST_BYTES else parsed


def enrich_ua(df: DataFrame, ua: Column, name: str = "parsed_ua", rules: DataFrame | None = None,
              agents: DataFrame | None = None) -> DataFrame:
    """``df`` with the struct ``name`` of device, OS and browser.

    ``agents`` is an ``agent_table`` that has all agents of ``df``, where there is one already.
    """
    side = agent_table(df, ua, rules) if agents is None else agents
    return df.withColumn("__ua", ua).join(side, "__ua", "left").select(
        *[F.col(f"`{c}`") for c in df.columns], F.coalesce("__parsed", _missing()).alias(name))
