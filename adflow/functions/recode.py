"""Code tables, and replacing codes by labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import cache
from importlib import resources

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Labels of report codes; the position is the code.
SEGMENT_DEVICE = ("0", "1", "Mobile Phones", "Tablets", "Computers", "5", "6", "7")
NETWORK_TYPE = ("0", "1", "Search", "Search", "Display", "Search", "Youtube", "7")
PERFORMANCE_LEVEL = ("0", "-", "2", "Learning", "Low", "Good", "Best")
ASSET_TYPE = (
    "0", "1", "YouTube video", "3", "4", "Text", "6", "7", "8", "9", "10", "11", "12", "13", "14",
    "15", "16", "17", "18", "19", "20", "21", "22", "23", "24", "25", "26",
)
ASSET_FIELD_TYPE = (
    "0", "1", "Headline", "Description", "4", "5", "6", "YouTube video", "8", "9", "10", "11", "12",
    "13", "14", "15", "16", "17", "18", "19", "20", "21", "22", "23", "24", "25", "26",
)

# Device type codes of bid requests.
DEVICE_TYPE = {
    "1": "Mobile/Tablet",
    "2": "PC",
    "3": "Connected TV",
    "4": "Phone",
    "5": "Tablet",
    "6": "Connected Device",
    "7": "Set Top Box",
}

# Operating system and banner size classes of the training set.
OS_CLASS = {"android": "1", "ios": "2", "unknown": "4"}
SIZE_CLASS = {(320, 480): "1", (320, 50): "2"}

# App store categories, in English and Korean, by class. The first
# table compares without blanks, the second as written. "Art & Design" shares
# the class of games; the labels it came from have it that way.
APP_CATEGORY_SQUEEZED = {
    "1": ("Books&Reference", "도서/참고자료", "도서"),
    "2": ("Business", "비즈니스"),
    "3": ("Tools", "도구", "Libraries&Demo", "라이브러리/데모", "개발자도구"),
    "4": ("Education", "학습", "교육"),
    "5": ("Entertainment", "엔터테인먼트"),
    "6": ("Finance", "금융"),
    "7": ("Food&Drink", "식음료", "음식및음료"),
    "8": (
        "Action", "액션", "Adventure", "어드벤처", "Arcade", "아케이드", "Board", "보드",
        "Bubbleshooter", "Card", "카드", "Casino", "카지노", "Casual", "캐주얼게임", "캐주얼",
        "Educational", "Multiplayer", "Music", "Puzzle", "퍼즐", "Racing", "자동차경주", "레이싱",
        "RolePlaying", "롤플레잉", "Simulation", "시뮬레이션", "Singleplayer", "싱글플레이어",
        "Sports", "Strategy", "전략", "Stylized", "Trivia", "Tycoon", "Word", "단어", "퀴즈", "게임",
    ),
}
APP_CATEGORY_VERBATIM = {
    "8": ("Art & Design", "예술/디자인", "그래픽 및 디자인"),
    "9": ("Health & Fitness", "건강/운동", "건강 및 피트니스"),
    "10": ("Lifestyle", "라이프 스타일", "라이프스타일"),
    "11": ("News & Magazines", "뉴스", "뉴스/잡지", "뉴스 및 잡지"),
    "12": ("Medical", "의료"),
    "13": ("Music & Audio", "음악/오디오", "음악"),
    "14": ("Navigation", "Maps & Navigation", "지도/내비게이션", "내비게이션"),
    "15": ("Photography", "사진", "Video Players & Editors", "동영상 플레이어/편집기", "사진 및 비디오"),
    "16": ("Productivity", "참고", "생산성"),
    "17": ("Shopping", "쇼핑"),
    "18": ("Social", "소셜", "스티커", "소셜 네트워킹"),
    "19": ("Sports", "스포츠"),
    "20": ("Travel & Local", "여행 및 지역정보", "여행"),
    "21": ("Personalization", "맞춤 설정", "유틸리티"),
    "22": ("Weather", "날씨"),
    "23": ("Auto & Vehicles", "자동차", "자동차 및 차량"),
    "24": ("Beauty", "뷰티"),
    "25": ("Comics", "만화"),
    "26": ("Communications", "Communication", "커뮤니케이션"),
    "27": ("Dating", "데이트"),
    "28": ("Events", "이벤트", "예약 및 예매"),
    "29": ("House & Home", "부동산/홈 인테리어", "부동산 및 인테리어"),
    "30": ("Parenting", "출산/육아", "육아"),
}

# Region spellings and their codes, as bid requests have them; lower case.
REGION_SPELLINGS = "functions/region_spellings.csv"


def by_position(code: Column, labels: Sequence[str]) -> Column:
    """Label at an integer code; NULL outside the list."""
    return F.get(F.array(*[F.lit(x) for x in labels]), code)


def lookup(spark: SparkSession, table: Mapping[str, str], key: str, value: str) -> DataFrame:
    """A fixed code table as a local relation (its size is known when it is built)."""
    return spark.createDataFrame(
        pa.table({key: list(table), value: list(table.values())})
    )


def recode(
    df: DataFrame,
    column: str,
    table: Mapping[str, str],
    out: str,
    default: Column | None = None,
) -> DataFrame:
    """Replace codes by a fixed table. Codes outside it take ``default``.

    The table is program text, hence bounded, and is broadcast.
    """
    spark = df.sparkSession
    codes = lookup(spark, table, "__code", "__label")
    joined = df.join(F.broadcast(codes), F.col(column) == F.col("__code"), "left")
    label = F.col("__label") if default is None else F.coalesce("__label", default)
    return joined.withColumn(out, label).drop("__code", "__label")


def _inverted(groups: Mapping[str, Sequence[str]]) -> dict[str, str]:
    out: dict[str, str] = {}
    for code, spellings in groups.items():
        for spelling in spellings:
            out.setdefault(spelling, code)
    return out


def app_category(df: DataFrame, column: str, out: str) -> DataFrame:
    """App store category to its class; unknown ones keep their text without blanks."""
    squeezed = F.replace(F.col(column), F.lit(" "), F.lit(""))
    step = recode(
        df.withColumn("__squeezed", squeezed), "__squeezed",
        _inverted(APP_CATEGORY_SQUEEZED), "__first",
    )
    step = recode(step, column, _inverted(APP_CATEGORY_VERBATIM), "__second")
    label = F.coalesce("__first", "__second", "__squeezed")
    return step.withColumn(out, label).drop("__squeezed", "__first", "__second")


@cache
def region_spellings() -> dict[str, str]:
    """The fixed table of region spellings, spelling to code."""
    text = resources.files("adflow").joinpath(REGION_SPELLINGS).read_text(encoding="utf-8")
    return dict(line.split(",") for line in text.splitlines()[1:])


def recode_region(
    df: DataFrame, column: str, out: str, spellings: DataFrame | None = None
) -> DataFrame:
    """Region code of a spelling in any case; NULL for one that no table has.

    An optional table ``(spelling, code)`` of the user's comes before the fixed one. It may have
    any size: no broadcast is forced.
    """
    lowered = df.withColumn("__region", F.lower(F.col(column)))
    fixed = recode(lowered, "__region", region_spellings(), out)
    if spellings is None:
        return fixed.drop("__region")
    table = spellings.select(
        F.lower("spelling").alias("__spelling"), F.col("code").alias("__own")
    ).dropDuplicates(["__spelling"])
    joined = fixed.join(table, F.col("__region") == F.col("__spelling"), "left")
    return joined.withColumn(out, F.coalesce("__own", out)).drop("__region", "__spelling", "__own")


def device_type(df: DataFrame, column: str, out: str) -> DataFrame:
    return recode(df, column, DEVICE_TYPE, out, default=F.col(column))


def os_class(os: Column) -> Column:
    """Class of a lower-cased OS name; other names are '3', NULL stays NULL."""
    out = F.when(os.isNull(), F.lit(None))
    for name, code in OS_CLASS.items():
        out = out.when(os == name, code)
    return out.otherwise("3")


def size_class(width: Column, height: Column) -> Column:
    out = None
    for (w, h), code in SIZE_CLASS.items():
        cond = (width == w) & (height == h)
        out = F.when(cond, code) if out is None else out.when(cond, code)
    return out


def decode_codes(
    df: DataFrame, key: Sequence[str], array_col: str, codes: DataFrame, out: str
) -> DataFrame:
    """Array of codes to an array of labels: explode, look up, collect back.

    ``codes`` has columns ``code`` and ``label``. Equal (key, array) pairs are
    decoded once, and grouping by both keeps a group as short as its own array,
    even when one key owns very many rows. Unknown codes drop out.
    """
    pairs = df.select(*key, array_col).distinct()
    single = pairs.select(*key, array_col, F.explode_outer(array_col).alias("__code"))
    named = single.join(codes, F.col("__code") == F.col("code"), "left")
    return named.groupBy(*key, array_col).agg(
        F.sort_array(F.collect_list("label")).alias(out)
    )
