"""Landed channel reports to uniform tables, driven by a spec per report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adflow.functions.recode import by_position
from adflow.functions.scalars import after_marker, micros_to_currency, video_url
from adflow.functions.timewin import Window
from adflow.operators.sets import scope as campaign_scope
from adflow.operators.web import default_metrics, first_value, pivot_actions
from adflow.sources.sinks import replace_window


@dataclass(frozen=True)
class Label:
    """Code at ``path`` replaced by its label."""

    path: str
    labels: Sequence[str]


@dataclass(frozen=True)
class Currency:
    """Micros at ``path`` in whole units."""

    path: str


@dataclass(frozen=True)
class Marked:
    """Text after a marker in the first URL at ``path``."""

    path: str
    marker: str = "mkt_"


@dataclass(frozen=True)
class First:
    """Field of the first element of the array at ``path``."""

    path: str
    name: str = "value"


@dataclass(frozen=True)
class VideoUrl:
    kind: str
    video: str


Source = str | Label | Currency | Marked | First | VideoUrl


@dataclass(frozen=True)
class Actions:
    """Action array pivoted by type."""

    path: str
    types: Sequence[str]
    prefix: str = ""


@dataclass(frozen=True)
class ReportSpec:
    """What one report selects and how.

    ``date`` is the landed path of the report day (text, ``yyyy-MM-dd``);
    ``window`` names the preset a scheduled run restates. ``fact`` says which columns go
    into the cross-channel fact, ``cost`` in what unit the report's cost is.
    """

    name: str
    date: str
    fields: Mapping[str, Source]
    window: str = "yesterday"
    equal: Mapping[str, Sequence] = field(default_factory=dict)
    positive: str | None = None
    actions: Sequence[Actions] = ()
    defaults: Sequence[str] = ()
    distinct: bool = False
    cost: str = "currency"
    fact: Mapping[str, str] = field(default_factory=dict)

    @property
    def date_column(self) -> str:
        return next(out for out, src in self.fields.items() if src == self.date)


def resolve(source: Source) -> Column:
    match source:
        case str():
            return F.col(source)
        case Label(path, labels):
            return by_position(F.col(path), labels)
        case Currency(path):
            return micros_to_currency(F.col(path))
        case Marked(path, marker):
            return after_marker(F.col(path), marker)
        case First(path, name):
            return first_value(path, name)
        case VideoUrl(kind, video):
            return video_url(F.col(kind), F.col(video))
    raise TypeError(f"no rule for {source!r}")


def _in_window(column: str, window: Window) -> Column:
    day = F.col(column)
    return (day >= window.start.strftime("%Y-%m-%d")) & (day < window.end.strftime("%Y-%m-%d"))


def normalize_report(
    landed: DataFrame, spec: ReportSpec, window: Window | None = None, **constants
) -> DataFrame:
    """Filter, select and rename landed rows by the spec.

    Filters come first and on bare columns, so they reach the scan. Constants
    (``customerName``, ``washDate``) are stamped on every row.
    """
    df = landed
    if window is not None:
        df = df.where(_in_window(spec.date, window))
    for path, values in spec.equal.items():
        df = df.where(F.col(path).isin(*values))
    if spec.positive:
        df = df.where(F.col(spec.positive) > 0)
    columns = {out: resolve(source) for out, source in spec.fields.items()}
    for action in spec.actions:
        columns.update(pivot_actions(action.path, action.types, action.prefix))
    df = df.select(*[c.alias(n) for n, c in columns.items()])
    if spec.defaults:
        df = default_metrics(df, spec.defaults)
    if constants:
        df = df.withColumns({k: F.lit(v) for k, v in constants.items()})
    return df.distinct() if spec.distinct else df


def in_scope(
    rows: DataFrame, campaigns: DataFrame, types: Sequence[str], key: str = "campaignId"
) -> DataFrame:
    return campaign_scope(rows, campaigns, types, key=key)


def table_name(channel: str, advertiser: str, domain: str, wash: bool = False) -> str:
    """``{channel}_{advertiser}_{domain}[_wash]_stats``."""
    return f"{channel}_{advertiser}_{domain}{'_wash' if wash else ''}_stats"


def load_report(
    rows: DataFrame, table: str, spec: ReportSpec, window: Window,
    scope: Mapping[str, object] | None = None,
) -> None:
    """Replace exactly the window that was computed, other accounts excepted.

    A wash run names its own window, so repeating it leaves no second copy.
    """
    replace_window(rows, table, _in_window(spec.date_column, window), scope)


@dataclass(frozen=True)
class Projection:
    """How a report that no spec describes goes into the cross-channel fact."""

    name: str
    fact: Mapping[str, str]
    cost: str = "currency"


FACT = (
    "date", "channel", "advertiser", "campaign", "adgroup", "ad", "impressions", "clicks",
    "cost", "conversions",
)
FACT_KINDS = {"impressions": "long", "clicks": "long", "cost": "double", "conversions": "double"}


def to_fact(rows: DataFrame, spec: ReportSpec | Projection, advertiser: str) -> DataFrame:
    """Project a report onto the shared fact; what it lacks is NULL.

    Cost is in whole units of the account's currency, whatever the report's unit.
    """

    def column(name: str) -> Column:
        if name in ("channel", "advertiser"):
            return F.lit(spec.name if name == "channel" else advertiser)
        source = spec.fact.get(name)
        value = F.col(source) if source else F.lit(None)
        value = value.cast(FACT_KINDS.get(name, "string"))
        return value / 1_000_000 if name == "cost" and spec.cost == "micros" else value

    return rows.select(*[column(n).alias(n) for n in FACT])


def union_facts(
    parts: Sequence[tuple[DataFrame, ReportSpec | Projection]], advertiser: str
) -> DataFrame:
    """One fact of several channels. Each channel comes once, at its finest grain: two views
    of the same spend would count it twice."""
    names = [spec.name for _, spec in parts]
    if len({n.split("_")[0] for n in names}) != len(names):
        raise ValueError(f"a channel comes twice: {names}")
    out = None
    for rows, spec in parts:
        fact = to_fact(rows, spec, advertiser)
        out = fact if out is None else out.unionByName(fact)
    return out
