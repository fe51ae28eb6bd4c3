"""Tables whose content changes by one statement.

A table is a view, the pointer, over a data table that holds the files of several versions.
The data table is partitioned by the table's own partition columns and, last, by the
version that wrote the files. A change adds files under a version of its own, which no reader
sees, and then replaces the view. A reader has the old content or the new, and a run that
stops anywhere leaves files that nobody refers to.

While all live files are of one version the view selects that version. Otherwise it keeps
the rows whose partition and version are listed in a manifest, a small table with a row per
live partition. No statement names partition values, but for the removal of old ones.

What the last change replaced stays for readers that are still at it; the next change removes
it. ``vacuum`` removes what stopped runs have left.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSION = "__version"
PROPERTY = "adflow.pointer"
_OWN = re.compile(r"^(.+)__[gm]_[0-9a-f]{12}$")


@dataclass(frozen=True)
class Pointer:
    """What a view points to. ``stored`` lists, for columns whose type was widened, the columns
    that hold their values, newest first."""

    data: str
    columns: list[str]
    parts: list[str]
    version: str | None = None
    manifest: str | None = None
    stored: dict[str, list[str]] = field(default_factory=dict)
    previous: dict | None = None


def statement(spark: SparkSession, text: str) -> DataFrame:
    """Every change of the catalog goes through here."""
    return spark.sql(text)


def base_name(name: str) -> str | None:
    """The table that a data table or manifest belongs to."""
    found = _OWN.match(name)
    return found.group(1) if found else None


def new_version() -> str:
    return uuid.uuid4().hex[:12]


def pointer(spark: SparkSession, table: str) -> Pointer | None:
    """None for a table that is missing, or that is no pointer."""
    if not spark.catalog.tableExists(table):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == PROPERTY).collect()
    return Pointer(**json.loads(bytes.fromhex(rows[0]["value"]))) if rows else None


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _kinds(spark: SparkSession, at: Pointer) -> dict[str, str]:
    if not at.stored:
        return {}
    return {f.name: f.dataType.simpleString() for f in spark.table(at.data).schema.fields}


def _shown(name: str, stored: dict[str, list[str]], kinds: dict[str, str]) -> str:
    if name not in stored:
        return f"d.`{name}`"
    values = ", ".join(f"CAST(d.`{c}` AS {kinds[stored[name][0]]})" for c in stored[name])
    return f"coalesce({values}) AS `{name}`"


def point(spark: SparkSession, table: str, to: Pointer, before: Pointer | None) -> None:
    """Make ``to`` the table's content: the one statement that readers notice."""
    older = (before.previous or {}) if before else {}
    to = replace(to, previous={**asdict(before), "previous": None} if before else None)
    kinds = _kinds(spark, to)
    columns = ", ".join(_shown(c, to.stored, kinds) for c in to.columns)
    if to.manifest:
        same = [f"d.`{p}` <=> m.`{p}`" for p in to.parts] + [f"d.`{VERSION}` = m.`{VERSION}`"]
        rest = f"LEFT SEMI JOIN {to.manifest} AS m ON {' AND '.join(same)}"
    else:
        rest = f"WHERE d.`{VERSION}` = '{to.version}'"
    # In hex: Spark hides property values that have words like "url" in them.
    value = json.dumps(asdict(to)).encode().hex()
    body = (f"TBLPROPERTIES ('{PROPERTY}' = '{value}') "
            f"AS SELECT {columns} FROM {to.data} AS d {rest}")
    if before or not spark.catalog.tableExists(table):
        statement(spark, f"CREATE OR REPLACE VIEW {table} {body}")
    else:
        # A table that someone else made: its place cannot be taken in one statement, once.
        statement(spark, f"CREATE OR REPLACE VIEW {table}__next {body}")
        statement(spark, f"DROP TABLE {table}")
        statement(spark, f"ALTER VIEW {table}__next RENAME TO {table}")
    if older:
        _expire(spark, Pointer(**older), [to, before])


def recover(spark: SparkSession, table: str) -> None:
    """Finish the only change that takes two statements, see ``point``."""
    if not spark.catalog.tableExists(table) and pointer(spark, f"{table}__next"):
        statement(spark, f"ALTER VIEW {table}__next RENAME TO {table}")


def live(spark: SparkSession, at: Pointer) -> DataFrame:
    """The partitions and versions that a pointer shows."""
    if at.manifest:
        return spark.table(at.manifest)
    return _listed(spark, at, at.version)


def _listed(spark: SparkSession, at: Pointer, version: str) -> DataFrame:
    """The partitions that a version has files in; reads partition columns only."""
    if not at.parts:
        return spark.range(1).select(F.lit(version).alias(VERSION))
    rows = spark.table(at.data).where(F.col(VERSION) == version)
    return rows.select(*at.parts, VERSION).distinct()


def _without(rows: DataFrame, gone: DataFrame, columns: Sequence[str]) -> DataFrame:
    gone = gone.select(*[F.col(c).alias(f"gone {c}") for c in columns]).distinct()
    cond = F.lit(True)
    for c in columns:
        cond = cond & F.col(c).eqNullSafe(F.col(f"`gone {c}`"))
    return rows.join(gone, cond, "left_anti")


def _expire(spark: SparkSession, old: Pointer, kept: Sequence[Pointer]) -> None:
    """Remove what ``old`` shows and none of ``kept`` does."""
    if old.data not in {k.data for k in kept}:
        statement(spark, f"DROP TABLE IF EXISTS {old.data}")
    else:
        dead = live(spark, old)
        for k in kept:
            if k.data == old.data:
                dead = _without(dead, live(spark, k), [*old.parts, VERSION])
        _drop(spark, old.data, [*old.parts, VERSION], dead)
    if old.manifest and old.manifest not in {k.manifest for k in kept}:
        statement(spark, f"DROP TABLE IF EXISTS {old.manifest}")


def _drop(spark: SparkSession, data: str, columns: Sequence[str], dead: DataFrame) -> None:
    """Drop partitions with their files, in one statement: those that one change replaced."""
    rows = dead.select(*[F.col(c).cast("string").alias(c) for c in columns]).collect()
    if rows:
        specs = ", ".join("PARTITION (" + ", ".join(
            f"`{c}` = " + ("NULL" if r[c] is None else _text(r[c])) for c in columns) + ")" for r in rows)
        statement(spark, f"ALTER TABLE {data} DROP IF EXISTS {specs}")


def vacuum(spark: SparkSession, table: str) -> list[str]:
    """Remove data tables, manifests and versions that stopped runs left; their names.

    For times when no load of the table runs.
    """
    now = pointer(spark, table)
    if now is None:
        return []
    kept = [now] + ([Pointer(**now.previous)] if now.previous else [])
    used = {n.rpartition(".")[2] for k in kept for n in (k.data, k.manifest) if n}
    database, _, name = table.rpartition(".")
    prefix, gone = f"{database}." if database else "", []
    for t in spark.catalog.listTables(database or None):
        if base_name(t.name) == name.lower() and t.name not in {u.lower() for u in used}:
            statement(spark, f"DROP TABLE IF EXISTS {prefix}{t.name}")
            gone.append(t.name)
    for data in {k.data for k in kept}:
        own = [k for k in kept if k.data == data]
        columns = [*own[0].parts, VERSION]
        dead = spark.table(data).select(*columns).distinct()
        for k in own:
            dead = _without(dead, live(spark, k), columns)
        gone += sorted(r[VERSION] for r in dead.select(VERSION).distinct().collect())
        _drop(spark, data, columns, dead)
    return gone


def remove(spark: SparkSession, table: str) -> None:
    """Drop a table, whoever made it."""
    now = pointer(spark, table)
    if now is None:
        statement(spark, f"DROP TABLE IF EXISTS {table}")
        return
    statement(spark, f"DROP VIEW {table}")
    for at in [now] + ([Pointer(**now.previous)] if now.previous else []):
        for name in (at.data, at.manifest):
            if name:
                statement(spark, f"DROP TABLE IF EXISTS {name}")


def stream(spark: SparkSession, table: str) -> DataFrame:
    """The table's rows, and those that later changes add, as a stream.

    A window that is replaced comes again with its new rows. Versions that stopped runs left
    would come too: ``vacuum`` first.
    """
    now = pointer(spark, table)
    if now is None:
        return spark.readStream.table(table)
    rows = spark.readStream.table(now.data)
    if now.previous and now.previous["data"] == now.data:
        columns = [*now.parts, VERSION]
        dead = _without(live(spark, Pointer(**now.previous)), live(spark, now), columns)
        rows = _without(rows, dead, columns)
    return rows.alias("d").selectExpr(*[_shown(c, now.stored, _kinds(spark, now)) for c in now.columns])


# --- changes -----------------------------------------------------------------


def sized(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Even file sizes: Spark merges small pieces of a partition and splits big ones.

    A plain repartition by the columns would put a hot day into one task.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def replace_all(df: DataFrame, table: str, parts: Sequence[str] = ()) -> None:
    """New content, schema and partitioning; ``df`` may read the table."""
    spark, version = df.sparkSession, new_version()
    recover(spark, table)
    before = pointer(spark, table)
    columns = [c for c in df.columns if c not in parts] + list(parts)
    data = f"{table}__g_{version}"
    rows = sized(df.select(*[F.col(f"`{c}`") for c in columns]), parts)
    rows.withColumn(VERSION, F.lit(version)).write.partitionBy(*parts, VERSION).saveAsTable(data)
    point(spark, table, Pointer(data, columns, list(parts), version), before)


def add(df: DataFrame, table: str, gone: DataFrame | None = None, widen: bool = False) -> None:
    """Show the rows of ``df`` too, and no longer what ``gone`` lists: partitions, by their
    columns; without partitions, everything if ``gone`` is given.

    Columns that the table lacks are an error; with ``widen`` they are added (NULL in old
    rows), columns that ``df`` lacks are NULL, and wider types take over. ``df`` may
    read the table.
    """
    spark, version = df.sparkSession, new_version()
    before = pointer(spark, table)
    to = _widened(spark, before, df, table, widen)
    stored = spark.table(to.data)
    place = {to.stored[c][0] if c in to.stored else c: c for c in to.columns}
    rows = df.select(*[
        (F.col(f"`{place[f.name]}`") if f.name in place and place[f.name] in df.columns
         else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in stored.schema.fields if f.name != VERSION])
    sized(rows, to.parts).withColumn(VERSION, F.lit(version)).write.insertInto(to.data)
    fresh = _listed(spark, to, version)
    if not to.parts and gone is not None:
        to = replace(to, version=version, manifest=None)
    else:
        old = live(spark, before)
        if gone is not None:
            old = _without(old, gone, to.parts)
        manifest = f"{table}__m_{version}"
        old.unionByName(fresh).coalesce(1).write.saveAsTable(manifest)
        to = replace(to, version=None, manifest=manifest)
    point(spark, table, to, before)


_WIDER = [  # a type on the left can be read as any type to the right of it
    ["tinyint", "smallint", "int", "bigint"],
    ["float", "double"],
    ["tinyint", "smallint", "int", "double"],
    ["date", "timestamp_ntz"],
]


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type of the two that holds the values of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        for x, y in ((a, b), (b, a)):
            if x.scale >= y.scale and x.precision - x.scale >= y.precision - y.scale:
                return x
        return None
    for chain in _WIDER:
        if a.simpleString() in chain and b.simpleString() in chain:
            return a if chain.index(a.simpleString()) > chain.index(b.simpleString()) else b
    return None


def _widened(spark: SparkSession, at: Pointer, df: DataFrame, table: str, widen: bool) -> Pointer:
    """``at`` with the columns and types of ``df`` merged in; the data table has them too."""
    shown = {f.name: f.dataType for f in spark.table(table).schema.fields}
    given = {f.name: f.dataType for f in df.schema.fields}
    extra = [c for c in given if c not in shown]
    lacking = [c for c in shown if c not in given]
    if not widen:
        if extra or lacking:
            raise ValueError(f"{table}: columns not in the table {extra}, not in the rows {lacking}")
        return at
    added, stored = {c: given[c] for c in extra}, dict(at.stored)
    there = set(spark.table(at.data).columns)
    for c in shown:
        kind = wider(shown[c], given[c]) if c in given else shown[c]
        if kind is None:
            raise ValueError(f"{table}.{c}: {given[c].simpleString()} does not go with {shown[c].simpleString()}")
        if kind != shown[c]:
            if c in at.parts:
                raise ValueError(f"{table}.{c}: the type of a partition column stays")
            wide = next(n for n in (f"{c}__{k}" for k in range(1, 1000)) if n not in there | set(added))
            stored[c] = [wide, *stored.get(c, [c])]
            added[wide] = kind
    # A column that a stopped run added is there already.
    new = {c: k for c, k in added.items() if c not in there}
    for c, k in added.items():
        if c in there and spark.table(at.data).schema[c].dataType != k:
            raise ValueError(f"{table}.{c}: a stopped load added it as another type; vacuum does not mend this")
    if new:
        columns = ", ".join(f"`{c}` {k.simpleString()}" for c, k in new.items())
        statement(spark, f"ALTER TABLE {at.data} ADD COLUMNS ({columns})")
    body = [c for c in at.columns if c not in at.parts]
    return replace(at, columns=[*body, *extra, *at.parts], stored=stored)
