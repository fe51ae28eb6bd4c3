"""Set operations, semi and anti joins, overlays, and dimension look-ups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adflow.operators.dedup import first_by


def append_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b)


def read_merged(*parts: DataFrame) -> DataFrame:
    """Union of parts whose schemas grew over time; absent columns are NULL."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def merge_domains(known: DataFrame, today: DataFrame) -> DataFrame:
    """Cumulative list: what was known plus today's values, each once."""
    return known.unionByName(today).distinct()


def new_domains(known: DataFrame, today: DataFrame) -> DataFrame:
    """Today's values that were not known."""
    return today.subtract(known)


def combine(original: DataFrame, synthetic: DataFrame) -> DataFrame:
    return original.unionByName(synthetic)


def semi(raw: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key tuple occurs in ``other``."""
    return raw.join(other.select(*keys), list(keys), "left_semi")


def anti(
    raw: DataFrame, other: DataFrame, keys: Sequence[str], null_aware: bool = False
) -> DataFrame:
    """Rows whose key tuple does not occur in ``other``.

    ``null_aware`` gives SQL ``NOT IN`` on one key: a NULL on the right empties
    the result, and unless the right side is empty, rows with a NULL key go as
    well. Both facts are one aggregate row, looked up first; the join itself
    stays a plain anti join, where SQL's form would compare every pair of rows.
    """
    keys = list(keys)
    if not null_aware:
        return raw.join(other.select(*keys), keys, "left_anti")
    if len(keys) != 1:
        raise ValueError("null-aware anti join takes one key column")
    key = keys[0]
    facts = other.agg(
        F.count("*").alias("rows"), F.count_if(F.col(key).isNull()).alias("nulls")
    ).first()
    if facts["rows"] == 0:
        return raw
    if facts["nulls"]:
        return raw.where(F.lit(False))
    return raw.where(F.col(key).isNotNull()).join(other.select(key), key, "left_anti")


def new_ids(current: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Ids not seen before, each once."""
    return current.select(key).distinct().join(known.select(key), key, "left_anti")


def overlay(
    raw: DataFrame, wash: DataFrame, keys: Sequence[str], descriptors: Sequence[str],
    metrics: Sequence[str], unique: bool = True,
) -> DataFrame:
    """Late restatement: washed keys keep raw descriptors and take wash metrics.

    Equal descriptors of a washed key merge into one row. Untouched raw rows
    pass through as they are, repeats included; a wash key absent from raw adds
    nothing. A wash key with two rows stops the job; with ``unique=False`` the greater
    metrics of its rows count.

    Each side is shuffled once and sorted once, by a number made of the key: numbers are told
    apart without looking at the texts of the keys. Rows that would merge are counted before the
    join, which keeps their order. Raw rows with a NULL key match nothing and are spread.
    """
    keys = list(keys)
    columns = [*dict.fromkeys([*keys, *descriptors, *metrics])]
    new = F.max(F.struct(*metrics))
    if unique:
        twice = F.raise_error(F.concat_ws(" ", F.lit("more than one wash row of"), F.to_json(F.struct(*keys))))
        new = F.when(F.count(F.lit(1)) > 1, twice).otherwise(new)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    number = _key_number(raw, wash, keys)
    folded = wash.where(known).withColumn("__key", number).groupBy("__key", *keys).agg(new.alias("__new"))
    spread = F.when(known, number).otherwise(F.xxhash64(*columns))
    placed = raw.select(*columns, spread.alias("__key")).repartition("__key", *keys)
    same = Window.partitionBy("__key", *dict.fromkeys([*keys, *descriptors])).orderBy(F.lit(1))
    counted = placed.withColumn("__n", F.row_number().over(same))
    joined = counted.join(folded, ["__key", *keys], "left")
    washed = F.col("__new").isNotNull()
    values = [F.when(washed, F.col(f"__new.{c}")).otherwise(F.col(c)).alias(c)
              if c in metrics else F.col(c) for c in columns]
    return joined.where(~washed | (F.col("__n") == 1)).select(*values)


def _key_number(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    """A long that is the same on both frames for keys a join takes as equal.

    Only keys of one plain type on both sides go in; the join compares the keys as well.
    """
    plain = {"string", "boolean", "tinyint", "smallint", "int", "bigint", "date", "timestamp", "timestamp_ntz"}
    kinds = [(k, a.schema[k].dataType.simpleString(), b.schema[k].dataType.simpleString()) for k in keys]
    alike = [k for k, x, y in kinds if x == y and x in plain]
    # Without any: always 0, but not a literal, which the planner would take out of the join keys.
    return F.xxhash64(*alike) if alike else F.pmod(F.xxhash64(*keys), F.lit(1))


def enrich(stats: DataFrame, dims: Sequence[tuple[DataFrame, Sequence[str]]], how: str = "inner") -> DataFrame:
    """Chain of look-ups, each by its own shared key.

    Dimension sizes are left to the optimizer, which broadcasts below its
    threshold and shuffles above it.
    """
    for dim, keys in dims:
        stats = stats.join(dim, list(keys), how)
    return stats


def left_lookup(
    fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str
) -> DataFrame:
    """Left join on keys of different names, both kept."""
    return fact.join(dim, fact[fact_key] == dim[dim_key], "left")


def left_metric(
    fact: DataFrame, detail: DataFrame, keys: Sequence[str], metric: str,
    positive: bool = True,
) -> DataFrame:
    """Per-key sum of a detail table put onto a fact."""
    agg = detail.groupBy(*keys).agg(F.sum(metric).alias(metric))
    if positive:
        agg = agg.where(F.col(metric) > 0)
    return fact.join(agg, list(keys), "left")


def scope(
    report: DataFrame, campaigns: DataFrame, types: Sequence[str],
    key: str = "campaignId", kind: str = "campaignType",
) -> DataFrame:
    """Report rows of the campaigns of given channel types."""
    wanted = campaigns.where(F.col(kind).isin(*types))
    return semi(report, wanted, [key])


def reconcile(
    a: DataFrame, b: DataFrame, keys: Sequence[str], metrics: Sequence[str],
    tolerance: float = 0.0,
) -> DataFrame:
    """Two sources side by side: totals per key, difference, and agreement.

    Both sides are folded to one row per key first, so the outer join is one to
    one and no key can be hot in it.
    """
    keys = list(keys)

    def folded(df: DataFrame, tag: str) -> DataFrame:
        return df.groupBy(*keys).agg(*[F.sum(m).alias(f"{m}_{tag}") for m in metrics])

    out = folded(a, "a").join(folded(b, "b"), keys, "full")
    for m in metrics:
        delta = F.coalesce(f"{m}_a", F.lit(0)) - F.coalesce(f"{m}_b", F.lit(0))
        out = out.withColumn(f"{m}_diff", delta)
    worst = F.greatest(*[F.abs(f"{m}_diff") for m in metrics]) if len(metrics) > 1 else F.abs(f"{metrics[0]}_diff")
    return out.withColumn("agrees", worst <= tolerance)


def match_counts(a: DataFrame, b: DataFrame, a_key: str, b_key: str) -> DataFrame:
    """Ids found in both sources, with their row counts on either side.

    Says what a plain inner join of the two would, without writing out every
    pair of a frequent id: the join would have ``rows_a * rows_b`` rows.
    """
    left = a.groupBy(F.col(a_key).alias("id")).agg(F.count("*").alias("rows_a"))
    right = b.groupBy(F.col(b_key).alias("id")).agg(F.count("*").alias("rows_b"))
    return left.join(right, "id").withColumn("pairs", F.col("rows_a") * F.col("rows_b"))


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str, *ties: str) -> DataFrame:
    return first_by(df, keys, [F.desc(ts), *[F.desc(t) for t in ties]])


def lookup_columns(mapping: Mapping[str, str]) -> list:
    return [F.col(old).alias(new) for old, new in mapping.items()]
