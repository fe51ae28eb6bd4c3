"""Connected components by alternating large-star and small-star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adflow.llm.stage import staged

_MOST_ROUNDS = 200


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step. ``edges`` has distinct (x, y) with y < x; every vertex hands its neighbours
    (larger ones, or smaller ones and itself) to the smallest vertex it knows."""
    if large:
        both = edges.select("x", "y").union(edges.select(F.col("y").alias("x"),
                                                         F.col("x").alias("y")))
    else:
        both = edges
    least = both.groupBy("x").agg(F.least("x", F.min("y")).alias("m"))
    if large:
        moved = both.join(least, "x").where(F.col("y") > F.col("x")).select(
            F.col("y").alias("x"), F.col("m").alias("y"))
        # An edge from a vertex to its least neighbour must stay.
        moved = moved.union(least.where(F.col("m") < F.col("x")).select(
            "x", F.col("m").alias("y")))
    else:
        moved = both.join(least, "x").select(F.col("y").alias("x"), F.col("m").alias("y")).union(
            least.select("x", F.col("m").alias("y")))
    return moved.where(F.col("y") < F.col("x")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``vertex`` and ``component`` (the smallest vertex) of all vertices in ``links`` (x, y).

    Null ends and loops are ignored. Each round is written to the shared folder; the edges
    never outnumber the links. Stops when a round changes nothing: then every vertex hangs
    on its component's smallest vertex.
    """
    edges = staged(links.where(F.col("x") != F.col("y")).select(
        F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct(), "edges")
    state = None
    for _ in range(_MOST_ROUNDS):
        edges = staged(_star(_star(edges, True), False), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)")),
                        F.bit_xor(F.xxhash64("x", "y"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {_MOST_ROUNDS} rounds")
    return edges.select(F.col("x").alias("vertex"), F.col("y").alias("component")).union(
        edges.select(F.col("y").alias("vertex"), F.col("y").alias("component")).distinct())
