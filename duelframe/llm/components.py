"""Connected components of a graph held as a DataFrame of undirected edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): every node of an edge and the smallest node it reaches.

    Alternating large-star and small-star steps: each hooks the neighbours of
    a node onto the least node next to it, so a long chain shrinks by half
    and more per round while no node gathers its neighbours in one place; the
    groups are only ever reduced to their minimum, which combines map-side.
    Each round is a table in the shared folder.  The loop ends when a round
    changes nothing, that is, when every edge points at its root.
    """
    now = written(_ordered(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))), "edges")
    state = _state(now)
    while True:
        now = written(_small_star(_large_star(now)), "edges")
        before, state = state, _state(now)
        if state == before:
            return (now.select(F.col("v").alias("node"), F.col("u").alias("root"))
                    .union(now.select("u", "u").distinct()))


def _ordered(edges: DataFrame) -> DataFrame:
    """Distinct edges with u < v."""
    return (edges.where("u <> v")
            .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())


def _state(edges: DataFrame) -> tuple:
    pair = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(pair)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Hook every larger neighbour of a node onto the least one of node and neighbours."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _ordered(both.where("v > u").join(least, "u").select(F.col("m").alias("u"), "v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hook a node and its smaller neighbours onto the least of them."""
    least = edges.groupBy("v").agg(F.min("u").alias("m"))
    hooked = edges.join(least, "v").select(F.col("m").alias("u"), F.col("u").alias("v"))
    return _ordered(hooked.union(least.select(F.col("m").alias("u"), "v")))
