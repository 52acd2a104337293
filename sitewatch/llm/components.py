"""Connected components of a stored edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewatch.llm.common import store


def components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` of every node of ``edges (a, b)``; the component is its smallest id.

    Alternates two steps until nothing changes: every node links its larger neighbours, then
    its smaller ones, to the smallest node it knows. Each is one minimum by node and one join,
    so a node with very many neighbours is combined before the shuffle and split in the join.
    The number of rounds grows with the logarithm of the longest path.
    """
    edges = store(_tidy(edges), "edges")
    state = _state(edges)
    while True:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        # Stored, as a join can only split a large node if both its sides come from a shuffle.
        least = store(least.select("u", F.least("u", "m").alias("m")), "least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = store(_tidy(large), "edges")
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(down)
        edges = store(_tidy(small), "edges")
        before, state = state, _state(edges)
        if state == before:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
                edges.select("b", "b").distinct()
            )


def _tidy(edges: DataFrame) -> DataFrame:
    """Each edge once, larger id first, no loops."""
    a, b = edges.columns
    return (
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .distinct()
    )


def _state(edges: DataFrame) -> tuple:
    digest = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), digest).first())


def merged(found: DataFrame, more: DataFrame) -> DataFrame:
    """``found (id, component)`` once the edges ``more (a, b)`` are added.

    Only components that the new edges join are worked on; nodes of theirs may be new.
    """
    new = more.select(F.col("a").alias("id")).union(more.select("b")).distinct()
    nodes = found.join(new, "id", "full_outer").select("id", F.coalesce("component", "id").alias("component"))
    of = nodes.join(new, "id", "left_semi")
    ends = more.join(of.toDF("a", "ca"), "a").join(of.toDF("b", "cb"), "b").select("ca", "cb")
    joined = components(ends).toDF("component", "joined")
    return nodes.join(joined, "component", "left").select(
        "id", F.coalesce("joined", "component").alias("component")
    )
