"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf.scratch import settle


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long); the smallest node names it.

    Large-star and small-star steps by turns: every step hangs the neighbours of
    a node on the smallest of them, until nothing changes. The smallest neighbour
    is an aggregate that is joined back, so a node with very many neighbours is
    not gathered in one task. Every round is stored in the shared folder, which
    cuts the lineage. Nulls and loops are no edges; repeated edges count once.
    """
    proper = edges.where("a is not null and b is not null and a <> b")
    links = settle(
        proper.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    state = _state(links)
    while True:
        links = settle(_small_star(_large_star(links)), "edges")
        before, state = state, _state(links)
        if state == before:
            break
    members = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return members.unionByName(roots).distinct()


def _state(links: DataFrame) -> tuple:
    """Number of links, and a sum that changes when a link does."""
    row = links.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum"),
    ).first()
    return row["n"], row["sum"]


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of a node go to its smallest neighbour, or to itself."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.join(least, "u")
        .where("v > u and v <> m")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and the node, go to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = (
        links.join(least, "u")
        .where("v <> m")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
    )
    own = least.select("u", F.col("m").alias("v"))
    return moved.unionByName(own).distinct()
