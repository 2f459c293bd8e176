"""Connected components of an undirected graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline.llm.common import Saved


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; the component is its smallest node.

    Alternating large-star and small-star rounds (Kiveris et al., 2014): every round hangs nodes under
    smaller ones with two combinable minima and two joins, and a graph of n nodes is done after about
    log n rounds. Hubs meet their minimum in an ordinary join that adaptive execution can split; no
    neighbour list is ever gathered. Each round's edges are written to the shared folder.

    Self loops and repeated edges are allowed and change nothing; edges with a null end are ignored. An empty table gives
    an empty result.
    """
    saved = Saved(edges.sparkSession, label)
    # Stored, as they are read twice and may be costly to make.
    ends = saved(edges.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL"), "edges")
    loops = ends.filter("a = b").select(F.col("a").alias("node"))
    links = saved(ends.filter("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links0")
    state, turn = _state(links), 1
    while state[0]:
        links = saved(_small_star(_large_star(links)), f"links{turn % 2}")
        before, state = state, _state(links)
        if state == before:
            break
        turn += 1
    roots = links.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    found = links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
    single = loops.distinct().join(found.select("node"), "node", "left_anti").withColumn("component", F.col("node"))
    return found.unionByName(single)


def _state(links: DataFrame) -> tuple:
    """Count and order-free checksum: equal before and after a round only if nothing changed."""
    return tuple(links.agg(
        F.count(F.lit(1)),
        F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)),
        F.coalesce(F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")), F.lit(0))).first())


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is hung under the least of the node and its neighbours."""
    both = links.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(
        links.select(F.col("v").alias("x"), F.col("u").alias("y")))
    least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
    return both.filter("y > x").join(least, "x").select(F.col("y").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are hung under the least of these."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return least.select("u", F.col("m").alias("v")).unionByName(moved).distinct()
