"""Connected components of a table of links, by alternating star contraction.

Each round hangs every node under its smallest neighbour, from both directions.
Minima are partial aggregates and the joins leave a hot node's links behind a plain
exchange, so one node with very many links neither sits in one task nor needs its
links in one place.  Rounds grow with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import staged


def _smallest(edges: DataFrame) -> DataFrame:
    """Per node u of edges (u, v): the least of u and its neighbours."""
    return edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both.join(_smallest(both), "u")
    return near.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _smallest(down)
    hung = down.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 30)))).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node that has a link; root is the component's smallest
    node.  Links may repeat and point either way; a link of a node to itself and one
    with a null end are none.  No links give no rows."""
    edges = links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
    edges = staged(edges.filter("u != v").distinct(), "links")
    state = _state(edges)
    while state[0]:
        contracted = staged(small_star(staged(large_star(edges), "large-star")), "small-star")
        before, state, edges = state, _state(contracted), contracted
        if state == before:
            break
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
