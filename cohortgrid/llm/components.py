"""Connected components of an edge table, by alternating large and small
stars over written tables (no component or label ever reaches the driver;
it sees one row count and one checksum a round)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cohortgrid.llm.storage import written


def _written_edges(edges: DataFrame, name: str) -> tuple[DataFrame, tuple]:
    """The distinct edges (hi, lo) as a written table, with its row count
    and a checksum of its rows, both observed by the writing job."""
    seen = Observation()
    distinct = edges.filter("hi != lo").distinct()
    table = written(distinct.observe(seen, F.count("*").alias("rows"), F.bit_xor(F.xxhash64("hi", "lo")).alias("sum")), name)
    return table, (seen.get["rows"], seen.get["sum"])


def _least(pairs: DataFrame) -> DataFrame:
    """For each node u its least neighbour, or u itself."""
    return pairs.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"))


def _large_star(edges: DataFrame, name: str) -> DataFrame:
    """Edges from each node's larger neighbours to its least neighbour.
    Both join sides are written tables, so that the join of a node with
    very many neighbours can be split."""
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = written(_least(both), f"{name}-least")
    return _written_edges(both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")), f"{name}-large")[0]


def _small_star(edges: DataFrame, name: str) -> tuple[DataFrame, tuple]:
    """Edges from each node and its smaller neighbours, which are few after
    a large star, to the least of them."""
    down = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
    least = _least(down)
    out = down.join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).union(least.select(F.col("u").alias("hi"), F.col("m").alias("lo")))
    return _written_edges(out, f"{name}-small")


def connected_components(edges: DataFrame, a: str, b: str, name: str = "components") -> DataFrame:
    """(node, component) for every node with an edge; a component is named
    by its smallest node. Self-loops, repeated edges and edges with a null
    end are ignored; without edges there are no rows."""
    one_way = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
    current, before = _written_edges(one_way, f"{name}-edges")
    while before[0]:
        current, after = _small_star(_large_star(current, name), name)
        if after == before:
            break
        before = after
    node, root = current.select("hi", "lo"), current.select("lo").distinct()
    return node.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(root.select(F.col("lo"), F.col("lo")))
