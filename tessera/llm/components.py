"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return int(row["n"]), int(row["s"] or 0)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # Written before it is joined back: the edges of a node with very many can then be split over tasks.
    least = written(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """The smaller neighbours of a node, and the node, move to the smallest of them (edges point from a down to b)."""
    least = written(edges.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = edges.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of the links ``(a, b)`` (longs); component = smallest node reachable.

    Each round moves edges towards the smallest node of their neighbourhood and
    is written to the shared folder; the edge count never grows, and the number
    of rounds is logarithmic in practice.  Self links and repeated links are
    harmless; links with a null end are ignored.  No links give no rows.
    """
    edges = links.filter("a is not null and b is not null and a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges = written(edges.distinct(), "edges")
    state = _state(edges)
    for _ in range(max_rounds):
        if state[0] == 0:
            break
        edges = written(_small_star(written(_large_star(edges), "stars")), "edges")
        state, before = _state(edges), state
        if state == before:
            break
    else:
        raise RuntimeError("connected components did not settle")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
