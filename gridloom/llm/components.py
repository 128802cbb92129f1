"""Connected components by alternating large and small stars, in DataFrames only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x")).first()
    return row["n"], row["x"]


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Roots of the nodes in edges (a, b): node, root (the smallest node reachable).

    Nodes without an edge to another node are not in the result; edges with a null end are none.
    Each round aggregates minima with map-side combining, writes them as a table and joins that back,
    so that adaptive skew handling can split a hub; rounds are cut by a table in the shared folder. An edge list of stars
    needs two or three rounds, any other a number logarithmic in the component's diameter.
    """
    edges = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = written(edges.distinct(), "edges")
    state = _state(edges)
    for _ in range(rounds):
        if not state[0]:
            break
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = written(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "low")
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        large = written(large, "large")
        low = written(large.groupBy("a").agg(F.min("b").alias("m")), "low")
        small = large.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(small.union(low.select("a", F.col("m").alias("b"))).distinct(), "edges")
        state, before = _state(edges), state
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
