"""Connected components by alternating large-star and small-star rounds (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from allelix.llm.common import cut_lineage, few_tasks


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return few_tasks(few_tasks(moved, rows).distinct(), rows)


def _small_star(edges: DataFrame, rows: int) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return few_tasks(few_tasks(moved.unionByName(least.select("a", F.col("m").alias("b"))), rows).distinct(), rows)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, root) for every node of the edges (a, b), root being the component's smallest node.

    No group of neighbours is gathered in one row or task: each round is a minimum per node and a join back, and
    every round's edges are written to the checkpoint folder, by as many tasks as their number needs. An empty edge table gives an empty result; nulls and
    self-loops are left out; repeated edges change nothing.
    """
    edges = cut_lineage(edges.where("a <> b").select("a", "b").distinct())
    state = _state(edges)
    edges = few_tasks(edges, state[0])
    for _ in range(max_rounds):
        if not state[0]:
            break
        edges = cut_lineage(_small_star(_large_star(edges, state[0]), state[0]))
        before, state = state, _state(edges)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = few_tasks(edges.select("b").distinct(), state[0])
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select(F.col("b").alias("node"), F.col("b").alias("root"))
    )
