"""Connected components of an edge table, by alternating star contractions in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.operators.joins import ROWS_PER_TASK, salted_join
from sparkmart.session import materialise


def _star(edges: DataFrame, large: bool, n_edges: int, rows_per_task: int) -> DataFrame:
    """Every node hands its smallest neighbour to its larger (or its other smaller) ones.

    ``edges`` are (u, v) with u > v. The large star looks at neighbours on both sides, the
    small star at smaller ones only; both keep the components as they are. There are at most
    ``n_edges`` of them; a node with more than ``rows_per_task`` neighbours is spread over tasks.
    """
    both = edges
    if large:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    met = salted_join(
        both, least, ["u"], "inner", left_rows=2 * n_edges, rows_per_task=rows_per_task
    )
    if large:
        out = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # a node without larger neighbours keeps the link to its smallest one
        out = out.unionAll(least.where("m < u").select("u", F.col("m").alias("v")))
    else:
        out = met.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = out.unionAll(least.select("u", F.col("m").alias("v")))
    return out.where("u > v").distinct()


def components(
    edges: DataFrame, folder: str, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of all nodes in ``edges`` (u, v longs).

    Each round is written below ``folder``, so a lost executor costs one round at most. Two
    numbers a round reach the driver. Self-loops and repeated edges do no harm; isolated
    nodes are not listed; no edges give an empty result.
    """
    start = (
        edges.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    current = materialise(start, f"{folder}/round0")
    state, turn = None, 0
    while True:
        summary = current.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if summary[0] == 0 or tuple(summary) == state:
            break
        state, turn = tuple(summary), turn + 1
        n = summary[0]
        # a large star leaves one edge per edge, and one for each of up to 2 n nodes
        stars = _star(_star(current, True, n, rows_per_task), False, 3 * n, rows_per_task)
        current = materialise(stars, f"{folder}/round{turn}")
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
