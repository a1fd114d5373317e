"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .workspace import Workspace, join_counted


def _counted(arcs: DataFrame, centre: str, end: str) -> DataFrame:
    """(x, m, n): of every centre its least end and its number of arcs, reduced map-side."""
    return arcs.groupBy(F.col(centre).alias("x")).agg(F.min(end).alias("m"), F.count("*").alias("n"))


def components(edges: DataFrame, work: Workspace, name: str = "cc", most: int = 60) -> DataFrame:
    """(id, component) for every end of an edge; component is the smallest id that links reach.

    edges: columns a, b of one orderable type.  Loops, repeats and nulls are ignored; no
    edges give an empty result.  Every round ends in a written table, and only two
    numbers per round reach the driver.  Arcs meet the least neighbour of their centre; those
    of a centre of very many are dealt to several tasks, so a hub is no hot task.
    """
    now = work.save(edges.where("a != b").select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y")).distinct(), f"{name}-0")
    total = now.count()
    if not total:
        return now.select(F.col("x").alias("id"), F.col("y").alias("component"))
    print_of = None
    for k in range(1, most):
        # large star: every greater neighbour of a node moves to the least of the node and its neighbours
        low, high = _counted(now, "x", "y"), _counted(now, "y", "x")
        least = high.select("x", "n").join(low.select("x", "m"), "x", "left").select("x", "n", F.coalesce("m", "x").alias("m"))
        large = join_counted(now.select(F.col("y").alias("x"), F.col("x").alias("end")), least, "x", "n", total).select(F.col("end").alias("x"), F.col("m").alias("y")).distinct()
        # small star: a node and its lesser neighbours move to the least of these
        least = _counted(large, "x", "y")
        small = join_counted(large, least, "x", "n", total).where("y != m").select(F.col("y").alias("x"), F.col("m").alias("y")).union(least.select("x", F.col("m").alias("y"))).distinct()
        then = work.save(small, f"{name}-{k}")
        mark = then.agg(F.count("*"), F.bit_xor(F.xxhash64("x", "y"))).first()
        work.drop(f"{name}-{k - 1}")
        now, total = then, mark[0]
        if mark == print_of:
            break
        print_of = mark
    else:
        raise RuntimeError("the components did not settle")
    tops = now.select("y").distinct().select(F.col("y").alias("id"), F.col("y").alias("component"))
    return now.select(F.col("x").alias("id"), F.col("y").alias("component")).union(tops)
