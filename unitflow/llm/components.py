"""Connected components of an edge list, by alternating large and small stars, without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, written


def mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("b", "a"))).first()
    return tuple(r)


def large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
    out = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
    return done(out, least)


def small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the least of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = written(down.groupBy("a").agg(F.min("b").alias("m")))
    near = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    out = near.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
    return done(out, least)


def done(out: DataFrame, *used: DataFrame) -> DataFrame:
    kept = written(out)
    for x in used:
        forget(x)
    return kept


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node and root (the least node of its component) for every node of ``edges`` (a, b: two columns of one ordered type).

    Edges from a node to itself and edges with a null end are dropped, repeated edges do no harm, an empty list gives no
    rows. The minima are taken by partial aggregation and the joins are between written tables, so that a node with very
    many neighbours can be split over tasks.
    """
    now = written(edges.where("a <> b").select("a", "b").distinct())
    seen = None
    for _ in range(rounds):
        big = large_star(now)
        forget(now)
        now = small_star(big)
        forget(big)
        if seen == (seen := mark(now)):
            break
    else:
        raise RuntimeError("the components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
