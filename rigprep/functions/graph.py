"""Connected components of an edge table, by joins and grouping alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rigprep.functions.shared import materialize, superseded

#: Rounds that share an order: a star is settled by its second round if that keeps the order of the first.
SAME_ORDER = 3


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``(node, component)``: the smallest node reachable from each node that has an edge.

    Randomised contraction: in each round nodes are put in an order by hash, every node points to the first of itself
    and its neighbours, and is represented by the node to which that one points. Edges between representatives go on.
    Loops vanish, so finished components leave. Whatever the shape of the graph, nodes fall by a constant factor in
    expectation whenever a new order is drawn, and each component loses one at least in the other rounds.
    Representatives of rounds are put together at the end, from the last and smallest table to the first. Edges are
    written tables, so that AQE can split a hub's rows on both sides of a join. Null ends, loops and repeated edges are ignored; an empty table gives an empty table.
    """
    e = edges.select(F.col(src).alias("x"), F.col(dst).alias("y")).where("x <> y")
    left = materialize(e.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    rounds: list[DataFrame] = []
    while left.limit(1).count():
        place = lambda c: F.struct(F.xxhash64(c, F.lit(len(rounds) // SAME_ORDER)), F.col(c).alias("n"))  # noqa: E731, B023
        both = left.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.a", "e.b")
        first = both.groupBy("a").agg(F.min(place("b")).alias("m")).select("a", F.least(F.col("m"), place("a"))["n"].alias("r"))
        first = materialize(first, "pointers")
        rounds.append(materialize(first.toDF("a", "via").join(first.toDF("via", "r"), "via").select("a", "r"), "contracted"))
        ends = rounds[-1].toDF("a", "ra"), rounds[-1].toDF("b", "rb")
        fewer = left.join(ends[0], "a").join(ends[1], "b").where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
        fewer = materialize(fewer.distinct(), "edges")
        superseded(left)
        left = fewer
    if not rounds:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = rounds[-1]
    for before in reversed(rounds[:-1]):
        later = found.toDF("via", "last")
        found = materialize(before.join(later, F.col("r") == F.col("via"), "left").select("a", F.coalesce("last", "r").alias("r")), "contracted")
    least = found.groupBy("r").agg(F.min("a").alias("component"))
    return found.join(least, "r").select(F.col("a").alias("node"), "component")
