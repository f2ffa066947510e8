"""Connected components of a link table, by contraction on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import salted_join, written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest vertex that each linked vertex can reach: (id, component), vertices without links left out.

    Each round hooks every vertex to a neighbour of lower rank and contracts the links. Ranks are the ids in even
    rounds, which settles stars at once, and a hash that changes with the round in odd ones, which halves long chains.
    Nothing but one count per round reaches the driver; a hub's links are aggregated before they are shuffled, and dealt to
    several tasks where they are joined.
    """
    links = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
    edges = written(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    steps, turn = [], 0
    while n := edges.count():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = (lambda c: F.col(c)) if turn % 2 == 0 else (lambda c, t=turn: F.xxhash64(F.col(c), F.lit(t)))
        hook = both.groupBy("a").agg(F.min(F.struct(rank("b").alias("r"), F.col("b").alias("v"))).alias("low"), F.count("*").alias("times"))
        mine = F.struct(rank("a").alias("r"), F.col("a").alias("v"))
        step = written(hook.select(F.col("a").alias("id"), F.least(mine, F.col("low")).getField("v").alias("to"), "times"), "hooks")
        steps.append(step.select("id", "to"))
        for end, other, to in (("a", "b", "x"), ("b", "a", "y")):
            hooked = step.select(F.col("id").alias(end), F.col("to").alias(to))
            edges = salted_join(edges, hooked, [end], [other], step.select(F.col("id").alias(end), "times"), 2 * n)
        edges = edges.filter("x <> y")
        edges = written(edges.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        turn += 1
    if not steps:
        return links.sparkSession.createDataFrame([], "id long, component long")
    at, n = steps[0], steps[0].count()
    for step in steps[1:]:
        further = step.select(F.col("id").alias("to"), F.col("to").alias("next"))
        at = written(_by_target(at, further, n, "left").select("id", F.coalesce("next", "to").alias("to")), "roots")
    return _by_target(at, at.groupBy("to").agg(F.min("id").alias("component")), n).select("id", "component")


def _by_target(at: DataFrame, one: DataFrame, n: int, how: str = "inner") -> DataFrame:
    return salted_join(at, one, ["to"], ["id"], at.groupBy("to").agg(F.count("*").alias("times")), n, how)
