"""Connected components of a link table, by alternating star contractions.

``large star`` joins every neighbour above a node to the node's least
neighbour; ``small star`` does so for the neighbours below.  Repeated, all links
become stars around the least node of each component; rounds grow with the
logarithm of the component's size.  Each round is two partial aggregates and
two equi-joins on narrow rows, and its result is checkpointed in the shared
folder, so lost executors cost no more than one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.session import checkpoint_dir


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``links(a, b)`` (any orientation, loops and repeats allowed) to
    ``(node, root)`` for every node that has a link to another node; ``root`` is
    the least node of its component.  Links with a null end are ignored."""
    checkpoint_dir(links.sparkSession)
    stars = (links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
             .distinct().checkpoint())
    state = _state(stars)
    if state[0] == 0:
        return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
    for _ in range(max_rounds):
        stars = _small_star(_large_star(stars)).checkpoint()
        before, state = state, _state(stars)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = stars.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _state(links: DataFrame) -> tuple:
    """Count and an order-free digest of the link table (two numbers)."""
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(links.agg(F.count(F.lit(1)), digest).first())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct())


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
