"""Connected components by alternating large and small stars, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node it reaches, of all nodes in ``links`` (``a``, ``b``).

    Each round is written before the next, so a lost executor costs one round. A hub's rows are
    joined to one minimum that is summed per task first; the join can be split by AQE.
    """
    pairs = cut(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    state = summary(pairs)
    while state[0]:
        pairs = cut(small_star(large_star(pairs)))
        before, state = state, summary(pairs)
        if state == before:
            break
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)


def large_star(pairs: DataFrame) -> DataFrame:
    """All larger neighbours of a node are tied to its least neighbour instead."""
    both = pairs.unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.join(low, "u")
        .where("v > u")
        .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        .distinct()
    )


def small_star(pairs: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of these."""
    low = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return (
        pairs.join(low, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .where("u <> v")
        .unionAll(low.select("u", F.col("m").alias("v")))
        .distinct()
    )


def summary(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
