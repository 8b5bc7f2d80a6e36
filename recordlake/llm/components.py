"""Connected components of a table of links, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlake.llm.batches import stored


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root``: the smallest node that each linked node is connected with.

    ``links`` has two long columns without nulls, ``a`` and ``b``, in any order and with
    repeats. A root has no row of its own, nor has a node without a link.

    Large-star and small-star steps in turn: each tells neighbours of the smallest node around
    and so at least halves long chains. Every step is a minimum, which combines before the
    shuffle, and a join with the stored minima, whose hot keys adaptive execution splits.
    Rounds end when a round changes nothing.
    """
    low, high = F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")
    edges = stored(links.select(low, high).where("low < high").distinct(), "links")
    before = _digest(edges)
    while before[0]:
        # Large star: larger neighbours learn the smallest node around a node, if it is another.
        around = edges.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("least"))
        around = stored(around, "smaller")
        linked = edges.join(around, F.col("low") == F.col("node"), "left")
        edges = linked.select(F.coalesce("least", "low").alias("low"), "high")
        # A node with smaller neighbours keeps its own link to the smallest of them.
        edges = edges.unionAll(around.select(F.col("least").alias("low"), F.col("node").alias("high")))
        edges = stored(edges.distinct(), "large-star")
        # Small star: smaller neighbours of a node, and the node, learn the smallest of them.
        around = stored(edges.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("least")), "least")
        linked = edges.join(around, F.col("high") == F.col("node"))
        pairs = linked.select(F.col("least").alias("low"), F.col("low").alias("high")).where("low < high")
        own = around.select(F.col("least").alias("low"), F.col("node").alias("high"))
        edges = stored(pairs.unionAll(own).distinct(), "small-star")
        after = _digest(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("high").alias("node"), F.col("low").alias("root"))


def _digest(edges: DataFrame) -> tuple:
    """Number of edges and a sum over them: equal for equal sets of edges."""
    value = F.xxhash64("low", "high").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(value)).first())
