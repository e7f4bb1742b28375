"""Connected components of a graph of longs, by contracting stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written


def _contracted(edges):
    """Each node's neighbours above it, and then it and its lower ones, hung on the least."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")
    large = large.distinct()
    least = large.groupBy("a").agg(F.min("b").alias("least"))
    small = large.join(least, "a")
    small = small.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
        least.select("a", F.col("least").alias("b")))
    return small.where("a <> b").distinct()


def _state(edges):
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label``, its component's least node, for all nodes but the least ones.

    ``edges`` has two columns of longs. Each round is a written table. Minima are
    combined before the shuffle. The joins find the minima already dealt by the node, so
    Spark doesn't split a node with many edges: its edges are one task's, two longs each.
    Repeated edges and edges from a node to itself do no harm.
    """
    edges = edges.toDF("a", "b").where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = written(edges, "edges")
    before = _state(edges)
    while before[0]:
        edges = written(_contracted(edges), "edges")
        now = _state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
