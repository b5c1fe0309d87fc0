"""Connected components of an edge table by alternating large and small stars.

Every round is a grouped minimum and a join on the node, so a node with very
many neighbours is combined before the shuffle and, in the join, split by AQE.
Rounds are written to the shared folder; the number of rounds grows with the
logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrid.llm.common import staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the neighbours of each node on the least of them.

    ``edges`` has upper > lower. Large star: the larger neighbours of a node go to
    the least of the node and its neighbours. Small star: the node and its smaller
    neighbours go to the least of those.
    """
    if large:
        both = edges.select(F.col("upper").alias("node"), F.col("lower").alias("other")).unionAll(
            edges.select(F.col("lower").alias("node"), F.col("upper").alias("other")))
        least = both.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("least"))
        moved = (edges.select(F.col("lower").alias("node"), F.col("upper").alias("other")).join(least, "node")
                 .select(F.col("other").alias("upper"), F.col("least").alias("lower")))
    else:
        least = edges.groupBy(F.col("upper").alias("node")).agg(F.min("lower").alias("least"))
        moved = (edges.select(F.col("upper").alias("node"), F.col("lower").alias("other")).join(least, "node")
                 .select(F.col("other").alias("upper"), F.col("least").alias("lower"))
                 .unionAll(least.select(F.col("node").alias("upper"), F.col("least").alias("lower"))))
    return moved.where(F.col("upper") > F.col("lower")).distinct()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that has an edge to another; root is the least node of its component."""
    now = edges.select(F.greatest(a, b).alias("upper"), F.least(a, b).alias("lower")).where("upper > lower").distinct()
    now, before = staged(now, "edges"), None
    while True:
        mark = now.agg(F.count(F.lit(1)).alias("n"),
                       F.sum(F.xxhash64("upper", "lower").cast("decimal(20,0)")).alias("s")).first()
        if mark == before or not mark["n"]:
            return now.select(F.col("upper").alias("node"), F.col("lower").alias("root")).unionAll(
                now.select(F.col("lower").alias("node"), F.col("lower").alias("root")).distinct())
        before = mark
        now = staged(_star(_star(now, True), False), "edges")
