"""Mixing sources to target weights by hierarchical budgets.

The corpus is a tree, by default domain, language, source. A budget of tokens
goes down the tree: each node's share is dealt to its children by weight, and a
child that has less than its share - every document taken ``max_epochs`` times -
leaves the rest to its siblings. So a shortage is made good among siblings, and
reaches a node's own siblings only when all below the node is used up.

A leaf takes whole epochs and then a prefix of one more: documents in the order
of ``md5(seed|epoch|id)`` as long as the tokens before them are fewer than what
is left. The prefix needs no sort of a leaf: tokens are summed by the first three
hexadecimal digits of the key, and only the digits where the prefix ends are
looked at document by document.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casegrid.llm.common import WHITE_SPACE, let, staged

#: Weights of nodes by level; nodes that aren't named have weight 1.
Weights = dict[str, dict[str, int]]


def token_count(text: Column) -> Column:
    """Words between white space; 0 for null."""
    return let(F.split(F.coalesce(text, F.lit("")), WHITE_SPACE + "+"),
               lambda w: F.size(w) - (w[0] == "").cast("int") - ((F.size(w) > 1) & (F.element_at(w, -1) == "")).cast("int")).cast("long")


def order_key(seed: int, epoch: Column, doc_id: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def _deal(nodes: DataFrame, parents: list[str]) -> DataFrame:
    """Adds ``share``: the part of ``budget`` (equal within a parent) for each node, by ``weight`` and at most ``room``."""
    ratio = F.when(F.col("weight") > 0, F.col("room") / F.col("weight")).otherwise(F.lit(float("inf")))
    nodes = nodes.withColumn("ratio", ratio)
    within = Window.partitionBy(*parents)
    order = within.orderBy("ratio", "name")
    used = F.coalesce(F.sum("room").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    nodes = nodes.withColumn("pour", F.when(left > 0, (F.col("budget") - used) / left).otherwise(F.lit(0.0)))
    nodes = nodes.withColumn("full", F.col("ratio") <= F.col("pour"))
    # the first node that isn't full sets how much every further unit of weight gets
    level = F.min(F.when(~F.col("full"), F.struct("ratio", "name", "pour"))).over(within)["pour"]
    return (nodes.withColumn("share", F.when(F.col("full"), F.col("room").cast("double"))
                             .otherwise(F.greatest(F.lit(0.0), level * F.col("weight"))))
            .drop("ratio", "pour", "full"))


def leaf_budgets(leaves: DataFrame, levels: list[str], weights: Weights, budget_share: float, max_epochs: int) -> DataFrame:
    """``leaves``: the level columns (strings) and ``tokens``. Adds ``share``, the tokens that each leaf may give."""
    leaves = staged(leaves, "leaves")
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    rows = leaves.withColumn("room", F.col("tokens") * max_epochs).withColumn("everything", F.lit(0))
    rows = rows.withColumn("share", F.lit(float(math.floor(total * budget_share))))
    path = ["everything"]
    for level in levels:
        nodes = rows.groupBy(*path, level).agg(F.sum("room").alias("room"), F.max("share").alias("budget"))
        nodes = nodes.withColumn("name", F.col(level))
        # as a map in the plan, since a table made from Python rows would need Python workers of its own
        named = F.create_map(*[F.lit(x) for pair in (weights.get(level) or {}).items() for x in pair]).cast("map<string,bigint>")
        nodes = nodes.withColumn("weight", F.coalesce(F.element_at(named, F.col("name")), F.lit(1)))
        dealt = _deal(nodes, path).select(*path, level, "share")
        path = [*path, level]
        rows = rows.drop("share").join(dealt, path)
    return rows.select(*levels, "tokens", "share")


def mix(docs: DataFrame, levels: dict[str, Column], weights: Weights, budget_share: float, max_epochs: int = 1,
        seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns ``row``, the levels, ``n_tokens`` and ``epoch``: a row for each time that a document is taken.

    ``levels``: name and expression of each level, from the root; null counts as the
    name ``""``. Documents without tokens take their place in the order and cost
    nothing. Rows that share an id have one place: all of them are taken, or none.
    A weight of 0 takes a node out. The budget is ``budget_share`` of all tokens;
    what no leaf can give stays unspent.
    """
    names = list(levels)
    placed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                         *[F.coalesce(e.cast("string"), F.lit("")).alias(f"level_{i}") for i, e in enumerate(levels.values())])
    keys = [f"level_{i}" for i in range(len(names))]
    doc_id, text = F.col(f"row.`{id_col}`"), F.col(f"row.`{text_col}`").cast("string")
    rows = staged(placed.select(*keys, doc_id.alias("id"), token_count(text).alias("tokens")), "tokens")
    leaves = rows.groupBy(*keys).agg(F.sum("tokens").alias("tokens"))
    renamed = {f"level_{i}": weights.get(n, {}) for i, n in enumerate(names)}
    plan = leaf_budgets(leaves, keys, renamed, budget_share, max_epochs)
    whole = F.when(F.col("tokens") > 0, F.floor(F.col("share") / F.col("tokens"))).otherwise(F.lit(0)).cast("long")
    plan = staged(plan.withColumn("whole", whole).select(
        *keys, "whole", (F.col("share") - F.col("whole") * F.col("tokens")).alias("rest")), "budgets")
    # where in the order of its last epoch does each leaf end?
    keyed = rows.join(plan.where("rest > 0"), keys).withColumn("key", order_key(seed, F.col("whole"), F.col("id")))
    keyed = keyed.withColumn("digits", F.substring("key", 1, 3))
    sums = keyed.groupBy(*keys, "digits").agg(F.sum("tokens").alias("sum"), F.first("rest").alias("rest"))
    before = F.sum("sum").over(Window.partitionBy(*keys).orderBy("digits")) - F.col("sum")
    last = sums.withColumn("before", before).where(F.col("before") < F.col("rest"))
    last = last.groupBy(*keys).agg(F.max_by(F.struct("digits", "before"), "digits").alias("last")).select(*keys, "last.*")
    ends = keyed.join(last, [*keys, "digits"])
    earlier = F.coalesce(F.sum("tokens").over(
        Window.partitionBy(*keys).orderBy("place").rangeBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # equal keys share a place; the places of one leaf's last digits are numbered
    ends = ends.withColumn("place", F.dense_rank().over(Window.partitionBy(*keys).orderBy("key")))
    ends = ends.withColumn("earlier", F.col("before") + earlier).where(F.col("earlier") < F.col("rest"))
    cuts = ends.groupBy(*keys).agg(F.max("key").alias("cut"))
    plan = staged(plan.join(cuts, keys, "left").select(*keys, "whole", F.coalesce("cut", F.lit("")).alias("cut")), "cuts")
    taken = placed.join(plan, keys)
    times = F.col("whole") + (order_key(seed, F.col("whole"), doc_id) <= F.col("cut")).cast("long")
    taken = taken.withColumn("times", times).where(F.col("times") > 0)
    return taken.select(
        "row", *[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], token_count(text).alias("n_tokens"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)).alias("epoch"))
