"""Pair counts that are kept up to date: what a load changes, from its rows and the links of its cases.

The dashboard counts cases by pairs of dimensions. Each dimension is a relation of
(case, id) links, and a pair count is a join of two of them on the case, counted by
both ids. When links D come to stored links S, the count of A with B grows by

    D_A x S_B  +  S_A x D_B  +  D_A x D_B

so only the links of cases with a new link are read, and nothing is counted again.
Links carry a weight: 1, or -1 for one that is taken back; weights multiply in a pair,
and counts are sums of weights.

``case_links`` is stored by buckets of the case's hash: the buckets of the new links' cases
are partition filters on the scan, so its folders are pruned. Changes of counts
are appended to ``pair_change`` in the load's own commit, so counts and tables can't
differ; reading sums them, and ``compact_pairs`` folds them.
"""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

if TYPE_CHECKING:
    from casegrid.operators.upsert import Commit, Warehouse

BUCKETS = 64
#: Kind of link: the table it is read from, and its id; the order is that of a stored pair.
KINDS = {"court": ("court_case", "court_id"), "judge": ("judge_assignment", "judge_id"),
         "tag": ("tag_assignment", "tag_id"), "verdict": ("court_case", "verdict_id")}
NAMES = {"court": "court_name", "judge": "judge_name", "tag": "tag_name", "verdict": "verdict"}
LINKS = "court_case_id string, kind string, id long, weight int"
CHANGES = "kind_a string, kind_b string, id_a long, id_b long, count long"


def links_of(rows: dict[str, DataFrame], weight: int = 1) -> DataFrame:
    """(court_case_id, kind, id, weight) of the rows of the case table and its bridges; a missing id is no link."""
    parts = [rows[table].where(F.col(id_col).isNotNull()).select("court_case_id", F.lit(kind).alias("kind"), F.col(id_col).cast("long").alias("id"),
                                                                 F.lit(weight).alias("weight"))
             for kind, (table, id_col) in KINDS.items() if table in rows]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def in_buckets(links: DataFrame) -> DataFrame:
    return links.withColumn("bucket", F.pmod(F.xxhash64("court_case_id"), F.lit(BUCKETS)).cast("int"))


def links_of_cases(stored: DataFrame, cases: DataFrame) -> DataFrame:
    """The net links of the (court_case_id, bucket) ``cases``: only their buckets are read."""
    buckets = [r["bucket"] for r in cases.select("bucket").distinct().collect()]  # BUCKETS at most
    mine = stored.where(F.col("bucket").isin(buckets)).join(cases.select("court_case_id").distinct(), "court_case_id", "left_semi")
    return mine.groupBy("court_case_id", "kind", "id").agg(F.sum("weight").cast("int").alias("weight")).where(F.col("weight") != 0)


def pair_changes(fresh: DataFrame, there: DataFrame) -> DataFrame:
    """What ``fresh`` links change in the counts of all pairs of kinds, given the stored links of their cases."""
    order = sorted(KINDS)  # numbers in the order of the names: links are compared and counted by them
    number = F.array_position(F.array(*[F.lit(k) for k in order]), F.col("kind")).cast("tinyint").alias("kind")
    both = fresh.select("court_case_id", number, "id", "weight", F.lit(True).alias("fresh")).unionByName(
        there.select("court_case_id", number, "id", "weight", F.lit(False).alias("fresh")))
    a, b = (both.select("court_case_id", *[F.col(c).alias(f"{c}_{side}") for c in ("kind", "id", "weight", "fresh")]) for side in "ab")
    pairs = a.join(b, "court_case_id").where((F.col("kind_a") < F.col("kind_b")) & (F.col("fresh_a") | F.col("fresh_b")))
    counts = (pairs.groupBy("kind_a", "kind_b", "id_a", "id_b").agg(F.sum(F.col("weight_a") * F.col("weight_b")).alias("count"))
              .where(F.col("count") != 0))
    names = F.array(*[F.lit(k) for k in order])
    return counts.select(*[F.element_at(names, F.col(k).cast("int")).alias(k) for k in ("kind_a", "kind_b")], "id_a", "id_b", "count")


def write_changes(commit: Commit, rows: dict[str, DataFrame], weight: int = 1) -> None:
    """Adds to a load's commit its links and what they change."""
    fresh = commit.write("case_links", in_buckets(links_of(rows, weight)), partition_by="bucket")
    there = links_of_cases(commit.warehouse.read("case_links", f"{LINKS}, bucket int"), fresh)
    commit.write("pair_change", pair_changes(fresh, there))


def summed(changes: DataFrame) -> DataFrame:
    return changes.groupBy("kind_a", "kind_b", "id_a", "id_b").agg(F.sum("count").alias("count")).where(F.col("count") != 0)


def pair_counts(warehouse: Warehouse, a: str, b: str) -> DataFrame:
    """A1-A8 from the maintained table: (count, name of a, name of b)."""
    kinds, ids = sorted([a, b]), {k: f"id_{s}" for k, s in zip(sorted([a, b]), "ab", strict=True)}
    mine = warehouse.read("pair_change", CHANGES).where((F.col("kind_a") == kinds[0]) & (F.col("kind_b") == kinds[1]))
    out = summed(mine)
    for k in (a, b):
        names = warehouse.read(k).select(F.col(KINDS[k][1]).alias(ids[k]), NAMES[k])
        out = out.join(names, ids[k])
    return out.select("count", NAMES[a], NAMES[b])


def compact_pairs(warehouse: Warehouse) -> None:
    """Fold the changes of all loads into one row for each pair."""
    warehouse.compact("pair_change", summed)
