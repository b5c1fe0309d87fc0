"""Pair counts kept up to date over loads, and commits that are seen whole or not at all."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from casegrid.operators import maintain as MT
from casegrid.operators import upsert as UP

CASE = UP.SCHEMAS["court_case"]


def rows_of(spark, cases, judges, tags):
    """Rows of the case table and its bridges; cases: (id, verdict_id, court_id)."""
    return {"court_case": spark.createDataFrame([(c, None, v, None, None, None, None, k, None) for c, v, k in cases], CASE),
            "judge_assignment": spark.createDataFrame(judges, UP.SCHEMAS["judge_assignment"]),
            "tag_assignment": spark.createDataFrame(tags, UP.SCHEMAS["tag_assignment"])}


def recounted(links):
    out = Counter()
    by_case = {}
    for case, kind, i in links:
        by_case.setdefault(case, []).append((kind, i))
    for mine in by_case.values():
        out.update((a[0], b[0], a[1], b[1]) for a in mine for b in mine if a[0] < b[0])
    return out


def maintained(wh):
    return {(r["kind_a"], r["kind_b"], r["id_a"], r["id_b"]): r["count"] for r in MT.summed(wh.read("pair_change", MT.CHANGES)).collect()}


def test_counts_like_recounted_ones(spark, tmp_path):
    """Batches bring new cases, and links to old ones; the last takes links back."""
    rng = random.Random(1)
    wh, links, known = UP.Warehouse(spark, str(tmp_path / "wh")), set(), []
    for k in range(3):
        cases = [(f"c{k}-{i}", rng.choice([1, 2, None]), rng.choice([7, 8, None])) for i in range(12)]
        known += [c for c, _, _ in cases]
        judges = {(rng.choice(known), rng.randrange(5)) for _ in range(25)} - {(c, i) for c, kind, i in links if kind == "judge"}
        tags = {(rng.choice(known), rng.randrange(4)) for _ in range(25)} - {(c, i) for c, kind, i in links if kind == "tag"}
        links |= {(c, "verdict", v) for c, v, _ in cases if v} | {(c, "court", t) for c, _, t in cases if t}
        links |= {(c, "judge", i) for c, i in judges} | {(c, "tag", i) for c, i in tags}
        commit = UP.Commit(wh, f"load-{k}")
        MT.write_changes(commit, rows_of(spark, cases, sorted(judges), sorted(tags)))
        commit.publish()
        assert maintained(wh) == recounted(links)
    gone = {x for x in links if x[1] in ("judge", "tag") and rng.random() < 0.4}
    links -= gone
    commit = UP.Commit(wh, "back")
    MT.write_changes(commit, rows_of(spark, [], [(c, i) for c, k, i in gone if k == "judge"], [(c, i) for c, k, i in gone if k == "tag"]), weight=-1)
    commit.publish()
    assert maintained(wh) == recounted(links)
    MT.compact_pairs(wh)
    assert maintained(wh) == recounted(links) and wh.read("pair_change", MT.CHANGES).count() == len(recounted(links))


def test_only_buckets_of_the_batch_are_read(spark, tmp_path):
    wh = UP.Warehouse(spark, str(tmp_path / "wh"))
    commit = UP.Commit(wh, "all")
    MT.write_changes(commit, rows_of(spark, [(f"c{i}", 1, 2) for i in range(3000)], [(f"c{i}", i % 9) for i in range(3000)], []))
    commit.publish()
    stored = wh.read("case_links", f"{MT.LINKS}, bucket int")
    fresh = MT.in_buckets(MT.links_of(rows_of(spark, [], [("c5", 77), ("c6", 77)], [])))
    found = MT.links_of_cases(stored, fresh)
    assert {r["court_case_id"] for r in found.collect()} == {"c5", "c6"} and found.count() == 6
    plan = found._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.split("\n") if "FileScan" in x and "PartitionFilters" in x)
    assert "bucket" in scan.split("PartitionFilters:")[1].split("]")[0]
    buckets = [r[0] for r in fresh.select("bucket").distinct().collect()]
    read = stored.where(F.col("bucket").isin(buckets))
    assert len(buckets) <= 2 and read.select(F.input_file_name()).distinct().count() <= 2 < len(stored.inputFiles())


def numbers(spark, n):
    return spark.range(n).select(F.col("id").alias("judge_id"), F.col("id").cast("string").alias("judge_name"))


def test_a_commit_is_seen_whole_or_not_at_all(spark, tmp_path):
    wh = UP.Warehouse(spark, str(tmp_path / "wh"))
    assert wh.manifests() == [] and wh.read("judge").count() == 0 and wh.read("seen", "citation string").count() == 0
    with pytest.raises(UP.Crash):
        commit = UP.Commit(wh, "one", fail_after="tag")
        commit.write("judge", numbers(spark, 5))
        commit.write("tag", spark.createDataFrame([(1, "t")], UP.SCHEMAS["tag"]))
    assert wh.committed("one") is None and wh.read("judge").count() == 0
    commit = UP.Commit(wh, "one")
    commit.write("judge", numbers(spark, 5))
    commit.write("tag", spark.createDataFrame([], UP.SCHEMAS["tag"]))
    assert wh.read("judge").count() == 0
    assert commit.publish() == {"judge": 5, "tag": 0} == wh.committed("one")
    wh.append("judge", numbers(spark, 2))
    assert wh.read("judge").count() == 7 and wh.read("judge").columns == ["judge_id", "judge_name"] and wh.read("tag").count() == 0
    wh.compact("judge", lambda df: df.distinct())
    assert wh.read("judge").count() == 5
    wh.append("judge", numbers(spark, 1))
    assert wh.read("judge").count() == 6


def test_a_manifest_written_twice_counts_once(spark, tmp_path):
    """A writer that dies between publishing and returning is run again, and its commit may be published again."""
    wh = UP.Warehouse(spark, str(tmp_path / "wh"))
    wh.append("judge", numbers(spark, 3), "one")
    again = spark.read.schema(wh.MANIFEST).json(f"{wh.root}/manifest")
    spark.createDataFrame(again.collect(), wh.MANIFEST).coalesce(1).write.mode("append").json(f"{wh.root}/manifest")
    assert wh.read("judge").count() == 3
