"""Search by trigrams finds what a scan finds, and reads the asked buckets only."""

import random

import pytest
from pyspark.sql import functions as F

from casegrid.plans import grams as G
from casegrid.plans import search as SR
from casegrid.sources.tables import star


def test_parts_and_trigrams_of_patterns():
    assert G.literal_parts("a%bc_d\\%e") == ["a", "bc", "d%e"] and G.literal_parts("%_") == []
    assert G.pattern_trigrams("Red%GEAR") == ["ear", "gea", "red"] and G.pattern_trigrams("ab_cd") == []
    assert G.pattern_trigrams("Élan") == ["lan"]


def test_like_a_scan(spark, tmp_path):
    rng = random.Random(2)
    texts = ["".join(rng.choices("abAB%_\\é K", k=rng.randrange(0, 14))) for _ in range(300)] + ["Red Gear", "red%gear", None, "", "ab"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    index = G.GramIndex.build(rows.select(F.lit("name").alias("field"), "id", "text").unionByName(
        rows.select(F.lit("other").alias("field"), "id", F.lit("red gear").alias("text"))), str(tmp_path / "ix"))
    asked = ["", "a", "ab", "aba", "ABAB", "a%b", "a_a", "ba%ab", "\\%", "a\\", "a\\_b", "red gear", "ed%ea", "zzz", "aéa", "é", "b a", "kab", "k", "%", "ab_ab"]
    asked += ["".join(rng.choices("abAB%_ ", k=rng.randrange(3, 7))) for _ in range(8)]
    for q in asked:
        want = {str(r["id"]) for r in rows.where(G.contains_ci("text", q)).select("id").collect()}
        assert {r["id"] for r in index.matches("name", q).collect()} == want, q
    assert index.candidates("name", "zqz").count() == 0 and index.candidates("name", "a%") is None


def test_only_asked_buckets_are_read(spark, tmp_path):
    rng = random.Random(3)
    names = ["".join(rng.choices("abcdefghij", k=12)) for _ in range(2000)]
    rows = spark.createDataFrame([("name", str(i), t) for i, t in enumerate(names)], "field string, id string, text string")
    index = G.GramIndex.build(rows, str(tmp_path / "ix"))
    found = index.candidates("name", names[0][:6])
    plan = found._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.split("\n") if "FileScan" in x)
    filters = scan.split("PartitionFilters:")[1].split("PushedFilters:")[0]
    assert "bucket" in filters and "field" in filters and "gram" in scan.split("PushedFilters:")[1]
    assert "0" in {r["id"] for r in found.collect()} and found.count() < 10
    postings = index.postings()
    buckets = [r[0] for r in spark.range(1).select(F.explode(F.array(*[G.bucket_of(F.lit(g)) for g in index.rarest("name", G.pattern_trigrams(names[0][:6]))]))).collect()]
    files = postings.where(F.col("bucket").isin(buckets)).select(F.input_file_name()).distinct().count()
    assert files < len(postings.inputFiles()) / 4


@pytest.fixture(scope="module")
def indexed(spark, sf_small, tmp_path_factory):
    st = star(spark, sf_small)
    return st, SR.build_index(st, str(tmp_path_factory.mktemp("grams") / "ix"))


@pytest.mark.parametrize(("endpoint", "params"), [
    ("courts", {"search": "of_B"}), ("judges", {"search": "000001"}), ("judges", {"search": "00"}), ("lawyers", {"lawyer": "promo", "limit": -1}),
    ("lawyers", {"law_firm": "#1"}), ("law_firms", {"search": "brand#2"}), ("tags", {"search": ""}), ("tags", {"search": "ed%ear"}),
    ("participants", {"participant": "customer#00000001", "lawyer": "a"}), ("participants", {"participant": "#0000000", "limit": -1}),
    ("participants", {"law_firm": "brand#1", "limit": 20})])
def test_endpoints_like_scans(indexed, endpoint, params):
    st, index = indexed
    plain, fast = SR.ENDPOINTS[endpoint](st, **params), SR.ENDPOINTS[endpoint](st, **params, index=index)
    assert plain.columns == fast.columns and sorted(map(str, plain.collect())) == sorted(map(str, fast.collect()))


@pytest.mark.parametrize("filters", [
    {"tag": "red", "judge": "00000002", "start_date": "1996-01-01", "end_date": "1997-12-31"}, {"title": "00000012", "citation": "no. ", "verdict": "urgent", "court": "COURT"},
    {"participant": "CUSTOMER#000000042", "lawyer": "promo", "law_firm": "brand#1"}, {"citation": "No. 1_", "tag": "zz"}])
def test_cases_like_scans(indexed, filters):
    st, index = indexed
    assert sorted(SR.court_case_ids(st, **filters).collect()) == sorted(SR.court_case_ids(st, **filters, index=index).collect())


def test_postings_are_dealt_out_once_and_by_their_number(spark, monkeypatch):
    """No aggregate before the shuffle, one shuffle, parts and salts that follow the rows; repeated ids count once."""
    monkeypatch.setattr(G, "_ROWS_A_TASK", 100)
    rows = [("title", str(i % 1000), f"Case Customer {i % 7}{i}") for i in range(1200)] + [("judge", "1", "ab"), ("judge", "2", "abc")]
    texts = spark.createDataFrame(rows, "field string, id string, text string")
    got = G._postings(texts)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("Exchange") > plan.rindex("HashAggregate")
    assert got.rdd.getNumPartitions() > 100
    want = {(f, i, t.lower()[k : k + 3]) for f, i, t in rows for k in range(len(t) - 2)}
    found = [(r["field"], r["id"], r["gram"]) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == want
