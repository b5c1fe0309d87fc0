"""The stored index says what matching against all known judges says, and does only a batch's work."""

import random

import pytest
from pyspark.sql import functions as F

from casegrid.functions.similarity import token_set_ratio
from casegrid.operators import upsert as UP
from casegrid.operators.judge_index import JudgeIndex
from tests.test_load import CASES, _case
from tests.test_resolve import _brute

PARTS = ["Anna", "Ana", "Lee", "Smith", "Smyth", "Lord", "Justice", "Jones", "Joness", "O'Neil", "ONeil", "de", "la", "Fontaine", "QC", "Ünal"]


def _add(spark, index, names):
    commit = index.warehouse.start()
    entered = index.add(commit, spark.createDataFrame([(x,) for x in names], "judge_name string"))
    commit.publish()
    return entered


def _match(spark, index, names):
    return {r["name"]: (r["matched_name"], r["score"]) for r in index.match(spark.createDataFrame([(x,) for x in names], "name string")).collect()}


@pytest.mark.parametrize("threshold", [95, 85, 70, 55])
def test_batches_like_brute_force(spark, tmp_path, threshold):
    rng = random.Random(threshold)
    index = JudgeIndex(UP.Warehouse(spark, str(tmp_path / "wh")), threshold)
    long = [" ".join(f"t{i}" for i in range(14)), "x" * 90]
    batches = [[" ".join(rng.sample(PARTS, rng.randrange(1, 4))) for _ in range(14)] + [f"Supplier#{i:09d}" for i in range(10 * b, 10 * b + 10)] for b in range(3)]
    batches[1] += long
    known: set[str] = set()
    for b, judges in enumerate(batches):
        assert _add(spark, index, [*judges, None, " ", judges[0]]) == len(set(judges) - known)
        known |= set(judges)
        names = {f"{j}1" for j in judges[:8]} | {f"Judge {j} KC" for j in judges[8:16]} | {" ".join(rng.sample(PARTS, rng.randrange(1, 5))) for _ in range(15)}
        names |= {"", " ", " ".join(f"t{i}" for i in range(13)) + " u", "x" * 88 + "yx", "Supplier #000000001", "Lord  Lee", f"Supplier#0000000{b}", "upplier#000000002"}
        got = _match(spark, index, [*sorted(names), None])
        assert set(got) == names
        assert {n: g for n, g in got.items() if g[1] is not None} == _brute(names, known, threshold), b


def test_only_the_work_of_a_batch(spark, tmp_path):
    wh = UP.Warehouse(spark, str(tmp_path / "wh"))
    index = JudgeIndex(wh)
    assert _match(spark, index, ["Judge Nobody"]) == {"Judge Nobody": ("Nobody", None)}  # none known
    _add(spark, index, ["Anna Lee Smith", "Supplier#000000001"])
    _match(spark, index, ["Anna Lee Smyth", "Supplier#000000012"])
    before = len(wh.manifests())
    assert _match(spark, index, ["Anna Lea Smith"])["Anna Lea Smith"] == _brute(["Anna Lea Smith"], ["Anna Lee Smith"], 95).get("Anna Lea Smith", ("Anna Lea Smith", None))
    assert len(wh.manifests()) == before  # lengths are covered, so nothing is written
    keys = index.read("keys").count()
    assert _add(spark, index, ["Anna Lee Smith"]) == 0 and index.read("keys").count() == keys
    assert _add(spark, index, ["Anne Lee Smith"]) == 1
    added = index.read("keys").where(F.col("s") == "Anne Lee Smith")
    assert {(r["length"], r["other"]) for r in added.collect()} == {(14, 14)}  # what was asked for, and no other length
    plan = index.candidates(spark.createDataFrame([("Supplier#000000013",)], "name string"))._jdf.queryExecution().toString()
    assert "judge_index_95_judges" not in plan and plan.count("bucket#") > 0 and "PartitionFilters: [bucket#" in plan.replace("isnotnull(", "").replace("In(", "")


def test_thresholds_have_indexes_of_their_own(spark, tmp_path):
    wh = UP.Warehouse(spark, str(tmp_path / "wh"))
    _add(spark, JudgeIndex(wh, 70), ["Anna Lee Smith"])
    assert token_set_ratio("Anne Leigh Smith", "Anna Lee Smith") >= 70
    assert _match(spark, JudgeIndex(wh, 70), ["Anne Leigh Smith"])["Anne Leigh Smith"][0] == "Anna Lee Smith"
    assert _match(spark, JudgeIndex(wh), ["Anne Leigh Smith"])["Anne Leigh Smith"] == ("Anne Leigh Smith", None)
    with pytest.raises(ValueError, match="threshold"):
        JudgeIndex(wh, 30)


def test_loads_by_the_index_are_the_same(spark, tmp_path):
    batches = [[_case("1", ["Anna Lee Smith", "Lee Smith"]), _case("2", ["Judge Lee Amy", "Amy"]), _case("3", ["Lee Smith CBE"])],
               [_case("4", ["Judge Lee Amy", "Smith Lee"]), _case("1", ["Lee Smith", "New Name"])]]
    seen = []
    for way in ("scan", "index"):
        wh = UP.Warehouse(spark, str(tmp_path / way))
        index = JudgeIndex(wh) if way == "index" else None
        gained = [UP.load_into(wh, spark.createDataFrame(b, CASES), judge_index=index) for b in (*batches, batches[0])]
        seen.append((gained, {tuple(r) for r in wh.read("judge_assignment").join(wh.read("judge"), "judge_id").select("court_case_id", "judge_name").collect()}))
    assert seen[0] == seen[1] and not any(seen[1][0][2].values())
    assert {r["s"] for r in index.read("judges").collect()} == {r["judge_name"] for r in wh.read("judge").collect()}
