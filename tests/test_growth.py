"""Work that must not grow faster than its input: what a load works out once, and how two streams meet."""

import datetime as dt
import threading
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from casegrid.operators import reply as RP
from casegrid.operators import resolve as RS
from casegrid.operators import upsert as UP
from casegrid.session import shared_dir, stage_table
from casegrid.sources import fixtures as FX
from casegrid.sources.tables import star
from casegrid.streaming import incremental as INC


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_load_works_out_each_table_once(spark, sf_small):
    """What ``keep`` returns is read by the tables that come later, and a table known to be empty is in no join."""
    st = star(spark, sf_small)
    cases = stage_table(RP.split(RP.assemble(FX.listing_rows(st), FX.synthetic_replies(st)))[0], "t")
    kept = []

    def keep(name, rows):
        kept.append(name)
        return stage_table(rows, f"kept-{name}")

    new = UP.load_batch(cases, UP.empty_tables(spark, seeded=False), materialize=lambda df: stage_table(df, "m"), keep=keep)
    assert sorted(kept) == sorted(UP.LOAD_ORDER)
    assert all("Exchange" not in _plan(df) for df in new.values())  # read as kept
    empty = UP.no_rows(spark, UP.SCHEMAS["judge"])
    assert empty.count() == 0 and empty.dtypes == [("judge_id", "bigint"), ("judge_name", "string")]
    assert "Join" not in _plan(UP.insert_if_absent(new["judge"], empty, ["judge_name"]))


def _few_cases(spark):
    st = star(spark, "/root/testdata/sf0.001")
    return stage_table(RP.split(RP.assemble(FX.listing_rows(st), FX.synthetic_replies(st)))[0].where("court_case_id < 20"), "t")


def test_parts_of_a_load_run_at_the_same_time(spark):
    """Each of the four waits for the others at its first table; a failure of one is the load's, after all have ended."""
    meet, kept = threading.Barrier(4), []

    def keep(name, rows):
        if name in ("court", "judge_match", "tag", "law_firm"):
            meet.wait(timeout=120)
        kept.append(name)
        if name == "tag":
            raise UP.Crash(name)
        return stage_table(rows, f"kept-{name}")

    with pytest.raises(UP.Crash, match="tag"):
        UP.load_batch(_few_cases(spark), UP.empty_tables(spark), materialize=lambda df: stage_table(df, "m"), keep=keep)
    assert sorted(kept) == sorted(set(UP.LOAD_ORDER) - {"tag_assignment"})


def test_keys_are_compared_only_of_repeated_ids(spark, tmp_path, monkeypatch):
    with monkeypatch.context() as m:
        m.setattr(UP, "id_collisions", None)
        assert UP.load_into(UP.Warehouse(spark, str(tmp_path / "a")), _few_cases(spark))["judge"] > 1
    one = UP.surrogate_id
    monkeypatch.setattr(UP, "surrogate_id", lambda table, *cols: F.lit(7).cast("long") if table in ("judge", "tag") else one(table, *cols))
    with pytest.raises(ValueError, match="hashed ids collide: judge, tag"):
        UP.load_into(UP.Warehouse(spark, str(tmp_path / "b")), _few_cases(spark))


def test_deletion_keys_are_made_in_all_tasks(spark, monkeypatch):
    """However few bytes the strings have that they are made of."""
    files = []

    def staged(df, name):
        out = stage_table(df, name)
        files.extend(Path(out.inputFiles()[0]).parts[-2:-1] * len(out.inputFiles()) if name == "judge-strings" else [])
        return out

    monkeypatch.setattr(RS, "stage_table", staged)
    names = spark.range(100).selectExpr("concat('Judge Ann', id) AS name")
    judges = spark.range(100).selectExpr("concat('Ann', id) AS judge_name")
    assert RS.match_judges(names, judges).count() == 100
    assert len(files) == spark.sparkContext.defaultParallelism  # it was 1


def test_replies_are_shuffled_once(spark, sf_small):
    st = star(spark, sf_small)
    with_replies = _plan(RP.assemble(FX.listing_rows(st), FX.synthetic_replies(st)))
    alone = _plan(FX.listing_rows(st)) + _plan(FX.synthetic_replies(st))
    assert with_replies.count("Exchange hashpartitioning") - alone.count("Exchange hashpartitioning") <= 2  # it was 3


def test_rows_of_a_commit_are_counted(spark, tmp_path):
    commit = UP.Warehouse(spark, str(tmp_path / "wh")).start("x")
    rows = spark.range(5).selectExpr("id AS court_id", "'x' AS court_name")
    commit.write("court", rows)
    commit.write("tag", rows, partition_by="court_id")
    commit.write("judge", rows.where("court_id > 7"))
    assert {name: n for name, (_, n, _) in commit.written.items()} == {"court": 5, "tag": 5, "judge": 0}


def test_cases_meet_subscriptions_of_both_orders(spark, tmp_path):
    """Cases that come before, with and after their subscription, over several batches; against all pairs."""
    rng = np.random.default_rng(7)
    start = dt.datetime(2024, 1, 1)

    def times(n, day):
        return [start + dt.timedelta(days=day, seconds=int(s)) for s in rng.integers(0, 2 * 86400, n)]

    cases, subs = [], []
    for k in range(4):
        cases.append([("a" if i % 3 else "b", t) for i, t in enumerate(times(60, 2 * k))])
        subs.append([("a" if i % 2 else "c", t) for i, t in enumerate(times(3, 2 * k))])
    subs[1].append(("b", start + dt.timedelta(days=3)))
    for k in range(4):
        spark.createDataFrame(cases[k], "topic string, ts timestamp").coalesce(1).write.mode("append").parquet(str(tmp_path / "cases"))
        spark.createDataFrame(subs[k], "topic string, sub_ts timestamp").coalesce(1).write.mode("append").parquet(str(tmp_path / "subs"))
    read = spark.readStream.option("maxFilesPerTrigger", 1)
    found = INC.subscribed_cases(read.schema("topic string, ts timestamp").parquet(str(tmp_path / "cases")),
                                 read.schema("topic string, sub_ts timestamp").parquet(str(tmp_path / "subs")), "30 HOURS", "3 days")
    assert "Join" not in found._jdf.queryExecution().analyzed().toString()  # which compared each case with all subscriptions of its topic
    found.writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start().awaitTermination()
    held = [s for part in subs for s in part]
    wanted = sorted(c for part in cases for c in part if any(
        c[0] == t and s <= c[1] < s + dt.timedelta(hours=30) for t, s in held))
    assert sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == wanted
    assert 0 < len(wanted) < sum(map(len, cases))


def test_parts_of_the_bridges_follow_the_rows(spark, sf_small, monkeypatch):
    """What a task holds of a bridge is bounded by rows, and not by the size that they have when they are compressed."""
    from casegrid.sources import tables as TB

    whole = {tuple(r) for r in star(spark, sf_small).judge_assignment.collect()}
    rows = star(spark, sf_small).raw("lineitem").count()
    monkeypatch.setattr(TB, "ROWS_A_TASK", rows // 10)
    st = star(spark, sf_small)
    for bridge in (st.judge_assignment, st.tag_assignment):
        sizes = [r["count"] for r in bridge.groupBy(F.spark_partition_id().alias("part")).count().collect()]
        assert len(sizes) >= 10 and max(sizes) < rows / 5
    assert {tuple(r) for r in st.judge_assignment.collect()} == whole


def test_what_a_task_holds_of_a_bridge_is_the_same_at_two_sizes():
    """Rows of a part at 6 and 60 times sf0.1, on three executors of four cores; it grew by two thirds."""
    from types import SimpleNamespace

    from casegrid.sources.tables import Star

    def rows_of_a_part(rows):
        st = Star(SimpleNamespace(sparkContext=SimpleNamespace(defaultParallelism=12)), "")
        st.raw = lambda name: SimpleNamespace(count=lambda: rows)
        return rows / st._parts

    assert rows_of_a_part(36_000_000) < 1.1 * rows_of_a_part(3_600_000)


def test_a_batch_makes_a_call_for_a_group_of_citations(spark, tmp_path):
    """However many citations it has; each had a state, and a call, of its own. The first of each day is admitted, over two batches."""
    rng = np.random.default_rng(3)
    rows = [(f"c{int(c)}", dt.datetime(2024, 1, 1 + int(d)) + dt.timedelta(seconds=int(s)), i)
            for i, (c, d, s) in enumerate(zip(rng.integers(0, 6000, 9000), rng.integers(0, 2, 9000), rng.integers(0, 86400, 9000)))]
    days = [[r for r in rows if r[1].day == d] for d in (1, 2)]
    for part in (days[0], days[1] + days[0][:50]):
        spark.createDataFrame(part, "citation string, ts timestamp, event_id long").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("citation string, ts timestamp, event_id long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = (INC.admit_daily(stream, "1 day").writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out"))
             .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start())
    query.awaitTermination()
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) <= INC.STATE_GROUPS  # it was over 4,000
    wanted = {}
    for c, ts, i in sorted(rows, key=lambda r: (r[1], r[2])):
        wanted.setdefault((c, ts.date()), i)
    found = spark.read.schema("citation string, day date, event_id long").parquet(str(tmp_path / "out")).collect()
    assert len(found) == len(wanted) and {(r["citation"], r["day"]): r["event_id"] for r in found} == wanted


def test_a_first_load_deals_no_whole_rows_out(spark):
    """Ids tell that no case is known or comes twice; whole rows were sorted and dealt out to find that."""
    plans = {}

    def keep(name, rows):
        plans[name] = _plan(rows)
        return stage_table(rows, f"kept-{name}")

    UP.load_batch(_few_cases(spark), UP.empty_tables(spark), materialize=lambda df: stage_table(df, "m"), keep=keep)
    assert "Aggregate" not in plans["court_case"] and "hashpartitioning(court_case_id" not in plans["court_case"]
    assert "SortAggregate" not in plans["participant_assignment"]
    assert all(plans[t].count("hashpartitioning(court_case_id") <= 1 for t in ("judge_assignment", "tag_assignment", "participant_assignment"))


@pytest.mark.parametrize("few", [0, 1000])
def test_cases_that_come_twice_or_are_known(spark, monkeypatch, few):
    """Whether the batch's ids are sent to the stored tables or not."""
    monkeypatch.setattr(UP, "FEW_CASES", few)
    row = _few_cases(spark).limit(1).drop("court_case_id", "summary")
    cases = stage_table(row.crossJoin(spark.createDataFrame([("a", "late", 2), ("a", "early", 1), ("b", "x", 5), (None, "n", 3)], "court_case_id string, summary string, place int")), "t")

    def load(tables, rows):
        return UP.load_batch(rows, tables, order_col="place", materialize=lambda df: stage_table(df, "m"), keep=lambda n, r: stage_table(r, n))

    empty = UP.empty_tables(spark)
    first = load(empty, cases.where("court_case_id = 'b'"))
    then = load(empty.union(first), cases)
    assert {(r["court_case_id"], r["summary"]) for r in then["court_case"].collect()} == {("a", "early"), (None, "n")}
    for bridge in UP.BRIDGES:
        assert {r["court_case_id"] for r in then[bridge].collect()} == {"a", None}
        assert then[bridge].distinct().count() == then[bridge].count() == (2 if bridge == "judge_assignment" else 4)  # both names of a judge that is known are one
    assert load(empty.union(first).union(then), cases)["court_case"].count() == 0


def _staged(spark):
    return {p.name for p in Path(shared_dir(spark, "x")).parent.iterdir()}


def test_what_a_load_stages_is_deleted(spark, sf_small, tmp_path):
    st = star(spark, sf_small)
    listing, replies = stage_table(FX.listing_rows(st).where("citation < 40"), "l"), stage_table(FX.synthetic_replies(st), "r")
    there = _staged(spark)
    wh = UP.Warehouse(spark, str(tmp_path / "wh"))
    found = INC.backfill(wh, listing, lambda misses: replies.join(misses, "citation", "left_semi"))
    assert _staged(spark) == there  # replies, parsed cases and the parts of the load were there for good
    assert found.where("raw IS NOT NULL").count() == listing.count() == wh.read("reply_cache", "citation string, raw string").count()
    with pytest.raises(UP.Crash):
        UP.load_into(wh, _few_cases(spark), commit=UP.Commit(wh, "x", "tag"))
    assert not {name for name in _staged(spark) if name.startswith("scratch")}


def test_loads_that_break_off_are_whole_loads(spark, sf_small, tmp_path, monkeypatch):
    """The query's attempts go through ``load_into``, and one that broke off leaves nothing behind when it is done anew."""
    from casegrid.plans import catalog

    tried, load = [], UP.load_into

    def spied(wh, cases, commit=None, staged=False):
        tried.append(commit and commit.fail_after)
        if commit is None:
            load(wh, cases, staged=True)
        elif commit.fail_after:
            raise UP.Crash(commit.fail_after)

    with monkeypatch.context() as m:
        m.setattr(UP, "load_into", spied)
        catalog._load_after_failures(spark, sf_small)
    assert tried[:13] == [None, *catalog._COUNTED_TABLES, None]  # they wrote rows that had been worked out before
    wh, cases = UP.Warehouse(spark, str(tmp_path / "wh")), _few_cases(spark)
    for fail_after in ("tag", None):
        commit = UP.Commit(wh, "second", fail_after)
        commit.clear()
        if fail_after:
            with pytest.raises(UP.Crash, match="tag"):
                load(wh, cases, commit=commit)
            with pytest.raises(UP.Crash):
                commit.publish()
            assert wh.committed("second") is None and wh.read("court_case").count() == 0
        else:
            load(wh, cases, commit=commit)
            commit.publish()
    assert wh.read("court_case").count() == cases.count() and "pair_change" in wh.committed("second")
    assert len(list((tmp_path / "wh/data/tag").iterdir())) == 1
