import datetime as dt

from pyspark.sql import functions as F

from casegrid.operators import upsert as UP
from casegrid.sources import fixtures as FX
from casegrid.sources.tables import star
from casegrid.streaming import incremental as INC

SCHEMA = "title string, url string, court string, citation string, date string, text_raw string, scope_id string, pos int"


def test_new_rows_and_outbox(spark):
    listing = spark.createDataFrame(
        [("t", "u", "Privy Council", "c1", "1 Jan 2024", "x", "s", 0),
         ("later", "u", "Family Court", "c2", "1 Jan 2020", "x", "s", 2),
         ("t", "u", "Family Court", "c2", "1 Jan 2020", "x", "s", 1)], SCHEMA)
    seen = spark.createDataFrame([("c0",)], "citation string")
    assert sorted((r["citation"], r["title"]) for r in INC.new_listing_rows(listing, seen).collect()) == [("c1", "t"), ("c2", "t")]
    assert [r["citation"] for r in INC.listing_scope(listing, ["Privy Council"], "2024-01-01", "2024-01-01").collect()] == ["c1"]
    assert INC.new_listing_rows(listing, seen, "2023-01-01", compat=True).count() == 1
    topics = INC.subscribe(spark.createDataFrame(
        [("me@x.org", ["Family Court"]), ("bad", ["Privy Council"]), ("you@y.org", [])],
        "email_input string, courts array<string>"))
    assert [r["topic"] for r in topics.collect()] == ["c12-courts-Family-Court"]
    box = INC.notify_outbox(INC.new_listing_rows(listing, seen), topics, 7).collect()
    assert [(r["topic"], r["batch_id"], r["message"]) for r in box] == [
        ("c12-courts-Family-Court", 7, "A new case has been uploaded from the Family Court")]


def test_seen_expires_and_cache_is_asked_first(spark):
    seen = spark.createDataFrame([("c1", dt.date(2024, 1, 1)), ("c2", dt.date(2024, 1, 2))], "citation string, log_date date")
    assert [r["citation"] for r in INC.roll_seen(seen, dt.date(2024, 1, 2)).collect()] == ["c2"]
    rows = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), ("d",)], "citation string")
    cache = spark.createDataFrame([("a", "kept"), ("b", None)], "citation string, raw string")
    asked = []

    def enrich(misses):
        asked.extend(sorted(r["citation"] for r in misses.collect()))
        return misses.where("citation = 'c'").withColumn("raw", F.lit("made"))

    got = {r["citation"]: (r["hit"], r["raw"]) for r in INC.enrich_cached(rows, cache, enrich).collect()}
    assert got == {"a": (True, "kept"), "b": (True, None), "c": (False, "made"), "d": (False, None)} and asked == ["c", "d"]


def test_backfill_asks_once(spark, sf_small, tmp_path):
    st = star(spark, sf_small)
    listing, replies = FX.listing_rows(st), FX.synthetic_replies(st)
    wh = UP.Warehouse(spark, str(tmp_path / "wh"))
    hook = lambda misses: replies.where("citation % 3 <> 0").join(misses, "citation", "left_semi")
    first = INC.backfill(wh, listing, hook)
    assert first.where("hit").count() == 0 and first.count() == listing.count()
    loaded, kept = wh.read("court_case").count(), wh.read("quarantine").count()
    assert loaded > 0 and wh.read("quarantine").where("reason = 'no_reply'").count() == listing.where("citation % 3 = 0").count()
    again = INC.backfill(wh, listing, hook)
    assert again.where("not hit").count() == 0
    assert (wh.read("court_case").count(), wh.read("quarantine").count()) == (loaded, kept)


def test_stream_equals_batch(spark, sf_small, tmp_path):
    st = star(spark, sf_small)
    listing = FX.listing_rows(st).withColumn("year", F.regexp_extract("date", " ([0-9]{4})", 1))
    listing.write.partitionBy("year").parquet(str(tmp_path / "listing"))
    replies = FX.synthetic_replies(st)
    hook = lambda valid: replies.join(valid.select("citation"), "citation", "left_semi")
    INC.run_incremental(spark, str(tmp_path / "listing"), SCHEMA, str(tmp_path / "wh"),
                        str(tmp_path / "ckpt"), hook, dt.date(2024, 1, 1), max_files_per_trigger=3)
    wh = UP.Warehouse(spark, str(tmp_path / "wh"))
    streamed = {r[0] for r in wh.read("court_case").select("court_case_id").collect()}
    from casegrid.operators import reply as RP
    dated = FX.listing_rows(st).where("date <> ''")
    good, bad = RP.split(RP.assemble(dated, replies))
    assert streamed == {r[0] for r in good.select("court_case_id").collect()}
    assert wh.read("quarantine").count() == bad.count() + FX.listing_rows(st).where("date = ''").count()
    assert wh.read("seen").count() == dated.count()
    log = wh.read("run_log").agg(F.sum("new_rows"), F.sum("blank_rows"), F.sum("cases"), F.sum("rejected"), F.sum("loaded")).first()
    assert tuple(log) == (FX.listing_rows(st).count(), FX.listing_rows(st).where("date = ''").count(), dated.count(), bad.count(), len(streamed))
    # a second run finds no new files and changes nothing
    INC.run_incremental(spark, str(tmp_path / "listing"), SCHEMA, str(tmp_path / "wh"),
                        str(tmp_path / "ckpt"), hook, dt.date(2024, 1, 1))
    assert wh.read("court_case").count() == len(streamed)


def _sightings(spark, path, rows):
    frame = spark.createDataFrame(rows, "citation string, ts string, event_id long").withColumn("ts", F.to_timestamp("ts"))
    frame.coalesce(1).write.mode("append").parquet(path)


def _admit(spark, tmp_path):
    stream = spark.readStream.schema("citation string, ts timestamp, event_id long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = (INC.admit_daily(stream, "1 day").writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out"))
             .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start())
    query.awaitTermination()
    return query.lastProgress["stateOperators"][0]["numRowsTotal"]


def test_a_citation_is_admitted_once_a_day(spark, tmp_path):
    """Day 1, again on day 1 (dropped), day 3 (admitted); the state of citations gone by expires, in runs of their own, too."""
    place = str(tmp_path / "in")
    _sightings(spark, place, [("a", "2024-01-01 10:00:00", 2), ("a", "2024-01-01 09:00:00", 1), ("b", "2024-01-01 10:00:00", 3)])
    _sightings(spark, place, [("a", "2024-01-01 12:00:00", 4), ("c", "2024-01-02 10:00:00", 5), ("a", "2024-01-01 13:00:00", 6)])
    assert _admit(spark, tmp_path) == 3
    _sightings(spark, place, [("a", "2024-01-03 01:00:00", 7), ("a", "2024-01-03 02:00:00", 8), ("c", "2024-01-02 11:00:00", 9)])
    _admit(spark, tmp_path)
    _sightings(spark, place, [("d", "2024-01-09 01:00:00", 10)])
    _sightings(spark, place, [("d", "2024-01-09 02:00:00", 11), ("b", "2024-01-09 02:00:00", 12)])
    assert _admit(spark, tmp_path) == 2
    got = spark.read.schema("citation string, day date, event_id long").parquet(str(tmp_path / "out")).collect()
    assert sorted((r["citation"], str(r["day"]), r["event_id"]) for r in got) == [
        ("a", "2024-01-01", 1), ("a", "2024-01-03", 7), ("b", "2024-01-01", 3), ("b", "2024-01-09", 12), ("c", "2024-01-02", 5), ("d", "2024-01-09", 10)]
