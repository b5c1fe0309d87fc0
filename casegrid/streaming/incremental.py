"""Incremental ingestion: seen-set anti join, notifications, subscriptions,
and the Structured Streaming form of the scheduled run.

Batch operators are pure DataFrame functions; ``run_incremental`` wires them
into ``readStream`` -> ``foreachBatch`` with ``trigger(availableNow=True)``
and a checkpoint, so each scheduled invocation processes exactly the new
files. A micro-batch is one commit over all tables that it changes, under its
batch id, so a failed one is retried without duplicates or gaps.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from casegrid.functions import text as TX
from casegrid.operators import reply as RP
from casegrid.operators import upsert as UP
from casegrid.session import scratch, stage_table

# Notification texts.
MESSAGE_TEMPLATE = "A new case has been uploaded from the %s"
MESSAGE_SUBJECT = "New case(s) uploaded"


def listing_scope(listing: DataFrame, courts: Sequence[str] | None = None, start=None, end=None) -> DataFrame:
    """Listing rows of the given courts, dated within the closed range; rows without a date are in no range."""
    rows = listing if courts is None else listing.where(F.col("court").isin(list(courts)))
    date = TX.parse_listing_date("date")
    if start is not None:
        rows = rows.where(date >= F.lit(start).cast("date"))
    if end is not None:
        rows = rows.where(date <= F.lit(end).cast("date"))
    return rows


def new_listing_rows(listing: DataFrame, seen: DataFrame, log_date=None,
                     compat: bool = False) -> DataFrame:
    """Listing rows whose citation is not yet seen.

    Late rows (dated before ``log_date``) are admitted by default, since the
    anti join is by citation; ``compat=True`` drops them like a date-scoped
    listing would. Of rows with one citation the first in page order
    (``scope_id``, ``pos``, url) stays.
    """
    rows = listing_scope(listing, start=log_date) if compat else listing
    rows = rows.join(seen.select("citation"), "citation", "left_anti")
    return UP.first_wins(rows, ["citation"], ["scope_id", "pos", "url"])


def validate_listing(rows: DataFrame, text_col: str = "text_raw") -> DataFrame:
    """All six listing fields must be non-blank strings; adds ``reason``."""
    fields = ["title", "url", "court", "citation", "date", text_col]
    missing = [F.when(F.col(c).isNull() | (F.trim(F.col(c)) == ""), F.lit(c)) for c in fields]
    reason = F.concat_ws(",", *missing)
    return rows.withColumn("reason", F.when(reason != "", F.concat(F.lit("blank:"), reason)))


def roll_seen(seen: DataFrame, today) -> DataFrame:
    """T4: keep only entries logged today (older log dates expire)."""
    return seen.where(F.col("log_date") >= F.lit(today).cast("date"))


def remember(citations: DataFrame, today) -> DataFrame:
    """Seen rows for every listing citation that passed validation."""
    return citations.select("citation", F.lit(today).cast("date").alias("log_date")).distinct()


def notify_outbox(new_cases: DataFrame, topics: DataFrame, batch_id) -> DataFrame:
    """One message per existing topic with new cases.

    ``new_cases(court)`` are rows not previously seen; ``topics(topic)`` the
    topics that exist (have subscribers). Keyed by (topic, batch_id).
    """
    courts = new_cases.select(TX.topic_name("court").alias("topic")).where(F.col("topic").isNotNull())
    hit = courts.join(topics.select("topic").distinct(), "topic", "left_semi").dropDuplicates(["topic"])
    display = TX.topic_display("topic")
    return hit.select(
        "topic", display.alias("court_display"), F.lit(batch_id).cast("long").alias("batch_id"),
        F.lit(MESSAGE_SUBJECT).alias("subject"),
        F.format_string(MESSAGE_TEMPLATE, display).alias("message"))


def subscribe(requests: DataFrame) -> DataFrame:
    """(email_input, courts array) -> subscription rows (topic, email).

    Requests without a valid email or with no court are rejected; duplicates
    collapse (insert-if-absent on (topic, email) is done by the caller's
    anti join against existing subscriptions).
    """
    email = TX.extract_email("email_input")
    ok = requests.where((email != "") & (F.size("courts") > 0))
    return ok.select(email.alias("email"), F.explode("courts").alias("court")).select(
        TX.topic_name("court").alias("topic"), "email").distinct()


# ---------------------------------------------------------------------------
# Structured Streaming driver
# ---------------------------------------------------------------------------

def dedup_stream(stream: DataFrame, key: str, event_time: str, delay: str = "1 day") -> DataFrame:
    """T3/T4 as streaming state: duplicates of ``key`` within the watermark are
    dropped; state older than the watermark is evicted (bounded state)."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


#: Groups of citations that share a state, by hash. A call for a group takes milliseconds whatever its rows, so a state for each citation would cost as many a batch.
STATE_GROUPS = 1024
_DAY_MS = 86_400_000


def _first_by_pair(citations: np.ndarray, days: np.ndarray, stamps: np.ndarray, ids: np.ndarray, known: tuple[list, list]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first row, by time, then id, of each (citation, day); and which of them aren't among the ``known`` pairs."""
    codes = pd.factorize(np.concatenate([np.array(known[0], object), citations]), use_na_sentinel=False)[0]
    every = np.concatenate([np.array(known[1], "int64"), days])
    low = every.min()
    pairs = codes.astype("int64") * (every.max() - low + 1) + every - low
    before, mine = pairs[:len(known[0])], pairs[len(known[0]):]
    order = np.lexsort((ids, stamps, mine))
    first = order[np.append(True, mine[order][1:] != mine[order][:-1])]
    return first, ~np.isin(mine[first], before)


def admit_daily(stream: DataFrame, delay: str) -> DataFrame:
    """T4 as keyed state: (citation, day, event_id) of the first sighting of a citation on each day.

    ``stream`` has (citation, ts, event_id). The state of a group of citations are the (citation, day) that were
    admitted, as long as rows of those days can still come; when the watermark (``delay`` behind the latest row) has passed
    a day, a timer removes what was admitted on it, so state is held for the citations
    of the last days only. Of a batch's rows of one day the first by time, then id, is admitted.
    """

    def admit(key, frames, state):
        known = state.get if state.exists else ([], [])
        passed, fresh = state.getCurrentWatermarkMs() // _DAY_MS, None
        kept = [(c, d) for c, d in zip(*known, strict=True) if d >= passed]
        rows = [] if state.hasTimedOut else list(frames)
        if rows:
            citations, stamps, ids = (np.concatenate([f[c].to_numpy() for f in rows]) for c in ("citation", "ts", "event_id"))
            days = stamps.astype("datetime64[D]").astype("int64")
            first, new = _first_by_pair(citations, days, stamps, ids, known)
            fresh = first[new]
            kept += [(c, d) for c, d in zip(citations[fresh].tolist(), days[fresh].tolist(), strict=True) if d >= passed]
        if kept:
            state.update(([c for c, _ in kept], [d for _, d in kept]))
            state.setTimeoutTimestamp((min(d for _, d in kept) + 1) * _DAY_MS)  # when the watermark has passed that day
        elif state.exists:
            state.remove()
        if fresh is not None and len(fresh):
            yield pd.DataFrame({"citation": citations[fresh], "day": days[fresh].astype("datetime64[D]").astype(object), "event_id": ids[fresh]})

    group = F.pmod(F.xxhash64("citation"), F.lit(STATE_GROUPS)).cast("int").alias("part")
    grouped = stream.withWatermark("ts", delay).select("citation", "ts", "event_id", group).groupBy("part")
    return grouped.applyInPandasWithState(
        admit, "citation string, day date, event_id long", "citations array<string>, days array<int>", "append", "EventTimeTimeout")


def _merged_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans [start, end) that overlap or touch as one, in order."""
    order = np.argsort(starts, kind="stable")
    starts, tops = starts[order], np.maximum.accumulate(ends[order])
    if not len(starts):
        return starts, tops
    begins = np.append(True, starts[1:] > tops[:-1])
    return starts[begins], tops[np.append(begins[1:], True)]


def subscribed_cases(cases: DataFrame, subscriptions: DataFrame, lasts: str, delay: str) -> DataFrame:
    """T7, T8 as a join of two streams: the cases (topic, ts) for which a subscription (topic, sub_ts) was in force.

    A subscription holds for ``lasts`` from its time on. Both streams meet in a state for each topic and day: the spans of
    time within which a subscription is in force, those that overlap as one, and the cases that none fits so far. So a case
    is looked up among disjoint spans, and not among all subscriptions of its topic. Both watermarks bound the state: a
    case is dropped when no subscription can come any more that fits it, and a day, when it has passed.
    """

    def meet(key, frames, state):
        if state.hasTimedOut:
            state.remove()
            return
        starts, ends, waiting = (np.array(x, "int64") for x in (state.get if state.exists else ([], [], [])))
        rows = pd.concat(list(frames))
        subs = rows[~rows["is_case"]]
        starts, ends = _merged_spans(np.append(starts, subs["at"].to_numpy("int64")), np.append(ends, subs["until"].to_numpy("int64")))
        asked = np.append(waiting, rows.loc[rows["is_case"], "at"].to_numpy("int64"))
        span = np.searchsorted(starts, asked, "right") - 1
        fits = (span >= 0) & (asked < ends[span]) if len(starts) else np.zeros(len(asked), bool)
        passed, closes_ms = state.getCurrentWatermarkMs(), int(key[1]) // 1000
        if closes_ms > passed:
            state.update((starts.tolist(), ends.tolist(), asked[~fits & (asked >= passed * 1000)].tolist()))
            state.setTimeoutTimestamp(closes_ms)  # when the watermark has passed that day
        elif state.exists:
            state.remove()
        yield pd.DataFrame({"topic": key[0], "at": asked[fits]})

    def closes(day: Column) -> Column:
        return F.unix_micros(F.date_add(day, 1).cast("timestamp"))

    at = F.unix_micros("ts")
    asked = cases.select("topic", "ts").where("topic IS NOT NULL AND ts IS NOT NULL").withWatermark("ts", delay).select(
        "topic", closes(F.to_date("ts")).alias("closes"), "ts", at.alias("at"), at.alias("until"), F.lit(True).alias("is_case"))
    until = F.expr(f"ts + INTERVAL {lasts}")
    held = subscriptions.select("topic", F.col("sub_ts").alias("ts")).where("topic IS NOT NULL AND ts IS NOT NULL").withWatermark("ts", delay).select(
        "topic", F.explode(F.sequence(F.to_date("ts"), F.to_date(until))).alias("day"), "ts", at.alias("at"), F.unix_micros(until).alias("until")).select(
        "topic", closes(F.col("day")).alias("closes"), "ts", "at", "until", F.lit(False).alias("is_case"))
    found = asked.unionByName(held).groupBy("topic", "closes").applyInPandasWithState(
        meet, "topic string, at long", "starts array<long>, ends array<long>, waiting array<long>", "append", "EventTimeTimeout")
    return found.select("topic", F.timestamp_micros("at").alias("ts"))


def notify_run(cases: DataFrame, subscriptions: DataFrame, warehouse: UP.Warehouse, checkpoint: str, lasts: str, delay: str) -> None:
    """Messages to the outbox, one for each topic and day, whatever micro-batches they come in."""

    def send(found: DataFrame, batch_id: int) -> None:
        load_id = f"notify-{batch_id}"
        if warehouse.committed(load_id) is None:
            new = found.select("topic", F.to_date("ts").alias("day")).distinct()
            there = warehouse.read("day_message", "topic string, day date, message string")
            display = TX.topic_display("topic")
            rows = UP.insert_if_absent(new, there, ["topic", "day"]).withColumn("message", F.format_string(MESSAGE_TEMPLATE, display))
            warehouse.append("day_message", rows, load_id)

    query = (subscribed_cases(cases, subscriptions, lasts, delay).writeStream.foreachBatch(send)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def count_days_run(stream: DataFrame, warehouse: UP.Warehouse, checkpoint: str, delay: str) -> None:
    """A9 as a windowed aggregate: the count of each day (of ``ts``) goes to ``day_count`` whenever it changes, with its batch.

    Rows that come after the watermark has passed their day aren't counted; with them goes the state of days gone by.
    """

    def keep_counts(changed: DataFrame, batch_id: int) -> None:
        load_id = f"days-{batch_id}"
        if warehouse.committed(load_id) is None:
            warehouse.append("day_count", changed.select(F.to_date("window.start").alias("day"), F.col("count").alias("n"),
                                                         F.lit(batch_id).cast("long").alias("batch_id")), load_id)

    counts = stream.withWatermark("ts", delay).groupBy(F.window("ts", "1 day")).count()
    query = (counts.writeStream.outputMode("update").foreachBatch(keep_counts).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def day_counts(warehouse: UP.Warehouse) -> DataFrame:
    """(day, n): the last count of each day."""
    return warehouse.read("day_count", "day date, n long, batch_id long").groupBy("day").agg(F.max_by("n", "batch_id").alias("n"))


def enrich_cached(rows: DataFrame, cache: DataFrame, enrich: Callable[[DataFrame], DataFrame],
                  keep: Callable[[DataFrame], DataFrame] = lambda made: made) -> DataFrame:
    """(citation, raw, hit) for each row: the cached reply, failures (null) included; misses go to ``enrich``.
    ``keep`` gets the replies (citation, raw) of the misses and returns them as they are to be read."""
    asked = rows.select("citation").distinct()
    hits = asked.join(cache.select("citation", "raw"), "citation").withColumn("hit", F.lit(True))
    misses = asked.join(cache, "citation", "left_anti")
    made = keep(misses.join(enrich(misses).select("citation", "raw"), "citation", "left"))
    return hits.unionByName(made.withColumn("hit", F.lit(False)))


def _raw_of_rejected(assembled: DataFrame) -> DataFrame:
    """Of valid cases the reply's text isn't needed any more."""
    return assembled.withColumn("raw", F.when(F.col("reason").isNotNull(), F.col("raw")))


def backfill(warehouse: UP.Warehouse, listing: DataFrame, enrich: Callable[[DataFrame], DataFrame],
             synonyms: DataFrame | None = None) -> DataFrame:
    """Load a whole listing once, by way of the enrichment cache; returns what ``enrich_cached`` did.

    Replies are written to the cache before they are judged and loaded, so a run
    that is repeated after a failure asks for nothing twice. They are read from there, and not written a second time.
    """
    cache = warehouse.read("reply_cache", "citation string, raw string")
    asked = warehouse.start()
    replies = enrich_cached(listing, cache, enrich, lambda made: asked.write("reply_cache", made))
    asked.publish()
    with scratch(warehouse.spark):
        good, bad = RP.split(stage_table(_raw_of_rejected(RP.assemble(listing, replies.select("citation", "raw"))), "assembled"))
        commit = UP.Commit(warehouse, uuid.uuid4().hex)
        UP.load_into(warehouse, good, synonyms, commit, staged=True)
        keep(commit, bad)
        commit.publish()
    return replies


def keep(commit: UP.Commit, bad: DataFrame) -> None:
    """Rejected rows that the quarantine doesn't have yet, with the load they belong to."""
    there = commit.warehouse.read("quarantine", "citation string, raw string, reason string, scope_id string")
    commit.write("quarantine", UP.insert_if_absent(bad, there, ["citation", "reason"]))


def process_batch(spark: SparkSession, listing: DataFrame, batch_id: int, warehouse: UP.Warehouse,
                  replies_for: Callable[[DataFrame], DataFrame], today,
                  synonyms: DataFrame | None = None, expire_seen: bool = False, fail_after: str | None = None) -> None:
    """One micro-batch of T1: unseen rows -> validate -> enrich -> assemble ->
    load -> quarantine -> outbox -> remember, all of it one commit under the
    batch's id: a batch that broke off leaves nothing and is done again, one that
    is committed isn't.

    With ``expire_seen`` only citations logged ``today`` count as seen (T4). The
    counts of the run (A22) are observed while the rows are written and go to
    ``run_log``.
    """
    load_id = f"batch-{batch_id}"
    if warehouse.committed(load_id) is not None or listing.isEmpty():  # T6: done before; T9: nothing new
        return
    commit = UP.Commit(warehouse, load_id, fail_after)
    commit.clear()
    remembered = warehouse.read("seen", "citation string, log_date date")
    seen = roll_seen(remembered, today) if expire_seen else remembered
    counted, judged = Observation("listing"), Observation("cases")
    blank = F.col("reason").isNotNull().cast("long")
    checked = validate_listing(new_listing_rows(listing, seen)).observe(
        counted, F.count(F.lit(1)).alias("new_rows"), F.sum(blank).alias("blank_rows"))
    with scratch(spark):  # all that stays is in the commit
        checked = stage_table(checked, "listing")
        valid = checked.where(F.col("reason").isNull()).drop("reason")
        replies = replies_for(valid)                    # X5 hook: (citation, raw)
        assembled = _raw_of_rejected(RP.assemble(valid, replies)).observe(
            judged, F.count(F.lit(1)).alias("cases"), F.sum(F.col("reason").isNotNull().cast("long")).alias("rejected"))
        assembled = stage_table(assembled, "assembled")
        good, bad = RP.split(assembled)
        gained = UP.load_into(warehouse, good, synonyms, commit, staged=True)
        rejected = checked.where(F.col("reason").isNotNull()).select(
            "citation", F.lit(None).cast("string").alias("raw"), "reason",
            F.col("scope_id").cast("string").alias("scope_id"))
        keep(commit, bad.unionByName(rejected))
        topics = warehouse.read("subscription", "topic string, email string")
        commit.write("outbox", notify_outbox(good.select(F.col("court_name").alias("court")), topics, batch_id))
        commit.write("seen", UP.insert_if_absent(remember(valid, today), seen, ["citation"]))
        counts = {"batch_id": batch_id, **counted.get, **judged.get, "loaded": gained["court_case"]}
        log = spark.createDataFrame([tuple(int(v or 0) for v in counts.values())], ", ".join(f"{k} long" for k in counts))
        commit.write("run_log", log)
        commit.publish()


def run_incremental(spark: SparkSession, listing_dir: str, listing_schema, warehouse_root: str,
                    checkpoint: str, replies_for: Callable[[DataFrame], DataFrame], today,
                    synonyms: DataFrame | None = None, max_files_per_trigger: int | None = None,
                    expire_seen: bool = False, fail_after: str | None = None):
    """Process every new listing file once (availableNow) and stop."""
    wh = UP.Warehouse(spark, warehouse_root)
    reader = spark.readStream.schema(listing_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(listing_dir)
    query = (stream.writeStream
             .foreachBatch(lambda df, bid: process_batch(spark, df, bid, wh, replies_for, today, synonyms, expire_seen, fail_after))
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    return query
