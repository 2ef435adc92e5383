"""The streaming jobs fed from files, against the batch operators."""

import json
import os
import time
from datetime import date, datetime, timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import Row, functions as F

from tests.conftest import SMALL
from tidemark.functions import parsing
from tidemark.operators import panes, sequence
from tidemark.plans import intents, nightly, reports
from tidemark.sources import adapters, sinks, tables, topic
from tidemark.streaming import counters, jobs
from tidemark.streaming.processor import newest_snapshot

T0 = 1_700_000_000_000
STAMP = datetime(2023, 11, 20)
MINUTE = 60_000


def iso(ms):
    return time.strftime("%Y-%m-%dT%H:%M:%S", time.gmtime(ms / 1000)) + f".{ms % 1000:03d}Z"


def message(customer, ms, category, amount, **more):
    return {"customer_id": customer, "event_ts": iso(ms), "merchant_category": category, "amount": amount,
            "has_credit_card": 0, **more}


class Topics:
    """Three folders of message files standing in for topics; files are taken in the order written."""

    def __init__(self, root):
        self.root, self.n = root, 0
        for name in ("txn", "product", "scores"):
            os.makedirs(f"{root}/{name}")

    def put(self, name, messages):
        self.n += 1
        path = f"{self.root}/{name}/{self.n:04d}.json"
        with open(path + ".tmp", "w") as f:
            f.writelines((m if isinstance(m, str) else json.dumps(m)) + "\n" for m in messages)
        stamp = time.time() - 1000 + self.n
        os.utime(path + ".tmp", (stamp, stamp))
        os.rename(path + ".tmp", path)

    def stream(self, spark, name):
        return tables.read_message_files(spark, f"{self.root}/{name}/*.json", files_per_trigger=1)

    def start(self, spark, run=1, tick_ms=None):
        return jobs.start_intents(
            parsing.parse_transactions(self.stream(spark, "txn")),
            parsing.parse_product_events(self.stream(spark, "product")),
            parsing.parse_scores(self.stream(spark, "scores")),
            f"{self.root}/out", f"{self.root}/checkpoint{run}", run, lambda: STAMP + timedelta(days=run), trigger="1 second",
            tick_ms=tick_ms, counters=f"{self.root}/counters",
        )

    def state(self, spark, name):
        return spark.read.format("statestore").option("stateVarName", name).load(f"{self.root}/checkpoint1")


def wait_for(query, done, seconds=150):
    """Wait until the progress reports satisfy `done`; such a query keeps running empty batches."""
    end = time.time() + seconds
    while time.time() < end:
        query.awaitTermination(1)
        if query.exception():
            raise query.exception()
        if done([p for p in query.recentProgress]):
            return
    raise AssertionError("stream did not get there in time")


def rows_in(progress):
    return sum(s.numInputRows for p in progress for s in p.sources)


@pytest.fixture()
def topics(tmp_path):
    return Topics(str(tmp_path))


def idle_after(total):
    """All rows taken in and a later, empty batch finished."""
    return lambda progress: rows_in(progress) >= total and progress[-1].numInputRows == 0


def test_scores_offers_dedup_and_late_events(spark, topics):
    home = ["home_improvement", "furniture", "kitchen_appliances"]
    topics.put("scores", [{"customer_id": "CUST_BCAST", "scores": {
                               "home_loan": 68.0, "credit_card": 55.0, "fixed_deposit": 50.0, "personal_loan": 48.0},
                           "score_ts": "2026-04-18T11:00:00Z"},
                          {"customer_id": "CUST_DEDUP", "scores": {"home_loan": 60.0}},
                          {"customer_id": "CUST_LATE", "scores": {"home_loan": 60.0}}, "not json"])
    topics.put("product", [{"customer_id": "CUST_BCAST", "event_ts": iso(T0), "product": "home_loan"}])
    # one message that cannot be summed must not stop the job
    topics.put("txn", [message("CUST_BCAST", T0, "furniture", a) for a in ("NaN", 1e20)])
    topics.put("txn", [message("CUST_BCAST", T0, c, 700.0) for c in home]
               + [message("CUST_DEDUP", T0, c, a) for c, a in zip(home, (800.0, 700.0, 700.0))]
               + [message("CUST_NEW", T0, "furniture", 2500.0), message("", T0, "furniture", 9000.0)])
    query = topics.start(spark)
    try:
        wait_for(query, idle_after(15))
        # the second session of the same day, and a row 25 minutes behind the newest event
        topics.put("txn", [message("CUST_DEDUP", T0 + i, c, 800.0) for i, c in enumerate(home)]
                   + [message("CUST_LATE", T0 - 25 * MINUTE, "home_improvement", 3000.0)])
        wait_for(query, idle_after(19))
    finally:
        query.stop()
    metrics = [p.observedMetrics["intent_input"] for p in query.recentProgress if "intent_input" in p.observedMetrics]
    assert sum(m.score_updates for m in metrics) == 3
    assert sum(m.events for m in metrics) == 12

    out = f"{topics.root}/out"
    stored = {r.customer_id: r for r in spark.read.parquet(f"{out}/intents").collect()}
    assert len(stored) == spark.read.parquet(f"{out}/intents").count() == 4
    assert stored["CUST_LATE"].is_late and not stored["CUST_BCAST"].is_late
    assert stored["CUST_NEW"].composite_score == 73.0
    assert stored["CUST_DEDUP"].pattern_metric == 2200.0
    assert stored["CUST_BCAST"].category_spend_7d == dict.fromkeys(home, 700.0)

    flat = parsing.flatten_offers(spark.read.parquet(f"{out}/offers"), ["received_at"])
    offers = {r.customer_id: r for r in flat.collect()}
    lists = spark.createDataFrame([("CUST_BCAST", "home_loan", 68.0, datetime(2023, 11, 1), "HOT", datetime(2023, 11, 1))],
                                  "customer_id string, product_family string, propensity_score double, score_ts timestamp, "
                                  "campaign_segment string, generated_at timestamp")
    feed = reports.intent_feed(flat, lists).collect()
    assert {r.customer_id for r in feed} == set(offers) and all(r.received_at == STAMP + timedelta(days=1) for r in feed)
    assert set(offers) == {"CUST_BCAST", "CUST_DEDUP", "CUST_LATE"}
    assert (offers["CUST_BCAST"].base_score, offers["CUST_BCAST"].final_score) == (68.0, 96.0)
    assert offers["CUST_BCAST"].trigger_event == "home_improvement_session_spend_gt_2000"
    assert offers["CUST_DEDUP"].final_score > 75

    (late,) = spark.read.parquet(f"{out}/late").collect()
    raw = json.loads(late.raw_event)
    assert late.arrived_at == STAMP + timedelta(days=1)
    assert (late.customer_id, raw["customer_id"], raw["event_ts_ms"]) == ("CUST_LATE", "CUST_LATE", T0 - 25 * MINUTE)


def test_stream_equals_batch(spark, topics):
    """The sample events in four files, cut by time: the stream keeps the same intents as the batch."""
    events = adapters.all_events(spark, SMALL)
    txn = adapters.transaction_messages(spark, SMALL).join(events.select("event_id", "event_ts_ms"), "event_id")
    product = adapters.product_messages(spark, SMALL).join(events.select("event_id", "event_ts_ms"), "event_id")
    bounds = events.approxQuantile("event_ts_ms", [0.25, 0.5, 0.75], 0.0)
    edges = [0, *map(int, bounds), 2**62]
    for low, high in zip(edges, edges[1:]):
        part = (F.col("event_ts_ms") >= low) & (F.col("event_ts_ms") < high)
        for name, messages in (("txn", txn), ("product", product)):
            topics.put(name, [r.value for r in messages.where(part).collect()])
    query = topics.start(spark)
    try:
        wait_for(query, idle_after(events.count()))
    finally:
        query.stop()
    fields = ["customer_id", "product", "pattern_name", "pattern_metric", "event_ts_ms", "session_window_ms",
              "category_spend_7d", "event_id"]
    none = spark.createDataFrame([], "customer_id string, product_family string, propensity_score double")
    batch = intents.intent_events(events, none)
    key = lambda r: (r.customer_id, r.product, r.event_ts_ms)
    got = sorted(spark.read.parquet(f"{topics.root}/out/intents").select(*fields).collect(), key=key)
    assert got == sorted(batch.select(*fields).collect(), key=key)


def test_sliding_spend_stream(spark, topics):
    day = 86_400_000
    base = T0 // day * day
    topics.put("txn", [message("a", base + i * day, "retail", 10.25 + i) for i in range(4)]
               + [message("a", base, "unknown", 5.0), message("", base, "retail", 5.0)])
    topics.put("txn", [message("a", base + 4 * day, "retail", 1.0)])
    out = f"{topics.root}/spend"
    def run(number):
        query = jobs.start_sliding_spend(
            parsing.parse_transactions(topics.stream(spark, "txn")), out, f"{topics.root}/checkpoint{number}", number,
            lambda: STAMP + timedelta(days=number), "1 second")
        try:
            query.processAllAvailable()
        finally:
            query.stop()

    run(1)
    parsed = parsing.parse_transactions(spark.read.text(f"{topics.root}/txn"))
    want = panes.sliding_spend(parsing.drop_blank_keys(parsing.known_categories(parsed)))
    columns = ["window_end_ms", "customer_id", "merchant_category", "total_spend", "event_count"]
    got = sinks.latest_by_key(spark.read.parquet(out)).select(*columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*columns).collect()))

    # a new checkpoint folder: newer values win, and the nightly snapshot reads the stored feed as it is
    topics.put("txn", [message("a", base + 4 * day, "retail", 100.0)])
    run(2)
    parsed = parsing.parse_transactions(spark.read.text(f"{topics.root}/txn"))
    want = panes.sliding_spend(parsing.drop_blank_keys(parsing.known_categories(parsed)))
    current = sinks.latest_by_key(spark.read.parquet(out))
    assert sorted(map(tuple, current.select(*columns).collect())) == sorted(map(tuple, want.select(*columns).collect()))
    sinks.replace_days(nightly.nightly_enrichment(current, date(2023, 11, 21)), f"{topics.root}/nightly")
    (row,) = spark.read.parquet(f"{topics.root}/nightly").collect()
    last = max(want.collect(), key=lambda r: r.window_end_ms)
    assert (row.total_spend, row.source_updated_at) == (last.total_spend, STAMP + timedelta(days=2))


def test_a_new_start_repeats_and_loses_nothing(spark, topics):
    topics.put("scores", [{"customer_id": "a", "scores": {"home_loan": 60.0}}])
    topics.put("product", [{"customer_id": "a", "event_ts": iso(T0), "product": "home_loan"}])
    topics.put("txn", [message("a", T0, "furniture", 2500.0)])
    query = topics.start(spark, 1)
    try:
        wait_for(query, idle_after(3))
    finally:
        query.stop()
    topics.put("txn", [message("b", T0, "furniture", 2500.0)])
    query = topics.start(spark, 2)
    try:
        wait_for(query, idle_after(4))
    finally:
        query.stop()
    end = time.time() + 30  # listeners hear of a batch a little later
    path = f"{topics.root}/counters"
    while time.time() < end and (not os.path.exists(f"{path}/run=2") or counters.totals(counters.stored_counters(spark, path)).first()[1] < 5):
        time.sleep(0.5)
    told = counters.stored_counters(spark, path)
    assert {r.run for r in told.collect()} == {1, 2} and tuple(counters.totals(told).first()) == (2, 5)
    # a batch that is told of again is not counted twice
    again = counters.CounterLog(spark, path, 1, "q", "m")
    row = told.where("run = 1").first()
    progress = SimpleNamespace(name="q", batchId=row.batch_id, timestamp="t", observedMetrics={"m": Row(score_updates=1, events=99)})
    again.onQueryProgress(SimpleNamespace(progress=progress))
    assert tuple(counters.totals(counters.stored_counters(spark, path)).first()) == (2, 5)
    stored = spark.read.parquet(f"{topics.root}/out/intents").collect()
    assert sorted(r.customer_id for r in stored) == ["a", "b"] and stored[0].event_date == date(2023, 11, 14)
    offers = parsing.flatten_offers(spark.read.parquet(f"{topics.root}/out/offers"), ["received_at"]).collect()
    assert [(r.customer_id, r.received_at) for r in offers] == [("a", STAMP + timedelta(days=1))]


def snapshot(customer, home_loan, ms=None):
    return {"customer_id": customer, "scores": {"home_loan": home_loan}, **({"score_ts": iso(ms)} if ms else {})}


def test_the_newest_snapshot_does_not_depend_on_order():
    told = [(None, {"a": 9.0}), (5, {"a": 1.0}), (7, {"a": 2.0}), (7, {"a": 3.0}), (7, {"a": None}), (6, {})]
    assert newest_snapshot(told) == newest_snapshot(told[::-1]) == (7, {"a": 3.0})
    assert newest_snapshot([(None, {"a": 1.0}), (None, {})]) == (None, {"a": 1.0})


def test_newer_scores_win_over_later_ones(spark, topics):
    topics.put("product", [{"customer_id": "x", "event_ts": iso(T0), "product": "home_loan"}])
    topics.put("scores", [snapshot("up", 61.0, T0), snapshot("up", 62.0, T0 + MINUTE), snapshot("down", 62.0, T0 + MINUTE),
                          snapshot("down", 61.0, T0), snapshot("old", 62.0, T0 + MINUTE), snapshot("none", 61.0)])
    topics.put("txn", [message("x", T0, "retail", 1.0)])
    query = topics.start(spark)
    try:
        wait_for(query, idle_after(8))
        # a snapshot from before those held, one without a time over one without, and one without over one with
        topics.put("scores", [snapshot("old", 61.0, T0), snapshot("none", 62.0), snapshot("up", 50.0)])
        wait_for(query, idle_after(11))
        topics.put("txn", [message(c, T0, "furniture", 2500.0) for c in ("up", "down", "old", "none")])
        wait_for(query, idle_after(15))
    finally:
        query.stop()
    stored = spark.read.parquet(f"{topics.root}/out/intents").collect()
    assert {r.customer_id: r.base_score for r in stored} == dict.fromkeys(("up", "down", "old", "none"), 62.0)


def test_a_silent_customer_keeps_only_scores(spark, topics):
    day = 24 * 60 * MINUTE
    topics.put("scores", [snapshot("a", 61.0, T0)])
    topics.put("product", [{"customer_id": "a", "event_ts": iso(T0), "product": "home_loan"}])
    topics.put("txn", [message("a", T0, "furniture", 2500.0), message("a", T0, "furniture", 100.0)])
    query = topics.start(spark, tick_ms=1000)
    try:
        wait_for(query, idle_after(4))
        topics.put("txn", [message("a", T0 + MINUTE, "furniture", 5.0), message("a", T0 + day, "retail", 5.0)])
        wait_for(query, idle_after(6))
        query.stop()
        # each micro-batch has added one chunk to a day; none was written again
        chunks = topics.state(spark, "week").selectExpr("key.customer_id", "user_map_key.*", "size(user_map_value.ms) as n").collect()
        assert sorted((r.day - T0 // day, r.number, r.n) for r in chunks) == [(0, 0, 2), (0, 1, 1), (1, 0, 1)]
        assert topics.state(spark, "session").count() == topics.state(spark, "kept").count() == 1

        query = topics.start(spark, tick_ms=1000)
        topics.put("txn", [message("b", T0 + 12 * day, "retail", 5.0)])
        wait_for(query, idle_after(1))
        end = time.time() + 90  # the watermark follows a batch later, the timer a second after that
        while time.time() < end and len([p for p in query.recentProgress]) < 14:
            query.awaitTermination(1)
    finally:
        query.stop()
    for name in ("week", "session", "kept"):
        assert {r.customer_id for r in topics.state(spark, name).select("key.customer_id").collect()} <= {"b"}, name
    assert {r.customer_id for r in topics.state(spark, "snapshot").select("key.customer_id").collect()} == {"a"}


def test_sequence_stream_equals_batch(spark, topics):
    day = 24 * 60 * MINUTE
    parts = [
        [("a", 0, "A"), ("a", 5 * MINUTE, "A"), ("b", 0, "A"), ("c", 0, "B"), ("d", 0, "A")],
        # out of order within the watermark's delay; the nearest later B counts
        [("a", day + 5 * MINUTE, "B"), ("a", day, "B"), ("a", day, "A"), ("c", MINUTE + day, "A"), ("e", day, "AB"), ("e", day + 1, "AB")],
        # b's week is over by a millisecond, d's is not
        [("b", 7 * day + 1, "B"), ("d", 7 * day, "B"), ("c", 2 * day, "A"), ("", 2 * day, "A")],
        [("z", 30 * day, "B")], [("z", 60 * day, "B")],
    ]
    rows, number = [], 0
    for i, part in enumerate(parts):
        for customer, ms, kind in part:
            number += 1
            rows.append((i, {"customer_id": customer, "ms": T0 + ms, "kind": kind, "event_id": number}))

    def parsed(raw):
        schema = "customer_id string, ms bigint, kind string, event_id bigint"
        return raw.select(F.from_json("value", schema).alias("m")).select(
            "m.customer_id", F.timestamp_millis("m.ms").alias("event_ts"), F.col("m.ms").alias("event_ts_ms"), "m.event_id", "m.kind")

    first, second = F.col("kind").contains("A"), F.col("kind").contains("B")
    out, checkpoint = f"{topics.root}/alerts", f"{topics.root}/checkpoint1"
    for i in range(len(parts)):  # a restart before every part
        topics.put("txn", [m for at, m in rows if at == i])
        query = jobs.start_sequence_alerts(parsed(topics.stream(spark, "txn")), first, second, out, checkpoint, "1 second")
        try:
            query.processAllAvailable()
        finally:
            query.stop()
    events = parsed(spark.read.text(f"{topics.root}/txn")).where("customer_id != ''")
    want = sequence.sequence_alerts(events, first, second)
    assert want.count() == 5
    got = spark.read.parquet(out).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert topics.state(spark, "firsts").count() == 0
    assert {r.customer_id for r in topics.state(spark, "seconds").select("key.customer_id").collect()} <= {"z"}


def test_a_topic_in_files_can_be_replayed(spark, topics):
    path = f"{topics.root}/topic"

    def publish(*messages, writer="0"):
        topics.put("txn", list(messages))
        query = topic.publish_stream(topics.stream(spark, "txn"), path, writer).option(
            "checkpointLocation", f"{topics.root}/publish{writer}").start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()

    def taken(starting, name):
        """What a query finds that starts, or goes on, now."""
        query = topic.read_topic(spark, path, starting).writeStream.foreachBatch(
            lambda batch, i: batch.write.mode("append").parquet(f"{topics.root}/{name}")
        ).option("checkpointLocation", f"{topics.root}/check-{name}").start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        return sorted(r.value for r in spark.read.schema("value string").parquet(f"{topics.root}/{name}").collect())

    os.makedirs(f"{topics.root}/late")
    publish("a", "b \u00e9")
    assert taken("earliest", "early") == ["a", "b \u00e9"]
    assert taken("latest", "late") == []  # skips what was there
    publish("c")
    assert taken("earliest", "early") == ["a", "b \u00e9", "c"]  # goes on at its offset
    assert taken("latest", "late") == ["c"]
    # a batch that is committed again adds nothing, nor do parts without a manifest
    held = topic.Topic(path)
    part = held.write_part(iter(["twice"]))
    held.commit([part], "0", 1)
    assert held.count() == 2 and taken("earliest", "early") == ["a", "b \u00e9", "c"]
    # a new series of batches reads the message files anew
    publish("d", writer="1")
    assert taken("latest", "late") == ["a", "b \u00e9", "c", "c", "d"]
    assert taken("earliest", "again") == ["a", "a", "b \u00e9", "b \u00e9", "c", "c", "d"]
    with pytest.raises(ValueError):
        topic.TopicReader(path, "middle")
