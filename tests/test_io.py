import json
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tests.conftest import SMALL
from tidemark.functions import parsing
from tidemark.plans import nightly, propensity, quality, reports
from tidemark.sources import sinks, tables
from tidemark.sources.keyed import Generations, KeyedTable

KEY = ["window_end_ms", "customer_id", "merchant_category"]


def test_batch_tables_round_trip_through_files(spark, tmp_path):
    sample = tables.sample_tables(spark, SMALL)
    for name, df in (("product_holdings", sample.holdings), ("demographics", sample.demographics),
                     ("campaign_history", sample.campaign),
                     ("transactions", sample.transactions.withColumn("amount", F.col("amount").cast("double")))):
        df.write.parquet(tables.batch_table_path(str(tmp_path), name))
    assert tables.missing_batch_tables(spark, str(tmp_path)) == []
    assert tables.missing_batch_tables(spark, f"{tmp_path}/nowhere") == list(tables.BATCH_TABLES)
    day = date(1998, 6, 30)
    loaded = propensity.propensity_inputs(tables.load_batch_tables(spark, str(tmp_path)), day)
    assert sorted(map(str, loaded.collect())) == sorted(map(str, propensity.propensity_inputs(sample, day).collect()))
    plan = loaded._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(transaction_ts" in plan


def test_text_times_are_converted_on_load(spark, tmp_path):
    rows = [("a", "2024-01-01T10:00:00Z"), ("b", "2024-01-01T10:00:00+02:00"), ("c", "bad"), ("d", "")]
    spark.createDataFrame(rows, "customer_id string, transaction_ts string").write.parquet(f"{tmp_path}/t")
    got = {r.customer_id: r.transaction_ts for r in tables.text_transactions(spark, f"{tmp_path}/t").collect()}
    assert got == {"a": datetime(2024, 1, 1, 10), "b": datetime(2024, 1, 1, 8), "c": None, "d": None}


def test_survey_and_weights(spark, tmp_path):
    (tmp_path / "survey.csv").write_text(
        '"age";"housing";"loan";"campaign";"y"\n30;"yes";"no";2;"no"\n41;"no";"yes";1;"yes"\n')
    rows = tables.read_survey(spark, str(tmp_path / "survey.csv")).collect()
    assert [(r.age, r.has_home_loan, r.has_personal_loan, r.last_campaign_response, r.campaign_touch_count)
            for r in rows] == [(30, 1, 0, "no", 2), (41, 0, 1, "yes", 1)]
    assert [r.customer_id for r in rows] == ["cust_000001", "cust_000002"]
    packaged = tables.load_weights(spark)
    assert packaged.collect() == tables.load_weights(spark, str(tables.SEED_WEIGHTS)).collect()
    sums = {r[0]: round(sum(r[1:]), 2) for r in packaged.collect()}
    assert sums == {"home_loan": 1.45, "credit_card": 1.2, "fixed_deposit": 1.45, "personal_loan": 1.35}


def test_row_numbers_are_dense(spark):
    numbered = tables.with_row_number(spark.range(1000, numPartitions=7).where("id % 3 <> 0")).collect()
    assert [r.row_number for r in sorted(numbered, key=lambda r: r.id)] == list(range(len(numbered)))


def test_iso_times(spark):
    texts = ["2024-01-01T10:00:00", "2024-01-01T10:00:00.123Z", "2024-01-01 10:00:00+05:30", "2024-01-01",
             "2024-01-01T10:00", "2024-13-01T00:00:00", "2024-01-01T25:00:00", "1970-01-01T00:00:00Z", "", None, "now"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(F.unix_millis(parsing.iso_timestamp(F.col("t")))).collect()]
    base = 1704067200000
    assert got == [base + 36000000, base + 36000123, base + 16200000, base, base + 36000000] + [None] * 6


def test_messages_with_gaps(spark):
    good = '"event_ts":"2024-01-01T00:00:00Z"'
    raw = spark.createDataFrame([(v,) for v in [
        "{" + good + "}", '{"customer_id":"a",' + good + ',"amount":"12.5","merchant_category":null}',
        '{"customer_id":"a",' + good + ',"amount":null}', '{"customer_id":"a"}', "[1,2]", "7", "", "{", None,
        '{"customer_id":"a",' + good + ',"amount":"x"}']], "value string")
    rows = parsing.parse_transactions(raw).collect()
    assert [(r.customer_id, r.amount, r.merchant_category, r.transaction_type, r.has_credit_card) for r in rows] == [
        ("", 0.0, "unknown", "debit", 0), ("a", 12.5, None, "debit", 0)]
    assert parsing.drop_blank_keys(parsing.parse_transactions(raw)).count() == 1
    scores = spark.createDataFrame([(v,) for v in [
        '{"customer_id":"a","scores":{"home_loan":60.5},"score_ts":"x"}', '{"customer_id":"b"}',
        '{"customer_id":"","scores":{}}', '{"customer_id":"c","scores":[1]}', '{"customer_id":"d","scores":null}',
        "oops"]], "value string")
    assert {(r.customer_id, tuple(r.scores.items())) for r in parsing.parse_scores(scores).collect()} == {
        ("a", (("home_loan", 60.5),)), ("b", ())}


def test_insert_new_ignores_known_keys(spark, tmp_path):
    path = f"{tmp_path}/events"
    rows = lambda *r: spark.createDataFrame(r, "event_id string, v int, event_date date")
    day = date(2024, 1, 1)
    sinks.insert_new(rows(("a", 1, day), ("a", 1, day)), path)
    sinks.insert_new(rows(("a", 2, day), ("b", 2, day), ("c", 2, date(2024, 1, 2))), path)
    assert sorted((r.event_id, r.v) for r in spark.read.parquet(path).collect()) == [("a", 1), ("b", 2), ("c", 2)]


def test_upserts_and_replays(spark, tmp_path):
    schema = "window_end_ms bigint, customer_id string, merchant_category string, total_spend double"
    first = spark.createDataFrame([(1, "a", "x", 1.0), (2, "a", "x", 2.0)], schema)
    second = spark.createDataFrame([(2, "a", "x", 5.0)], schema)
    path = f"{tmp_path}/feed"
    for batch_id, batch in ((0, first), (7, second), (7, second)):
        sinks.write_batch(batch, path, batch_id, 1)
    assert spark.read.parquet(path).count() == 3
    current = sinks.latest_by_key(spark.read.parquet(path))
    assert sorted((r.window_end_ms, r.total_spend) for r in current.collect()) == [(1, 1.0), (2, 5.0)]
    # a new checkpoint folder counts its batches from 0 again
    third = spark.createDataFrame([(2, "a", "x", 9.0)], schema)
    sinks.compact(spark, path, f"{tmp_path}/compact")
    sinks.write_batch(third, path, 0, 2)
    for log in (spark.read.parquet(path), spark.read.parquet(f"{tmp_path}/compact").unionByName(spark.read.parquet(path))):
        current = sinks.latest_by_key(log)
        assert sorted((r.window_end_ms, r.total_spend) for r in current.collect()) == [(1, 1.0), (2, 9.0)]
    merged = sinks.upsert(second, first, KEY)
    assert sorted((r.window_end_ms, r.total_spend) for r in merged.collect()) == [(1, 1.0), (2, 5.0)]
    assert sinks.upsert(first, None, KEY) is first


def test_nightly_snapshot_can_be_repeated(spark, tmp_path):
    schema = "window_end_ms bigint, customer_id string, merchant_category string, total_spend double, event_count int, updated_at timestamp"
    feed = spark.createDataFrame([(1, "a", "x", 1.0, 1, datetime(2024, 1, 1)), (9, "a", "x", 4.0, 2, datetime(2024, 1, 2))], schema)
    path = f"{tmp_path}/nightly"
    for day in (date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 2)):
        sinks.replace_days(nightly.nightly_enrichment(feed, day), path)
    got = spark.read.parquet(path).collect()
    assert sorted((r.as_of_date, r.total_spend) for r in got) == [(date(2024, 1, 1), 4.0), (date(2024, 1, 2), 4.0)]


FEED = ("window_end_ms bigint, customer_id string, merchant_category string, total_spend double, event_count int, "
        "updated_at timestamp")


class Feed:
    """A spend feed that grows by micro-batches, beside its plain content."""

    def __init__(self, spark, root):
        self.spark, self.root, self.plain = spark, root, {}
        self.table = KeyedTable(spark, f"{root}/log", f"{root}/base", sinks.FEED_KEY,
                                StructType.fromDDL(FEED), buckets=4)

    def put(self, run, batch_id, *rows):
        frame = self.spark.createDataFrame([(*r, 1, datetime(2024, 1, 1 + batch_id % 20)) for r in rows], FEED)
        sinks.write_batch(frame, f"{self.root}/log", batch_id, run)
        self.plain.update({r[:3]: r[3] for r in rows})

    def current(self):
        return {(r.window_end_ms, r.customer_id, r.merchant_category): r.total_spend for r in self.table.current().collect()}

    def files(self, name):
        return [f for _, _, files in os.walk(f"{self.root}/{name}") for f in files if f.endswith(".parquet")]


def test_a_compacted_feed_has_as_many_files_as_buckets(spark, tmp_path):
    feed = Feed(spark, str(tmp_path))
    assert feed.current() == {} and not feed.table.compact()
    for i in range(12):
        feed.put(1, i, (i % 5, f"c{i % 7}", "x", float(i)), (1, "c1", "x", float(i)))
    assert feed.current() == feed.plain
    assert feed.table.compact() and not feed.table.compact()
    assert len(feed.files("base")) <= 4 and feed.current() == feed.plain
    # a folder without its end mark, and a generation without its own, do not count
    os.makedirs(f"{tmp_path}/log/run=1/batch_id=99")
    os.makedirs(f"{tmp_path}/base/gen-2")
    assert feed.table.newest() == (1, 11) and feed.current() == feed.plain
    reader = feed.table.current()  # begun before the compactions that follow
    before = dict(feed.plain)
    feed.put(2, 0, (1, "c1", "x", 100.0), (9, "new", "y", 1.0))
    assert feed.table.compact() and feed.current() == feed.plain
    # the log up to the generation before last is gone, that generation still reads
    assert feed.table.versions() == [(2, 0)] and feed.table.generations.numbers() == [1, 2]
    assert {tuple(r)[:3]: r.total_spend for r in reader.collect()} == before
    feed.put(2, 1, (1, "c1", "x", 7.0))
    assert feed.table.compact() and feed.current() == feed.plain
    assert feed.table.generations.numbers() == [2, 3] and len(feed.files("base")) <= 8 and len(feed.files("log")) <= 2
    with pytest.raises(FileExistsError):
        feed.table.generations.folder.put("ready/gen-3", "{}")


def test_nightly_refresh_reads_what_is_new_and_equals_a_rebuild(spark, tmp_path):
    feed = Feed(spark, str(tmp_path))
    snapshots = Generations(spark, f"{tmp_path}/snapshots", nightly.SNAPSHOT_KEY, buckets=2)
    out = f"{tmp_path}/nightly"

    def night(day, *parts):
        changed = nightly.refresh(feed.table, snapshots, date(2024, 1, day), out)
        files = changed.inputFiles()
        assert {p.split("/batch_id=")[0].split("run=")[-1] + "/" + p.split("batch_id=")[1].split("/")[0] for p in files if "/log/" in p} == set(parts)
        rebuilt = nightly.nightly_enrichment(feed.table.current(), date(2024, 1, day))
        stored = spark.read.parquet(out).where(F.col("as_of_date") == date(2024, 1, day)).select(*rebuilt.columns)
        assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, rebuilt.collect())) and stored.count() > 0
        return files

    feed.put(1, 0, (1, "a", "x", 1.0), (2, "a", "x", 2.0), (1, "b", "x", 3.0))
    feed.put(1, 1, (2, "a", "x", 2.5))
    night(1, "1/0", "1/1")
    feed.put(1, 2, (3, "a", "x", 4.0), (1, "b", "x", 5.0), (1, "c", "y", 6.0))
    night(2, "1/2")
    night(2)  # again: nothing new is read, the rows are the same
    feed.table.compact()
    feed.put(2, 0, (1, "b", "x", 9.0), (0, "a", "x", 9.0))
    assert all("/base/" not in f for f in night(3, "2/0"))
    # two compactions later the log's folders are gone; the newest generation stands for them
    feed.put(2, 1, (8, "a", "x", 1.0))
    feed.table.compact()
    feed.put(2, 2, (9, "d", "x", 1.0))
    feed.table.compact()
    assert (2, 1) not in feed.table.versions()
    assert any("/base/" in f for f in night(4))


def test_tables_exports_and_snapshots(spark, tmp_path):
    sample, day = tables.sample_tables(spark, SMALL), date(1998, 6, 30)
    inputs = propensity.propensity_inputs(sample, day)
    scores = sinks.materialise(propensity.propensity_scores(inputs, tables.load_weights(spark), day), "scores_test")
    assert scores.count() == inputs.count()
    top = reports.ranked_scores(scores).head(2)
    assert top[0].propensity_score >= top[1].propensity_score
    listed = reports.campaign_candidates(scores, inputs, "home_loan", 60)
    sinks.export_csv(reports.export_list(listed), f"{tmp_path}/list")
    exported = spark.read.csv(f"{tmp_path}/list", header=True)
    assert exported.columns == list(reports.EXPORT_COLUMNS.values()) and exported.count() == listed.count() > 0
    messages = propensity.snapshot_messages(propensity.score_snapshots(scores))
    sinks.write_snapshots(messages, f"{tmp_path}/snapshots")
    sinks.write_messages(messages, f"{tmp_path}/messages")
    back = parsing.parse_scores(spark.read.text(f"{tmp_path}/messages"))
    assert back.count() == spark.read.parquet(f"{tmp_path}/snapshots").count() == scores.select("customer_id").distinct().count()
    assert {len(r.scores) for r in back.collect()} == {4}


def test_odd_amounts_and_flags(spark):
    def message(**fields):
        return (json.dumps({"customer_id": "a", "event_ts": "2024-01-01T00:00:00", "amount": 1, **fields}),)

    good = [message(amount=True), message(amount="2.5"), message(has_credit_card=True), message(has_credit_card="")]
    bad = [message(amount="NaN"), message(amount="Infinity"), message(amount=1e20), message(amount=[1]),
           message(has_credit_card="abc"), message(has_fixed_deposit="NaN")]
    raw = spark.createDataFrame(good + bad, "value string")
    got = parsing.parse_transactions(raw).collect()
    assert sorted((r.amount, r.has_credit_card) for r in got) == [(1.0, 0), (1.0, 0), (1.0, 1), (2.5, 0)]
    assert tuple(parsing.rejected_transactions(raw).first()) == (4, 2, 4)
    ids = [r[0] for r in raw.select(parsing.message_id("txn")).union(raw.select(parsing.message_id("product"))).collect()]
    assert len(set(ids)) == 2 * len(good + bad)


def test_a_failed_check_tells_how_many_rows_broke_it(spark):
    with pytest.raises(ValueError, match="in 30 rows"):
        quality.require(spark.range(50), "id < 20")


def test_report_titles(spark):
    feed = spark.createDataFrame([(datetime(2024, 1, 1), "a", "HOT", "home_loan", 96.0, "p")],
                                 "received_at timestamp, customer_id string, customer_segment string, product string, "
                                 "composite_intent_score double, trigger_event string")
    assert set(reports.titled_feed(feed).columns) == set(reports.FEED_TITLES.values())
    assert reports.titled_feed(feed, "credit_card").count() == 0
    assert [r.product for r in reports.offered_products(feed).collect()] == ["home_loan"]


def test_insert_new_reads_only_partitions_whose_filter_knows_a_key(spark, tmp_path):
    path = str(tmp_path / "inserted")
    insert = lambda *rows: sinks.insert_new(
        spark.createDataFrame(rows, "event_id string, v int, day string").selectExpr("event_id", "v", "cast(day as date) as event_date"), path)
    held = lambda day: sorted(tuple(r) for r in spark.read.parquet(f"{path}/event_date={day}").collect())
    insert(("a", 1, "2024-01-01"), ("b", 1, "2024-01-01"), ("b", 1, "2024-01-01"), ("c", 1, "2024-01-02"), ("n", 1, None))
    insert(("a", 2, "2024-01-01"), ("d", 2, "2024-01-01"), ("n", 2, None))
    assert held("2024-01-01") == [("a", 1), ("b", 1), ("d", 2)] and held("__HIVE_DEFAULT_PARTITION__") == [("n", 1)]
    # a batch of new keys, and one that replays another day, do not open the files of a day
    for file in (tmp_path / "inserted" / "event_date=2024-01-01").glob("*.parquet"):
        file.write_bytes(b"unreadable")
    insert(("e", 3, "2024-01-01"))
    insert(("f", 3, "2024-01-01"), ("c", 3, "2024-01-02"), ("g", 3, "2024-01-02"))
    assert held("2024-01-02") == [("c", 1), ("g", 3)]
    with pytest.raises(Exception):
        insert(("a", 4, "2024-01-01"))


def test_insert_new_gives_an_older_table_its_filter(spark, tmp_path):
    path = str(tmp_path / "older")
    rows = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-02")], "event_id string, day string").selectExpr(
        "event_id", "cast(day as date) as event_date")
    rows.write.partitionBy("event_date").parquet(path)
    for _ in range(2):
        sinks.insert_new(rows.unionByName(rows.selectExpr("concat(event_id, 'x') as event_id", "event_date")), path)
    assert sorted(r.event_id for r in spark.read.parquet(path).collect()) == ["a", "ax", "b", "bx"]
