"""Streaming jobs: intents, offers and late events from the event streams; sliding spend."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.parsing import drop_blank_keys, iso_timestamp, known_categories
from tidemark.functions.scoring import base_or_default, composite_score, pattern_boost
from tidemark.plans.intents import assemble, offer_json, realtime_offers
from tidemark.schemas import OFFER_THRESHOLD, WATERMARK_DELAY, WEEK_MS
from tidemark.sources import sinks
from tidemark.streaming.counters import CounterLog
from tidemark.streaming.processor import OUTPUT_SCHEMA, SEQUENCE_SCHEMA, IntentProcessor, SequenceProcessor

# Time that outputs are stamped with.
Clock = Callable[[], datetime]

INPUT_COLUMNS = [
    "customer_id", "kind", "event_ts", "event_ts_ms", "merchant_category", "transaction_type", "amount",
    "has_credit_card", "event_type", "product",
]


def keyed_input(transactions: DataFrame, product_events: DataFrame, scores: DataFrame) -> DataFrame:
    """Events and score snapshots as one stream, with counters that a query listener can read."""
    events = transactions.unionByName(product_events, allowMissingColumns=True).select(*INPUT_COLUMNS)
    watched = drop_blank_keys(events).withWatermark("event_ts", WATERMARK_DELAY)
    told = watched.withColumn("raw_event", F.to_json(F.struct(*[c for c in INPUT_COLUMNS if c != "event_ts"])))
    snapshots = scores.select(
        "customer_id", F.lit("score").alias("kind"), "scores", F.unix_millis(iso_timestamp(F.col("score_ts"))).alias("score_ts_ms"))
    return told.unionByName(snapshots, allowMissingColumns=True).observe(
        "intent_input",
        F.count_if(F.col("kind") == "score").alias("score_updates"),
        F.count_if(F.col("kind") != "score").alias("events"),
    )


def intent_stream(transactions: DataFrame, product_events: DataFrame, scores: DataFrame,
                  tick_ms: int | None = None) -> DataFrame:
    """Kept intents and late events, tagged in column `output`.

    Scores are keyed like the events, so no task holds a copy of all scores.  The processing-time
    mode is what lets rows behind the watermark reach the processor.
    """
    return (
        keyed_input(transactions, product_events, scores)
        .groupBy("customer_id")
        .transformWithState(
            statefulProcessor=IntentProcessor(tick_ms), outputStructType=OUTPUT_SCHEMA, outputMode="append",
            timeMode="ProcessingTime",
        )
    )


def stored_intents(output: DataFrame) -> DataFrame:
    base, boost = base_or_default(F.col("propensity_score")), pattern_boost(F.col("product"))
    return assemble(output.where("output = 'intent'").withColumns({
        "pattern_boost": boost,
        "base_score": F.round(base, 2),
        "composite_score": composite_score(base, boost),
        "threshold": F.lit(OFFER_THRESHOLD),
    })).withColumn("event_date", F.timestamp_millis("event_ts_ms").cast("date"))


def late_events(output: DataFrame, arrived_at: datetime) -> DataFrame:
    return output.where("output = 'late'").select(
        "customer_id", "raw_event", F.timestamp_millis("event_ts_ms").alias("event_ts"),
        F.lit(arrived_at).alias("arrived_at"),
    )


def stored_offers(intents: DataFrame, received_at: datetime) -> DataFrame:
    """Offer messages in column `value`, with the key and date of their intent and the time of arrival."""
    offers = realtime_offers(intents, F.lit(received_at))
    message = [c for c in offers.columns if c != "received_at"]
    return offers.select(
        F.sha2(F.concat_ws("|", "customer_id", "product", "trigger_event", "event_ts_ms"), 256).alias("event_id"),
        F.timestamp_millis("event_ts_ms").cast("date").alias("event_date"), "received_at",
        offer_json(message).alias("value"),
    )


def start_intents(transactions: DataFrame, product_events: DataFrame, scores: DataFrame, out: str,
                  checkpoint: str, run: int, now: Clock, trigger: str = "10 seconds",
                  tick_ms: int | None = None, counters: str | None = None) -> StreamingQuery:
    """Run the intent job; intents, offers and late events land under `out`.

    Intents and offers have a deterministic key and are inserted once, whatever is replayed and however
    often the job starts anew.  Late events are a log: a micro-batch replaces its own partition when
    replayed.  A new checkpoint folder needs a higher `run`.  `now` gives the time of arrival.
    With `counters`, a listener stores there what each batch took in.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            # finding a batch empty evaluates every partition, so the state is committed all the same
            if batch.isEmpty():
                return
            arrived = now()
            intents = stored_intents(batch)
            sinks.insert_new(intents, f"{out}/intents")
            sinks.write_batch(late_events(batch, arrived), f"{out}/late", batch_id, run)
            sinks.insert_new(stored_offers(intents, arrived), f"{out}/offers")
        finally:
            batch.unpersist()

    name = f"intents-{run}-{uuid.uuid4().hex}"
    if counters:
        spark = transactions.sparkSession
        spark.streams.addListener(CounterLog(spark, counters, run, name, "intent_input"))
    return (
        intent_stream(transactions, product_events, scores, tick_ms)
        .writeStream.foreachBatch(write)
        .queryName(name)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(processingTime=trigger)
        .start()
    )


def sliding_spend_stream(transactions: DataFrame) -> DataFrame:
    """Weekly spend and count per customer and category, sliding by a day, with late-data limits."""
    return (
        known_categories(drop_blank_keys(transactions))
        .withWatermark("event_ts", WATERMARK_DELAY)
        .groupBy(F.window("event_ts", "7 days", "1 day"), "customer_id", "merchant_category")
        .agg(F.sum(F.col("amount").try_cast("decimal(18,2)")).alias("spend"), F.count("*").alias("n"))
        .select(
            (F.unix_millis("window.end") - 1).alias("window_end_ms"),
            "customer_id",
            "merchant_category",
            F.col("spend").cast("double").alias("total_spend"),
            F.col("n").cast("int").alias("event_count"),
        )
    )


def start_sliding_spend(transactions: DataFrame, out: str, checkpoint: str, run: int, now: Clock,
                        trigger: str = "10 seconds") -> StreamingQuery:
    """Run the spend job; `sources.keyed.KeyedTable` over `out` reads the current row of each window and
    shortens the log.

    A new checkpoint folder needs a higher `run`.  `now` gives `updated_at`.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        sinks.write_batch(batch.withColumn("updated_at", F.lit(now())), out, batch_id, run)

    return (
        sliding_spend_stream(transactions)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(processingTime=trigger)
        .start()
    )


def sequence_stream(events: DataFrame, first: Column, second: Column, within_ms: int = WEEK_MS) -> DataFrame:
    """The stream form of `operators.sequence.sequence_alerts`: the same alerts once the watermark has passed the second event.

    `events` has customer_id, event_ts, event_ts_ms and event_id.  Rows behind the watermark are left out.
    """
    flags = F.coalesce(first, F.lit(False)).alias("is_first"), F.coalesce(second, F.lit(False)).alias("is_second")
    return (
        drop_blank_keys(events)
        .withWatermark("event_ts", WATERMARK_DELAY)
        .select("customer_id", "event_ts", "event_ts_ms", "event_id", *flags)
        .where("is_first or is_second")
        .groupBy("customer_id")
        .transformWithState(
            statefulProcessor=SequenceProcessor(within_ms), outputStructType=SEQUENCE_SCHEMA, outputMode="append",
            timeMode="EventTime",
        )
    )


def start_sequence_alerts(events: DataFrame, first: Column, second: Column, out: str, checkpoint: str,
                          trigger: str = "10 seconds", within_ms: int = WEEK_MS) -> StreamingQuery:
    """Run the alert job; an alert is inserted once, whatever is replayed."""
    def write(batch: DataFrame, batch_id: int) -> None:
        sinks.insert_new(batch.withColumns({
            "event_id": F.sha2(F.concat_ws("|", "customer_id", "first_event_id", "first_ts_ms"), 256),
            "event_date": F.timestamp_millis("second_ts_ms").cast("date"),
        }), out)

    return (
        sequence_stream(events, first, second, within_ms)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(processingTime=trigger)
        .start()
    )
