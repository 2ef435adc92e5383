"""Registered queries and their check SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from checks.oracle import ORACLE
from tidemark.functions import parsing, scoring
from tidemark.operators import features as ft
from tidemark.operators import panes, rolling, sequence, sessions
from tidemark.operators.slices import busiest
from tidemark.plans import intents, nightly, propensity, quality, reports
from tidemark.schemas import PRODUCTS
from tidemark.session import configure
from tidemark.sources import adapters, tables

# The sample tables end in 1998-2001 and the sample events in January 2024.
BATCH_DAY = date(1998, 6, 30)
SCORE_DAYS = [date(1998, 6, 8), date(1998, 6, 15), date(1998, 6, 22), date(1998, 6, 29)]
STREAM_DAY = date(2024, 1, 30)

Query = Callable[[SparkSession, str], DataFrame]


# ---- shared steps -------------------------------------------------------------------------------

def _inputs(spark: SparkSession, sf: str) -> DataFrame:
    return propensity.propensity_inputs(tables.sample_tables(spark, sf), BATCH_DAY)


def _scores(spark: SparkSession, sf: str) -> DataFrame:
    return propensity.propensity_scores(_inputs(spark, sf), tables.load_weights(spark), BATCH_DAY)


def _score_history(spark: SparkSession, sf: str) -> DataFrame:
    dated = propensity.dated_inputs(tables.sample_tables(spark, sf), SCORE_DAYS)
    return propensity.propensity_scores(dated, tables.load_weights(spark))


def _lists(spark: SparkSession, sf: str) -> DataFrame:
    return propensity.campaign_lists(_scores(spark, sf), BATCH_DAY)


def _features(spark: SparkSession, sf: str) -> DataFrame:
    recent = ft.recent_transactions(adapters.transactions(spark, sf), [BATCH_DAY])
    return ft.transaction_features(recent, [BATCH_DAY])


def _base(spark: SparkSession, sf: str) -> DataFrame:
    return ft.customer_base(
        _features(spark, sf), adapters.demographics(spark, sf), adapters.campaign_history(spark, sf)
    )


def _marked_events(spark: SparkSession, sf: str) -> DataFrame:
    events = adapters.all_events(spark, sf)
    return rolling.with_hot(events, largest=busiest(events, ["customer_id"]))


def _kept(spark: SparkSession, sf: str) -> DataFrame:
    return intents.kept_intents(adapters.all_events(spark, sf))


def _enriched(spark: SparkSession, sf: str) -> DataFrame:
    return intents.enrich(_kept(spark, sf), _scores(spark, sf))


def _offers(spark: SparkSession, sf: str) -> DataFrame:
    """Stored offers; the time an offer arrives is the time of its event."""
    return intents.realtime_offers(_enriched(spark, sf), F.timestamp_millis("event_ts_ms"))


def _grid(spark: SparkSession, sf: str) -> DataFrame:
    return reports.performance_grid(_offers(spark, sf), STREAM_DAY)


def _feed(spark: SparkSession, sf: str) -> DataFrame:
    return reports.intent_feed(_offers(spark, sf), _lists(spark, sf))


def _candidates(spark: SparkSession, sf: str) -> DataFrame:
    return reports.campaign_candidates(
        _scores(spark, sf), _inputs(spark, sf), "home_loan", 60, region="ASIA",
        regions=adapters.demographics(spark, sf),
    )


def _spend_feed(spark: SparkSession, sf: str) -> DataFrame:
    return panes.sliding_spend(parsing.known_categories(adapters.transaction_events(spark, sf)))


def _updated_feed(spark: SparkSession, sf: str) -> DataFrame:
    """The spend feed; a window was last updated at its end."""
    known = parsing.known_categories(adapters.transaction_events(spark, sf))
    return panes.sliding_spend(known, updated_at=F.timestamp_millis("window_end_ms"))


def _ms(name: str) -> Column:
    return F.unix_millis(name).alias(name)


def _cents(value: Column) -> Column:
    return F.round(value, 2).cast("decimal(18,2)").cast("string")


def _pairs(mapping: str) -> Column:
    """A map as text, in key order."""
    entries = F.sort_array(F.map_entries(mapping))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), _cents(e["value"]))), ",")


# ---- sources, parsing, projections --------------------------------------------------------------

def seed_weights(spark: SparkSession, sf: str) -> DataFrame:
    """The weights beside the number of holders of each product."""
    held = ft.holdings_long(adapters.product_holdings(spark, sf)).groupBy("product_family").agg(
        F.sum("has_product").alias("holders")
    )
    return tables.load_weights(spark).join(held, "product_family")


def parse_iso(spark: SparkSession, sf: str) -> DataFrame:
    """Event times written in the accepted and in some rejected forms, and read back."""
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    form = F.col("event_id") % 8
    text = (
        F.when(form == 1, F.concat(iso, F.lit("Z")))
        .when(form == 2, F.concat(iso, F.lit("+05:30")))
        .when(form == 3, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(form == 4, F.date_format("ts", "yyyy-MM-dd"))
        .when(form == 5, F.lit(""))
        .when(form == 6, F.concat(F.lit("x"), iso))
        .when(form == 7, F.lit("1970-01-01T00:00:00Z"))
        .otherwise(iso)
    )
    parsed = parsing.iso_timestamp(text)
    return adapters.sample_events(spark, sf).select("event_id", F.unix_millis(parsed).alias("event_ts_ms")).where(
        F.col("event_ts_ms").isNotNull()
    )


def _damaged(messages: DataFrame) -> DataFrame:
    """Messages of which some lack a field, hold a null or are cut short."""
    value, form = F.col("value"), F.col("event_id") % 40
    return messages.withColumn("value", (
        F.when(form == 0, F.expr("left(value, length(value) - 5)"))
        .when(form == 1, F.replace(value, F.lit('"merchant_category"'), F.lit('"other"')))
        .when(form == 2, F.regexp_replace(value, '"amount":[^,}]*', '"amount":null'))
        .when(form == 3, F.regexp_replace(value, '("event_ts":"[^"]*)"', '$1Z"'))
        .when(form == 4, F.regexp_replace(value, '("event_ts":"[^"]*)"', '$1+05:30"'))
        .when(form == 5, F.regexp_replace(value, '"event_ts":"[^"]*"', '"event_ts":""'))
        .when(form == 6, F.regexp_replace(value, '"customer_id":"[^"]*"', '"customer_id":""'))
        .when(form == 7, F.regexp_replace(value, '"merchant_category":"[^"]*"', '"merchant_category":null'))
        .when(form == 8, F.regexp_replace(value, '"(transaction_type|event_type)"', '"other"'))
        .when(form == 9, F.regexp_replace(value, '"has_credit_card":[^,}]*', '"has_credit_card":true'))
        .when(form == 10, F.regexp_replace(value, '"has_fixed_deposit":[^,}]*', '"has_fixed_deposit":"abc"'))
        .when(form == 11, F.regexp_replace(value, '"amount":[^,}]*', '"amount":true'))
        .when(form == 12, F.regexp_replace(value, '"amount":[^,}]*', '"amount":"NaN"'))
        .when(form == 13, F.regexp_replace(value, '"amount":[^,}]*', '"amount":1e20'))
        .when(form == 14, F.regexp_replace(value, '"has_credit_card":[^,}]*', '"has_credit_card":""'))
        .otherwise(value)
    ))


def parse_txn(spark: SparkSession, sf: str) -> DataFrame:
    raw = _damaged(adapters.transaction_messages(spark, sf))
    return parsing.drop_blank_keys(parsing.parse_transactions(raw, ["event_id"])).drop("event_ts", "kind")


def parse_product_event(spark: SparkSession, sf: str) -> DataFrame:
    raw = _damaged(adapters.product_messages(spark, sf))
    return parsing.drop_blank_keys(parsing.parse_product_events(raw, ["event_id"])).drop("event_ts", "kind")


def parse_score(spark: SparkSession, sf: str) -> DataFrame:
    messages = propensity.snapshot_messages(propensity.score_snapshots(_scores(spark, sf)))
    return parsing.parse_scores(messages).select(
        "customer_id", F.explode("scores").alias("product_family", "propensity_score"), "score_ts"
    )


def known_category_filter(spark: SparkSession, sf: str) -> DataFrame:
    raw = _damaged(adapters.transaction_messages(spark, sf))
    known = parsing.known_categories(parsing.parse_transactions(raw, ["event_id"]))
    return known.select("event_id", "customer_id", "merchant_category", "amount")


def txn_30d_filter(spark: SparkSession, sf: str) -> DataFrame:
    recent = ft.recent_transactions(adapters.transactions(spark, sf), [BATCH_DAY])
    return recent.select("customer_id", "txn_dt", "merchant_category", F.col("amount").cast("double").alias("amount"))


def scan_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return adapters.transactions(spark, sf).withColumn("amount", F.col("amount").cast("double")).withColumn(
        "transaction_ts", _ms("transaction_ts")
    )


def holding_campaign_flags(spark: SparkSession, sf: str) -> DataFrame:
    return _inputs(spark, sf).select("customer_id", "product_family", "existing_products_flag", "campaign_response_flag")


def days_since_last_txn(spark: SparkSession, sf: str) -> DataFrame:
    return _features(spark, sf).select("customer_id", "last_txn_date", "days_since_last_txn")


def txn_features(spark: SparkSession, sf: str) -> DataFrame:
    return _features(spark, sf).drop("as_of", "days_since_last_txn")


def customer_base(spark: SparkSession, sf: str) -> DataFrame:
    return _base(spark, sf).select(
        "customer_id", "total_spend_30d", "txn_count_30d", "age", "income_band", "last_campaign_response",
        "campaign_touch_count",
    )


def customer_x_product(spark: SparkSession, sf: str) -> DataFrame:
    flags = {p: F.lit(0) for p in PRODUCTS}
    return ft.per_product(_features(spark, sf), flags).select("customer_id", "product_family", "txn_count_30d")


def normalized_signals(spark: SparkSession, sf: str) -> DataFrame:
    return propensity.normalized_signals(_inputs(spark, sf), tables.load_weights(spark)).select(
        "customer_id", "product_family", *scoring.TERM_NAMES
    )


def propensity_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _scores(spark, sf).withColumn("score_ts", _ms("score_ts"))


def campaign_lists(spark: SparkSession, sf: str) -> DataFrame:
    return _lists(spark, sf).withColumn("score_ts", _ms("score_ts")).withColumn("generated_at", _ms("generated_at"))


def campaign_segments(spark: SparkSession, sf: str) -> DataFrame:
    """Size and lowest score of each segment of the campaign lists."""
    return _lists(spark, sf).groupBy("product_family", "campaign_segment").agg(
        F.count("*").alias("customers"), F.round(F.min("propensity_score"), 4).alias("lowest_score")
    )


def age_bands(spark: SparkSession, sf: str) -> DataFrame:
    return adapters.demographics(spark, sf).select("customer_id", "age", scoring.age_band(F.col("age")).alias("age_band"))


def hash_region(spark: SparkSession, sf: str) -> DataFrame:
    return adapters.demographics(spark, sf).select(
        "customer_id", scoring.hash_region(F.col("customer_id")).alias("hash_region")
    )


def holdings_from_json(spark: SparkSession, sf: str) -> DataFrame:
    return parsing.holdings_from_json(adapters.demographics(spark, sf))


def holdings_long(spark: SparkSession, sf: str) -> DataFrame:
    return ft.holdings_long(adapters.product_holdings(spark, sf))


def txn_product_tag(spark: SparkSession, sf: str) -> DataFrame:
    tagged = intents.tag_transactions(
        adapters.transaction_events(spark, sf), adapters.product_holdings(spark, sf)
    )
    return tagged.select("event_id", "customer_id", "merchant_category", "product", "trigger_signal",
                         "has_credit_card", "has_fixed_deposit")


def event_union(spark: SparkSession, sf: str) -> DataFrame:
    events = parsing.union_events(adapters.transaction_events(spark, sf), adapters.product_events(spark, sf))
    return events.select("event_id", "customer_id", "kind", "event_ts_ms", "merchant_category", "event_type", "product")


# ---- reports ------------------------------------------------------------------------------------

def campaign_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return _candidates(spark, sf).select(
        "customer_id", "product_family", "propensity_score", "region", "age_band", "income_band", "total_spend_30d"
    )


def signal_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return reports.with_reasons(_inputs(spark, sf)).select(
        "customer_id", "product_family", "top_3_signal_reasons",
        F.array_join(scoring.reason_texts(F.col("reasons")), " | ").alias("reason_texts"),
    )


def intent_feed(spark: SparkSession, sf: str) -> DataFrame:
    return _feed(spark, sf).withColumn("received_at", _ms("received_at"))


def weekly_propensity_counts(spark: SparkSession, sf: str) -> DataFrame:
    return reports.weekly_propensity_counts(_score_history(spark, sf), BATCH_DAY)


def weekly_wow(spark: SparkSession, sf: str) -> DataFrame:
    return reports.weekly_change(reports.weekly_propensity_counts(_score_history(spark, sf), BATCH_DAY))


def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    return reports.run_summary(_inputs(spark, sf), _scores(spark, sf), _lists(spark, sf))


def score_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    return propensity.score_snapshots(_scores(spark, sf)).select(
        "customer_id", _pairs("scores").alias("scores"), _ms("score_ts")
    )


def nightly_enrichment(spark: SparkSession, sf: str) -> DataFrame:
    return nightly.nightly_enrichment(_updated_feed(spark, sf), STREAM_DAY).withColumn(
        "source_updated_at", _ms("source_updated_at")
    ).drop("refreshed_at")


# ---- intents ------------------------------------------------------------------------------------

def rolling_features(spark: SparkSession, sf: str) -> DataFrame:
    return rolling.rolling_features(_marked_events(spark, sf)).drop("hot")


def large_credit_quiet(spark: SparkSession, sf: str) -> DataFrame:
    return rolling.quiet_credits(_marked_events(spark, sf)).select("customer_id", "event_id", "credit_ms", "next_ms")


def home_session(spark: SparkSession, sf: str) -> DataFrame:
    events = adapters.all_events(spark, sf)
    return sessions.home_session_triggers(events, largest=busiest(events, ["customer_id"]))


def home_session_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Home sessions from transactions as they come from a topic, with amounts as doubles."""
    parsed = parsing.parse_transactions(adapters.transaction_messages(spark, sf), ["event_id"])
    return sessions.home_session_triggers(parsed, largest=busiest(parsed, ["customer_id"]))


def rejected_messages(spark: SparkSession, sf: str) -> DataFrame:
    return parsing.rejected_transactions(_damaged(adapters.transaction_messages(spark, sf)))


def sequence_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """Fixed-deposit quote followed by a salary credit within a week."""
    quote = (F.col("event_type") == "quote_request") & (F.col("product") == "fixed_deposit")
    return sequence.sequence_alerts(_marked_events(spark, sf), quote, F.col("transaction_type") == "salary")


def intent_signals(spark: SparkSession, sf: str) -> DataFrame:
    return intents.intent_signals(adapters.all_events(spark, sf))


def score_enrich(spark: SparkSession, sf: str) -> DataFrame:
    """Base score of every active customer and product, the default where there is none."""
    active = adapters.all_events(spark, sf).select("customer_id").distinct()
    pairs = ft.per_product(active, {p: F.lit(0) for p in PRODUCTS})
    return pairs.join(_scores(spark, sf), ["customer_id", "product_family"], "left").select(
        "customer_id", "product_family", scoring.base_or_default(F.col("propensity_score")).alias("base_score")
    )


def composite_score(spark: SparkSession, sf: str) -> DataFrame:
    boost = scoring.pattern_boost(F.col("product_family"))
    return score_enrich(spark, sf).select(
        "customer_id", "product_family",
        scoring.composite_score(F.col("base_score"), boost).alias("composite_score"),
    ).withColumn("offered", F.col("composite_score") > 75.0)


def category_spend_7d(spark: SparkSession, sf: str) -> DataFrame:
    events = adapters.all_events(spark, sf)
    largest = busiest(events, ["customer_id"])
    return intents.category_spend_of(intents.kept_intents(events, largest=largest), events)


def intent_events(spark: SparkSession, sf: str) -> DataFrame:
    stored = intents.intent_events(adapters.all_events(spark, sf), _scores(spark, sf))
    return stored.withColumn("category_spend_7d", _pairs("category_spend_7d"))


def realtime_offers(spark: SparkSession, sf: str) -> DataFrame:
    return _offers(spark, sf).select("*", "txn_features.*").drop("txn_features", "received_at")


def offer_flatten(spark: SparkSession, sf: str) -> DataFrame:
    return parsing.flatten_offers(intents.offer_messages(_offers(spark, sf).drop("received_at"))).drop("payload")


# ---- checks -------------------------------------------------------------------------------------

def dq_inputs(spark: SparkSession, sf: str) -> DataFrame:
    t = tables.sample_tables(spark, sf)
    return quality.check_inputs({
        "transactions": t.transactions, "product_holdings": t.holdings, "demographics": t.demographics,
        "campaign_history": t.campaign,
    })


def dq_signals(spark: SparkSession, sf: str) -> DataFrame:
    return quality.check_signals(_inputs(spark, sf), min_rows=100)


def dq_feed_contract(spark: SparkSession, sf: str) -> DataFrame:
    return quality.check_feed(_feed(spark, sf))


_QUERIES: dict[str, Query] = {
    "scan_transactions": scan_transactions,
    "seed_weights": seed_weights,
    "parse_iso": parse_iso,
    "parse_txn": parse_txn,
    "rejected_messages": rejected_messages,
    "parse_product_event": parse_product_event,
    "parse_score": parse_score,
    "known_category_filter": known_category_filter,
    "event_union": event_union,
    "txn_30d_filter": txn_30d_filter,
    "txn_features": txn_features,
    "days_since_last_txn": days_since_last_txn,
    "customer_base": customer_base,
    "customer_x_product": customer_x_product,
    "holdings_from_json": holdings_from_json,
    "holdings_long": holdings_long,
    "holding_campaign_flags": holding_campaign_flags,
    "propensity_inputs": _inputs,
    "normalized_signals": normalized_signals,
    "propensity_scores": propensity_scores,
    "campaign_lists": campaign_lists,
    "campaign_segments": campaign_segments,
    "age_bands": age_bands,
    "hash_region": hash_region,
    "campaign_candidates": campaign_candidates,
    "signal_reasons": signal_reasons,
    "score_snapshots": score_snapshots,
    "weekly_propensity_counts": weekly_propensity_counts,
    "weekly_wow": weekly_wow,
    "txn_product_tag": txn_product_tag,
    "rolling_features": rolling_features,
    "large_credit_quiet": large_credit_quiet,
    "home_session": home_session,
    "home_session_messages": home_session_messages,
    "intent_signals": intent_signals,
    "intent_dedup": _kept,
    "score_enrich": score_enrich,
    "composite_score": composite_score,
    "category_spend_7d": category_spend_7d,
    "intent_events": intent_events,
    "realtime_offers": realtime_offers,
    "offer_flatten": offer_flatten,
    "sequence_alerts": sequence_alerts,
    "sliding_spend": _spend_feed,
    "nightly_enrichment": nightly_enrichment,
    "intent_feed": intent_feed,
    "intents_today": lambda s, sf: reports.intents_today(_offers(s, sf), STREAM_DAY),
    "weekly_offer_performance": lambda s, sf: reports.weekly_offers(_offers(s, sf), STREAM_DAY),
    "performance_grid": _grid,
    "conversion_series": lambda s, sf: reports.conversion_series(_grid(s, sf)),
    "revenue_summary": lambda s, sf: reports.revenue_summary(_grid(s, sf)),
    "run_summary": run_summary,
    "dq_inputs": dq_inputs,
    "dq_signals": dq_signals,
    "dq_feed_contract": dq_feed_contract,
}


try:
    from corpus_pipeline import ORACLE_SQL as _PIPELINE_SQL, run as _run_pipeline
    from tidemark.llm.oracle import ORACLE as _LLM_ORACLE
    from tidemark.llm.queries import QUERIES as _LLM_QUERIES
except ModuleNotFoundError as error:
    if not str(error.name).startswith(("tidemark.llm", "corpus_pipeline")):
        raise
    _LLM_ORACLE, _LLM_QUERIES = {}, {}
else:
    _LLM_QUERIES = {**_LLM_QUERIES, "pipeline": _run_pipeline}
    _LLM_ORACLE = {**_LLM_ORACLE, **({"pipeline": _PIPELINE_SQL} if _PIPELINE_SQL else {})}


def entry(spark: SparkSession) -> DataFrame:
    """Campaign lists from raw transactions, as one plan."""
    return campaign_lists(configure(spark), "/root/testdata/sf0.001")


# Whole numbers that may be missing.
_OPTIONAL = {"age", "campaign_touch_count", "next_ms", "session_window_ms", "txn_10m", "txn_2h", "txn_24h"}


def _portable(df: DataFrame) -> DataFrame:
    """Dates leave as ISO text and optional whole numbers as doubles, which every client reads back alike."""
    casts = {name: F.col(name).cast("string") for name, kind in df.dtypes if kind == "date"}
    casts |= {name: F.col(name).cast("double") for name in df.columns if name in _OPTIONAL}
    return df.withColumns(casts) if casts else df


def queries() -> dict[str, Query]:
    def configured(query: Query) -> Query:
        return lambda spark, sf_dir: _portable(query(configure(spark), sf_dir))

    return {name: configured(query) for name, query in {**_QUERIES, **_LLM_QUERIES}.items()}


def oracle_sql() -> dict[str, str]:
    return {**ORACLE, **_LLM_ORACLE}
