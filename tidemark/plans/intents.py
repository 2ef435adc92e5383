"""Batch form of the real-time intent job: events in, intents and offers out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.scoring import base_or_default, composite_score, pattern_boost
from tidemark.operators import rolling
from tidemark.operators.sessions import home_session_triggers
from tidemark.operators.slices import busiest
from tidemark.operators.spacing import FOLD_ROWS, keep_spaced
from tidemark.schemas import (
    DAY_MS,
    OFFER_THRESHOLD,
    PATTERN_NAMES,
    QUIET_MS,
    RETAIL_BURST_COUNT,
    WEEK_MS,
)

CANDIDATE_COLUMNS = [
    "customer_id", "product", "event_ts_ms", "event_id", "pattern_name", "pattern_metric", "session_window_ms"
]


def rolling_signals(features: DataFrame) -> DataFrame:
    """Signals that follow from the trailing windows; raised at every event while they hold."""
    rules = {
        "credit_card": (f"retail_24h >= {RETAIL_BURST_COUNT} and card_7d = 0", "retail_24h"),
        "personal_loan": ("lifestyle_7d > 0 and salary_7d > 0", "lifestyle_7d"),
        "fixed_deposit": ("quiet_credit > 0", "1"),
    }
    found = ", ".join(
        f"if({holds}, named_struct('product', '{product}', 'pattern_name', '{PATTERN_NAMES[product]}', "
        f"'pattern_metric', double({metric})), null)"
        for product, (holds, metric) in rules.items()
    )
    return (
        features.where(" or ".join(f"({holds})" for holds, _ in rules.values()))
        .selectExpr("customer_id", "event_ts_ms", "event_id", f"inline(array({found}))",
                    "cast(null as bigint) as session_window_ms")
        .where("product is not null")
    )


def intent_signals(events: DataFrame, quiet_ms: int = QUIET_MS, largest: int | None = None) -> DataFrame:
    """All signals, before repeats are removed.  Events need unique `event_id` values per customer."""
    largest = busiest(events, ["customer_id"]) if largest is None else largest
    home = home_session_triggers(events, largest=largest).selectExpr(
        "customer_id", "event_ts_ms", "event_id", "'home_loan' as product",
        f"'{PATTERN_NAMES['home_loan']}' as pattern_name", "spend as pattern_metric", "session_window_ms",
    )
    features = rolling.rolling_features(rolling.with_hot(events, largest=largest), quiet_ms)
    return rolling_signals(features).unionByName(home).select(*CANDIDATE_COLUMNS)


def kept_intents(events: DataFrame, quiet_ms: int = QUIET_MS, largest: int | None = None,
                 fold_rows: int = FOLD_ROWS) -> DataFrame:
    """Signals at least a day after the last kept one of the same customer and product.

    A customer cannot have more signals of a product than events, so the event count of the busiest
    customer bounds the size of every key.
    """
    largest = busiest(events, ["customer_id"]) if largest is None else largest
    signals = intent_signals(events, quiet_ms, largest)
    return keep_spaced(signals, ["customer_id", "product"], DAY_MS, fold_rows, largest)


def enrich(intents: DataFrame, scores: DataFrame) -> DataFrame:
    """Adds base score, boost and composite; customers without a score get the default base."""
    known = scores.select("customer_id", F.col("product_family").alias("product"), "propensity_score")
    joined = intents.join(known, ["customer_id", "product"], "left")
    base, boost = base_or_default(F.col("propensity_score")), pattern_boost(F.col("product"))
    return joined.select(
        *intents.columns,
        boost.alias("pattern_boost"),
        F.round(base, 2).alias("base_score"),
        composite_score(base, boost).alias("composite_score"),
        F.lit(OFFER_THRESHOLD).alias("threshold"),
    )


def category_spend_of(intents: DataFrame, events: DataFrame) -> DataFrame:
    """Spend per category of the week up to each intent's event, one row per event and category."""
    asked = intents.select("customer_id", "event_id", "event_ts_ms").distinct()
    return rolling.category_spend(asked, events).select("customer_id", "event_id", "merchant_category", "spend")


def with_category_spend(intents: DataFrame, events: DataFrame) -> DataFrame:
    """Adds the category -> spend map.  The intents travel through as payload, so they are computed
    once; each signal implies a transaction in its week, so none is lost."""
    pairs = F.sort_array(F.collect_list(F.struct("merchant_category", "spend")))
    return rolling.category_spend(intents, events).groupBy(*intents.columns).agg(
        F.map_from_entries(pairs).alias("category_spend_7d"))


def intent_key() -> Column:
    """Same intent, same key: a replay can be recognised."""
    return F.sha2(F.concat_ws("|", "customer_id", "product", "pattern_name", "event_ts_ms"), 256)


def assemble(enriched: DataFrame) -> DataFrame:
    """The stored form of an intent; `enriched` carries is_late and category_spend_7d."""
    return enriched.select(
        intent_key().alias("event_id"),
        "customer_id",
        "product",
        "pattern_name",
        "pattern_metric",
        "pattern_boost",
        "base_score",
        "composite_score",
        "threshold",
        "event_ts_ms",
        (F.col("event_ts_ms") - WEEK_MS).alias("window_start_ms"),
        "session_window_ms",
        "category_spend_7d",
        F.lit("intent_detector").alias("source"),
        "is_late",
    )


def intent_events(events: DataFrame, scores: DataFrame) -> DataFrame:
    """Stored intents of a batch of events in event-time order, where nothing is late."""
    largest = busiest(events, ["customer_id"])
    kept = with_category_spend(kept_intents(events, largest=largest), events)
    return assemble(enrich(kept, scores).withColumn("is_late", F.lit(False)))


def realtime_offers(intents: DataFrame, received_at: Column | None = None) -> DataFrame:
    """Offers of intents above the threshold.  Takes enriched or stored intents.

    `received_at`, an expression over the offers, adds the time of arrival that the reports go by.
    """
    offers = intents.where(F.col("composite_score") > F.col("threshold")).select(
        "customer_id",
        "product",
        "base_score",
        F.col("pattern_boost").alias("intent_score"),
        F.col("composite_score").alias("final_score"),
        "threshold",
        F.col("pattern_name").alias("trigger_event"),
        F.struct(
            F.lit(7).alias("window_days"), F.lit(1).alias("slide_days"), "pattern_metric", "session_window_ms"
        ).alias("txn_features"),
        F.lit("intent_detector").alias("source"),
        "event_ts_ms",
        *(["is_late"] if "is_late" in intents.columns else [F.lit(False).alias("is_late")]),
    )
    return offers if received_at is None else offers.withColumn("received_at", received_at)


def offer_json(columns: list[str]) -> Column:
    """An offer as a JSON message; missing values are written as null."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def offer_messages(offers: DataFrame) -> DataFrame:
    return offers.select(offer_json(offers.columns).alias("value"))


def tag_transactions(transactions: DataFrame, holdings: DataFrame) -> DataFrame:
    """Product and trigger a transaction hints at, moved to home loan where the product is already held.

    A busy customer makes the left side uneven; AQE splits such a partition of a left join.
    """
    category = F.col("merchant_category")
    held = holdings.select(
        "customer_id", F.col("has_credit_card").alias("_card"), F.col("has_fixed_deposit").alias("_deposit")
    )
    card, deposit = F.coalesce("_card", F.lit(0)), F.coalesce("_deposit", F.lit(0))
    hint = (
        F.when(category == "home_improvement", "home_loan")
        .when(category.isin("electronics", "travel"), "personal_loan")
        .when(category == "salary", "fixed_deposit")
        .otherwise("credit_card")
    )
    trigger = (
        F.when(F.col("hint") == "fixed_deposit", "fd_intent").otherwise(F.concat("hint", F.lit("_intent")))
    )
    redirected = ((F.col("hint") == "credit_card") & (card == 1)) | ((F.col("hint") == "fixed_deposit") & (deposit == 1))
    own = [c for c in transactions.columns if c not in ("has_credit_card", "has_fixed_deposit")]
    return (
        transactions.select(*own)
        .join(held, "customer_id", "left")
        .withColumn("hint", hint)
        .select(
            *own,
            F.when(redirected, "home_loan").otherwise(F.col("hint")).alias("product"),
            trigger.alias("trigger_signal"),
            card.cast("int").alias("has_credit_card"),
            deposit.cast("int").alias("has_fixed_deposit"),
        )
    )
