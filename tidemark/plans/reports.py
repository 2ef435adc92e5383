"""Report queries: each takes tables and an explicit date and returns a DataFrame."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.scoring import (
    age_band,
    hash_region,
    offer_tier,
    product_label,
    product_value,
    reason_names,
    signal_reasons,
)
from tidemark.schemas import (
    BASELINE_RATE_PCT,
    OFFER_THRESHOLD,
    PRODUCTS,
    REVENUE_PER_CONVERSION,
    TARGETED_RATE_PCT,
)

HISTORY_WEEKS = 14
TRACKER_WEEKS = 12


def _midnight(day: date) -> Column:
    return F.lit(day).cast("timestamp")


def _week(ts: str) -> Column:
    return F.to_date(F.date_trunc("week", F.col(ts)))


def _product_rows(spark: SparkSession, extra: dict[str, Column] | None = None) -> DataFrame:
    """One row per product, kept even where the data has none."""
    rows = spark.range(1, numPartitions=1).select(F.explode(F.array(*[F.lit(p) for p in PRODUCTS])).alias("product"))
    return rows.withColumns(extra) if extra else rows


def intent_feed(offers: DataFrame, lists: DataFrame, limit: int = 500) -> DataFrame:
    """Newest offers with the campaign segment, or a tier from the score where the customer is on no list."""
    segments = lists.select("customer_id", F.col("product_family").alias("product"), "campaign_segment")
    return (
        offers.join(segments, ["customer_id", "product"], "left")
        .select(
            "received_at",
            "customer_id",
            F.coalesce("campaign_segment", offer_tier(F.col("final_score"))).alias("customer_segment"),
            "product",
            F.col("final_score").alias("composite_intent_score"),
            "trigger_event",
        )
        .orderBy(F.col("received_at").desc(), "customer_id", "product")
        .limit(limit)
    )


def intents_today(offers: DataFrame, today: date) -> DataFrame:
    counts = offers.where(F.col("received_at") >= _midnight(today)).groupBy("product").agg(
        F.count("*").alias("intents_today")
    )
    return (
        _product_rows(offers.sparkSession)
        .join(counts, "product", "left")
        .select("product", product_label(F.col("product")).alias("product_label"),
                F.coalesce("intents_today", F.lit(0)).alias("intents_today"))
    )


def offered_products(offers: DataFrame) -> DataFrame:
    return offers.where(F.col("product").isNotNull()).select("product").distinct()


def weekly_propensity_counts(scores: DataFrame, today: date, weeks: int = HISTORY_WEEKS) -> DataFrame:
    """High scores per product and week.  The range is on `score_ts`, so a dated table is pruned by it."""
    first = today - timedelta(weeks=weeks)
    return (
        # weeks start on Monday: the first whole week is the one that starts on or after `first`
        scores.where(F.col("score_ts") >= _midnight(first))
        .groupBy("product_family", _week("score_ts").alias("week_start"))
        .agg(F.count_if(F.col("propensity_score") >= OFFER_THRESHOLD).alias("high_propensity_count"))
        .where(F.col("week_start") >= F.lit(first))
    )


def weekly_change(counts: DataFrame) -> DataFrame:
    """Latest week against the week before, per product, with the revenue expected at the targeted rate."""
    latest = counts.agg(F.max("week_start").alias("latest_week"))
    product = F.col("product_family")

    def total(week: Column) -> Column:
        return F.coalesce(F.sum(F.when(F.col("week_start") == week, F.col("high_propensity_count"))), F.lit(0))

    # one row per product, beside a single row: both sides are of fixed size
    grid = _product_rows(counts.sparkSession).withColumnRenamed("product", "product_family").crossJoin(
        F.broadcast(latest)
    )
    return (
        grid.join(counts, "product_family", "left")
        .groupBy("product_family", "latest_week")
        .agg(total(F.col("latest_week")).alias("latest_count"),
             total(F.date_sub("latest_week", 7)).alias("previous_count"))
        .select(
            "product_family",
            "latest_count",
            (F.col("latest_count") - F.col("previous_count")).alias("wow_change"),
            (F.col("latest_count") * (TARGETED_RATE_PCT / 100) * product_value(REVENUE_PER_CONVERSION, product))
            .alias("est_revenue"),
        )
    )


def ranked_scores(scores: DataFrame) -> DataFrame:
    """The score table, highest first; the stored table itself carries no order."""
    return scores.orderBy(F.col("propensity_score").desc(), "customer_id", "product_family")


def campaign_candidates(scores: DataFrame, inputs: DataFrame, product: str, min_score: float,
                        region: str = "All", band: str = "All", limit: int = 700,
                        regions: DataFrame | None = None) -> DataFrame:
    """Best customers of one product that pass the chosen filters, with their signals.

    The region is the customer's own where `regions` (customer_id, region) is given, and the hash
    bucket otherwise.  A filter left at 'All' adds nothing to the plan.
    """
    chosen = scores.where((F.col("product_family") == product) & (F.col("propensity_score") >= min_score))
    joined = chosen.join(inputs, ["customer_id", "product_family"], "left")
    if regions is None:
        joined = joined.withColumn("region", hash_region(F.col("customer_id")))
    else:
        joined = joined.join(regions.select("customer_id", "region"), "customer_id", "left")
    joined = joined.withColumn("age_band", age_band(F.col("age")))
    if region != "All":
        joined = joined.where(F.col("region") == region)
    if band != "All":
        joined = joined.where(F.col("age_band") == band)
    return joined.orderBy(F.col("propensity_score").desc(), "customer_id").limit(limit)


def with_reasons(candidates: DataFrame) -> DataFrame:
    return candidates.withColumn("reasons", signal_reasons()).withColumn(
        "top_3_signal_reasons", reason_names(F.col("reasons"))
    )


# Column titles of the exported list.
EXPORT_COLUMNS = {
    "customer_id": "Customer ID",
    "product_family": "Product",
    "propensity_score": "Propensity Score",
    "region": "Region",
    "age_band": "Age Band",
    "income_band": "Income Band",
    "top_3_signal_reasons": "Top 3 Signal Reasons",
}
FEED_TITLES = {
    "customer_id": "Customer",
    "customer_segment": "Segment",
    "product": "Product",
    "composite_intent_score": "Composite Intent Score",
    "trigger_event": "Trigger Signal",
    "received_at": "Received At",
}


def export_list(candidates: DataFrame) -> DataFrame:
    return with_reasons(candidates).select(*EXPORT_COLUMNS).withColumnsRenamed(EXPORT_COLUMNS)


def titled_feed(feed: DataFrame, product: str = "All") -> DataFrame:
    shown = feed if product == "All" else feed.where(F.col("product") == product)
    return shown.withColumnsRenamed(FEED_TITLES)


def weekly_offers(offers: DataFrame, today: date, weeks: int = TRACKER_WEEKS) -> DataFrame:
    """Offers and their average score per week and product; the average is taken over exact hundredths."""
    return (
        offers.where(F.col("received_at") >= _midnight(today - timedelta(weeks=weeks)))
        .groupBy(_week("received_at").alias("week_start"), "product")
        .agg(
            F.count("*").alias("offers_sent"),
            (F.sum(F.col("final_score").cast("decimal(8,2)")).cast("double") / F.count("final_score"))
            .alias("avg_final_score"),
        )
    )


def performance_grid(offers: DataFrame, today: date, weeks: int = TRACKER_WEEKS) -> DataFrame:
    """Every week and product of the tracker, zero where there was no offer, with expected conversions."""
    monday = today - timedelta(days=today.weekday())
    days = F.sequence(F.lit(monday - timedelta(weeks=weeks - 1)), F.lit(monday), F.expr("interval 7 days"))
    grid = _product_rows(offers.sparkSession).select(F.explode(days).alias("week_start"), "product")
    sent = F.coalesce("offers_sent", F.lit(0))
    return grid.join(weekly_offers(offers, today, weeks), ["week_start", "product"], "left").select(
        "week_start",
        "product",
        sent.alias("offers_sent"),
        F.coalesce("avg_final_score", F.lit(0.0)).alias("avg_final_score"),
        F.lit(BASELINE_RATE_PCT).alias("baseline_rate_pct"),
        F.lit(TARGETED_RATE_PCT).alias("propensity_targeted_rate_pct"),
        (sent * (BASELINE_RATE_PCT / 100)).alias("baseline_est_conversions"),
        (sent * (TARGETED_RATE_PCT / 100)).alias("targeted_est_conversions"),
    )


def conversion_series(grid: DataFrame) -> DataFrame:
    # Labels of the two series.
    names = {"baseline_rate_pct": "Baseline", "propensity_targeted_rate_pct": "Propensity Targeted"}
    return (
        grid.select("week_start", "product", *names)
        .unpivot(["week_start", "product"], list(names), "series", "conversion_rate_pct")
        .replace(names, subset=["series"])
        .withColumn("product_label", product_label(F.col("product")))
    )


def revenue_summary(grid: DataFrame) -> DataFrame:
    sent = F.sum("offers_sent")
    conversions = sent * (TARGETED_RATE_PCT / 100)
    return grid.groupBy("product").agg(
        sent.alias("offers_sent"), conversions.alias("targeted_est_conversions")
    ).select(
        product_label(F.col("product")).alias("product_label"),
        "offers_sent",
        "targeted_est_conversions",
        (F.col("targeted_est_conversions") * product_value(REVENUE_PER_CONVERSION, F.col("product")))
        .alias("targeted_est_revenue"),
    )


# Column titles of the revenue table.
REVENUE_TITLES = {
    "product_label": "Product",
    "offers_sent": "Offers Sent (12w)",
    "targeted_est_conversions": "Estimated Conversions @2%",
    "targeted_est_revenue": "Estimated Revenue @2%",
}


def run_summary(inputs: DataFrame, scores: DataFrame, lists: DataFrame) -> DataFrame:
    """Row counts of the tables a run leaves behind, with the range of the scores."""
    def counted(name: str, df: DataFrame, score: Column) -> DataFrame:
        return df.agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("row_count"),
            F.round(F.min(score), 4).alias("min_score"),
            F.round(F.avg(score), 4).alias("avg_score"),
            F.round(F.max(score), 4).alias("max_score"),
        )

    none = F.lit(None).cast("double")
    return (
        counted("propensity_inputs", inputs, none)
        .unionByName(counted("mart_propensity_scores", scores, F.col("propensity_score")))
        .unionByName(counted("mart_campaign_lists", lists, F.col("propensity_score")))
    )
