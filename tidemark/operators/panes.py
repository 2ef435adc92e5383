"""Sliding-window spend from daily panes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.schemas import DAY_MS


def sliding_spend(transactions: DataFrame, days: int = 7, updated_at: Column | None = None) -> DataFrame:
    """Spend and count per customer, category and window of `days` days that slides by one day.

    Windows start at UTC midnight.  Rows are summed per day first (map-side, so a busy customer
    shrinks before the shuffle) and only the daily sums are repeated for the windows that hold them.
    `window_end_ms` is the last millisecond of the window.  `updated_at`, an expression over the result, adds the
    time the nightly snapshot goes by.
    """
    daily = transactions.groupBy(
        "customer_id", "merchant_category", F.floor(F.col("event_ts_ms") / DAY_MS).alias("day")
    ).agg(F.sum(F.col("amount").try_cast("decimal(18,2)")).alias("spend"), F.count("*").alias("n"))
    ends = F.explode(F.sequence(F.col("day") + 1, F.col("day") + days)).alias("end_day")
    spend = (
        daily.select("customer_id", "merchant_category", "spend", "n", ends)
        .groupBy("customer_id", "merchant_category", "end_day")
        .agg(F.sum("spend").alias("spend"), F.sum("n").alias("n"))
        .select(
            (F.col("end_day") * DAY_MS - 1).alias("window_end_ms"),
            "customer_id",
            "merchant_category",
            F.col("spend").cast("double").alias("total_spend"),
            F.col("n").cast("int").alias("event_count"),
        )
    )
    return spend if updated_at is None else spend.withColumn("updated_at", updated_at)


def latest_spend(feed: DataFrame) -> DataFrame:
    """Newest window per customer and category; a max over structs combines map-side, a window would not."""
    newest = F.max(F.struct("window_end_ms", "total_spend", "event_count", "updated_at"))
    return feed.groupBy("customer_id", "merchant_category").agg(newest.alias("w")).select(
        "customer_id", "merchant_category", "w.total_spend", "w.event_count", "w.updated_at"
    )
