"""Data checks, each returned as a small report frame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark.schemas import FEED_COLUMNS, REQUIRED_SIGNALS

MIN_SIGNAL_ROWS = 500_000


def check_inputs(tables: dict[str, DataFrame], key: str = "customer_id",
                 unique: tuple[str, ...] = ("product_holdings", "demographics", "campaign_history")) -> DataFrame:
    """Per table: is it non-empty, and is the key unique where later joins rely on it."""
    def check(name: str, df: DataFrame) -> DataFrame:
        rows = df.groupBy(key).count() if name in unique else df.select(F.lit(1).alias("count")).limit(1)
        repeated = F.count_if(F.col("count") > 1) if name in unique else F.lit(0)
        return rows.agg(
            F.lit(name).alias("table_name"),
            (F.count("*") > 0).alias("has_rows"),
            F.coalesce(repeated, F.lit(0)).cast("bigint").alias("repeated_keys"),
        )

    return reduce(DataFrame.unionByName, [check(n, df) for n, df in tables.items()])


def check_signals(inputs: DataFrame, min_rows: int = MIN_SIGNAL_ROWS) -> DataFrame:
    """Enough rows, and every required signal column present."""
    missing = [c for c in REQUIRED_SIGNALS if c not in inputs.columns]
    return inputs.agg(F.count("*").alias("row_count")).select(
        "row_count",
        (F.col("row_count") >= min_rows).alias("enough_rows"),
        F.lit(",".join(missing)).alias("missing_columns"),
        ((F.col("row_count") >= min_rows) & F.lit(not missing)).alias("passed"),
    )


def check_feed(feed: DataFrame) -> DataFrame:
    """The feed has exactly its agreed columns, and can be read."""
    missing = [c for c in FEED_COLUMNS if c not in feed.columns]
    return feed.agg(F.count("*").alias("feed_rows")).select(
        "feed_rows", F.lit(",".join(missing)).alias("missing_columns"), F.lit(not missing).alias("passed")
    )


def require(report: DataFrame, condition: str) -> None:
    """Fail the run when any row of a report breaks the condition: tells how many do and shows the first of them."""
    broken = report.where(f"NOT coalesce({condition}, false)")
    shown = broken.limit(20).collect()
    if shown:
        raise ValueError(f"data check failed ({condition}) in {broken.count()} rows: {[r.asDict() for r in shown]}")
