"""Thirty-day customer features and the customer x product scoring input."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.schemas import PRODUCTS

WINDOW_DAYS = 30

INPUT_COLUMNS = [
    "customer_id",
    "product_family",
    "total_spend_30d",
    "txn_count_30d",
    "avg_txn_30d",
    "unique_category_count_30d",
    "home_improvement_spend_30d",
    "electronics_spend_30d",
    "travel_spend_30d",
    "salary_credit_30d",
    "debit_txn_count_30d",
    "days_since_last_txn",
    "existing_products_flag",
    "age",
    "income_band",
    "campaign_response_flag",
    "campaign_touch_count",
]


def recent_transactions(transactions: DataFrame, as_ofs: list[date]) -> DataFrame:
    """Transactions of the 30 days up to each date, tagged with the date as `as_of` where there are several.

    The overall range is a plain comparison on the timestamp column, so it reaches the scan.  With
    several dates each row is repeated only for the dates whose window holds it.
    """
    first, last = min(as_ofs) - timedelta(days=WINDOW_DAYS), max(as_ofs) + timedelta(days=1)
    ts = F.col("transaction_ts")
    in_range = transactions.where(
        (ts >= F.lit(first).cast("timestamp")) & (ts < F.lit(last).cast("timestamp"))
    ).withColumn("txn_dt", F.to_date(ts))
    if len(as_ofs) == 1:
        return in_range
    dates = F.array(*[F.lit(d) for d in sorted(as_ofs)])
    holding = F.filter(
        dates, lambda d: (F.col("txn_dt") <= d) & (F.col("txn_dt") >= F.date_sub(d, WINDOW_DAYS))
    )
    return in_range.withColumn("as_of", F.explode(holding))


def transaction_features(recent: DataFrame, as_ofs: list[date]) -> DataFrame:
    """One row per date and customer.  Money is summed as decimals, so the result has no order effects.

    A single date is not a grouping key: the result then stays hashed by customer alone, which is
    what the joins that follow need.
    """
    keys = ["customer_id"] if len(as_ofs) == 1 else ["as_of", "customer_id"]
    as_of = F.lit(as_ofs[0]) if len(as_ofs) == 1 else F.col("as_of")
    spend = F.abs("amount").try_cast("decimal(18,4)")

    def total(condition: Column | None = None) -> Column:
        value = spend if condition is None else F.when(condition, spend).otherwise(F.lit(0).cast("decimal(18,4)"))
        return F.sum(value).cast("double")

    category, kind = F.col("merchant_category"), F.col("transaction_type")
    return (
        recent.groupBy(*keys)
        .agg(
            total().alias("total_spend_30d"),
            F.count("*").alias("txn_count_30d"),
            F.count("amount").alias("_n_amounts"),
            F.countDistinct("merchant_category").alias("unique_category_count_30d"),
            total(category == "home_improvement").alias("home_improvement_spend_30d"),
            total(category == "electronics").alias("electronics_spend_30d"),
            total(category == "travel").alias("travel_spend_30d"),
            total(kind == "salary").alias("salary_credit_30d"),
            F.count_if(kind == "debit").alias("debit_txn_count_30d"),
            F.max("txn_dt").alias("last_txn_date"),
        )
        .withColumn("avg_txn_30d", F.try_divide("total_spend_30d", "_n_amounts"))
        .withColumn("as_of", as_of)
        .withColumn("days_since_last_txn", F.datediff("as_of", "last_txn_date"))
        .drop("_n_amounts")
    )


def holdings_long(holdings: DataFrame) -> DataFrame:
    flags = holdings.select("customer_id", *[F.col(f"has_{p}").alias(p) for p in PRODUCTS])
    return flags.unpivot("customer_id", PRODUCTS, "product_family", "has_product")


def customer_base(features: DataFrame, demographics: DataFrame, campaign: DataFrame) -> DataFrame:
    """Every join is on the key the features are already hashed by: one exchange per input."""
    return (
        features.join(demographics.select("customer_id", "age", "income_band", "region"), "customer_id", "left")
        .join(
            campaign.select("customer_id", "last_campaign_response", "campaign_touch_count"), "customer_id", "left"
        )
        .withColumn("campaign_response_flag", F.when(F.col("last_campaign_response") == "yes", 1).otherwise(0))
    )


def per_product(customers: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """Repeat each customer once per product; no join, the flag rides along in the array."""
    items = F.array(*[
        F.struct(F.lit(p).alias("product_family"), flags[p].alias("existing_products_flag")) for p in flags
    ])
    return customers.select("*", F.inline(items))


def scoring_inputs(base: DataFrame, holdings: DataFrame) -> DataFrame:
    """Customer x product rows.  The holdings join stays on `customer_id` alone and runs before the
    rows are repeated per product, which keeps the partitioning and moves a quarter of the rows."""
    wide = base.join(holdings.select("customer_id", *[f"has_{p}" for p in PRODUCTS]), "customer_id", "left")
    flags = {p: F.when(F.col(f"has_{p}") == 1, 1).otherwise(0) for p in PRODUCTS}
    return per_product(wide, flags)
