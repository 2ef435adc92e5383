"""From the four batch tables to scores and campaign lists, as one lazy plan."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.scoring import campaign_segment, normalized_terms, propensity_score
from tidemark.operators import features as ft
from tidemark.operators.ranking import top_n_per_group
from tidemark.schemas import CAMPAIGN_THRESHOLD, CAMPAIGN_TOP_N


@dataclass(frozen=True)
class BatchTables:
    transactions: DataFrame
    holdings: DataFrame
    demographics: DataFrame
    campaign: DataFrame


def dated_inputs(tables: BatchTables, as_ofs: list[date]) -> DataFrame:
    """Scoring inputs of several dates in one pass over the transactions, with `as_of` and `region`."""
    recent = ft.recent_transactions(tables.transactions, as_ofs)
    base = ft.customer_base(ft.transaction_features(recent, as_ofs), tables.demographics, tables.campaign)
    return ft.scoring_inputs(base, tables.holdings).select("as_of", *ft.INPUT_COLUMNS, "region")


def propensity_inputs(tables: BatchTables, as_of: date) -> DataFrame:
    return dated_inputs(tables, [as_of]).select(*ft.INPUT_COLUMNS)


def normalized_signals(inputs: DataFrame, weights: DataFrame) -> DataFrame:
    """Inputs plus the normalised terms and the weights.  `weights` holds one row per product."""
    return inputs.join(F.broadcast(weights), "product_family").selectExpr("*", *normalized_terms())


def propensity_scores(inputs: DataFrame, weights: DataFrame, as_of: date | None = None) -> DataFrame:
    """Score table; `as_of` is needed only when the inputs carry no date of their own."""
    score_ts = (F.col("as_of") if as_of is None else F.lit(as_of)).cast("timestamp")
    return normalized_signals(inputs, weights).select(
        "customer_id", "product_family", propensity_score().alias("propensity_score"), score_ts.alias("score_ts")
    )


def campaign_lists(scores: DataFrame, as_of: date, threshold: float = CAMPAIGN_THRESHOLD,
                   top_n: int = CAMPAIGN_TOP_N) -> DataFrame:
    chosen = top_n_per_group(
        scores.where(F.col("propensity_score") >= threshold),
        ["product_family"],
        [F.col("propensity_score").desc(), F.col("customer_id")],
        top_n,
        spread_by=["customer_id"],
    )
    return chosen.select(
        "customer_id",
        "product_family",
        "propensity_score",
        "score_ts",
        campaign_segment(F.col("product_family"), F.col("propensity_score")).alias("campaign_segment"),
        F.lit(as_of).cast("timestamp").alias("generated_at"),
    )


def score_snapshots(scores: DataFrame) -> DataFrame:
    """One row per customer with a product -> score map; a customer has one row per product."""
    pairs = F.sort_array(F.collect_list(F.struct("product_family", "propensity_score")))
    return scores.groupBy("customer_id").agg(
        F.map_from_entries(pairs).alias("scores"), F.max("score_ts").alias("score_ts")
    )


def snapshot_messages(snapshots: DataFrame) -> DataFrame:
    """Key/value form of the snapshots, the key being the customer."""
    iso = F.date_format("score_ts", "yyyy-MM-dd'T'HH:mm:ss").alias("score_ts")
    return snapshots.select(
        F.col("customer_id").alias("key"), F.to_json(F.struct("customer_id", "scores", iso)).alias("value")
    )
