"""Nightly snapshot of the newest weekly spend per customer and category."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.panes import latest_spend
from tidemark.sources import sinks
from tidemark.sources.keyed import START, Generations, KeyedTable, Version

SNAPSHOT_KEY = ["customer_id", "merchant_category"]


def nightly_enrichment(feed: DataFrame, as_of: date) -> DataFrame:
    return latest_spend(feed).select(
        F.lit(as_of).alias("as_of_date"),
        "customer_id",
        "merchant_category",
        "total_spend",
        "event_count",
        F.col("updated_at").alias("source_updated_at"),
        F.lit(as_of).cast("timestamp").alias("refreshed_at"),
    )


def newest_windows(rows: DataFrame) -> DataFrame:
    """The row of the newest window of each customer and category, of that window the newest version."""
    rest = [c for c in rows.columns if c not in (*SNAPSHOT_KEY, "window_end_ms", *sinks.VERSION)]
    newest = F.max(F.struct("window_end_ms", *sinks.VERSION, *rest)).alias("r")
    return rows.groupBy(*SNAPSHOT_KEY).agg(newest).select(*SNAPSHOT_KEY, "r.*").select(*rows.columns)


def refresh(feed: KeyedTable, snapshots: Generations, as_of: date, out: str) -> DataFrame:
    """Bring the snapshot up to date, write the night's rows to `out`, and return what was read of the feed.

    Only versions since the last refresh are read and merged into the last snapshot; the note beside that says up to where
    it goes.  Running a night again gives the same rows as long as the feed has not moved on.
    """
    numbers, newest = snapshots.numbers(), feed.newest()
    since = Version(*snapshots.note(numbers[-1])["upto"]) if numbers else START
    changed = feed.changes(since, newest)
    if not numbers or newest > since:
        merged = changed
        if numbers:
            merged = snapshots.read(numbers[-1], feed.schema).unionByName(changed)
        numbers = [snapshots.write(newest_windows(merged), {"upto": newest})]
    sinks.replace_days(nightly_enrichment(snapshots.read(numbers[-1], feed.schema), as_of), out)
    return changed
