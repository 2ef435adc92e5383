"""A-then-B patterns per customer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.slices import first_at_or_after, marks
from tidemark.schemas import WEEK_MS


TARGET = "struct<ms:bigint,id:bigint>"
PROBE = "struct<first_event_id:bigint,first_ts_ms:bigint>"


def sequence_alerts(events: DataFrame, first: Column, second: Column, within_ms: int = WEEK_MS) -> DataFrame:
    """Each `first` event that is followed by a `second` event of the same customer within the period.

    The alert carries the nearest later `second`.
    """
    opens = F.when(first, F.struct(
        (F.col("event_ts_ms") + 1).alias("t"), F.lit(None).cast(TARGET).alias("target"),
        F.struct(F.col("event_id").alias("first_event_id"), F.col("event_ts_ms").alias("first_ts_ms")).alias("probe"),
    ))
    closes = F.when(second, F.struct(
        F.col("event_ts_ms").alias("t"),
        F.struct(F.col("event_ts_ms").alias("ms"), F.col("event_id").alias("id")).alias("target"),
        F.lit(None).cast(PROBE).alias("probe"),
    ))
    rows = events.select("customer_id", *marks(events), F.inline(F.array(opens, closes))).where("t is not null")
    return (
        first_at_or_after(rows, ["customer_id"])
        .where(F.col("next_ms") <= F.col("first_ts_ms") + within_ms)
        .select("customer_id", "first_event_id", "first_ts_ms", F.col("next_id").alias("second_event_id"),
                F.col("next_ms").alias("second_ts_ms"))
    )
