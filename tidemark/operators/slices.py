"""Ordered per-key computations that also hold when one key has a large share of all rows.

A window partitioned by customer puts a whole customer into one task.  Here the rows of a key with more than `hot_rows`
are sorted and cut by their rank into slices of `slice_rows` at most, whatever their times.  Each slice is its own window
partition, and what the other slices contribute enters as one extra *carry* row.  Carries are a scan over the slices: up
to FAN neighbours are summed up, those sums again, until FAN at most are left, and the totals are handed down again, so
no window holds more than a slice or FAN carries.  All other keys take the usual plan: one exchange, one sort.

Rows are ordered by (t, step, event_id, seq): `t` is event time in milliseconds, `step` puts expiries
(0) before events (1) of the same millisecond, `seq` puts a row before (0), at (1) or after (2) the event.

Column `hot` marks the rows of such keys.  Where it is known beforehand that there are none, the column is left out.
Where there are hot keys, the sorted rows are materialised in the checkpoint folder as the query is built.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import ensure_checkpoint_dir

HOT_ROWS = 1_000_000
SLICE_ROWS = 100_000
FAN = 1024
ORDER = ["t", "step", "event_id", "seq"]
HOT = "hot"


def busiest(df: DataFrame, keys: list[str]) -> int:
    """Rows of the largest key.  One aggregate over the key column; a single number comes back."""
    return df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than `hot_rows` rows, however many rows there are in all."""
    return df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > hot_rows).select(*keys, F.lit(True).alias(HOT))


def mark_hot(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS, largest: int | None = None) -> DataFrame:
    """Adds `hot`, true for the rows of hot keys and null for others; not with `largest` known to be within `hot_rows`.

    The size of the list of hot keys is left for Spark to judge.
    """
    if largest is not None and largest <= hot_rows:
        return df
    return df.join(hot_keys(df, keys, hot_rows), keys, "left")


def marks(df: DataFrame) -> list[str]:
    """The name of the marking column, if `df` has it."""
    return [c for c in df.columns if c == HOT]


def parts(df: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The rows of all other keys and those of hot ones; None where there are none."""
    if not marks(df):
        return df, None
    return df.where("hot is null").drop(HOT), df.where("hot").drop(HOT)


def by_rank(rows: DataFrame, order: list[str | Column], slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Rows with `slice`, rising in `order`: at most `slice_rows` rows of the sorted whole.

    Materialised, as a second evaluation may cut elsewhere.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    ranked = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "_rank", F.monotonically_increasing_id()
    ).selectExpr("*", "shiftright(_rank, 33) as _part", f"(_rank & {(1 << 33) - 1}) div {slice_rows} as _piece")
    ranked = ranked.drop("_rank").checkpoint()
    pieces = (ranked.agg(F.max("_piece")).first()[0] or 0) + 1
    return ranked.withColumn("slice", F.col("_part") * pieces + F.col("_piece")).drop("_part", "_piece")


def others(slices: DataFrame, keys: list[str], values: list[str], total: Callable[[str], Column],
           join: Callable[[Column, Column], Column], later: bool = False) -> DataFrame:
    """For each slice the `total` over the earlier (or later) slices of its key, null where there are none.

    `slices` has the keys, `slice` and the values, one row for each slice; `join` joins two totals of which either may be null.
    """
    slices = slices.checkpoint()
    order = F.col("slice").desc() if later else F.col("slice")
    span = (slices.agg(F.max("slice")).first()[0] or 0) + 1
    if span <= FAN:
        before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return slices.select(*keys, "slice", *[total(v).over(before).alias(v) for v in values])
    grouped = slices.withColumn("_group", F.expr(f"slice div {FAN}"))
    above = others(
        grouped.groupBy(*keys, F.col("_group").alias("slice")).agg(*[total(v).alias(v) for v in values]), keys, values, total, join, later
    ).select(*keys, F.col("slice").alias("_group"), *[F.col(v).alias(f"_{v}") for v in values])
    before = Window.partitionBy(*keys, "_group").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    within = grouped.select(*keys, "slice", "_group", *[total(v).over(before).alias(v) for v in values])
    return within.join(above, [*keys, "_group"]).select(
        *keys, "slice", *[join(F.col(v), F.col(f"_{v}")).alias(v) for v in values])


def _added(a: Column, b: Column) -> Column:
    return F.coalesce(a + b, a, b)


def running_totals(rows: DataFrame, keys: list[str], measures: list[str], slice_rows: int | None = None) -> DataFrame:
    """Replaces each measure by its running total per key, in ORDER, up to and including the row.

    `rows` has the keys, the ORDER columns, the measures and any payload columns; a marking column is kept.
    """
    cold, hot = parts(rows)
    whole = Window.partitionBy(*keys).orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
    done = cold.withColumns({m: F.sum(m).over(whole) for m in measures})
    if hot is None:
        return done
    sliced = by_rank(hot, [*keys, *ORDER], slice_rows or SLICE_ROWS)
    sums = sliced.groupBy(*keys, "slice").agg(*[F.sum(m).alias(m) for m in measures])
    carry = others(sums, keys, measures, F.sum, _added).where(F.col(measures[0]).isNotNull())
    # a carry row has no time, which sorts it to the front of its slice
    within = Window.partitionBy(*keys, "slice").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
    scanned = (
        sliced.withColumn("carried", F.lit(False))
        .unionByName(carry.withColumn("carried", F.lit(True)), allowMissingColumns=True)
        .withColumns({m: F.sum(m).over(within) for m in measures})
        .where("not carried")
        .drop("carried", "slice")
    )
    return done.withColumn(HOT, F.lit(None).cast("boolean")).unionByName(scanned.withColumn(HOT, F.lit(True))).select(*rows.columns)


def first_at_or_after(rows: DataFrame, keys: list[str], slice_rows: int | None = None) -> DataFrame:
    """For every probe the first target of the same key whose time is not before the probe's.

    `rows` has the keys, `t`, and either `target` (struct ms, id; ms = t) or `probe` (any
    struct), the other being null.  The result has the keys, a marking column if `rows` has one, the fields of `probe`,
    `next_ms` and `next_id`.
    """
    cold, hot = parts(rows)

    def found(part: DataFrame, *by: str) -> DataFrame:
        # Descending time with a frame that only grows: each row costs constant work.
        onwards = Window.partitionBy(*keys, *by).orderBy(F.col("t").desc()).rangeBetween(Window.unboundedPreceding, 0)
        return part.withColumn("first", F.min("target").over(onwards)).where("probe is not null")

    asked = ["probe.*", "first.ms as next_ms", "first.id as next_id"]
    done = found(cold)
    if hot is None:
        return done.selectExpr(*keys, *asked)
    # probes come before the targets of their time, so what answers them lies in their own or a later slice
    sliced = by_rank(hot, [*keys, "t", F.col("target").isNotNull(), "target", "probe"], slice_rows or SLICE_ROWS)
    firsts = sliced.groupBy(*keys, "slice").agg(F.min("target").alias("target"))
    carry = others(firsts, keys, ["target"], F.min, F.least, later=True).where("target is not null").withColumn("t", F.col("target.ms"))
    scanned = found(sliced.unionByName(carry, allowMissingColumns=True), "slice")
    return done.selectExpr(*keys, f"cast(null as boolean) as {HOT}", *asked).unionByName(
        scanned.selectExpr(*keys, f"true as {HOT}", *asked))
