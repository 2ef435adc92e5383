"""Greedy spacing: keep the first row of a key, then the next one at least `gap_ms` after the last kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from tidemark.operators.slices import HOT, SLICE_ROWS, first_at_or_after, hot_keys, mark_hot, parts
from tidemark.session import ensure_checkpoint_dir

FOLD_ROWS = 200_000


def keep_spaced(rows: DataFrame, keys: list[str], gap_ms: int, fold_rows: int = FOLD_ROWS,
                largest: int | None = None) -> DataFrame:
    """Rows kept by the greedy rule, ordered by (event_ts_ms, event_id) within each key.

    The comparison is with the last kept row, not with the previous one, so a lag cannot express it.
    Keys with up to `fold_rows` rows use a built-in array aggregate; a caller that knows `largest`, a
    bound on the rows of a key, to be within that gets this lazy plan.  Otherwise the rows are first
    cut from their lineage and larger keys, if there are any, are followed by pointer doubling,
    which never gathers a key.
    """
    if largest is not None and largest <= fold_rows:
        return _fold(rows, keys, gap_ms)
    ensure_checkpoint_dir(rows.sparkSession)
    rows = rows.checkpoint()
    if hot_keys(rows, keys, fold_rows).isEmpty():
        return _fold(rows, keys, gap_ms)
    small, large = parts(mark_hot(rows, keys, fold_rows))
    return _fold(small, keys, gap_ms).unionByName(_follow(large, keys, gap_ms, fold_rows))


def _fold(rows: DataFrame, keys: list[str], gap_ms: int) -> DataFrame:
    rest = [c for c in rows.columns if c not in (*keys, "event_ts_ms", "event_id")]
    item = F.struct("event_ts_ms", "event_id", *rest)
    kept_type = T.ArrayType(rows.select(item.alias("x")).schema["x"].dataType)
    zero = F.struct(F.lit(None).cast("bigint").alias("last"), F.array().cast(kept_type).alias("kept"))

    def step(acc, x):
        keep = acc["last"].isNull() | (x["event_ts_ms"] - acc["last"] >= gap_ms)
        return F.when(
            keep, F.struct(x["event_ts_ms"].alias("last"), F.array_append(acc["kept"], x).alias("kept"))
        ).otherwise(acc)

    return (
        rows.groupBy(*keys)
        .agg(F.sort_array(F.collect_list(item)).alias("ordered"))
        .select(*keys, F.inline(F.aggregate("ordered", zero, step)["kept"]))
        .select(*rows.columns)
    )


def _follow(rows: DataFrame, keys: list[str], gap_ms: int, slice_rows: int) -> DataFrame:
    """Pointer doubling: each moment knows its successor; each round doubles the length of the jumps.

    After k rounds the first 2**k kept moments of every key are known, so a year of daily offers
    takes nine rounds.  Each round is a join on (key, moment) and is checkpointed.
    """
    moments = rows.groupBy(*keys, "event_ts_ms").agg(F.min("event_id").alias("event_id"))
    target, probe = "struct(event_ts_ms as ms, event_id as id)", "struct(event_ts_ms)"
    rows_of_moment = moments.selectExpr(
        *keys, f"true as {HOT}",
        f"""inline(array(
            named_struct('t', event_ts_ms, 'target', {target}, 'probe', if(false, {probe}, null)),
            named_struct('t', event_ts_ms + {gap_ms}, 'target', if(false, {target}, null), 'probe', {probe})))""",
    )
    jumps = (
        first_at_or_after(rows_of_moment, keys, min(slice_rows, SLICE_ROWS))
        .where(F.col("next_ms").isNotNull())
        .select(*keys, "event_ts_ms", "next_ms")
        .checkpoint()
    )
    kept = moments.groupBy(*keys).agg(F.min("event_ts_ms").alias("event_ts_ms")).checkpoint()
    while True:
        ahead = kept.join(jumps, [*keys, "event_ts_ms"]).select(*keys, F.col("next_ms").alias("event_ts_ms"))
        ahead = ahead.checkpoint()
        if ahead.isEmpty():
            break
        kept = kept.unionByName(ahead).checkpoint()
        onward = jumps.select(*keys, F.col("event_ts_ms").alias("next_ms"), F.col("next_ms").alias("then_ms"))
        jumps = (
            jumps.join(onward, [*keys, "next_ms"])
            .select(*keys, "event_ts_ms", F.col("then_ms").alias("next_ms"))
            .checkpoint()
        )
    chosen = kept.join(moments, [*keys, "event_ts_ms"])
    return rows.join(chosen, [*keys, "event_ts_ms", "event_id"]).select(*rows.columns)
