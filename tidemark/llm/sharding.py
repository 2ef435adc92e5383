"""Sharding: weighted rendezvous hashing of stable record keys.

Every (key, shard) pair has a pseudo-random score that depends on nothing else; a record goes to the shard with
the best score.  A new shard can only win records for itself, so growing from n to n + 1 moves about 1 / (n + 1)
of the records, all of them into the new shard.  With weights w the score is -w / ln(u), which sends each shard
a share of w / sum(w).

Placing needs no shuffle.  Slots need one shuffle of narrow rows that are combined first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import cut, fresh

# Slots are counted within 16 ** 3 parts of each shard, so that no task orders a whole shard.
PART_DIGITS = 3


def _uniform(key: Column, shard: int) -> Column:
    """A number in (0, 1) from the first 52 bits of the MD5 of `key:shard`."""
    digest = F.md5(F.concat(key, F.lit(f":{shard}")).cast("binary"))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")
    return (bits + F.lit(0.5)) / F.lit(float(2 ** 52))


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """Number of the shard with the best score; ties go to the smaller number, a null key hashes like the text `null`.

    Shards with a weight of 0 or less take nothing.
    """
    text = F.coalesce(key.cast("string"), F.lit("null"))
    scores = [
        F.struct((F.lit(-float(w)) / F.ln(_uniform(text, i))).alias("score"), F.lit(-i).alias("order"))
        for i, w in enumerate(weights) if w > 0
    ]
    if not scores:
        raise ValueError("no shard has a weight")
    return (-F.array_max(F.array(*scores))["order"]).cast("int")


def shard_records(df: DataFrame, key: str, weights: Sequence[float], grown: Sequence[float] | None = None) -> DataFrame:
    """Add `law`, `shard` and, with the weights after growth, `grown_shard`.

    Columns of these names in the input are replaced, all others are kept; repeated keys share a shard; an empty
    table stays empty.
    """
    added = {"law": F.lit("key"), "shard": rendezvous(F.col(key), weights)}
    if grown is not None:
        added["grown_shard"] = rendezvous(F.col(key), grown)
    return df.withColumns(added)


def numbered(placed: DataFrame, shard: str, order: list[str]) -> DataFrame:
    """Add `slot`: 0, 1, 2, ... within each shard, without gaps, the same on every run.

    `placed` should be narrow.  Rows are ordered by a hash of the `order` columns, then by these; rows equal in
    all columns are combined before the shuffle and unfolded after it, so a key with a third of all rows costs
    one row for each task.
    """
    names = placed.columns
    part, n, before, rows, start = (fresh(placed, c) for c in ("_part", "_n", "_before", "_rows", "_start"))
    text = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in order])
    digits = F.substring(F.md5(text.cast("binary")), 1, PART_DIGITS)
    counted = cut(placed.withColumn(part, digits).groupBy(*names, part).agg(F.count("*").alias(n)))
    in_part = Window.partitionBy(shard, part).orderBy(*order)
    earlier = F.sum(n).over(in_part.rowsBetween(Window.unboundedPreceding, -1))
    local = counted.withColumn(before, F.coalesce(earlier, F.lit(0)))
    parts = counted.groupBy(shard, part).agg(F.sum(n).alias(rows))
    in_shard = F.sum(rows).over(
        Window.partitionBy(shard).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = parts.select(shard, part, F.coalesce(in_shard, F.lit(0)).alias(start))
    first = F.col(start) + F.col(before)
    return local.join(starts, [shard, part]).select(
        *names, F.explode(F.sequence(first, first + F.col(n) - 1)).alias("slot")
    )
