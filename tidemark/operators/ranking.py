"""Exact top-n per group for groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_n_per_group(df: DataFrame, groups: list[str], order: list[Column], n: int, spread_by: list[str],
                    salts: int = 64, rank: str = "rank_in_group") -> DataFrame:
    """Rows ranked 1..n within `groups`.

    A few large groups would otherwise be sorted by as many tasks.  The first ranking runs in
    `salts` parts per group and keeps n rows of each, which cannot lose a row of the final top n; the
    second ranks at most salts * n rows per group.  Both are cut down map-side by Spark's window
    group limit.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)))
    part = Window.partitionBy(*groups, "_salt").orderBy(*order)
    whole = Window.partitionBy(*groups).orderBy(*order)
    return (
        salted.withColumn(rank, F.row_number().over(part))
        .where(F.col(rank) <= n)
        .drop("_salt", rank)
        .withColumn(rank, F.row_number().over(whole))
        .where(F.col(rank) <= n)
    )
