"""Helpers shared by the operators: lineage cuts, the shared folder, checked broadcasts, Arrow row mapping."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidemark.session import ensure_checkpoint_dir

# Words are runs of anything but ASCII white space; `bytes.split()` cuts at exactly the same bytes.
WORD = r"[^\x20\x09-\x0D]+"

# A side with at most so many narrow rows may be broadcast.
BROADCAST_ROWS = 100_000

# Rows that a Python function gets at once.
SLICE = 256


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the shared checkpoint folder, so that lost executors cost no recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below the checkpoint folder that all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def fresh(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Cut `df` and mark it for broadcast if its counted rows stay within the bound; else leave the join to Spark."""
    kept = cut(df)
    return F.broadcast(kept) if kept.count() <= rows else kept


def hashed_share(wanted: int, available: int, *columns: str) -> Column:
    """True for about twice `wanted` of `available` rows, chosen by a hash.

    In front of an ordered limit it keeps what the partitions send at a bounded size however many there are.
    """
    steps = 1 << 40
    return F.pmod(F.xxhash64(F.lit("sample"), *columns), F.lit(steps)) < F.lit(min(steps, 2 * steps * wanted // max(1, available)))


def map_rows(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: StructType | str
) -> DataFrame:
    """Apply a function to the rows, at most SLICE at a time, so that few long texts are Python objects at once."""
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for at in range(0, batch.num_rows, SLICE):
                result = function(batch.slice(at, SLICE))
                if result.num_rows:
                    yield result

    return df.mapInArrow(batches, schema)


def deal(rows: DataFrame, keys: list[str], member: str, chunk: int) -> DataFrame:
    """Split the home rows (role 0) of crowded groups into parts of about `chunk` and let them visit the other parts.

    Adds `part`; a row has role 0 in its own part only and role 1 in all others.  Visitors (role 1) go to every part.
    """
    crowded = small_side(rows.where("role = 0").groupBy(*keys).agg(F.count("*").alias("_n")).where(
        F.col("_n") > chunk
    ).select(*keys, F.ceil(F.col("_n") / chunk).cast("int").alias("_parts")))
    dealt = rows.join(crowded, keys, "left").withColumn("_parts", F.coalesce("_parts", F.lit(1)))
    own = F.when(F.col("role") == 0, F.pmod(F.xxhash64(member), F.col("_parts")).cast("int")).otherwise(-1)
    return dealt.withColumn("_own", own).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))
    ).withColumn("role", F.when(F.col("_own") == F.col("part"), 0).otherwise(1)).drop("_own", "_parts")
