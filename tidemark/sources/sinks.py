"""Writers: relational tables, message outputs, keyed tables, exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.sources.tables import path_exists

FEED_KEY = ["window_end_ms", "customer_id", "merchant_category"]


def overwrite_relational(df: DataFrame, url: str, table: str, driver: str | None = None, batch_size: int = 5000,
                         partitions: int = 32, **options: str) -> None:
    """Replace a relational table over JDBC; `partitions` bounds the connections."""
    writer = df.write.format("jdbc").mode("overwrite").options(
        url=url, dbtable=table, batchsize=str(batch_size), numPartitions=str(partitions), **options
    )
    if driver:
        writer = writer.option("driver", driver)
    writer.save()


def materialise(df: DataFrame, table: str) -> DataFrame:
    """Replace a managed table with the result of a model, and read it back."""
    df.write.mode("overwrite").format("parquet").saveAsTable(table)
    return df.sparkSession.table(table)


def write_batch(df: DataFrame, path: str, batch_id: int, run: int) -> None:
    """One micro-batch as one partition; replaying the batch replaces the partition.

    Batches count from 0 again with a new checkpoint folder, so each such folder needs a `run` of its own, higher
    than those before it.
    """
    df.write.mode("overwrite").parquet(f"{path}/run={run}/batch_id={batch_id}")


def _key_bits(df: DataFrame, key: str, by: str) -> DataFrame:
    """(by, slot, bits): a Bloom filter of the keys of each partition, with one hash of 30 bits, in words of 64 bits."""
    hashed = F.xxhash64(key)
    bit = F.shiftrightunsigned(hashed, 34).bitwiseAND(63).cast("int")
    return df.select(
        by, F.shiftrightunsigned(hashed, 40).alias("slot"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bits"))


def _of(df: DataFrame, by: str, values: list) -> DataFrame:
    """The rows of some partitions, as a filter that reaches the scan."""
    held = F.col(by).isin([v for v in values if v is not None])
    return df.where(held | F.col(by).isNull() if None in values else held)


def insert_new(df: DataFrame, path: str, key: str = "event_id", by: str = "event_date") -> None:
    """Append the rows whose key is not in the table's partition yet.

    The table is partitioned by `by`, a date or the like, whose values of one batch go through the driver.  A Bloom filter
    of each partition's keys stands in `{path}_keys`.  Only partitions whose filter knows a key of the batch are read, so
    new keys read no stored ones.  The filter is written before the rows: what a lost run leaves in it costs a read, never
    a row.  A table without a filter gets one from its keys.  One writer at a time.
    """
    spark, keys = df.sparkSession, f"{path}_keys"
    fresh = df.dropDuplicates([key])
    write_bits = lambda rows, mode: rows.groupBy(by, "slot").agg(F.bit_or("bits").alias("bits")).write.mode(
        mode).partitionBy(by).parquet(keys)
    if path_exists(spark, path):
        table = spark.read.schema(fresh.schema).parquet(path)
        if not path_exists(spark, f"{keys}/_SUCCESS"):
            write_bits(_key_bits(table, key, by), "overwrite")
        touched = [r[0] for r in fresh.select(by).distinct().collect()]
        mine = _key_bits(fresh, key, by)
        stored = _of(spark.read.schema(mine.schema).parquet(keys), by, touched)
        same = (F.col(f"m.{by}").eqNullSafe(F.col(f"s.{by}")) & (F.col("m.slot") == F.col("s.slot"))
                & (F.col("m.bits").bitwiseAND(F.col("s.bits")) != 0))
        doubtful = [r[0] for r in mine.alias("m").join(stored.alias("s"), same, "left_semi").select(by).distinct().collect()]
        if doubtful:
            known = _of(table, by, doubtful).select(F.col(key).alias("key"), F.col(by).alias("by"))
            again = (F.col(f"f.{key}") == F.col("k.key")) & F.col(f"f.{by}").eqNullSafe(F.col("k.by"))
            fresh = fresh.alias("f").join(known.alias("k"), again, "left_anti")
    write_bits(_key_bits(fresh, key, by), "append")
    fresh.write.mode("append").partitionBy(by).parquet(path)


VERSION = ["run", "batch_id"]


def latest_by_key(log: DataFrame, keys: list[str] = FEED_KEY, version: list[str] = VERSION) -> DataFrame:
    """Current row per key of an append log: an upsert resolved on read, as a max over structs.  Keeps the version."""
    rest = [c for c in log.columns if c not in (*keys, *version)]
    newest = F.max(F.struct(*version, *rest)).alias("r")
    return log.groupBy(*keys).agg(newest).select(*keys, *[f"r.{c}" for c in (*version, *rest)])


def compact(spark: SparkSession, path: str, target: str, keys: list[str] = FEED_KEY) -> None:
    """Write the current rows of the log at `path` to the new folder `target`, as one log with the same versions.

    The log goes on beside it: later batches win over compacted rows, so readers take the union of both.
    """
    latest_by_key(spark.read.parquet(path), keys).write.partitionBy(*VERSION).parquet(target)


def upsert(df: DataFrame, current: DataFrame | None, keys: list[str]) -> DataFrame:
    """The table after an upsert: new rows win over current ones."""
    if current is None:
        return df
    both = df.withColumn("_new", F.lit(1)).unionByName(current.withColumn("_new", F.lit(0)))
    newest = Window.partitionBy(*keys).orderBy(F.col("_new").desc())
    return both.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank", "_new")


def replace_days(df: DataFrame, path: str, by: str = "as_of_date") -> None:
    """Overwrite only the dates the rows belong to, so running a date again changes nothing else."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def write_messages(messages: DataFrame, path: str) -> None:
    """Message strings in column `value`, one per line."""
    messages.select("value").write.mode("append").text(path)


def publish(messages: DataFrame, brokers: str, topic: str) -> None:
    """Key/value messages to a Kafka topic (needs the Kafka connector on the class path)."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", brokers).option("topic", topic).save()


def write_snapshots(messages: DataFrame, path: str) -> None:
    """Keyed snapshot messages as a table of `key`, `value`."""
    messages.select("key", "value").write.mode("overwrite").parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)
