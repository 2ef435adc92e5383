"""Readers for batch tables, seeds, relational tables and message streams."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.functions.parsing import iso_timestamp
from tidemark.plans.propensity import BatchTables
from tidemark.schemas import CAMPAIGN_HISTORY, DEMOGRAPHICS, PRODUCT_HOLDINGS, TRANSACTIONS, WEIGHTS
from tidemark.sources import adapters

SEED_WEIGHTS = Path(__file__).resolve().parent.parent / "data" / "weights.csv"

BATCH_TABLES = {
    "transactions": TRANSACTIONS,
    "product_holdings": PRODUCT_HOLDINGS,
    "demographics": DEMOGRAPHICS,
    "campaign_history": CAMPAIGN_HISTORY,
}


def batch_table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}.parquet"


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def missing_batch_tables(spark: SparkSession, base: str) -> list[str]:
    """Input tables that are not there; what is there is checked by `quality.check_inputs`."""
    return [name for name in BATCH_TABLES if not path_exists(spark, batch_table_path(base, name))]


def load_batch_tables(spark: SparkSession, base: str) -> BatchTables:
    """The four input tables of the scoring job, with declared schemas."""
    t = {n: spark.read.schema(s).parquet(batch_table_path(base, n)) for n, s in BATCH_TABLES.items()}
    return BatchTables(t["transactions"], t["product_holdings"], t["demographics"], t["campaign_history"])


def sample_tables(spark: SparkSession, sf_dir: str) -> BatchTables:
    """The same tables derived from the sample star schema."""
    return BatchTables(
        adapters.transactions(spark, sf_dir),
        adapters.product_holdings(spark, sf_dir),
        adapters.demographics(spark, sf_dir),
        adapters.campaign_history(spark, sf_dir),
    )


def text_transactions(spark: SparkSession, path: str) -> DataFrame:
    """Transactions whose time is ISO text: convert once on load, so later filters see a timestamp."""
    raw = spark.read.schema(TRANSACTIONS.replace("transaction_ts timestamp", "transaction_ts string"))
    return raw.parquet(path).withColumn("transaction_ts", iso_timestamp(F.col("transaction_ts")))


def load_weights(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Scoring weights, one row per product.

    The packaged file is read on the driver, since executors cannot see the driver's disk; any
    other path is read by Spark.
    """
    if path is not None:
        return spark.read.schema(WEIGHTS).csv(path, header=True)
    header, *lines = SEED_WEIGHTS.read_text().split()
    rows = [(name, *map(float, values)) for name, *values in (line.split(",") for line in lines)]
    return spark.createDataFrame(rows, WEIGHTS)


def with_row_number(df: DataFrame) -> DataFrame:
    """Adds a dense `row_number` from 0 in read order, without a global sort.

    The generated id holds the partition and the position in it; only one row per partition is
    needed to turn that into an offset.
    """
    marked = df.withColumn("_id", F.monotonically_increasing_id())
    part, position = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        marked.groupBy(part.alias("_part")).count()
        .select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        marked.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn("row_number", position + F.col("_offset"))
        .drop("_id", "_part", "_offset")
    )


def read_survey(spark: SparkSession, path: str) -> DataFrame:
    """Bank survey file (`;` separated) with its yes/no answers turned into flags."""
    def yes(c: str):
        return F.when(F.col(c) == "yes", 1).otherwise(0)

    raw = with_row_number(spark.read.csv(path, sep=";", header=True))
    return raw.select(
        F.format_string("cust_%06d", F.col("row_number") + 1).alias("customer_id"),
        F.col("age").cast("bigint").alias("age"),
        yes("housing").alias("has_home_loan"),
        F.lit(0).alias("has_credit_card"),
        F.lit(0).alias("has_fixed_deposit"),
        yes("loan").alias("has_personal_loan"),
        F.when(F.col("y") == "yes", "yes").otherwise("no").alias("last_campaign_response"),
        F.col("campaign").cast("bigint").alias("campaign_touch_count"),
    )


def read_relational(spark: SparkSession, url: str, table: str, driver: str | None = None,
                    partition_column: str | None = None, lower: str | None = None, upper: str | None = None,
                    partitions: int = 32, **options: str) -> DataFrame:
    """A relational table over JDBC, in parallel range reads when a partition column is named."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if driver:
        reader = reader.option("driver", driver)
    if partition_column:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=lower, upperBound=upper, numPartitions=str(partitions)
        )
    return reader.load()


def read_topic(spark: SparkSession, brokers: str, topic: str, starting: str = "latest") -> DataFrame:
    """Stream of message strings from a Kafka topic (needs the Kafka connector on the class path)."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )


def read_message_files(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Stream of message strings from text files, one message per line."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)
