"""Domain tables derived from the sample star schema and event table.

The sample data has no bank tables, so each one is a projection of a sample table.  Every function
returns a lazy DataFrame; the work grows with the sample tables.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.schemas import EVENT_MONEY, MONEY

# Sample column types; timestamps are read as instants so that the session zone (UTC) applies.
LINEITEM = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp"
)
ORDERS = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
    "o_orderpriority string"
)
CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
NATION = "n_nationkey int, n_name string, n_regionkey int"
REGION = "r_regionkey int, r_name string"
EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"

BATCH_CATEGORIES = ["home_improvement", "electronics", "travel", "retail", "insurance", "utilities", "salary"]
STREAM_CATEGORIES = [
    "home_improvement",
    "furniture",
    "kitchen_appliances",
    "electronics",
    "travel",
    "retail",
    "insurance",
    "utilities",
    "salary",
]
EVENT_PRODUCTS = ["home_loan", "credit_card", "fixed_deposit", "personal_loan"]


def read_sample(spark: SparkSession, sf_dir: str, name: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{sf_dir}/{name}.parquet")


def customer_key(key: Column) -> Column:
    return F.format_string("cust_%06d", key)


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def _divisible(key: Column, divisor: int) -> Column:
    return F.when(key % divisor == 0, 1).otherwise(0).cast("bigint")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_sample(spark, sf_dir, "lineitem", LINEITEM)
    orders = read_sample(spark, sf_dir, "orders", ORDERS).select(
        F.col("o_orderkey").alias("l_orderkey"), customer_key(F.col("o_custkey")).alias("customer_id")
    )
    signed = F.col("l_extendedprice").cast("decimal(18,2)") * F.lit(Decimal("0.02"))
    amount = F.when(F.col("l_returnflag") == "R", -signed).otherwise(signed)
    return (
        lines.join(orders, "l_orderkey")
        .withColumn("merchant_category", _pick(BATCH_CATEGORIES, F.col("l_partkey") % 7))
        .select(
            "customer_id",
            F.col("l_shipdate").alias("transaction_ts"),
            "merchant_category",
            F.when(F.col("merchant_category") == "salary", "salary").otherwise("debit").alias("transaction_type"),
            amount.cast(MONEY).alias("amount"),
            F.concat(F.lit("merchant_"), F.col("l_suppkey").cast("string")).alias("merchant_name"),
            _pick(["branch", "online", "mobile"], F.col("l_linenumber") % 3).alias("channel"),
        )
    )


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_sample(spark, sf_dir, "customer", CUSTOMER)


def product_holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return _customers(spark, sf_dir).select(
        customer_key(key).alias("customer_id"),
        _divisible(key, 4).alias("has_home_loan"),
        _divisible(key, 3).alias("has_credit_card"),
        _divisible(key, 5).alias("has_fixed_deposit"),
        _divisible(key, 7).alias("has_personal_loan"),
    )


def demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, balance = F.col("c_custkey"), F.col("c_acctbal")
    # nation and region are fixed-size lookup tables (tens of rows at any scale)
    places = read_sample(spark, sf_dir, "nation", NATION).join(
        F.broadcast(read_sample(spark, sf_dir, "region", REGION)), F.col("n_regionkey") == F.col("r_regionkey")
    )
    holdings = F.struct(
        _divisible(key, 4).cast("int").alias("home_loan"),
        _divisible(key, 3).cast("int").alias("credit_card"),
        _divisible(key, 5).cast("int").alias("fixed_deposit"),
        _divisible(key, 7).cast("int").alias("personal_loan"),
    )
    return (
        _customers(spark, sf_dir)
        .join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            customer_key(key).alias("customer_id"),
            F.when(key % 17 != 0, 18 + key % 60).alias("age"),
            F.when(balance < 1000, "25-40k")
            .when(balance < 3000, "40-60k")
            .when(balance < 6000, "60-90k")
            .when(balance < 8500, "90-120k")
            .otherwise("120k+")
            .alias("income_band"),
            F.col("r_name").alias("region"),
            F.to_json(holdings).alias("existing_products"),
        )
    )


def campaign_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return (
        _customers(spark, sf_dir)
        .where(key % 19 != 0)
        .select(
            customer_key(key).alias("customer_id"),
            F.when(key % 6 == 0, "yes").otherwise("no").alias("last_campaign_response"),
            F.lit("1998-01-01").alias("last_campaign_date"),
            (key % 8).alias("campaign_touch_count"),
        )
    )


def _event_fields(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return events.withColumn("k", k).withColumn("customer_id", customer_key(F.col("user_id")))


def shape_transactions(events: DataFrame) -> DataFrame:
    """Transaction events; works on a batch or a streaming read of the event table."""
    return (
        _event_fields(events)
        .where(F.col("event_type").isin("purchase", "signup", "error"))
        .withColumn("merchant_category", _pick(STREAM_CATEGORIES, F.col("k") % 9))
        .select(
            "customer_id",
            "event_id",
            F.lit("txn").alias("kind"),
            F.col("ts").alias("event_ts"),
            F.unix_millis("ts").alias("event_ts_ms"),
            "merchant_category",
            F.when(F.col("merchant_category") == "salary", "salary").otherwise("debit").alias("transaction_type"),
            (F.col("value").cast("decimal(18,2)") * 40).cast(EVENT_MONEY).alias("amount"),
            _divisible(F.col("user_id"), 3).cast("int").alias("has_credit_card"),
            _divisible(F.col("user_id"), 5).cast("int").alias("has_fixed_deposit"),
        )
    )


def shape_product_events(events: DataFrame) -> DataFrame:
    return (
        _event_fields(events)
        .where(F.col("event_type").isin("view", "click"))
        .select(
            "customer_id",
            "event_id",
            F.lit("product").alias("kind"),
            F.col("ts").alias("event_ts"),
            F.unix_millis("ts").alias("event_ts_ms"),
            F.when(F.col("event_type") == "view", "page_view").otherwise("quote_request").alias("event_type"),
            _pick(EVENT_PRODUCTS, F.col("k") % 4).alias("product"),
        )
    )


def sample_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_sample(spark, sf_dir, "events", EVENTS)


def transaction_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape_transactions(sample_events(spark, sf_dir))


def product_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape_product_events(sample_events(spark, sf_dir))


def all_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transaction_events(spark, sf_dir).unionByName(product_events(spark, sf_dir), allowMissingColumns=True)


def transaction_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transaction events as the JSON strings a topic would carry."""
    return _messages(
        transaction_events(spark, sf_dir),
        ["merchant_category", "transaction_type", F.col("amount").cast("double").alias("amount"),
         "has_credit_card", "has_fixed_deposit"],
    )


def product_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _messages(product_events(spark, sf_dir), ["event_type", "product", F.lit("api").alias("source")])


def _messages(events: DataFrame, fields: list) -> DataFrame:
    iso = F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_ts")
    return events.select("event_id", F.to_json(F.struct("customer_id", iso, *fields)).alias("value"))
