"""Column expressions for timestamps and JSON messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.schemas import HOLDINGS_JSON, OFFER_MESSAGE, PRODUCTS

# Fixed pattern: date, optional time to microseconds, optional offset.
ISO_PATTERN = (
    r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{3}(\d{3})?)?)?(Z|[+-]\d{2}:\d{2})?)?$"
)


def _instant(text: Column) -> Column:
    return F.when(text.rlike(ISO_PATTERN), F.try_to_timestamp(text))


def iso_timestamp(text: Column) -> Column:
    """Instant of an ISO-8601 string, UTC when it carries no offset; null when blank, bad or the epoch."""
    return F.when(F.unix_millis(_instant(text)) != 0, _instant(text))


def _once(value: Column) -> Column:
    """Keeps an expensive value from being evaluated again by every filter that uses it: predicates
    are pushed through a projection, copying its expressions, but not through a generator."""
    return F.explode(F.array(value))


def _field(name: str, default: str) -> Column:
    # the default replaces a missing key only; an explicit null stays null
    return F.when(F.map_contains_key("m", name), F.col("m")[name]).otherwise(F.lit(default))


def _number(text: Column) -> Column:
    """A JSON number, a number as text, or a boolean; null when it is neither."""
    return F.when(text == "true", 1.0).when(text == "false", 0.0).otherwise(text.try_cast("double"))


def _flag(name: str) -> Column:
    """0 when missing, null or empty; null, which drops the message, when it is not a number."""
    text = F.col("m")[name]
    return F.when(text.isNull() | (text == ""), 0).otherwise(_number(text).try_cast("int")).alias(name)


def _decode(raw: DataFrame, keep: list[str], kind: str, fields: list[Column]) -> DataFrame:
    """Message fields as columns; rows that are not an object with a usable time are dropped."""
    row = F.struct(
        _field("customer_id", "").alias("customer_id"),
        F.lit(kind).alias("kind"),
        _instant(F.col("m")["event_ts"]).alias("event_ts"),
        *fields,
    )
    return (
        raw.select(*keep, _once(F.from_json("value", "map<string,string>")).alias("m"))
        .where("m is not null")
        .select(*keep, _once(row).alias("r"))
        .select(*keep, "r.*", F.unix_millis("r.event_ts").alias("event_ts_ms"))
        .where("event_ts_ms != 0")
    )


# Amounts from here on cannot be summed as cents; no account moves that much.
AMOUNT_LIMIT = 1e15


def _transactions(raw: DataFrame, keep: list[str]) -> DataFrame:
    return _decode(raw, keep, "txn", [
        _field("merchant_category", "unknown").alias("merchant_category"),
        _field("transaction_type", "debit").alias("transaction_type"),
        _number(_field("amount", "0")).alias("amount"),
        _flag("has_credit_card"),
        _flag("has_fixed_deposit"),
    ])


# Not a number, not finite or out of range; NaN is larger than every number.
_BAD_AMOUNT = f"(amount is null or abs(amount) >= {AMOUNT_LIMIT:.0f}D)"
_BAD_FLAG = "(has_credit_card is null or has_fixed_deposit is null)"


def parse_transactions(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Decode transaction messages in column `value`; undecodable rows are dropped (see `rejected_transactions`)."""
    return _transactions(raw, keep or []).where(f"not {_BAD_AMOUNT} and not {_BAD_FLAG}")


def rejected_transactions(raw: DataFrame) -> DataFrame:
    """How many messages `parse_transactions` drops for their amount or a flag, beside those it takes."""
    return _transactions(raw, []).agg(
        F.count_if(F.expr(_BAD_AMOUNT)).alias("bad_amounts"),
        F.count_if(F.expr(f"{_BAD_FLAG} and not {_BAD_AMOUNT}")).alias("bad_flags"),
        F.count_if(F.expr(f"not {_BAD_AMOUNT} and not {_BAD_FLAG}")).alias("accepted"),
    )


def message_id(kind: str) -> Column:
    """An event id for messages that carry none: the same message has the same id, topics do not clash."""
    return F.xxhash64(F.lit(kind), F.col("value")).alias("event_id")


def parse_product_events(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    return _decode(raw, keep or [], "product", [
        _field("event_type", "page_view").alias("event_type"),
        _field("product", "unknown").alias("product"),
    ])


def parse_scores(raw: DataFrame) -> DataFrame:
    """Decode score snapshots; a row needs a customer and, where `scores` is given, an object."""
    text = _field("scores", "{}")
    return (
        raw.select(_once(F.from_json("value", "map<string,string>")).alias("m"))
        .select(
            F.col("m")["customer_id"].alias("customer_id"),
            _once(F.when(F.ltrim(text).startswith("{"), F.from_json(text, "map<string,double>"))).alias("scores"),
            F.col("m")["score_ts"].alias("score_ts"),
        )
        .where("customer_id != '' and scores is not null")
    )


def drop_blank_keys(events: DataFrame) -> DataFrame:
    return events.where((F.col("customer_id") != "") & (F.col("event_ts_ms") != 0))


def known_categories(events: DataFrame) -> DataFrame:
    return events.where(F.col("merchant_category") != "unknown")


def union_events(transactions: DataFrame, product_events: DataFrame) -> DataFrame:
    return transactions.unionByName(product_events, allowMissingColumns=True)


def holdings_from_json(demographics: DataFrame) -> DataFrame:
    parsed = demographics.select("customer_id", F.from_json("existing_products", HOLDINGS_JSON).alias("p"))
    return parsed.select("customer_id", *[F.col(f"p.{p}").alias(f"has_{p}") for p in PRODUCTS])


def flatten_offers(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One column per offer field plus the whole message; windows the sender never fills stay null."""
    keep = keep or []
    offer = raw.select(
        *keep, _once(F.from_json("value", OFFER_MESSAGE)).alias("o"), F.col("value").alias("payload")
    )
    return offer.where(F.col("o").isNotNull()).select(
        *keep,
        *[F.col(f"o.{c}") for c in
          ["customer_id", "product", "base_score", "intent_score", "final_score", "threshold", "trigger_event"]],
        *[F.col(f"o.txn_features.{c}").alias(c) for c in ["txn_10m", "txn_2h", "txn_24h"]],
        "o.source",
        "o.event_ts_ms",
        "payload",
    )
