"""Trailing-window behaviour of each customer event.

Windows are expressed as differences: a transaction adds its marks when it happens and takes them
away one millisecond after it leaves the window.  A trailing count is then a plain running total,
which orders events of the same millisecond by event id and can be cut into slices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.slices import HOT_ROWS, first_at_or_after, mark_hot, marks, running_totals
from tidemark.schemas import DAY_MS, LARGE_CREDIT_AMOUNT, QUIET_MS, WEEK_MS

MEASURES = ["retail_24h", "card_7d", "salary_7d", "lifestyle_7d", "quiet_credit"]

IS_SALARY = "(transaction_type <=> 'salary' or merchant_category <=> 'salary')"
IS_LIFESTYLE = "merchant_category in ('travel', 'electronics')"
TARGET = "struct(event_ts_ms as ms, event_id as id)"


def with_hot(events: DataFrame, hot_rows: int = HOT_ROWS, largest: int | None = None) -> DataFrame:
    """Events with the rows of customers with more than `hot_rows` events marked as hot."""
    return mark_hot(events, ["customer_id"], hot_rows, largest)


def quiet_credits(events: DataFrame, quiet_ms: int = QUIET_MS) -> DataFrame:
    """Large salary credits with no other transaction in the `quiet_ms` that follow.

    Columns: customer_id, that of hot customers where `events` has it, event_id, credit_ms, next_ms, next_id; the next transaction is the first one strictly later than the credit.  A transaction
    exactly at the end of the quiet period is kept too: the credit counts as quiet until it arrives.
    """
    probe = "named_struct('credit_ms', event_ts_ms, 'event_id', event_id)"
    at = f"named_struct('t', event_ts_ms, 'target', {TARGET}, 'probe', if(false, {probe}, null))"
    ask = f"named_struct('t', event_ts_ms + 1, 'target', if(false, {TARGET}, null), 'probe', {probe})"
    is_large = f"{IS_SALARY} and amount >= {LARGE_CREDIT_AMOUNT}"
    rows = events.where("kind = 'txn'").selectExpr(
        "customer_id", *marks(events), f"inline(if({is_large}, array({at}, {ask}), array({at})))"
    )
    found = first_at_or_after(rows, ["customer_id"])
    return found.where(f"next_ms is null or next_ms >= credit_ms + {quiet_ms}")


def _mark(t: str, step: int, event_id: str, seq: int, is_event: bool = False, **marks: str) -> str:
    values = ", ".join(f"'{m}', int({marks.get(m, '0')})" for m in MEASURES)
    return (f"named_struct('t', bigint({t}), 'step', {step}, 'event_id', bigint({event_id}), 'seq', {seq}, "
            f"'is_event', {str(is_event).lower()}, {values})")


def rolling_features(events: DataFrame, quiet_ms: int = QUIET_MS) -> DataFrame:
    """One row per event: counts over the trailing day and week, and open quiet credits.

    Hot customers are those that `events` marks (see `with_hot`).
    """
    hot = marks(events)
    marked = events.selectExpr(
        "customer_id", *hot, "event_ts_ms", "event_id",
        "int(kind = 'txn' and merchant_category <=> 'retail') as r",
        "int(kind = 'txn' and coalesce(has_credit_card, 0) > 0) as c",
        f"int(kind = 'txn' and {IS_SALARY}) as s",
        f"int(kind = 'txn' and coalesce({IS_LIFESTYLE}, false)) as l",
    )
    at_event = _mark("event_ts_ms", 1, "event_id", 1, True, retail_24h="r", card_7d="c", salary_7d="s", lifestyle_7d="l")
    after_day = _mark(f"event_ts_ms + {DAY_MS + 1}", 0, "event_id", 0, retail_24h="-r")
    after_week = _mark(f"event_ts_ms + {WEEK_MS + 1}", 0, "event_id", 0, card_7d="-c", salary_7d="-s", lifestyle_7d="-l")
    rows = marked.selectExpr(
        "customer_id", *hot,
        # one array per case: dropping nulls from a common array would need an interpreted lambda
        f"""inline(case when r > 0 and c + s + l > 0 then array({at_event}, {after_day}, {after_week})
                        when r > 0 then array({at_event}, {after_day})
                        when c + s + l > 0 then array({at_event}, {after_week})
                        else array({at_event}) end)""",
    )
    opens = _mark(f"credit_ms + {quiet_ms}", 0, "event_id", 0, quiet_credit="1")
    lapses = _mark(f"credit_ms + {WEEK_MS + 1}", 0, "event_id", 0, quiet_credit="-1")
    broken = _mark("next_ms", 1, "next_id", 0, quiet_credit="-1")
    quiet = quiet_credits(events, quiet_ms).selectExpr(
        "customer_id", *hot,
        f"inline(array({opens}, if(next_ms <=> credit_ms + {quiet_ms}, {broken}, {lapses})))",
    )
    totals = running_totals(rows.unionByName(quiet), ["customer_id"], MEASURES)
    return totals.where("is_event").selectExpr("customer_id", *hot, "event_id", "t as event_ts_ms", *MEASURES)


def _day(ms: str) -> str:
    return f"({ms} - pmod({ms}, {DAY_MS})) div {DAY_MS}"


def category_spend(intents: DataFrame, events: DataFrame) -> DataFrame:
    """Spend and count per category over the week up to each intent, in rows of the intent's columns
    plus merchant_category, spend and n; only categories that the week holds.

    The intent's own event is included, as are earlier events of its millisecond.  The days wholly inside the week come
    from daily sums, those it begins and ends in from single transactions, both in one join by customer and day.
    Kept intents are a day apart, so a customer's day meets few of them; a day of very many transactions
    is combined beforehand or, at the ends, left for AQE to split.
    """
    txns = events.where("kind = 'txn'").selectExpr(
        "customer_id", f"{_day('event_ts_ms')} as _day", "coalesce(merchant_category, 'unknown') as merchant_category",
        "bigint(cast(amount as decimal(18,2)) * 100) as _cents", "event_ts_ms as _ms", "event_id as _id",
    )
    daily = txns.groupBy("customer_id", "_day", "merchant_category").agg(
        F.sum("_cents").alias("_cents"), F.count("*").alias("n")).withColumn("_end", F.lit(False))
    single = txns.withColumns({"n": F.lit(1).cast("long"), "_end": F.lit(True)})
    spent = daily.unionByName(single, allowMissingColumns=True)
    first, last = _day(f"event_ts_ms - {WEEK_MS}"), _day("event_ts_ms")
    days = intents.selectExpr("*", f"explode(sequence({first}, {last})) as _day").withColumn(
        "_end", F.expr(f"_day = {first} or _day = {last}"))
    inside = F.expr(f"not _end or (_ms >= event_ts_ms - {WEEK_MS} "
                    "and (_ms < event_ts_ms or _ms = event_ts_ms and _id <= event_id))")
    return (
        days.join(spent, ["customer_id", "_day", "_end"])
        .where(inside)
        .groupBy(*intents.columns, "merchant_category")
        .agg((F.coalesce(F.sum("_cents"), F.lit(0)) / 100).alias("spend"), F.sum("n").alias("n"))
    )
