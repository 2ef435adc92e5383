"""Batch intent operators against the straight-line model, with and without slicing of hot customers."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests import naive
from tests.naive import DAY, HOUR, WEEK, event
from tidemark.operators import rolling, sequence, sessions, slices, spacing
from tidemark.plans import intents
from tidemark.schemas import DAY_MS

T0 = 1_700_000_000_000
SCHEMA = ("event_id bigint, customer_id string, event_ts_ms bigint, kind string, merchant_category string, "
          "amount decimal(18,2), has_credit_card int, transaction_type string")
CATEGORIES = ["home_improvement", "furniture", "electronics", "travel", "retail", "retail", "utilities", "salary"]


def frame(spark, events):
    from decimal import Decimal
    rows = [(e["event_id"], e["customer_id"], e["event_ts_ms"], e["kind"], e["merchant_category"],
             Decimal(str(e["amount"])), e["has_credit_card"], e["transaction_type"]) for e in events]
    return spark.createDataFrame(rows, SCHEMA)


def random_events(seed, customers, per_customer, tick, span, quiet_share=0.15):
    rng = random.Random(seed)
    events = []
    for c in range(customers):
        for _ in range(per_customer):
            ms = T0 + rng.randrange(span // tick) * tick
            if rng.random() < quiet_share:
                events.append(event(len(events), f"c{c}", ms, kind="product"))
            else:
                events.append(event(len(events), f"c{c}", ms, rng.choice(CATEGORIES),
                                    rng.randrange(0, 700_000) / 100, card=int(c % 2 and rng.random() < 0.1)))
    return events


def signal_rows(df):
    return sorted((r.customer_id, r.product, r.event_ts_ms, r.event_id, r.pattern_metric, r.session_window_ms)
                  for r in df.collect())


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0], r[1], r[2], r[3]))


# a coarse tick gives many events of the same millisecond
@pytest.mark.parametrize("seed,tick,span", [(1, HOUR, 40 * DAY), (2, 6 * HOUR, 25 * DAY), (3, DAY, 60 * DAY)])
@pytest.mark.parametrize("hot", [False, True])
def test_signals_and_kept_intents(spark, seed, tick, span, hot, monkeypatch):
    events = random_events(seed, 4, 60, tick, span)
    signals, kept, spend = naive.run(events)
    df = frame(spark, events)
    if hot:
        # every customer counts as hot and is cut into slices of a few rows
        monkeypatch.setattr(rolling.with_hot, "__defaults__", (20, None))
        monkeypatch.setattr(slices, "SLICE_ROWS", 7)
        monkeypatch.setattr(slices, "FAN", 4)
        monkeypatch.setattr(sessions.home_session_triggers, "__defaults__", (5, 4, None))
    largest = 10**9 if hot else None
    got = intents.intent_signals(df, largest=largest)
    assert signal_rows(got) == in_order(signals)
    got_kept = intents.kept_intents(df, largest=largest, fold_rows=3 if hot else 10**6)
    assert signal_rows(got_kept) == in_order(kept)
    per_category = intents.category_spend_of(got_kept, df).collect()
    found = {}
    for r in per_category:
        found.setdefault((r.customer_id, r.event_id), {})[r.merchant_category] = r.spend
    assert found == spend
    mapped = intents.with_category_spend(got_kept, df).collect()
    assert {(r.customer_id, r.event_id): r.category_spend_7d for r in mapped} == spend
    assert len(mapped) == len(kept)


def only(spark, events, product):
    return [r[2] - T0 for r in in_order(naive_and_spark(spark, events)) if r[1] == product]


def naive_and_spark(spark, events):
    signals, _, _ = naive.run(events)
    assert signal_rows(intents.intent_signals(frame(spark, events))) == in_order(signals)
    return signals


def test_session_spend_of_exactly_the_limit_is_silent(spark):
    events = [event(1, "c", T0, "furniture", 1500.0), event(2, "c", T0 + HOUR, "home_improvement", 500.0)]
    assert only(spark, events, "home_loan") == []
    assert only(spark, [*events, event(3, "c", T0 + 2 * HOUR, "furniture", 0.01)], "home_loan") == [2 * HOUR]


def test_cents_of_parsed_amounts_are_not_cut_off(spark):
    events = frame(spark, [event(1, "c", T0, "furniture", 1.15), event(2, "c", T0 + 1, "furniture", 1998.86)])
    parsed = events.withColumn("amount", F.col("amount").cast("double"))
    assert [r.spend for r in sessions.home_session_triggers(parsed).collect()] == [2000.01]


@pytest.mark.parametrize("late,fires", [(0, True), (1, False)])
def test_session_breaks_only_after_more_than_seven_days(spark, late, fires):
    events = [event(1, "c", T0, "furniture", 1500.0), event(2, "c", T0 + WEEK + late, "furniture", 1000.0)]
    assert bool(only(spark, events, "home_loan")) is fires


@pytest.mark.parametrize("late,fires", [(0, False), (1, True)])
def test_quiet_period_includes_its_last_millisecond(spark, late, fires):
    events = [event(1, "c", T0, "salary", 6000.0), event(2, "c", T0 + 3 * DAY + late, "utilities", 10.0)]
    assert bool(only(spark, events, "fixed_deposit")) is fires


def test_quiet_credit_lapses_after_seven_days(spark):
    events = [event(1, "c", T0, "salary", 5000.0), event(2, "c", T0 + WEEK, kind="product"),
              event(3, "c", T0 + WEEK + 1, kind="product")]
    assert only(spark, events, "fixed_deposit") == [WEEK]


@pytest.mark.parametrize("fold_rows", [1, 10**6])
def test_spacing_compares_with_the_last_kept(spark, fold_rows):
    hours = [0, 20, 30, 53, 54, 54, 77, 78]
    rows = spark.createDataFrame([("k", T0 + h * HOUR, i) for i, h in enumerate(hours)],
                                 "key string, event_ts_ms bigint, event_id bigint")
    kept = spacing.keep_spaced(rows, ["key"], DAY_MS, fold_rows)
    assert sorted(r.event_id for r in kept.collect()) == [0, 2, 4, 7]


@pytest.mark.parametrize("late,count", [(0, 2), (-1, 1)])
def test_spacing_of_exactly_a_day_is_kept(spark, late, count):
    rows = spark.createDataFrame([("k", T0, 1), ("k", T0 + DAY + late, 2)], "key string, event_ts_ms bigint, event_id bigint")
    assert spacing.keep_spaced(rows, ["key"], DAY_MS, largest=2).count() == count


@pytest.mark.parametrize("seed", range(4))
def test_large_sessions_equal_folded_sessions(spark, seed):
    """Slices with refunds, long pauses and amounts of very different size."""
    rng = random.Random(seed)
    ms, events = T0, []
    for i in range(1500):
        ms += rng.choice([0, 1000, HOUR, DAY, 8 * DAY if rng.random() < 0.05 else HOUR])
        amount = rng.choice([1.0, 25.5, 400.0, 2500.0, -300.0]) if seed % 2 else rng.choice([0.0, 0.5, 3.0, 900.0])
        events.append(event(i, "hot" if i % 10 else "other", ms, "furniture", amount))
    df = frame(spark, events)
    plain = sessions.home_session_triggers(df, largest=1500)
    cut = sessions.home_session_triggers(df, fold_rows=64, slice_rows=7)
    want = sorted((c, m, i, spend, length) for c, p, m, i, spend, length in naive.run(events)[0] if p == "home_loan")
    for got in (plain, cut):
        assert sorted((r.customer_id, r.event_ts_ms, r.event_id, r.spend, r.session_window_ms)
                      for r in got.collect()) == want


def test_slices_of_a_session_follow_the_rank_and_are_combined_in_rounds(spark, monkeypatch):
    """A millisecond that holds a 25th of the rows neither makes each other row a slice nor is one slice."""
    rng = random.Random(9)
    events = [event(i, "hot", T0 + (5 * DAY if i % 25 == 0 else i * 40 * 60_000), "furniture",
                    rng.choice([0.5, 30.0, 700.0, -90.0])) for i in range(1500)]
    events += [event(2000 + i, "other", T0 + i * HOUR, "furniture", 90.0) for i in range(200)]
    df = frame(spark, events)
    sliced = sessions._by_rank(sessions.home_transactions(df), 20)
    sizes = [r["count"] for r in sliced.groupBy("customer_id", "slice").count().collect()]
    assert sum(sizes) == 1700 and max(sizes) <= 20
    assert len(sizes) <= 1700 // 20 + 2 + int(spark.conf.get("spark.sql.shuffle.partitions"))
    monkeypatch.setattr(sessions, "FAN", 2)
    got = sessions.home_session_triggers(df, fold_rows=64, slice_rows=20).collect()
    want = sorted((c, m, i, spend, length) for c, p, m, i, spend, length in naive.run(events)[0] if p == "home_loan")
    assert len(want) > 20 and sorted((r.customer_id, r.event_ts_ms, r.event_id, r.spend, r.session_window_ms) for r in got) == want


def test_summaries_keep_only_what_can_be_looked_up():
    rows = pd.DataFrame({"event_ts_ms": range(1000), "event_id": range(1000), "cents": [10_000] * 1000, "debt": 0})
    (tops,) = sessions._summary(("c", 0), rows)["tops"]
    assert len(tops) == 21 and tops[-1] > sessions.LIMIT_CENTS
    rows["debt"] = 50_000
    (tops,) = sessions._summary(("c", 0), rows)["tops"]
    assert tops[-1] > sessions.LIMIT_CENTS + 50_000 and len(tops) <= 26


def test_slices_follow_the_rank_and_totals_do_not_change(spark, monkeypatch):
    """A fortieth of the rows in one millisecond, a stray old row, and a key all of one time."""
    monkeypatch.setattr(slices, "FAN", 4)
    t = f"if(id = 7, 0, {T0} + if(id % 40 = 0, 5000, id * 60000))"
    rows = spark.range(20_000).selectExpr("'burst' as k", f"{t} as t", "int(id % 2) as step", "id as event_id", "int(id % 3) as seq",
                                          "bigint(id % 7 - 2) as a", "1 as n", "concat('p', id) as payload")
    same = spark.range(6000).selectExpr("'same' as k", f"{T0} as t", "1 as step", "id as event_id", "0 as seq", "id as a", "1 as n",
                                        "cast(null as string) as payload")
    rows = rows.union(same).union(same.where("event_id < 50").withColumn("k", F.lit("small")))
    marked = slices.mark_hot(rows, ["k"], 1000)
    sliced = slices.by_rank(marked.where("hot"), ["k", *slices.ORDER], 500)
    sizes = [r["count"] for r in sliced.groupBy("k", "slice").count().collect()]
    assert sum(sizes) == 26_000 and max(sizes) <= 500 and len(sizes) <= 26_000 // 500 + 3 + int(spark.conf.get("spark.sql.shuffle.partitions"))
    want = sorted(map(tuple, slices.running_totals(rows, ["k"], ["a", "n"]).collect()), key=str)
    got = slices.running_totals(marked, ["k"], ["a", "n"], 500)
    assert got.columns == marked.columns
    assert sorted((tuple(r)[:-1] for r in got.collect()), key=str) == want

    asked = rows.selectExpr("k", "inline(array(named_struct('t', t, 'target', if(a < 3, struct(t as ms, event_id as id), null), "
                            "'probe', if(a < 3, null, struct(event_id)))))").where("target is not null or probe is not null")
    want = sorted(map(tuple, slices.first_at_or_after(asked, ["k"]).collect()), key=str)
    got = slices.first_at_or_after(slices.mark_hot(asked, ["k"], 1000), ["k"], 500)
    assert sorted((tuple(r) for r in got.drop("hot").collect()), key=str) == want and len(want) > 10_000


def test_a_key_just_above_the_bound_is_sliced_however_many_rows_there_are(spark):
    rows = spark.range(300_000).selectExpr("if(id < 1001, 'hot', concat('k', id % 1000)) as k", "id as t")
    assert [r.k for r in slices.hot_keys(rows, ["k"], 1000).collect()] == ["hot"]


@pytest.mark.parametrize("hot", [False, True])
def test_sequence_alerts(spark, hot):
    # the same-millisecond pair and the pair a week and a millisecond apart do not count
    rows = [("a", 1, T0, "close"), ("a", 2, T0, "redirect"), ("a", 3, T0 + WEEK, "redirect"),
            ("b", 4, T0, "close"), ("b", 5, T0 + WEEK + 1, "redirect"), ("b", 6, T0 + WEEK + 2, "close"),
            ("b", 7, T0 + WEEK + 3, "close"), ("b", 8, T0 + WEEK + 4, "redirect")]
    df = spark.createDataFrame(rows, "customer_id string, event_id bigint, event_ts_ms bigint, event_type string")
    marked = rolling.with_hot(df, hot_rows=2 if hot else 10**6)
    alerts = sequence.sequence_alerts(marked, F.col("event_type") == "close", F.col("event_type") == "redirect")
    assert sorted((r.first_event_id, r.second_event_id) for r in alerts.collect()) == [(1, 3), (6, 8), (7, 8)]


def test_offers_need_more_than_the_threshold(spark):
    kept = spark.createDataFrame(
        [("c", "home_loan", T0, 1, "p", 1.0, None), ("d", "home_loan", T0, 2, "p", 1.0, None)],
        "customer_id string, product string, event_ts_ms bigint, event_id bigint, pattern_name string, "
        "pattern_metric double, session_window_ms bigint")
    scores = spark.createDataFrame([("c", "home_loan", 47.0), ("d", "home_loan", 47.01)],
                                   "customer_id string, product_family string, propensity_score double")
    enriched = intents.enrich(kept, scores)
    assert sorted(r.composite_score for r in enriched.collect()) == [75.0, 75.01]
    offers = intents.realtime_offers(enriched)
    assert [r.customer_id for r in offers.collect()] == ["d"]
    assert '"session_window_ms":null' in intents.offer_messages(offers).first().value
