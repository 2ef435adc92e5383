from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import scoring
from tidemark.operators import features as ft
from tidemark.operators.ranking import top_n_per_group
from tidemark.plans import propensity, quality, reports
from tidemark.sources import tables

INPUT = ("customer_id string, product_family string, total_spend_30d double, txn_count_30d bigint, avg_txn_30d double, "
         "unique_category_count_30d bigint, salary_credit_30d double, debit_txn_count_30d bigint, "
         "days_since_last_txn int, existing_products_flag int, age bigint, campaign_response_flag int, "
         "campaign_touch_count bigint")
PRODUCTS = ["home_loan", "credit_card", "fixed_deposit", "personal_loan"]


def scored(spark, **change):
    row = dict(total_spend_30d=500.0, txn_count_30d=10, avg_txn_30d=50.0, unique_category_count_30d=3,
               salary_credit_30d=2500.0, debit_txn_count_30d=9, days_since_last_txn=5, existing_products_flag=1,
               age=44, campaign_response_flag=1, campaign_touch_count=2) | change
    inputs = spark.createDataFrame([("c", p, *row.values()) for p in PRODUCTS], INPUT)
    weights = tables.load_weights(spark)
    terms = propensity.normalized_signals(inputs, weights)
    scores = propensity.propensity_scores(inputs, weights, date(2024, 1, 1))
    return {r.product_family: r for r in terms.collect()}, {r.product_family: r.propensity_score for r in scores.collect()}


def test_worked_vector(spark):
    terms, scores = scored(spark)
    assert [round(terms["home_loan"][n], 4) for n in scoring.TERM_NAMES] == [
        50, 50, 10, 60, 50, 45, 94.4444, 100, 50, 50, 20]
    assert {p: round(s, 6) for p, s in scores.items()} == {
        "home_loan": 98.166667, "credit_card": 80.194444, "fixed_deposit": 98.166667, "personal_loan": 90.666667}


def test_missing_age_counts_nothing_and_missing_touches_count_fully(spark):
    terms, _ = scored(spark, age=None, campaign_touch_count=None)
    assert terms["home_loan"].age_normalized == 0
    assert terms["home_loan"].touch_bonus == 50


def test_score_is_cut_at_100(spark):
    _, scores = scored(spark, total_spend_30d=9e9, txn_count_30d=99, avg_txn_30d=9e9, salary_credit_30d=9e9)
    assert max(scores.values()) == 100


@pytest.mark.parametrize("product,score,segment", [
    ("home_loan", 85.0, "HOME_LOAN_HOT"), ("home_loan", 84.99, "HOME_LOAN_WARM"), ("credit_card", 85.0, "CC_HOT"),
    ("credit_card", 60.0, "CC_WARM"), ("fixed_deposit", 99.0, "FD_TARGET"), ("personal_loan", 60.0, "PL_TARGET"),
])
def test_segments(spark, product, score, segment):
    row = spark.range(1).select(scoring.campaign_segment(F.lit(product), F.lit(score)).alias("s")).first()
    assert row.s == segment


def test_tiers_bands_and_composite(spark):
    frame = spark.createDataFrame([(90.0, 24), (89.99, 25), (74.9, None)], "score double, age int")
    rows = frame.select(scoring.offer_tier(F.col("score")).alias("t"), scoring.age_band(F.col("age")).alias("b")).collect()
    assert [(r.t, r.b) for r in rows] == [("HOT", "18-24"), ("WARM", "25-34"), ("WATCH", "Unknown")]
    top = spark.range(1).select(
        scoring.composite_score(F.lit(68.0), F.lit(28.0)).alias("a"),
        scoring.composite_score(F.lit(90.0), F.lit(28.0)).alias("b"),
        # a customer without scores can never pass the offer threshold
        scoring.composite_score(F.lit(45.0), scoring.pattern_boost(F.lit("home_loan"))).alias("c"),
        scoring.pattern_boost(F.lit("other")).alias("d"),
    ).first()
    assert tuple(top) == (96.0, 100.0, 73.0, 20.0)


def test_lists_keep_threshold_and_break_ties_by_customer(spark):
    scores = spark.createDataFrame(
        [("b", "home_loan", 100.0), ("a", "home_loan", 100.0), ("c", "home_loan", 100.0), ("d", "home_loan", 60.0),
         ("e", "credit_card", 59.99), ("f", "credit_card", 60.0)],
        "customer_id string, product_family string, propensity_score double",
    ).withColumn("score_ts", F.lit(datetime(2024, 1, 1)))
    lists = propensity.campaign_lists(scores, date(2024, 1, 1), top_n=2)
    assert {(r.customer_id, r.product_family) for r in lists.collect()} == {
        ("a", "home_loan"), ("b", "home_loan"), ("f", "credit_card")}


def test_top_n_with_a_dominant_group(spark):
    rows = spark.range(4000).selectExpr("if(id % 3 = 0, 'small', 'big') as g", "id as k", "(id * 37) % 1009 as v")
    order = [F.col("v").desc(), F.col("k")]
    got = {(r.g, r.k, r.rank_in_group)
           for r in top_n_per_group(rows, ["g"], order, 50, spread_by=["k"], salts=7).collect()}
    data = sorted(((r.g, r.k, r.v) for r in rows.collect()), key=lambda r: (r[0], -r[2], r[1]))
    want = set()
    for group in ("small", "big"):
        want |= {(g, k, i + 1) for i, (g, k, _) in enumerate([r for r in data if r[0] == group][:50])}
    assert got == want


def test_features_of_several_days_equal_each_day_alone(spark):
    t = tables.sample_tables(spark, "/root/testdata/sf0.001")
    days = [date(1998, 6, 8), date(1998, 6, 22), date(1998, 6, 30)]
    together = propensity.dated_inputs(t, days).select("as_of", *ft.INPUT_COLUMNS).collect()
    alone = [(d, *r) for d in days for r in propensity.propensity_inputs(t, d).collect()]
    key = lambda r: (str(r[0]), r[1], r[2])
    assert sorted(map(tuple, together), key=key) == sorted(alone, key=key)


def test_reasons_keep_listed_order_on_ties(spark):
    columns = ["home_improvement_spend_30d", "total_spend_30d", "txn_count_30d", "unique_category_count_30d",
               "salary_credit_30d", "campaign_response_flag", "travel_spend_30d", "electronics_spend_30d", "avg_txn_30d"]
    row = spark.createDataFrame([("home_loan", 5, 1)], "product_family string, days_since_last_txn int, existing_products_flag int")
    row = row.withColumns({c: F.lit(0.0) for c in columns})
    got = reports.with_reasons(row).first()
    assert got.top_3_signal_reasons == "Recent Activity | Home Improvement Spend | Overall Spend Momentum"


def test_candidate_filters(spark):
    scores = spark.createDataFrame(
        [("a", "home_loan", 80.0), ("b", "home_loan", 70.0), ("c", "home_loan", 80.0)],
        "customer_id string, product_family string, propensity_score double")
    inputs = spark.createDataFrame([("a", "home_loan", 30), ("b", "home_loan", 30), ("c", "home_loan", None)],
                                   "customer_id string, product_family string, age int")
    pick = lambda **f: [r.customer_id for r in reports.campaign_candidates(
        scores, inputs, "home_loan", f.pop("least", 0), **f).collect()]
    assert pick() == ["a", "c", "b"]
    assert pick(least=75) == ["a", "c"]
    assert pick(band="Unknown") == ["c"]
    assert pick(limit=1) == ["a"]


def test_weekly_change_covers_products_without_rows(spark):
    counts = spark.createDataFrame(
        [("home_loan", date(2024, 1, 8), 5), ("home_loan", date(2024, 1, 1), 7), ("credit_card", date(2024, 1, 1), 3)],
        "product_family string, week_start date, high_propensity_count bigint")
    got = {r.product_family: (r.latest_count, r.wow_change, r.est_revenue) for r in reports.weekly_change(counts).collect()}
    assert got == {"home_loan": (5, -2, 25000.0), "credit_card": (0, -3, 0.0), "fixed_deposit": (0, 0, 0.0),
                   "personal_loan": (0, 0, 0.0)}


def test_checks_fail_when_they_should(spark):
    one = spark.createDataFrame([("a",), ("a",)], "customer_id string")
    report = quality.check_inputs({"transactions": one.limit(0), "demographics": one})
    assert {(r.table_name, r.has_rows, r.repeated_keys) for r in report.collect()} == {
        ("transactions", False, 0), ("demographics", True, 1)}
    with pytest.raises(ValueError):
        quality.require(report, "has_rows")
    signals = quality.check_signals(one.selectExpr("customer_id", "1 as total_spend_30d"), 1).first()
    assert not signals.passed and "txn_count_30d" in signals.missing_columns
    assert not quality.check_feed(one).first().passed
