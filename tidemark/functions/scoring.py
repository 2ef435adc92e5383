"""Column expressions for scores, segments and labels."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

from tidemark.schemas import (
    DEFAULT_BASE_SCORE,
    DEFAULT_BOOST,
    HOT_SCORE,
    PATTERN_BOOST,
    PRODUCT_LABELS,
    REGIONS,
)


def _clamp(value: str, top: str = "100D") -> str:
    return f"least({top}, greatest(0D, {value}))"


def _share(name: str, full: int, top: int = 100) -> str:
    """`name` as a share of `full`, scaled to `top` and cut there; a null counts as `top`."""
    return f"least({top}D, double({name}) / {full}D * {top}D)"


# Output term, its expression, and the weight that multiplies it, in the order of addition.
WEIGHTED_TERMS = [
    ("total_spend_normalized", _share("total_spend_30d", 1000), "total_spend_wt"),
    ("txn_count_normalized", _share("txn_count_30d", 20), "txn_count_wt"),
    ("avg_txn_normalized", _share("avg_txn_30d", 500), "avg_txn_wt"),
    ("diversity_normalized", _share("unique_category_count_30d", 5), "diversity_wt"),
    ("income_normalized", _share("salary_credit_30d", 5000), "income_wt"),
    ("activity_normalized", _share("debit_txn_count_30d", 20), "activity_wt"),
    ("recency_normalized", _clamp("(90D - double(days_since_last_txn)) / 0.9D"), "recency_wt"),
    ("affinity_normalized", "double(existing_products_flag) * 100D", "affinity_wt"),
    ("age_normalized", _clamp("(double(age) - 18D) / 52D * 100D"), "age_wt"),
]
BONUS_TERMS = [
    ("campaign_bonus", "double(campaign_response_flag) * 50D"),
    ("touch_bonus", _share("campaign_touch_count", 5, 50)),
]
TERM_NAMES = [t[0] for t in WEIGHTED_TERMS] + [t[0] for t in BONUS_TERMS]


def normalized_terms() -> list[str]:
    return [f"{expression} as {name}" for name, expression, *_ in [*WEIGHTED_TERMS, *BONUS_TERMS]]


def propensity_score() -> Column:
    """Score from the columns of `normalized_terms` and the weight columns."""
    parts = [f"{name} * {weight}" for name, _, weight in WEIGHTED_TERMS]
    return F.expr(_clamp(" + ".join([*parts, "(campaign_bonus + touch_bonus) / 10D"])))


def campaign_segment(product: Column, score: Column) -> Column:
    hot = score >= HOT_SCORE
    return (
        F.when((product == "home_loan") & hot, "HOME_LOAN_HOT")
        .when(product == "home_loan", "HOME_LOAN_WARM")
        .when((product == "credit_card") & hot, "CC_HOT")
        .when(product == "credit_card", "CC_WARM")
        .when(product == "fixed_deposit", "FD_TARGET")
        .when(product == "personal_loan", "PL_TARGET")
    )


def offer_tier(score: Column) -> Column:
    return F.when(score >= 90, "HOT").when(score >= 75, "WARM").otherwise("WATCH")


def age_band(age: Column) -> Column:
    return (
        F.when(age.isNull(), "Unknown")
        .when(age < 25, "18-24")
        .when(age < 35, "25-34")
        .when(age < 45, "35-44")
        .when(age < 55, "45-54")
        .when(age < 65, "55-64")
        .otherwise("65+")
    )


def hash_region(customer_id: Column) -> Column:
    """Stable bucket of a customer into the four regions, from the first digit of its md5."""
    digit = F.instr(F.lit("0123456789abcdef"), F.substring(F.md5(customer_id), 1, 1)) - 1
    return F.element_at(F.array(*[F.lit(r) for r in REGIONS]), digit % 4 + 1)


def _lookup(values: dict) -> Column:
    return F.create_map(*[F.lit(v) for v in chain.from_iterable(values.items())])


def product_label(product: Column) -> Column:
    return _lookup(PRODUCT_LABELS)[product]


def product_value(values: dict[str, float], product: Column) -> Column:
    return _lookup(values)[product]


def pattern_boost(product: Column) -> Column:
    return F.coalesce(_lookup(PATTERN_BOOST)[product], F.lit(DEFAULT_BOOST))


def base_or_default(score: Column) -> Column:
    return F.coalesce(score, F.lit(DEFAULT_BASE_SCORE))


def composite_score(base: Column, boost: Column) -> Column:
    return F.least(F.lit(100.0), F.round(base + boost, 2))


def _recent(limit: int) -> Column:
    return F.greatest(F.lit(0), limit - F.coalesce(F.col("days_since_last_txn"), F.lit(30)))


# Per product three (value, name, text) candidates in their tie order.
def _reason_candidates() -> dict[str, list[tuple[Column, str, str]]]:
    c = F.col
    return {
        "home_loan": [
            (c("home_improvement_spend_30d"), "Home Improvement Spend",
             "Recent home-improvement spend is high, indicating active renovation needs."),
            (c("total_spend_30d"), "Overall Spend Momentum",
             "Overall spending has increased, suggesting near-term financing appetite."),
            (_recent(10), "Recent Activity",
             "Customer has transacted recently, so outreach timing is favorable."),
        ],
        "credit_card": [
            (c("txn_count_30d"), "Frequent Transactions",
             "High transaction frequency suggests strong card-usage potential."),
            (c("unique_category_count_30d"), "Category Diversity",
             "Spending across many categories fits credit card benefits usage."),
            (F.when(c("existing_products_flag") == 0, 1).otherwise(0), "No Existing Card Flag",
             "Customer is not currently marked with this product, indicating upsell headroom."),
        ],
        "fixed_deposit": [
            (c("salary_credit_30d"), "Salary Credit Strength",
             "Strong salary inflows indicate ability to lock funds in deposits."),
            (c("campaign_response_flag"), "Campaign Responsiveness",
             "Past campaign responsiveness indicates higher acceptance probability."),
            (_recent(20), "Recent Banking Activity",
             "Recent activity suggests the customer is currently engaged."),
        ],
        "personal_loan": [
            (c("travel_spend_30d") + c("electronics_spend_30d"), "Lifestyle Spend Pattern",
             "Travel/electronics spend suggests potential need for short-term financing."),
            (c("salary_credit_30d"), "Income Signal",
             "Stable salary credits support repayment capacity."),
            (c("avg_txn_30d"), "Ticket Size",
             "Higher average transaction size indicates credit demand potential."),
        ],
    }


def signal_reasons() -> Column:
    """Array of struct(name, text), strongest first; equal values keep the listed order."""
    result = None
    for product, candidates in _reason_candidates().items():
        ranked = F.sort_array(F.array(*[
            F.struct((-F.coalesce(value.cast("double"), F.lit(0.0))).alias("rank"), F.lit(i).alias("position"),
                     F.lit(name).alias("name"), F.lit(text).alias("text"))
            for i, (value, name, text) in enumerate(candidates)
        ]))
        named = F.transform(ranked, lambda r: F.struct(r["name"].alias("name"), r["text"].alias("text")))
        # the last product also serves any other value, as the report does
        if result is None:
            result = F.when(F.col("product_family") == product, named)
        elif product == "personal_loan":
            result = result.otherwise(named)
        else:
            result = result.when(F.col("product_family") == product, named)
    return result


def reason_names(reasons: Column) -> Column:
    return F.array_join(F.transform(reasons, lambda r: r["name"]), " | ")


def reason_texts(reasons: Column) -> Column:
    return F.transform(reasons, lambda r: F.concat(r["name"], F.lit(": "), r["text"]))
