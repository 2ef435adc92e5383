"""Table and message schemas (as DDL text), and the fixed values of the domain."""

from __future__ import annotations

from pyspark.sql import types as T

# Products, in report order.
PRODUCTS = ["home_loan", "credit_card", "fixed_deposit", "personal_loan"]

PRODUCT_LABELS = {
    "home_loan": "Home Loan",
    "credit_card": "Credit Card",
    "fixed_deposit": "Fixed Deposit",
    "personal_loan": "Personal Loan",
}

# Estimated revenue of one conversion.
REVENUE_PER_CONVERSION = {
    "home_loan": 250000.0,
    "credit_card": 8000.0,
    "fixed_deposit": 25000.0,
    "personal_loan": 60000.0,
}
BASELINE_RATE_PCT = 1.0
TARGETED_RATE_PCT = 2.0

# Real-time scoring.
PATTERN_BOOST = {
    "home_loan": 28.0,
    "credit_card": 26.0,
    "fixed_deposit": 24.0,
    "personal_loan": 25.0,
}
DEFAULT_BOOST = 20.0
DEFAULT_BASE_SCORE = 45.0
OFFER_THRESHOLD = 75.0
LARGE_CREDIT_AMOUNT = 5000
HOME_SESSION_LIMIT = 2000
RETAIL_BURST_COUNT = 3
HOME_CATEGORIES = ["home_improvement", "furniture", "kitchen_appliances"]
LIFESTYLE_CATEGORIES = ["travel", "electronics"]
PATTERN_NAMES = {
    "home_loan": "home_improvement_session_spend_gt_2000",
    "credit_card": "retail_3plus_24h_no_existing_card",
    "personal_loan": "travel_or_electronics_plus_salary_same_week",
    "fixed_deposit": "large_credit_and_72h_no_activity",
}

# Campaign lists.
CAMPAIGN_THRESHOLD = 60.0
CAMPAIGN_TOP_N = 5000
HOT_SCORE = 85.0

# Periods in milliseconds.
HOUR_MS = 3_600_000
DAY_MS = 24 * HOUR_MS
QUIET_MS = 72 * HOUR_MS
WEEK_MS = 7 * DAY_MS
WATERMARK_DELAY = "10 minutes"

REGIONS = ["North", "South", "East", "West"]

# The signal columns a scoring input must have.
REQUIRED_SIGNALS = [
    "total_spend_30d",
    "txn_count_30d",
    "avg_txn_30d",
    "unique_category_count_30d",
    "home_improvement_spend_30d",
    "electronics_spend_30d",
    "travel_spend_30d",
    "salary_credit_30d",
    "debit_txn_count_30d",
    "days_since_last_txn",
    "existing_products_flag",
    "campaign_response_flag",
]

FEED_COLUMNS = [
    "received_at",
    "customer_id",
    "customer_segment",
    "product",
    "composite_intent_score",
    "trigger_event",
]

MONEY = T.DecimalType(18, 4)
EVENT_MONEY = T.DecimalType(18, 2)


TRANSACTIONS = (
    "customer_id string, transaction_ts timestamp, merchant_category string, transaction_type string, "
    "amount double, merchant_name string, channel string"
)
DEMOGRAPHICS = (
    "customer_id string, age bigint, income_band string, region string, existing_products string"
)
PRODUCT_HOLDINGS = (
    "customer_id string, has_home_loan bigint, has_credit_card bigint, has_fixed_deposit bigint, "
    "has_personal_loan bigint"
)
CAMPAIGN_HISTORY = (
    "customer_id string, last_campaign_response string, last_campaign_date string, campaign_touch_count bigint"
)
WEIGHT_COLUMNS = [
    "total_spend_wt",
    "txn_count_wt",
    "avg_txn_wt",
    "diversity_wt",
    "income_wt",
    "activity_wt",
    "recency_wt",
    "affinity_wt",
    "age_wt",
]
WEIGHTS = ("product_family string, " + ", ".join(f"{c} double" for c in WEIGHT_COLUMNS))

HOLDINGS_JSON = ("home_loan int, credit_card int, fixed_deposit int, personal_loan int")

OFFER_MESSAGE = (
    "customer_id string, product string, base_score double, intent_score double, final_score double, "
    "threshold double, trigger_event string, "
    "txn_features struct<window_days:int,slide_days:int,pattern_metric:double,session_window_ms:bigint,"
    "txn_10m:int,txn_2h:int,txn_24h:int>, "
    "source string, event_ts_ms bigint, is_late boolean"
)
