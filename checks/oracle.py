"""Check SQL for every registered query, written for DuckDB over the sample tables."""

from __future__ import annotations

DAY = 86_400_000
WEEK = 7 * DAY
QUIET = 3 * DAY

# Half-up rounding of the shortest decimal form of a double.
def _r(x: str, n: int = 2) -> str:
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), {n}) AS DOUBLE)"


def _cents(x: str) -> str:
    return f"CAST(CAST({_r(x)} AS DECIMAL(18,2)) AS VARCHAR)"


_CTES: dict[str, str] = {}


def _cte(name: str, sql: str) -> None:
    _CTES[name] = sql


def _with(*names: str, tail: str) -> str:
    parts = ",\n".join(f"{n} AS ({_CTES[n.split('(')[0]]})" for n in names)
    return f"WITH RECURSIVE {parts}\n{tail}"


_cte("txn", """
  SELECT printf('cust_%06d', o_custkey) AS customer_id, l_shipdate AS transaction_ts,
         ['home_improvement','electronics','travel','retail','insurance','utilities','salary'][1 + l_partkey % 7]
           AS merchant_category,
         CASE WHEN l_partkey % 7 = 6 THEN 'salary' ELSE 'debit' END AS transaction_type,
         CAST((CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END) * (CAST(l_extendedprice AS DECIMAL(18,2)) * 0.02)
           AS DECIMAL(18,4)) AS amount,
         'merchant_' || l_suppkey AS merchant_name,
         ['branch','online','mobile'][1 + l_linenumber % 3] AS channel
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
_cte("holdings", """
  SELECT printf('cust_%06d', c_custkey) AS customer_id,
         CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END AS has_home_loan,
         CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS has_credit_card,
         CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END AS has_fixed_deposit,
         CASE WHEN c_custkey % 7 = 0 THEN 1 ELSE 0 END AS has_personal_loan
  FROM customer""")
_cte("demo", """
  SELECT printf('cust_%06d', c_custkey) AS customer_id,
         CASE WHEN c_custkey % 17 <> 0 THEN 18 + c_custkey % 60 END AS age,
         CASE WHEN c_acctbal < 1000 THEN '25-40k' WHEN c_acctbal < 3000 THEN '40-60k'
              WHEN c_acctbal < 6000 THEN '60-90k' WHEN c_acctbal < 8500 THEN '90-120k' ELSE '120k+' END AS income_band,
         r_name AS region
  FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""")
_cte("camp", """
  SELECT printf('cust_%06d', c_custkey) AS customer_id,
         CASE WHEN c_custkey % 6 = 0 THEN 'yes' ELSE 'no' END AS last_campaign_response,
         c_custkey % 8 AS campaign_touch_count
  FROM customer WHERE c_custkey % 19 <> 0""")
_cte("days", "SELECT DATE '1998-06-30' AS as_of")
_cte("history_days", """
  SELECT unnest([DATE '1998-06-08', DATE '1998-06-15', DATE '1998-06-22', DATE '1998-06-29']) AS as_of""")


def _features_over(days: str) -> str:
    return f"""
  SELECT as_of, customer_id,
         CAST(sum(abs(amount)) AS DOUBLE) AS total_spend_30d,
         count(*) AS txn_count_30d,
         CAST(sum(abs(amount)) AS DOUBLE) / count(amount) AS avg_txn_30d,
         count(DISTINCT merchant_category) AS unique_category_count_30d,
         CAST(sum(CASE WHEN merchant_category = 'home_improvement' THEN abs(amount) ELSE 0 END) AS DOUBLE)
           AS home_improvement_spend_30d,
         CAST(sum(CASE WHEN merchant_category = 'electronics' THEN abs(amount) ELSE 0 END) AS DOUBLE)
           AS electronics_spend_30d,
         CAST(sum(CASE WHEN merchant_category = 'travel' THEN abs(amount) ELSE 0 END) AS DOUBLE) AS travel_spend_30d,
         CAST(sum(CASE WHEN transaction_type = 'salary' THEN abs(amount) ELSE 0 END) AS DOUBLE) AS salary_credit_30d,
         count(CASE WHEN transaction_type = 'debit' THEN 1 END) AS debit_txn_count_30d,
         max(CAST(transaction_ts AS DATE)) AS last_txn_date
  FROM txn JOIN {days} ON CAST(transaction_ts AS DATE) BETWEEN as_of - 30 AND as_of
  GROUP BY as_of, customer_id"""


_cte("feat", _features_over("days"))
_cte("products", "SELECT unnest(['home_loan','credit_card','fixed_deposit','personal_loan']) AS product_family")
_cte("holdings_long", """
  SELECT customer_id, 'home_loan' AS product_family, has_home_loan AS has_product FROM holdings
  UNION ALL SELECT customer_id, 'credit_card', has_credit_card FROM holdings
  UNION ALL SELECT customer_id, 'fixed_deposit', has_fixed_deposit FROM holdings
  UNION ALL SELECT customer_id, 'personal_loan', has_personal_loan FROM holdings""")


_cte("inputs", """
  SELECT f.as_of, f.customer_id, p.product_family, total_spend_30d, txn_count_30d, avg_txn_30d,
         unique_category_count_30d, home_improvement_spend_30d, electronics_spend_30d, travel_spend_30d,
         salary_credit_30d, debit_txn_count_30d, date_diff('day', last_txn_date, f.as_of) AS days_since_last_txn,
         CASE WHEN has_product = 1 THEN 1 ELSE 0 END AS existing_products_flag, age, income_band,
         CASE WHEN last_campaign_response = 'yes' THEN 1 ELSE 0 END AS campaign_response_flag, campaign_touch_count
  FROM feat f
  LEFT JOIN demo d ON d.customer_id = f.customer_id
  LEFT JOIN camp c ON c.customer_id = f.customer_id
  CROSS JOIN products p
  LEFT JOIN holdings_long h ON h.customer_id = f.customer_id AND h.product_family = p.product_family""")
_cte("weights", """
  SELECT * FROM (VALUES
    ('home_loan', 0.25::DOUBLE, 0.20::DOUBLE, 0.10::DOUBLE, 0.15::DOUBLE, 0.15::DOUBLE, 0.10::DOUBLE, 0.15::DOUBLE,
     0.30::DOUBLE, 0.05::DOUBLE),
    ('credit_card', 0.15, 0.20, 0.10, 0.10, 0.10, 0.15, 0.10, 0.25, 0.05),
    ('fixed_deposit', 0.20, 0.20, 0.10, 0.15, 0.20, 0.10, 0.15, 0.30, 0.05),
    ('personal_loan', 0.20, 0.20, 0.10, 0.15, 0.15, 0.10, 0.15, 0.25, 0.05))
  AS w(product_family, total_spend_wt, txn_count_wt, avg_txn_wt, diversity_wt, income_wt, activity_wt, recency_wt,
       affinity_wt, age_wt)""")
_cte("norm", """
  SELECT i.as_of, i.customer_id, i.product_family,
         least(100::DOUBLE, total_spend_30d / 1000::DOUBLE * 100) AS total_spend_normalized,
         least(100::DOUBLE, txn_count_30d::DOUBLE / 20::DOUBLE * 100) AS txn_count_normalized,
         least(100::DOUBLE, avg_txn_30d / 500::DOUBLE * 100) AS avg_txn_normalized,
         least(100::DOUBLE, unique_category_count_30d::DOUBLE / 5::DOUBLE * 100) AS diversity_normalized,
         least(100::DOUBLE, salary_credit_30d / 5000::DOUBLE * 100) AS income_normalized,
         least(100::DOUBLE, debit_txn_count_30d::DOUBLE / 20::DOUBLE * 100) AS activity_normalized,
         least(100::DOUBLE, greatest(0::DOUBLE, (90 - days_since_last_txn)::DOUBLE / 0.9::DOUBLE)) AS recency_normalized,
         existing_products_flag * 100::DOUBLE AS affinity_normalized,
         least(100::DOUBLE, greatest(0::DOUBLE, (age - 18)::DOUBLE / 52::DOUBLE * 100)) AS age_normalized,
         campaign_response_flag * 50::DOUBLE AS campaign_bonus,
         least(50::DOUBLE, campaign_touch_count::DOUBLE / 5::DOUBLE * 50) AS touch_bonus,
         w.* EXCLUDE (product_family)
  FROM inputs i JOIN weights w ON w.product_family = i.product_family""")
_cte("scores", """
  SELECT as_of, customer_id, product_family,
         least(100::DOUBLE, greatest(0::DOUBLE,
           total_spend_normalized * total_spend_wt + txn_count_normalized * txn_count_wt
           + avg_txn_normalized * avg_txn_wt + diversity_normalized * diversity_wt + income_normalized * income_wt
           + activity_normalized * activity_wt + recency_normalized * recency_wt
           + affinity_normalized * affinity_wt + age_normalized * age_wt
           + (campaign_bonus + touch_bonus) / 10::DOUBLE)) AS propensity_score
  FROM norm""")
_cte("ranked", """
  SELECT *, row_number() OVER (PARTITION BY product_family ORDER BY propensity_score DESC, customer_id) AS rank_no,
         CASE WHEN product_family = 'home_loan' AND propensity_score >= 85 THEN 'HOME_LOAN_HOT'
              WHEN product_family = 'home_loan' THEN 'HOME_LOAN_WARM'
              WHEN product_family = 'credit_card' AND propensity_score >= 85 THEN 'CC_HOT'
              WHEN product_family = 'credit_card' THEN 'CC_WARM'
              WHEN product_family = 'fixed_deposit' THEN 'FD_TARGET'
              WHEN product_family = 'personal_loan' THEN 'PL_TARGET' END AS campaign_segment
  FROM scores WHERE propensity_score >= 60""")

_FEATURES = ("txn", "days", "feat")
_INPUTS = (*_FEATURES, "holdings", "demo", "camp", "products", "holdings_long", "inputs")
_SCORES = (*_INPUTS, "weights", "norm", "scores")
_LISTS = (*_SCORES, "ranked")

_cte("ev", """
  SELECT event_id, printf('cust_%06d', user_id) AS customer_id, user_id, epoch_us(ts) // 1000 AS event_ts_ms, ts,
         CASE WHEN event_type IN ('view','click') THEN 'product' ELSE 'txn' END AS kind,
         CASE WHEN event_type NOT IN ('view','click') THEN
           ['home_improvement','furniture','kitchen_appliances','electronics','travel','retail','insurance',
            'utilities','salary'][1 + k % 9] END AS merchant_category,
         CASE WHEN event_type NOT IN ('view','click') THEN
           CASE WHEN k % 9 = 8 THEN 'salary' ELSE 'debit' END END AS transaction_type,
         CASE WHEN event_type NOT IN ('view','click') THEN CAST(CAST(value AS DECIMAL(18,2)) * 40 AS DECIMAL(18,2)) END
           AS amount,
         CASE WHEN user_id % 3 = 0 THEN 1 ELSE 0 END AS has_credit_card,
         CASE WHEN user_id % 5 = 0 THEN 1 ELSE 0 END AS has_fixed_deposit,
         CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'quote_request' END AS event_type,
         CASE WHEN event_type IN ('view','click') THEN
           ['home_loan','credit_card','fixed_deposit','personal_loan'][1 + k % 4] END AS product
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""")
_cte("txe", "SELECT * FROM ev WHERE kind = 'txn'")
_cte("credits", f"""
  SELECT e.customer_id, e.event_id, e.event_ts_ms AS credit_ms,
         (SELECT min(t.event_ts_ms) FROM txe t WHERE t.customer_id = e.customer_id AND t.event_ts_ms > e.event_ts_ms)
           AS next_ms
  FROM txe e WHERE e.transaction_type = 'salary' AND e.amount >= 5000""")
_cte("quiet", f"SELECT * FROM credits WHERE next_ms IS NULL OR next_ms > credit_ms + {QUIET}")
_cte("roll", f"""
  SELECT customer_id, event_id, event_ts_ms,
         count(*) FILTER (merchant_category = 'retail') OVER day AS retail_24h,
         count(*) FILTER (kind = 'txn' AND has_credit_card > 0) OVER week AS card_7d,
         count(*) FILTER (transaction_type = 'salary') OVER week AS salary_7d,
         count(*) FILTER (merchant_category IN ('travel','electronics')) OVER week AS lifestyle_7d,
         (SELECT count(*) FROM quiet q WHERE q.customer_id = ev.customer_id
            AND ev.event_ts_ms BETWEEN q.credit_ms + {QUIET} AND q.credit_ms + {WEEK}) AS quiet_credit
  FROM ev
  WINDOW day AS (PARTITION BY customer_id ORDER BY event_ts_ms RANGE BETWEEN {DAY} PRECEDING AND CURRENT ROW),
         week AS (PARTITION BY customer_id ORDER BY event_ts_ms RANGE BETWEEN {WEEK} PRECEDING AND CURRENT ROW)""")
_cte("home", """
  SELECT customer_id, event_id, event_ts_ms, amount,
         row_number() OVER (PARTITION BY customer_id ORDER BY event_ts_ms, event_id) AS rn
  FROM txe WHERE merchant_category IN ('home_improvement','furniture','kitchen_appliances')""")
_cte("session", f"""
  SELECT customer_id, event_id, event_ts_ms, rn, amount AS spend, event_ts_ms AS started FROM home WHERE rn = 1
  UNION ALL
  SELECT h.customer_id, h.event_id, h.event_ts_ms, h.rn,
         CAST(CASE WHEN s.spend > 2000 OR h.event_ts_ms - s.event_ts_ms > {WEEK} THEN h.amount
              ELSE s.spend + h.amount END AS DECIMAL(18,2)),
         CASE WHEN s.spend > 2000 OR h.event_ts_ms - s.event_ts_ms > {WEEK} THEN h.event_ts_ms ELSE s.started END
  FROM session s JOIN home h ON h.customer_id = s.customer_id AND h.rn = s.rn + 1""")
_cte("fired", """
  SELECT customer_id, event_id, event_ts_ms, CAST(spend AS DOUBLE) AS spend,
         event_ts_ms - started AS session_window_ms
  FROM session WHERE spend > 2000""")
_cte("signals", """
  SELECT customer_id, 'home_loan' AS product, event_ts_ms, event_id,
         'home_improvement_session_spend_gt_2000' AS pattern_name, spend AS pattern_metric, session_window_ms
  FROM fired
  UNION ALL SELECT customer_id, 'credit_card', event_ts_ms, event_id, 'retail_3plus_24h_no_existing_card',
         CAST(retail_24h AS DOUBLE), NULL FROM roll WHERE retail_24h >= 3 AND card_7d = 0
  UNION ALL SELECT customer_id, 'personal_loan', event_ts_ms, event_id,
         'travel_or_electronics_plus_salary_same_week', CAST(lifestyle_7d AS DOUBLE), NULL
  FROM roll WHERE lifestyle_7d > 0 AND salary_7d > 0
  UNION ALL SELECT customer_id, 'fixed_deposit', event_ts_ms, event_id, 'large_credit_and_72h_no_activity', 1.0, NULL
  FROM roll WHERE quiet_credit > 0""")
_cte("numbered", """
  SELECT *, row_number() OVER (PARTITION BY customer_id, product ORDER BY event_ts_ms, event_id) AS rn FROM signals""")
_cte("walk", f"""
  SELECT *, event_ts_ms AS last_ms, TRUE AS kept FROM numbered WHERE rn = 1
  UNION ALL
  SELECT n.*, CASE WHEN n.event_ts_ms - w.last_ms >= {DAY} THEN n.event_ts_ms ELSE w.last_ms END,
         n.event_ts_ms - w.last_ms >= {DAY}
  FROM walk w JOIN numbered n ON n.customer_id = w.customer_id AND n.product = w.product AND n.rn = w.rn + 1""")
_cte("kept", "SELECT * EXCLUDE (rn, last_ms, kept) FROM walk WHERE kept")
_cte("spend7", f"""
  SELECT i.customer_id, i.event_id, t.merchant_category, CAST(sum(t.amount) AS DOUBLE) AS spend
  FROM (SELECT DISTINCT customer_id, event_id, event_ts_ms FROM kept) i
  JOIN txe t ON t.customer_id = i.customer_id AND t.event_ts_ms BETWEEN i.event_ts_ms - {WEEK} AND i.event_ts_ms
  GROUP BY ALL""")
_cte("boosts", """
  SELECT * FROM (VALUES ('home_loan', 28.0::DOUBLE), ('credit_card', 26.0), ('fixed_deposit', 24.0),
                        ('personal_loan', 25.0)) AS b(product, boost)""")
_cte("enriched", f"""
  SELECT k.*, boost AS pattern_boost, {_r("coalesce(propensity_score, 45::DOUBLE)")} AS base_score,
         least(100::DOUBLE, {_r("coalesce(propensity_score, 45::DOUBLE) + boost")}) AS composite_score,
         75.0::DOUBLE AS threshold
  FROM kept k JOIN boosts USING (product)
  LEFT JOIN scores s ON s.customer_id = k.customer_id AND s.product_family = k.product""")
_cte("offers", """
  SELECT customer_id, product, base_score, pattern_boost AS intent_score, composite_score AS final_score, threshold,
         pattern_name AS trigger_event, 7 AS window_days, 1 AS slide_days, pattern_metric, session_window_ms,
         'intent_detector' AS source, event_ts_ms, FALSE AS is_late
  FROM enriched WHERE composite_score > threshold""")

_ROLL = ("ev", "txe", "credits", "quiet", "roll")
_SIGNALS = (*_ROLL, "home", "session", "fired", "signals")
_KEPT = (*_SIGNALS, "numbered", "walk", "kept")
_OFFERS = (*_KEPT, *_SCORES, "boosts", "enriched", "offers")

_TODAY = "DATE '2024-01-30'"
_cte("panes", f"""
  SELECT customer_id, merchant_category, event_ts_ms // {DAY} AS day, sum(amount) AS spend, count(*) AS n
  FROM txe GROUP BY ALL""")
_cte("feed", f"""
  SELECT (day + k) * {DAY} - 1 AS window_end_ms, customer_id, merchant_category,
         CAST(sum(spend) AS DOUBLE) AS total_spend, CAST(sum(n) AS INTEGER) AS event_count
  FROM panes CROSS JOIN (SELECT unnest(range(1, 8)) AS k) GROUP BY ALL""")
_cte("weekly", """
  SELECT product_family, CAST(date_trunc('week', as_of) AS DATE) AS week_start,
         count(*) FILTER (propensity_score >= 75) AS high_propensity_count
  FROM scores GROUP BY ALL""")
_cte("weekly_offers", f"""
  SELECT CAST(date_trunc('week', make_timestamp(event_ts_ms * 1000)) AS DATE) AS week_start, product,
         count(*) AS offers_sent, CAST(sum(CAST(final_score AS DECIMAL(8,2))) AS DOUBLE) / count(*) AS avg_final_score
  FROM offers WHERE make_timestamp(event_ts_ms * 1000) >= {_TODAY} - INTERVAL 84 DAY GROUP BY ALL""")
_cte("grid", """
  SELECT g.week_start, g.product, coalesce(offers_sent, 0) AS offers_sent, coalesce(avg_final_score, 0) AS avg_final_score,
         1.0::DOUBLE AS baseline_rate_pct, 2.0::DOUBLE AS propensity_targeted_rate_pct,
         coalesce(offers_sent, 0) * 0.01::DOUBLE AS baseline_est_conversions,
         coalesce(offers_sent, 0) * 0.02::DOUBLE AS targeted_est_conversions
  FROM (SELECT CAST(DATE '2024-01-29' - 7 * CAST(k AS INTEGER) AS DATE) AS week_start, product_family AS product
        FROM (SELECT unnest(range(0, 12)) AS k) CROSS JOIN products) g
  LEFT JOIN weekly_offers w ON w.week_start = g.week_start AND w.product = g.product""")
_cte("labels_of", """
  SELECT * FROM (VALUES ('home_loan', 'Home Loan', 250000.0::DOUBLE), ('credit_card', 'Credit Card', 8000.0),
                        ('fixed_deposit', 'Fixed Deposit', 25000.0), ('personal_loan', 'Personal Loan', 60000.0))
  AS l(product, product_label, revenue)""")
_cte("feed_rows", """
  SELECT o.event_ts_ms AS received_at, o.customer_id,
         coalesce(r.campaign_segment, CASE WHEN final_score >= 90 THEN 'HOT' WHEN final_score >= 75 THEN 'WARM'
                                           ELSE 'WATCH' END) AS customer_segment,
         o.product, final_score AS composite_intent_score, trigger_event
  FROM offers o
  LEFT JOIN (SELECT * FROM ranked WHERE rank_no <= 5000) r
    ON r.customer_id = o.customer_id AND r.product_family = o.product
  ORDER BY received_at DESC, o.customer_id, o.product LIMIT 500""")
_GRID = (*_OFFERS, "weekly_offers", "grid", "labels_of")
_FEED = (*_OFFERS, "ranked", "feed_rows")

_REASONS = {
    "home_loan": ["home_improvement_spend_30d", "total_spend_30d", "greatest(0, 10 - days_since_last_txn)"],
    "credit_card": ["txn_count_30d", "unique_category_count_30d",
                    "CASE WHEN existing_products_flag = 0 THEN 1 ELSE 0 END"],
    "fixed_deposit": ["salary_credit_30d", "campaign_response_flag", "greatest(0, 20 - days_since_last_txn)"],
    "personal_loan": ["travel_spend_30d + electronics_spend_30d", "salary_credit_30d", "avg_txn_30d"],
}
_REASON_TEXT = {
    "home_loan": [
        ("Home Improvement Spend", "Recent home-improvement spend is high, indicating active renovation needs."),
        ("Overall Spend Momentum", "Overall spending has increased, suggesting near-term financing appetite."),
        ("Recent Activity", "Customer has transacted recently, so outreach timing is favorable.")],
    "credit_card": [
        ("Frequent Transactions", "High transaction frequency suggests strong card-usage potential."),
        ("Category Diversity", "Spending across many categories fits credit card benefits usage."),
        ("No Existing Card Flag", "Customer is not currently marked with this product, indicating upsell headroom.")],
    "fixed_deposit": [
        ("Salary Credit Strength", "Strong salary inflows indicate ability to lock funds in deposits."),
        ("Campaign Responsiveness", "Past campaign responsiveness indicates higher acceptance probability."),
        ("Recent Banking Activity", "Recent activity suggests the customer is currently engaged.")],
    "personal_loan": [
        ("Lifestyle Spend Pattern", "Travel/electronics spend suggests potential need for short-term financing."),
        ("Income Signal", "Stable salary credits support repayment capacity."),
        ("Ticket Size", "Higher average transaction size indicates credit demand potential.")],
}
_cte("reason_rows", " UNION ALL ".join(
    f"SELECT customer_id, product_family, CAST({value} AS DOUBLE) AS v, {i} AS pos, '{name}' AS name, "
    f"'{text}' AS txt FROM inputs WHERE product_family = '{product}'"
    for product in _REASONS
    for i, (value, (name, text)) in enumerate(zip(_REASONS[product], _REASON_TEXT[product]))))


# Messages as the damaged-message fixture leaves them.
_cte("msg", """
  SELECT event_id, kind, CASE WHEN event_id % 40 = 6 THEN '' ELSE customer_id END AS customer_id,
         event_ts_ms - CASE WHEN event_id % 40 = 4 THEN 19800000 ELSE 0 END AS event_ts_ms,
         CASE event_id % 40 WHEN 1 THEN 'unknown' WHEN 7 THEN NULL ELSE merchant_category END AS merchant_category,
         CASE event_id % 40 WHEN 8 THEN 'debit' ELSE transaction_type END AS transaction_type,
         CASE event_id % 40 WHEN 11 THEN 1::DOUBLE ELSE CAST(amount AS DOUBLE) END AS amount,
         CASE event_id % 40 WHEN 9 THEN 1 WHEN 14 THEN 0 ELSE has_credit_card END AS has_credit_card, has_fixed_deposit,
         CASE event_id % 40 WHEN 8 THEN 'page_view' ELSE event_type END AS event_type, product
  FROM ev WHERE event_id % 40 NOT IN (0, 5) AND NOT (kind = 'txn' AND event_id % 40 IN (2, 10, 12, 13))""")

_DAY_MS_1998 = "epoch_ms(TIMESTAMP '1998-06-30')"

ORACLE: dict[str, str] = {
    "scan_transactions": _with("txn", tail="""
        SELECT customer_id, epoch_ms(transaction_ts) AS transaction_ts, merchant_category, transaction_type,
               CAST(amount AS DOUBLE) AS amount, merchant_name, channel FROM txn"""),
    "seed_weights": _with("holdings", "holdings_long", "weights", tail="""
        SELECT w.*, holders FROM weights w
        JOIN (SELECT product_family, CAST(sum(has_product) AS BIGINT) AS holders FROM holdings_long GROUP BY 1) h
          ON h.product_family = w.product_family"""),
    "parse_iso": """
        SELECT event_id, CASE event_id % 8 WHEN 2 THEN epoch_us(ts) // 1000 - 19800000
                 WHEN 3 THEN epoch_ms(date_trunc('second', ts)) WHEN 4 THEN epoch_ms(date_trunc('day', ts))
                 ELSE epoch_us(ts) // 1000 END AS event_ts_ms
        FROM events WHERE event_id % 8 NOT IN (5, 6, 7)""",
    "parse_txn": _with("ev", "msg", tail="""
        SELECT event_id, customer_id, event_ts_ms, merchant_category, transaction_type, amount, has_credit_card,
               has_fixed_deposit FROM msg WHERE kind = 'txn' AND customer_id <> ''"""),
    "rejected_messages": _with("ev", tail="""
        SELECT count(*) FILTER (event_id % 40 IN (2, 12, 13)) AS bad_amounts, count(*) FILTER (event_id % 40 = 10) AS bad_flags,
               count(*) FILTER (event_id % 40 NOT IN (0, 2, 5, 10, 12, 13)) AS accepted
        FROM ev WHERE kind = 'txn'"""),
    "parse_product_event": _with("ev", "msg", tail="""
        SELECT event_id, customer_id, event_ts_ms, event_type, product
        FROM msg WHERE kind = 'product' AND customer_id <> ''"""),
    "parse_score": _with(*_SCORES, tail="""
        SELECT customer_id, product_family, propensity_score, '1998-06-30T00:00:00' AS score_ts FROM scores"""),
    "known_category_filter": _with("ev", "msg", tail="""
        SELECT event_id, customer_id, merchant_category, amount FROM msg
        WHERE kind = 'txn' AND merchant_category IS NOT NULL AND merchant_category <> 'unknown'"""),
    "event_union": _with("ev", tail="""
        SELECT event_id, customer_id, kind, event_ts_ms, merchant_category, event_type, product FROM ev"""),
    "txn_30d_filter": _with("txn", "days", tail="""
        SELECT customer_id, CAST(transaction_ts AS DATE) AS txn_dt, merchant_category, CAST(amount AS DOUBLE) AS amount
        FROM txn, days WHERE CAST(transaction_ts AS DATE) BETWEEN as_of - 30 AND as_of"""),
    "txn_features": _with(*_FEATURES, tail="SELECT * EXCLUDE (as_of) FROM feat"),
    "days_since_last_txn": _with(*_FEATURES, tail="""
        SELECT customer_id, last_txn_date, date_diff('day', last_txn_date, as_of) AS days_since_last_txn FROM feat"""),
    "customer_base": _with(*_FEATURES, "demo", "camp", tail="""
        SELECT f.customer_id, total_spend_30d, txn_count_30d, age, income_band, last_campaign_response,
               campaign_touch_count
        FROM feat f LEFT JOIN demo d ON d.customer_id = f.customer_id
        LEFT JOIN camp c ON c.customer_id = f.customer_id"""),
    "customer_x_product": _with(*_FEATURES, "products", tail="""
        SELECT customer_id, product_family, txn_count_30d FROM feat CROSS JOIN products"""),
    "holdings_from_json": _with("holdings", tail="SELECT * FROM holdings"),
    "holdings_long": _with("holdings", "holdings_long", tail="SELECT * FROM holdings_long"),
    "holding_campaign_flags": _with(*_INPUTS, tail="""
        SELECT customer_id, product_family, existing_products_flag, campaign_response_flag FROM inputs"""),
    "propensity_inputs": _with(*_INPUTS, tail="SELECT * EXCLUDE (as_of) FROM inputs"),
    "normalized_signals": _with(*_INPUTS, "weights", "norm", tail="""
        SELECT customer_id, product_family, total_spend_normalized, txn_count_normalized, avg_txn_normalized,
               diversity_normalized, income_normalized, activity_normalized, recency_normalized, affinity_normalized,
               age_normalized, campaign_bonus, touch_bonus FROM norm"""),
    "propensity_scores": _with(*_SCORES, tail="""
        SELECT customer_id, product_family, propensity_score, epoch_ms(CAST(as_of AS TIMESTAMP)) AS score_ts
        FROM scores"""),
    "campaign_lists": _with(*_LISTS, tail=f"""
        SELECT customer_id, product_family, propensity_score, {_DAY_MS_1998} AS score_ts, campaign_segment,
               {_DAY_MS_1998} AS generated_at
        FROM ranked WHERE rank_no <= 5000"""),
    "campaign_segments": _with(*_LISTS, tail=f"""
        SELECT product_family, campaign_segment, count(*) AS customers, {_r("min(propensity_score)", 4)} AS lowest_score
        FROM ranked WHERE rank_no <= 5000 GROUP BY product_family, campaign_segment"""),
    "age_bands": _with("demo", tail="""
        SELECT customer_id, age,
               CASE WHEN age IS NULL THEN 'Unknown' WHEN age < 25 THEN '18-24' WHEN age < 35 THEN '25-34'
                    WHEN age < 45 THEN '35-44' WHEN age < 55 THEN '45-54' WHEN age < 65 THEN '55-64' ELSE '65+' END
                 AS age_band FROM demo"""),
    "hash_region": _with("demo", tail="""
        SELECT customer_id, ['North','South','East','West'][
          1 + (instr('0123456789abcdef', substr(md5(customer_id), 1, 1)) - 1) % 4] AS hash_region FROM demo"""),
    "campaign_candidates": _with(*_SCORES, tail="""
        SELECT s.customer_id, s.product_family, propensity_score, region,
               CASE WHEN i.age IS NULL THEN 'Unknown' WHEN i.age < 25 THEN '18-24' WHEN i.age < 35 THEN '25-34'
                    WHEN i.age < 45 THEN '35-44' WHEN i.age < 55 THEN '45-54' WHEN i.age < 65 THEN '55-64'
                    ELSE '65+' END AS age_band,
               i.income_band, total_spend_30d
        FROM scores s JOIN inputs i ON i.customer_id = s.customer_id AND i.product_family = s.product_family
        JOIN demo d ON d.customer_id = s.customer_id
        WHERE s.product_family = 'home_loan' AND propensity_score >= 60 AND region = 'ASIA'
        ORDER BY propensity_score DESC, s.customer_id LIMIT 700"""),
    "signal_reasons": _with(*_INPUTS, "reason_rows", tail="""
        SELECT customer_id, product_family, string_agg(name, ' | ' ORDER BY v DESC, pos) AS top_3_signal_reasons,
               string_agg(name || ': ' || txt, ' | ' ORDER BY v DESC, pos) AS reason_texts
        FROM reason_rows GROUP BY customer_id, product_family"""),
    "score_snapshots": _with(*_SCORES, tail=f"""
        SELECT customer_id,
               string_agg(product_family || '=' || {_cents("propensity_score")}, ',' ORDER BY product_family) AS scores,
               {_DAY_MS_1998} AS score_ts FROM scores GROUP BY customer_id"""),
    "txn_product_tag": _with("ev", "txe", "holdings", tail="""
        SELECT event_id, customer_id, merchant_category,
               CASE WHEN hint = 'credit_card' AND card = 1 THEN 'home_loan'
                    WHEN hint = 'fixed_deposit' AND deposit = 1 THEN 'home_loan' ELSE hint END AS product,
               CASE hint WHEN 'fixed_deposit' THEN 'fd_intent' ELSE hint || '_intent' END AS trigger_signal,
               card AS has_credit_card, deposit AS has_fixed_deposit
        FROM (SELECT t.event_id, t.customer_id, t.merchant_category,
                CASE WHEN merchant_category = 'home_improvement' THEN 'home_loan'
                     WHEN merchant_category IN ('electronics','travel') THEN 'personal_loan'
                     WHEN merchant_category = 'salary' THEN 'fixed_deposit' ELSE 'credit_card' END AS hint,
                coalesce(h.has_credit_card, 0) AS card, coalesce(h.has_fixed_deposit, 0) AS deposit
              FROM txe t LEFT JOIN holdings h ON h.customer_id = t.customer_id)"""),
    "rolling_features": _with(*_ROLL, tail="SELECT * FROM roll"),
    "large_credit_quiet": _with("ev", "txe", "credits", tail=f"""
        SELECT customer_id, event_id, credit_ms, next_ms FROM credits
        WHERE next_ms IS NULL OR next_ms >= credit_ms + {QUIET}"""),
    "home_session": _with("ev", "txe", "home", "session", "fired", tail="SELECT * FROM fired"),
    "home_session_messages": _with("ev", "txe", "home", "session", "fired", tail="SELECT * FROM fired"),
    "intent_signals": _with(*_SIGNALS, tail="SELECT * FROM signals"),
    "intent_dedup": _with(*_KEPT, tail="SELECT * FROM kept"),
    "score_enrich": _with("ev", *_SCORES, tail="""
        SELECT a.customer_id, p.product_family, coalesce(propensity_score, 45::DOUBLE) AS base_score
        FROM (SELECT DISTINCT customer_id FROM ev) a CROSS JOIN products p
        LEFT JOIN scores s ON s.customer_id = a.customer_id AND s.product_family = p.product_family"""),
    "composite_score": _with("ev", *_SCORES, "boosts", tail=f"""
        SELECT customer_id, product_family, composite_score, composite_score > 75 AS offered FROM (
          SELECT a.customer_id, p.product_family,
                 least(100::DOUBLE, {_r("coalesce(propensity_score, 45::DOUBLE) + boost")}) AS composite_score
          FROM (SELECT DISTINCT customer_id FROM ev) a CROSS JOIN products p
          JOIN boosts b ON b.product = p.product_family
          LEFT JOIN scores s ON s.customer_id = a.customer_id AND s.product_family = p.product_family)"""),
    "category_spend_7d": _with(*_KEPT, "spend7", tail="SELECT * FROM spend7"),
    "intent_events": _with(*_OFFERS, "spend7", tail=f"""
        SELECT sha256(concat_ws('|', e.customer_id, product, pattern_name, CAST(event_ts_ms AS VARCHAR))) AS event_id,
               e.customer_id, product, pattern_name, pattern_metric, pattern_boost, base_score, composite_score,
               threshold, event_ts_ms, event_ts_ms - {WEEK} AS window_start_ms, session_window_ms,
               m.category_spend_7d, 'intent_detector' AS source, FALSE AS is_late
        FROM enriched e LEFT JOIN (
          SELECT customer_id, event_id,
                 string_agg(merchant_category || '=' || {_cents("spend")}, ',' ORDER BY merchant_category)
                   AS category_spend_7d
          FROM spend7 GROUP BY customer_id, event_id) m
        ON m.customer_id = e.customer_id AND m.event_id = e.event_id"""),
    "realtime_offers": _with(*_OFFERS, tail="SELECT * FROM offers"),
    "offer_flatten": _with(*_OFFERS, tail="""
        SELECT customer_id, product, base_score, intent_score, final_score, threshold, trigger_event,
               CAST(NULL AS INTEGER) AS txn_10m, CAST(NULL AS INTEGER) AS txn_2h, CAST(NULL AS INTEGER) AS txn_24h,
               source, event_ts_ms FROM offers"""),
    "sequence_alerts": _with("ev", tail=f"""
        SELECT a.customer_id, a.event_id AS first_event_id, a.event_ts_ms AS first_ts_ms,
               b.event_id AS second_event_id, b.event_ts_ms AS second_ts_ms
        FROM ev a JOIN ev b ON b.customer_id = a.customer_id AND b.transaction_type = 'salary'
         AND b.event_ts_ms > a.event_ts_ms AND b.event_ts_ms <= a.event_ts_ms + {WEEK}
        WHERE a.event_type = 'quote_request' AND a.product = 'fixed_deposit'
        QUALIFY row_number() OVER (PARTITION BY a.event_id ORDER BY b.event_ts_ms, b.event_id) = 1"""),
    "sliding_spend": _with("ev", "txe", "panes", "feed", tail="SELECT * FROM feed"),
    "nightly_enrichment": _with("ev", "txe", "panes", "feed", tail=f"""
        SELECT {_TODAY} AS as_of_date, customer_id, merchant_category, total_spend, event_count,
               window_end_ms AS source_updated_at
        FROM feed QUALIFY row_number() OVER (PARTITION BY customer_id, merchant_category
                                             ORDER BY window_end_ms DESC) = 1"""),
    "intent_feed": _with(*_FEED, tail="SELECT * FROM feed_rows"),
    "intents_today": _with(*_OFFERS, "labels_of", tail=f"""
        SELECT l.product, product_label, count(o.product) AS intents_today
        FROM labels_of l LEFT JOIN (SELECT * FROM offers WHERE make_timestamp(event_ts_ms * 1000) >= {_TODAY}) o
          ON o.product = l.product GROUP BY l.product, product_label"""),
    "weekly_offer_performance": _with(*_OFFERS, "weekly_offers", tail="SELECT * FROM weekly_offers"),
    "performance_grid": _with(*_GRID, tail="SELECT * FROM grid"),
    "conversion_series": _with(*_GRID, tail="""
        SELECT week_start, g.product, series, conversion_rate_pct, product_label FROM (
          SELECT week_start, product, 'Baseline' AS series, baseline_rate_pct AS conversion_rate_pct FROM grid
          UNION ALL SELECT week_start, product, 'Propensity Targeted', propensity_targeted_rate_pct FROM grid) g
        JOIN labels_of l ON l.product = g.product"""),
    "revenue_summary": _with(*_GRID, tail="""
        SELECT product_label, CAST(sum(offers_sent) AS BIGINT) AS offers_sent,
               CAST(sum(offers_sent) AS BIGINT) * 0.02::DOUBLE AS targeted_est_conversions,
               CAST(sum(offers_sent) AS BIGINT) * 0.02::DOUBLE * any_value(revenue) AS targeted_est_revenue
        FROM grid g JOIN labels_of l ON l.product = g.product GROUP BY product_label"""),
    "run_summary": _with(*_LISTS, tail=f"""
        SELECT 'propensity_inputs' AS table_name, count(*) AS row_count, CAST(NULL AS DOUBLE) AS min_score,
               CAST(NULL AS DOUBLE) AS avg_score, CAST(NULL AS DOUBLE) AS max_score FROM inputs
        UNION ALL SELECT 'mart_propensity_scores', count(*), {_r("min(propensity_score)", 4)},
               {_r("avg(propensity_score)", 4)}, {_r("max(propensity_score)", 4)} FROM scores
        UNION ALL SELECT 'mart_campaign_lists', count(*), {_r("min(propensity_score)", 4)},
               {_r("avg(propensity_score)", 4)}, {_r("max(propensity_score)", 4)} FROM ranked WHERE rank_no <= 5000"""),
    "dq_inputs": """
        SELECT 'transactions' AS table_name, (SELECT count(*) > 0 FROM lineitem) AS has_rows, 0::BIGINT AS repeated_keys
        UNION ALL SELECT 'product_holdings', (SELECT count(*) > 0 FROM customer),
          (SELECT count(*) - count(DISTINCT c_custkey) FROM customer)
        UNION ALL SELECT 'demographics', (SELECT count(*) > 0 FROM customer),
          (SELECT count(*) - count(DISTINCT c_custkey) FROM customer)
        UNION ALL SELECT 'campaign_history', (SELECT count(*) > 0 FROM customer),
          (SELECT count(*) - count(DISTINCT c_custkey) FROM customer)""",
    "dq_signals": _with(*_INPUTS, tail="""
        SELECT count(*) AS row_count, count(*) >= 100 AS enough_rows, '' AS missing_columns, count(*) >= 100 AS passed
        FROM inputs"""),
    "dq_feed_contract": _with(*_FEED, tail="""
        SELECT count(*) AS feed_rows, '' AS missing_columns, TRUE AS passed FROM feed_rows"""),
}

# The weekly reports score four dates; their scores come from the same steps over other days.
_HISTORY = tuple(n for n in _SCORES if n != "days")
_weekly = _with("history_days", *_HISTORY, "weekly", tail="{tail}").replace("JOIN days ON", "JOIN history_days ON")
ORACLE["weekly_propensity_counts"] = _weekly.replace("{tail}", """
    SELECT * FROM weekly WHERE week_start >= DATE '1998-06-30' - INTERVAL 98 DAY""")
ORACLE["weekly_wow"] = _weekly.replace("{tail}", """
    SELECT product_family, latest_count, latest_count - previous_count AS wow_change,
           latest_count * 0.02::DOUBLE * CASE product_family WHEN 'home_loan' THEN 250000 WHEN 'credit_card' THEN 8000
             WHEN 'fixed_deposit' THEN 25000 ELSE 60000 END::DOUBLE AS est_revenue
    FROM (SELECT p.product_family,
            CAST(coalesce(sum(high_propensity_count) FILTER (week_start = latest), 0) AS BIGINT) AS latest_count,
            CAST(coalesce(sum(high_propensity_count) FILTER (week_start = latest - 7), 0) AS BIGINT) AS previous_count
          FROM products p CROSS JOIN (SELECT max(week_start) AS latest FROM weekly)
          LEFT JOIN weekly w ON w.product_family = p.product_family GROUP BY p.product_family)""")

# Dates are compared as ISO text, optional whole numbers as doubles.
_TEXT = {
    "txn_30d_filter": ["txn_dt"],
    "txn_features": ["last_txn_date"],
    "days_since_last_txn": ["last_txn_date"],
    "weekly_propensity_counts": ["week_start"],
    "weekly_offer_performance": ["week_start"],
    "performance_grid": ["week_start"],
    "conversion_series": ["week_start"],
    "nightly_enrichment": ["as_of_date"],
}
_DOUBLE = {
    "customer_base": ["age", "campaign_touch_count"],
    "propensity_inputs": ["age", "campaign_touch_count"],
    "age_bands": ["age"],
    "large_credit_quiet": ["next_ms"],
    "intent_signals": ["session_window_ms"],
    "intent_dedup": ["session_window_ms"],
    "intent_events": ["session_window_ms"],
    "realtime_offers": ["session_window_ms"],
    "offer_flatten": ["txn_10m", "txn_2h", "txn_24h"],
    "home_session": ["session_window_ms"],
    "home_session_messages": ["session_window_ms"],
}
for _columns_of, _type in ((_TEXT, "VARCHAR"), (_DOUBLE, "DOUBLE")):
    for _name, _columns in _columns_of.items():
        _casts = ", ".join(f"CAST({c} AS {_type}) AS {c}" for c in _columns)
        ORACLE[_name] = f"SELECT * REPLACE ({_casts}) FROM ({ORACLE[_name]})"
