"""Check SQL per query name, for DuckDB over the given tables."""

from __future__ import annotations

from oracles.base import AS_OF, pct, q, r, with_
from tillscope.models.features import CATEGORICAL, FRAUD_FEATURES
from tillscope.operators.quality import CONTRACTS
from tillscope.plans.executive import CARDS
from tillscope.text.lexicon import INTENSIFIERS, LEXICON, NEGATIONS, STOP_WORDS
from tillscope.text.tickets import TOPICS, URGENT_WORDS

ORACLES: dict[str, str] = {}

TX = "transactions"
OK, BAD, BACK = "status = 'Success'", "status = 'Failed'", "status = 'Refunded'"
HIT = "is_fraud = 1"
DAY = 'CAST("timestamp" AS DATE)'
MONTH = "CAST(date_trunc('month', \"timestamp\") AS DATE)"


def n(where: str | None = None) -> str:
    return f"count(*) FILTER (WHERE {where})" if where else "count(*)"


def total(x: str, where: str | None = None) -> str:
    return f"sum({x})" + (f" FILTER (WHERE {where})" if where else "")


def mean(x: str, where: str | None = None) -> str:
    return f"avg({x})" + (f" FILTER (WHERE {where})" if where else "")


def last_days(days: int) -> str:
    return f'"timestamp" >= {AS_OF} - INTERVAL {days} DAY AND "timestamp" < {AS_OF} + INTERVAL 1 DAY'


def oracle(name: str, body: str, *needs: str) -> None:
    ORACLES[name] = with_(body, *(needs or (TX,)))


def on_tx(name: str, body: str) -> None:
    oracle(name, body, TX)


# -------------------------------------------------------------- bronze, silver
for name in ("customers", "merchants", "transactions", "reviews", "tickets"):
    oracle(f"silver_{name}", f"SELECT * FROM {name}", name)
oracle("bronze_csv_scan", """SELECT transaction_id, customer_id, merchant_id, amount,
  payment_method, "timestamp", status, device_type FROM transactions0""", "transactions0")


def _quality() -> str:
    have = {
        "customers": {"customer_id", "customer_name", "email", "phone", "city", "state", "device_preference"},
        "merchants": {"merchant_id", "merchant_name", "risk_score", "category", "city", "state", "status"},
        "transactions": {"transaction_id", "amount", "timestamp", "customer_id", "merchant_id",
                         "payment_method", "status", "device_type"},
        "reviews": {"review_id", "rating"},
        "tickets": {"ticket_id"},
    }
    parts = []
    for table, contract in CONTRACTS.items():
        source = f"{table}0"

        def part(rule: str, where: str) -> str:
            return (f"SELECT {q(rule)} AS \"rule\", {q(table)} AS table_name, "
                    f"count(*) AS violations FROM {source} AS t WHERE {where}")

        parts += [part(f"not_null:{c}", f'"{c}" IS NULL') for c in contract.not_null if c in have[table]]
        parts += [part(f"range:{c}", f"NOT ({c} BETWEEN {lo} AND {hi})")
                  for c, (lo, hi) in contract.ranges.items() if c in have[table]]
        parts += [part(f"length:{c}", f"length({c}) > {m}") for c, m in contract.lengths.items() if c in have[table]]
        key = contract.key[0]
        parts.append(f"SELECT 'unique:{key}' AS \"rule\", {q(table)} AS table_name, "
                     f"count(*) - count(DISTINCT {key}) AS violations FROM {source}")
        parts += [part(f"reference:{c}", f"{c} IS NOT NULL AND {c} NOT IN (SELECT {c} FROM {target}0)")
                  for c, target in contract.references.items()]
    return "\nUNION ALL ".join(parts)


oracle("quality_report", _quality(), "customers0", "merchants0", "transactions0", "reviews0", "tickets0")
oracle("load_report", """
SELECT CAST(1 AS INTEGER) AS load_order, 'customers' AS table_name, count(*) AS row_count FROM customers
UNION ALL SELECT CAST(2 AS INTEGER), 'merchants', count(*) FROM merchants
UNION ALL SELECT CAST(3 AS INTEGER), 'transactions', count(*) FROM transactions""", "customers", "merchants", TX)

# ------------------------------------------------------------------------ gold
on_tx("daily_revenue", f"""SELECT {DAY} AS "date", {r(total('amount'))} AS total_revenue, {n()} AS total_transactions,
  {n(HIT)} AS fraud_transactions, {r(mean('amount'))} AS avg_transaction_value FROM transactions GROUP BY 1""")
on_tx("merchant_kpis", f"""SELECT merchant_id, {r(total('amount'))} AS merchant_revenue, {n()} AS txn_count,
  {r(mean('amount'))} AS avg_txn_value, {r(pct(n(HIT), n()))} AS fraud_rate_pct,
  {r(pct(n(OK), n()))} AS success_rate_pct FROM transactions GROUP BY 1""")
on_tx("payment_trends", f"""SELECT payment_method, {n()} AS total_transactions, {r(total('amount'))} AS total_volume
  FROM transactions GROUP BY 1""")
on_tx("fraud_summary", f"""SELECT risk_level, payment_method, {n()} AS total_transactions, {n(HIT)} AS fraud_count,
  {r(mean('fraud_score'))} AS avg_fraud_score FROM transactions GROUP BY 1, 2""")
on_tx("customer_spend", f"""SELECT customer_id, {r(total('amount'))} AS total_spent, {n()} AS txn_count,
  {r(mean('amount'))} AS avg_spend FROM transactions GROUP BY 1""")
oracle("support_metrics", "SELECT issue_type, priority, status, count(*) AS ticket_count FROM tickets GROUP BY 1, 2, 3",
       "tickets")
on_tx("agg_daily_revenue", f"""SELECT {DAY} AS txn_date, {r(total('amount'))} AS total_revenue,
  {n()} AS total_transactions, {n(OK)} AS success_count, {n(BAD)} AS failed_count, {n(BACK)} AS refunded_count,
  {r(mean('amount'))} AS avg_transaction_value, {n(HIT)} AS fraud_count,
  {r(f"coalesce({total('amount', HIT)}, 0)")} AS fraud_amount FROM transactions GROUP BY 1""")
on_tx("agg_fraud_summary", f"""SELECT {DAY} AS txn_date, {n()} AS total_transactions, {n(HIT)} AS fraud_transactions,
  {r(pct(n(HIT), n()))} AS fraud_rate, {r(f"coalesce({total('amount', HIT)}, 0)")} AS fraud_amount,
  {r(total('amount'))} AS total_amount, {n("risk_level = 'High'")} AS high_risk_count,
  {n("risk_level = 'Medium'")} AS medium_risk_count, {n("risk_level = 'Low'")} AS low_risk_count
  FROM transactions GROUP BY 1""")
on_tx("agg_payment_trends", f"""SELECT payment_method, {MONTH} AS "month", {n()} AS transaction_count,
  {r(total('amount'))} AS total_amount FROM transactions GROUP BY 1, 2""")
oracle("agg_support_metrics", f"""SELECT issue_type, {n()} AS ticket_count, {n("status = 'Open'")} AS open_count,
  {n("status = 'Resolved'")} AS resolved_count, {n("status = 'Escalated'")} AS escalated_count,
  {n("priority = 'High'")} AS high_priority_count FROM tickets GROUP BY 1""", "tickets")

# ----------------------------------------------------------------------- views
PERFORMANCE = f"""SELECT m.merchant_id, any_value(m.merchant_name) AS merchant_name, any_value(m.category) AS category,
  any_value(m.city) AS city, any_value(m.state) AS state, any_value(m.risk_score) AS risk_score,
  any_value(m.status) AS status, count(t.transaction_id) AS total_txns,
  {r("coalesce(sum(t.amount) FILTER (WHERE t.status = 'Success'), 0)")} AS revenue,
  {r("coalesce(avg(t.amount) FILTER (WHERE t.status = 'Success'), 0)")} AS avg_txn_value,
  count(DISTINCT t.customer_id) AS unique_customers,
  {r(pct("count(*) FILTER (WHERE t.is_fraud = 1)", 'count(*)'), 4)} AS fraud_pct,
  {r(pct("count(*) FILTER (WHERE t.status = 'Refunded')", 'count(*)'), 4)} AS refund_pct
  FROM merchants m LEFT JOIN transactions t ON t.merchant_id = m.merchant_id GROUP BY 1"""
SUMMARY = f"""SELECT c.customer_id, any_value(c.customer_name) AS customer_name, any_value(c.city) AS city,
  any_value(c.state) AS state, any_value(c.registration_date) AS registration_date,
  any_value(c.device_preference) AS device_preference, count(t.transaction_id) AS total_txns,
  {r("coalesce(sum(t.amount) FILTER (WHERE t.status = 'Success'), 0)")} AS total_spend,
  {r("coalesce(avg(t.amount) FILTER (WHERE t.status = 'Success'), 0)")} AS avg_txn_value,
  max(t."timestamp") AS last_txn, count(DISTINCT t.merchant_id) AS unique_merchants,
  count(*) FILTER (WHERE t.is_fraud = 1) AS fraud_txn_count
  FROM customers c LEFT JOIN transactions t ON t.customer_id = c.customer_id GROUP BY 1"""
oracle("v_merchant_performance", PERFORMANCE, TX, "merchants")
oracle("v_customer_summary", SUMMARY, TX, "customers")
ALERTS = """SELECT t.transaction_id, t."timestamp", t.amount, t.payment_method, t.category, t.city, t.status,
  t.device_type, t.fraud_score, t.risk_level, t.customer_merchant_distance, t.transaction_hour, t.weekend_flag,
  c.customer_name, c.device_preference AS customer_device, m.merchant_name, m.risk_score AS merchant_risk_score
  FROM transactions t JOIN customers c ON t.customer_id = c.customer_id
  JOIN merchants m ON t.merchant_id = m.merchant_id WHERE t.is_fraud = 1"""
oracle("v_fraud_alerts", ALERTS, TX, "customers", "merchants")

oracle("agg_merchant_kpis", f"""SELECT p.merchant_id, {AS_OF} AS metric_date, revenue AS total_revenue,
  total_txns AS transaction_count, unique_customers, refund_pct AS refund_rate, fraud_pct AS fraud_rate,
  CASE WHEN total_txns > 0 THEN {r('''40 * coalesce(revenue / nullif(max(revenue) OVER (PARTITION BY category), 0), 0)
    + 0.3::DOUBLE * ok_pct + 0.15::DOUBLE * (100 - refund_pct) + 0.15::DOUBLE * (100 - fraud_pct)''')}
  ELSE 0 END AS merchant_score
  FROM ({PERFORMANCE}) p LEFT JOIN (SELECT merchant_id, {r(pct(n(OK), n()), 4)} AS ok_pct FROM transactions GROUP BY 1) s
  ON p.merchant_id = s.merchant_id""", TX, "merchants")

# ------------------------------------------------------------------- executive
KPIS = f"""SELECT {n()} AS total_transactions, {r(f"coalesce({total('amount', OK)}, 0)")} AS total_revenue,
  {n(HIT)} AS fraud_count, {r(f"coalesce({total('amount', HIT)}, 0)")} AS fraud_amount,
  {r(pct(n(OK), n()))} AS success_rate, {r(pct(n(HIT), n()))} AS fraud_rate,
  (SELECT count(*) FROM customers) AS total_customers,
  (SELECT count(*) FROM merchants WHERE status = 'Active') AS total_merchants FROM transactions"""
oracle("executive_kpis", KPIS, TX, "customers", "merchants")


def _mark(x: str | None) -> str:
    return f"CAST({q(x) if x else 'NULL'} AS VARCHAR)"


oracle("kpi_cards", "\nUNION ALL ".join(
    f"SELECT {q(label)} AS label, CAST({source} AS DOUBLE) AS \"value\", {_mark(pre)} AS prefix, {_mark(post)} AS suffix "
    f"FROM ({KPIS})" for label, source, pre, post in CARDS), TX, "customers", "merchants")
on_tx("executive_today", f"""SELECT {r(f"coalesce({total('amount', OK)}, 0)")} AS revenue, {n()} AS transactions,
  {n(HIT)} AS fraud FROM transactions WHERE {DAY} = {AS_OF}""")
on_tx("executive_daily_trend", f"""SELECT {DAY} AS "date", {n()} AS transactions, {r(total('amount'))} AS revenue,
  {n(OK)} AS success, {n(BAD)} AS failed, {n(HIT)} AS fraud FROM transactions WHERE {last_days(30)} GROUP BY 1""")
on_tx("payment_distribution", f"""SELECT payment_method, {n()} AS txn_count, {r(total('amount'))} AS total_amount,
  {r(pct(n(), f"(SELECT count(*) FROM transactions WHERE {OK})"))} AS percentage
  FROM transactions WHERE {OK} GROUP BY 1""")
on_tx("category_distribution", f"""SELECT category, {n()} AS txn_count, {r(total('amount'))} AS revenue
  FROM transactions WHERE {OK} GROUP BY 1""")

# ---------------------------------------------------------------- transactions
NAMED = """SELECT t.*, c.customer_name, m.merchant_name FROM transactions t
  JOIN customers c ON t.customer_id = c.customer_id JOIN merchants m ON t.merchant_id = m.merchant_id"""
PAGE = """status = 'Success' AND risk_level = 'High' AND "timestamp" >= TIMESTAMP '1996-01-01'
  AND "timestamp" <= TIMESTAMP '2001-06-30'"""
oracle("transactions_page", f"""SELECT * FROM ({NAMED}) WHERE {PAGE}
  ORDER BY amount DESC, transaction_id LIMIT 50 OFFSET 50""", TX, "customers", "merchants")
oracle("transactions_far_page", f"SELECT * FROM ({NAMED}) ORDER BY amount, transaction_id LIMIT 100 OFFSET 29900",
       TX, "customers", "merchants")
oracle("transactions_status_page", f"""SELECT * FROM ({NAMED})
  ORDER BY status DESC, transaction_id LIMIT 100 OFFSET 11900""", TX, "customers", "merchants")
LATEST = "status = 'Success' AND risk_level = 'High'"
oracle("transactions_latest_page", f"""SELECT * FROM ({NAMED}) WHERE {LATEST}
  ORDER BY "timestamp" DESC, transaction_id LIMIT 50 OFFSET 1950""", TX, "customers", "merchants")
on_tx("transactions_counted_total", f"SELECT count(*) AS total FROM transactions WHERE {LATEST}")
on_tx("transactions_page_total", f"SELECT count(*) AS total FROM transactions WHERE {PAGE}")
oracle("transaction_get", f"SELECT * FROM ({NAMED}) WHERE transaction_id IN (SELECT transaction_id FROM reviews)",
       TX, "customers", "merchants", "reviews")
on_tx("transaction_stats", f"""SELECT {n()} AS total_transactions, {r(f"coalesce({total('amount', OK)}, 0)")} AS total_revenue,
  {r(f"coalesce({mean('amount', OK)}, 0)")} AS avg_transaction_value, {r(pct(n(OK), n()))} AS success_rate,
  {r(pct(n(BAD), n()))} AS failure_rate, {r(pct(n(BACK), n()))} AS refund_rate FROM transactions""")

# ------------------------------------------------------------------- merchants
DIRECTORY = f"""SELECT p.* EXCLUDE (avg_txn_value), m.avg_transaction_value, m.registration_date
  FROM ({PERFORMANCE}) p JOIN merchants m ON p.merchant_id = m.merchant_id"""
oracle("merchants_page", f"""SELECT * FROM ({DIRECTORY}) WHERE status = 'Active' AND merchant_name ILIKE '%supplier%'
  ORDER BY revenue DESC, merchant_id LIMIT 25""", TX, "merchants")
oracle("merchants_page_total", """SELECT count(*) AS total FROM merchants
  WHERE status = 'Active' AND merchant_name ILIKE '%supplier%'""", "merchants")
DAILY = f"""SELECT merchant_id, {DAY} AS "date", {n()} AS transactions, {r(total('amount'))} AS revenue,
  {n(BAD)} AS failed, {n(HIT)} AS fraud FROM transactions WHERE {last_days(30)} GROUP BY 1, 2"""
on_tx("merchant_daily", DAILY)
oracle("merchant_profile", f"""SELECT d.merchant_id, merchant_name, category, status, risk_score, avg_transaction_value,
  total_txns, d.revenue, unique_customers, fraud_pct, refund_pct, y."date", y.transactions, y.failed, y.fraud,
  y.revenue AS day_revenue FROM ({DIRECTORY}) d LEFT JOIN ({DAILY}) y ON d.merchant_id = y.merchant_id""", TX, "merchants")
oracle("top_merchants", f"""SELECT merchant_id, merchant_name, category, city, revenue, total_txns, unique_customers,
  fraud_pct FROM ({PERFORMANCE}) ORDER BY revenue DESC, merchant_id LIMIT 10""", TX, "merchants")

# ------------------------------------------------------------------- customers
oracle("customers_page", f"""SELECT * FROM ({SUMMARY}) WHERE customer_name ILIKE '%customer#%'
  ORDER BY total_spend DESC, customer_id LIMIT 25 OFFSET 25""", TX, "customers")
oracle("customers_page_total", "SELECT count(*) AS total FROM customers WHERE customer_name ILIKE '%customer#%'",
       "customers")
RECENT = """SELECT customer_id, CAST(position AS INTEGER) AS position, transaction_id, "timestamp", amount, status, merchant_name
  FROM (SELECT t.*, m.merchant_name, row_number() OVER (PARTITION BY t.customer_id
          ORDER BY t."timestamp" DESC, t.transaction_id) AS position
        FROM transactions t JOIN merchants m ON t.merchant_id = m.merchant_id) WHERE position <= 20"""
oracle("customer_recent", RECENT, TX, "merchants")
MONTHLY = f"""SELECT customer_id, {MONTH} AS "month", {n()} AS transactions, {r(total('amount', OK))} AS spend,
  {n(HIT)} AS fraud_count FROM transactions GROUP BY 1, 2"""
on_tx("customer_monthly", MONTHLY)
oracle("customer_profile", f"""SELECT s.customer_id, s.customer_name, c.email, s.total_txns, s.total_spend,
  s.avg_txn_value, s.last_txn, s.unique_merchants, s.fraud_txn_count,
  CAST(k.n_recent AS INTEGER) AS n_recent, m."month", m.transactions, m.spend, m.fraud_count
  FROM ({SUMMARY}) s JOIN customers c ON s.customer_id = c.customer_id
  LEFT JOIN ({MONTHLY}) m ON s.customer_id = m.customer_id
  LEFT JOIN (SELECT customer_id, count(*) AS n_recent FROM ({RECENT}) GROUP BY 1) k ON s.customer_id = k.customer_id""",
       TX, "customers", "merchants")
SEGMENTS = f"""SELECT CASE WHEN total_spend >= 2000000 AND total_txns >= 36 THEN 'high_value'
    WHEN total_txns >= 36 THEN 'frequent'
    WHEN last_txn < {AS_OF} - INTERVAL 90 DAY THEN 'dormant'
    WHEN avg_txn_value >= 58000 THEN 'luxury_spender'
    WHEN unique_merchants >= 26 THEN 'diverse_shopper' ELSE 'casual' END AS segment,
  count(*) AS customer_count, {r('avg(total_spend)')} AS avg_spend, {r('avg(total_txns)', 1)} AS avg_transactions,
  {r('sum(total_spend)')} AS total_revenue FROM ({SUMMARY}) GROUP BY 1"""
oracle("customer_segments_heuristic", SEGMENTS, TX, "customers")
oracle("agg_customer_segments", f"""SELECT CAST(row_number() OVER (ORDER BY avg_spend DESC, segment) AS INTEGER) AS segment_id,
  segment AS segment_name, customer_count, avg_spend, avg_transactions, total_revenue FROM ({SEGMENTS})""", TX, "customers")
oracle("insight_top_segment", f"""SELECT segment, customer_count, avg_spend FROM ({SEGMENTS})
  ORDER BY avg_spend DESC, segment LIMIT 1""", TX, "customers")

# ----------------------------------------------------------------------- fraud
LOST = total("amount", HIT)
on_tx("fraud_totals", f"""SELECT {n(HIT)} AS fraud_transactions, {r(f'coalesce({LOST}, 0)')} AS fraud_amount,
  {r(pct(n(HIT), n()))} AS fraud_rate, {r(pct(LOST, 'sum(amount)'))} AS fraud_amount_pct FROM transactions""")
on_tx("risk_distribution", f"""SELECT {n("risk_level = 'High'")} AS high, {n("risk_level = 'Medium'")} AS medium,
  {n("risk_level = 'Low'")} AS low FROM transactions""")
for name, key, where in (
    ("fraud_by_hour", "transaction_hour", HIT),
    ("fraud_by_category", "category", HIT),
    ("fraud_daily", f'{DAY} AS "date"', f"{HIT} AND {last_days(90)}"),
):
    on_tx(name, f"""SELECT {key}, {n()} AS fraud_count, {r(total('amount'))} AS fraud_amount
      FROM transactions WHERE {where} GROUP BY 1""")
ALERT_FILTER = "risk_level = 'High' AND \"timestamp\" >= TIMESTAMP '1997-01-01'"
oracle("fraud_alerts_page", f"""SELECT * FROM ({ALERTS}) WHERE {ALERT_FILTER}
  ORDER BY "timestamp" DESC, transaction_id LIMIT 50""", TX, "customers", "merchants")
oracle("fraud_alerts_total", f"SELECT count(*) AS total FROM ({ALERTS}) WHERE {ALERT_FILTER}",
       TX, "customers", "merchants")
on_tx("fraud_rules", """SELECT transaction_id, fraud_points, fraud_score, risk_level, customer_merchant_distance
  FROM transactions""")
on_tx("fraud_top_fraction", f"SELECT transaction_id, fraud_points FROM transactions WHERE {HIT}")
GUESS = "(customer_merchant_distance > 75 AND txn_hour <= 4)"
on_tx("fraud_ml_comparison", f"""SELECT {n()} AS total, {n(f'{HIT} AND {GUESS}')} AS both_flagged,
  {n(f'{HIT} AND NOT {GUESS}')} AS heuristic_only, {n(f'is_fraud = 0 AND {GUESS}')} AS ml_only,
  {n(f'is_fraud = 0 AND NOT {GUESS}')} AS neither FROM transactions""")
on_tx("fraud_flagged_share", f"""SELECT {n()} AS total, {n(GUESS)} AS flagged, {r(pct(n(GUESS), n()))} AS flagged_pct
  FROM transactions""")
on_tx("fraud_agreement", f"""SELECT {n()} AS total, {n(f'({HIT}) = {GUESS}')} AS agreed, {r(pct(n(f'({HIT}) = {GUESS}'), n()))} AS agreement_pct
  FROM transactions""")

# ---------------------------------------------------------------------- models
_CODES = ", ".join(
    f"dense_rank() OVER (ORDER BY t.{x} NULLS LAST) - 1 AS {x}_enc" for x in CATEGORICAL
)
FEATURES = f"""SELECT t.transaction_id, t.amount, t.transaction_hour, t.weekend_flag, t.customer_merchant_distance,
  {_CODES}, c.mean_amount AS customer_mean, c.std_amount AS customer_std, c.mean_nb_tx_per_day AS customer_tx_rate,
  m.risk_score AS merchant_risk, t.amount / (c.mean_amount + 1) AS amount_vs_customer_mean
  FROM transactions t JOIN customers c ON t.customer_id = c.customer_id JOIN merchants m ON t.merchant_id = m.merchant_id"""
oracle("fraud_features", f"SELECT transaction_id, {', '.join(f'{r(x, 4)} AS {x}' for x in FRAUD_FEATURES)} FROM ({FEATURES})",
       TX, "customers", "merchants")
oracle("category_codes", "\nUNION ALL ".join(
    f"""SELECT {q(x)} AS field, {x} AS "value", CAST(row_number() OVER (ORDER BY {x}) - 1 AS INTEGER) AS code
    FROM (SELECT DISTINCT {x} FROM transactions)""" for x in CATEGORICAL))
oracle("scale_moments", "\nUNION ALL ".join(
    f"SELECT {q(x)} AS feature, {r(f'avg({x})', 4)} AS mean, {r(f'stddev_pop({x})', 4)} AS std FROM ({FEATURES})"
    for x in FRAUD_FEATURES), TX, "customers", "merchants")
_SCALED = ", ".join(
    f"{r(f'({x} - avg({x}) OVER ()) / stddev_pop({x}) OVER ()', 3)} AS {x}" for x in FRAUD_FEATURES)
oracle("standard_scale", f"SELECT transaction_id, {_SCALED} FROM ({FEATURES})", TX, "customers", "merchants")
oracle("customer_features", f"""SELECT customer_id,
  CAST(coalesce(floor(epoch({AS_OF} + INTERVAL 1 DAY - last_txn) / 86400), 999) AS INTEGER) AS days_since_last_txn,
  {r('total_spend / (unique_merchants + 1)', 4)} AS spend_per_merchant FROM ({SUMMARY})""", TX, "customers")
HISTORY = f"""SELECT {DAY} AS "date", {n()} AS transactions, {r(total('amount', OK))} AS revenue, {n(BAD)} AS failed,
  {n(HIT)} AS fraud FROM transactions"""
on_tx("daily_history", f"{HISTORY} GROUP BY 1")
on_tx("daily_history_60", f"{HISTORY} WHERE {last_days(60)} GROUP BY 1")
_PAIRS = [(i, j) for i in range(8) for j in range(i, 8)]
on_tx("forecast_gram", f"""SELECT metric_name, n_days, n_obs, entry, CAST(round(CAST(ratio AS DECIMAL(30,12)), 6) AS DOUBLE) AS ratio
FROM (SELECT metric_name, any_value(n_days) AS n_days, count(*) AS n_obs,
        unnest([{', '.join(q(f'g_{i}_{j}') for i, j in _PAIRS)}]) AS entry,
        unnest([{', '.join(f'sum(d{i} * d{j}) / sum(d0 * d0)' for i, j in _PAIRS)}]) AS ratio
      FROM (SELECT metric_name, n_days, d0, {', '.join(f'lag(d0, {i}) OVER w AS d{i}' for i in range(1, 8))}
            FROM (SELECT metric_name, "date", count(*) OVER (PARTITION BY metric_name) AS n_days,
                    y - lag(y) OVER (PARTITION BY metric_name ORDER BY "date") AS d0
                  FROM (SELECT 'transactions' AS metric_name, {DAY} AS "date", CAST(count(*) AS DOUBLE) AS y
                        FROM transactions GROUP BY 2
                        UNION ALL SELECT 'revenue', {DAY}, coalesce({total('amount', OK)}, 0) FROM transactions GROUP BY 2))
            WINDOW w AS (PARTITION BY metric_name ORDER BY "date"))
      WHERE d7 IS NOT NULL GROUP BY metric_name)""")

# One lag: the exact likelihood's derivative has one zero between -1 and 1, found by halving.
_SLOPE = """n * (2 * phi * (g11 - x1 * x1) - 2 * g01) * (1 - phi * phi)
  + 2 * phi * (x1 * x1 * (1 - phi * phi) + g00 - 2 * phi * g01 + phi * phi * g11)"""
LAG1 = f"""SELECT metric_name, CAST(last_date + CAST(h AS INTEGER) AS DATE) AS forecast_date,
  CASE WHEN is_count THEN round_even(greatest(v, 0), 0) ELSE {r('greatest(v, 0)')} END AS forecast_value,
  CASE WHEN is_count THEN round_even(greatest(v - e, 0), 0) ELSE {r('greatest(v - e, 0)')} END AS lower_bound,
  CASE WHEN is_count THEN round_even(greatest(v + e, 0), 0) ELSE {r('greatest(v + e, 0)')} END AS upper_bound,
  'arima' AS model_name
FROM (
  SELECT *, last_y + last_d * phi * (1 - phi ** h) / (1 - phi) AS v,
    1.959964 * sigma * sqrt(list_sum([((1 - phi ** (j + 1)) / (1 - phi)) ** 2 for j in range(0, h)])) AS e
  FROM (
    WITH RECURSIVE s AS (
      SELECT 'transactions' AS metric_name, true AS is_count, {DAY} AS "date", CAST(count(*) AS DOUBLE) AS y
      FROM transactions GROUP BY 3
      UNION ALL SELECT 'revenue', false, {DAY}, CAST(coalesce({total('amount', OK)}, 0) AS DOUBLE) FROM transactions GROUP BY 3),
    d AS (SELECT *, y - lag(y) OVER (PARTITION BY metric_name ORDER BY "date") AS x FROM s),
    p AS (SELECT *, lag(x) OVER (PARTITION BY metric_name ORDER BY "date") AS x0 FROM d),
    g AS (
      SELECT metric_name, any_value(is_count) AS is_count, count(*) - 1 AS n, arg_min(x, "date") FILTER (WHERE x IS NOT NULL) AS x1,
        sum(x * x) FILTER (WHERE x0 IS NOT NULL) AS g00, sum(x * x0) AS g01, sum(x0 * x0) AS g11,
        max("date") AS last_date, arg_max(y, "date") AS last_y, arg_max(x, "date") AS last_d
      FROM p GROUP BY metric_name HAVING count(*) >= 14),
    b AS (
      SELECT metric_name, 0 AS step, CAST(-1 AS DOUBLE) AS lo, CAST(1 AS DOUBLE) AS hi FROM g
      UNION ALL
      SELECT metric_name, step + 1, CASE WHEN f < 0 THEN phi ELSE lo END, CASE WHEN f < 0 THEN hi ELSE phi END
      FROM (SELECT *, {_SLOPE} AS f FROM (SELECT b.*, (lo + hi) / 2 AS phi, g.* EXCLUDE (metric_name)
                                          FROM b JOIN g ON b.metric_name = g.metric_name WHERE step < 60)))
    SELECT g.*, phi, sqrt((x1 * x1 * (1 - phi * phi) + g00 - 2 * phi * g01 + phi * phi * g11) / n) AS sigma
    FROM g JOIN (SELECT metric_name, (lo + hi) / 2 AS phi FROM b WHERE step = 60) z ON g.metric_name = z.metric_name
  ), range(1, 31) k(h))"""
on_tx("forecast_lag1", LAG1)
on_tx("forecast_lag1_read", f"""SELECT forecast_date, forecast_value, lower_bound, upper_bound FROM ({LAG1})
  WHERE metric_name = 'revenue' ORDER BY forecast_date""")
on_tx("forecast_lag1_union", f"""SELECT * FROM (WITH h AS ({HISTORY} GROUP BY 1)
  SELECT 'transactions' AS metric, "date" AS ds, CAST(transactions AS DOUBLE) AS y, 'history' AS kind FROM h
  UNION ALL SELECT 'revenue', "date", CAST(revenue AS DOUBLE), 'history' FROM h
  UNION ALL SELECT metric_name, forecast_date, forecast_value, 'forecast' FROM ({LAG1}))""")

# ------------------------------------------------------------------------ text
def phrase_table(source: str, key: str, text: str, longest: int, least: int) -> str:
    """Scored phrases of all texts, and ``g``, the phrases of each text, as CTEs."""
    return f"""t AS (
  SELECT {key} AS id, list_transform(regexp_extract_all(lower(coalesce({text}, '')), '\\p{{L}}+|[^\\p{{L}} \\t\\n\\r\\f]+'),
    lambda w: CASE WHEN regexp_matches(w, '^\\p{{L}}') AND NOT list_contains([{', '.join(map(q, STOP_WORDS))}], w) THEN w END) AS ws
  FROM {source}),
g AS (
  SELECT id, n, array_to_string(ws[i:i + n - 1], ' ') AS phrase
  FROM (SELECT id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM t, range(1, {longest + 1}) k(n))
  WHERE len(list_filter(ws[i:i + n - 1], lambda w: w IS NULL)) = 0),
f AS (SELECT phrase, CAST(any_value(n) AS INTEGER) AS n_words, count(*) AS n FROM g GROUP BY phrase HAVING count(*) >= {least}),
w AS (SELECT count(*) AS words FROM g WHERE n = 1),
nested AS (
  SELECT inner_phrase AS phrase, sum(n) / count(*) AS mean FROM (
    SELECT DISTINCT phrase, n, array_to_string(ps[i:i + k - 1], ' ') AS inner_phrase
    FROM (SELECT phrase, n, ps, k, unnest(range(1, len(ps) - k + 2)) AS i
          FROM (SELECT phrase, n, string_split(phrase, ' ') AS ps FROM f), range(1, {longest}) j(k) WHERE k < len(ps)))
  GROUP BY inner_phrase),
alone AS (
  SELECT f.phrase, sum(log2(u.n / (SELECT words FROM w))) AS bits
  FROM (SELECT phrase, unnest(string_split(phrase, ' ')) AS word FROM f) f JOIN f u ON u.phrase = f.word GROUP BY f.phrase),
p AS (
  SELECT *, c_value * (1 + greatest(0, CASE WHEN n_words = 1 OR n = words THEN 0 ELSE pmi / -log2(n / words) END)) AS score
  FROM (SELECT f.*, words, log2(n_words + 1) * (n - coalesce(mean, 0)) AS c_value,
          CASE WHEN n_words = 1 THEN 0 ELSE log2(n / words) - bits END AS pmi
        FROM f JOIN alone USING (phrase) LEFT JOIN nested USING (phrase), w))"""


def phrases(name: str, source: str, key: str, text: str, longest: int, least: int, *needs: str) -> None:
    made = phrase_table(source, key, text, longest, least)
    ORACLES[f"{name}_phrases"] = with_(f"""SELECT * FROM (WITH {made}
      SELECT phrase, n_words, n, {r('c_value', 6)} AS c_value, {r('pmi', 6)} AS pmi, {r('score', 6)} AS score FROM p)""", *needs)
    ORACLES[f"{name}_ranked_keywords"] = with_(f"""SELECT * FROM (WITH {made},
      k AS (SELECT id, phrase, row_number() OVER (PARTITION BY id ORDER BY round(score, 6) DESC, phrase) AS place
            FROM (SELECT DISTINCT id, phrase FROM g) JOIN p USING (phrase) WHERE length(phrase) > 3)
      SELECT t.id AS {key}, coalesce(string_agg(phrase, ', ' ORDER BY place), 'general') AS keywords
      FROM t LEFT JOIN k ON t.id = k.id AND place <= 5 GROUP BY t.id)""", *needs)


# Word weights from labelled documents; those whose doc_id 5 divides are held out.
_LEXICON = """w AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(coalesce(text, '')), '\\p{L}{2,}|[^\\p{L}\\p{N} \\t\\n\\r\\f]+'))) AS word
  FROM documents),
l AS (SELECT DISTINCT d.doc_id, quality FROM documents d JOIN labels USING (doc_id) WHERE doc_id % 5 <> 0),
n AS (
  SELECT word, count(*) FILTER (WHERE quality = 1) AS n_good, count(*) FILTER (WHERE quality <> 1) AS n_bad
  FROM w JOIN l USING (doc_id) GROUP BY word),
x AS (
  SELECT word, n_good, n_bad, ln((n_good + 1) / (good + size)) - ln((n_bad + 1) / (bad + size)) AS weight
  FROM n, (SELECT sum(n_good) AS good, sum(n_bad) AS bad, count(*) AS size FROM n) WHERE n_good + n_bad >= 3),
k AS (SELECT doc_id, count(*) AS n_known, avg(weight) AS mean FROM w JOIN x USING (word) GROUP BY doc_id),
m AS (
  SELECT coalesce((avg(mean) FILTER (WHERE quality = 1) + avg(mean) FILTER (WHERE quality <> 1)) / 2, 0) AS middle
  FROM k JOIN l USING (doc_id)),
s AS (
  SELECT doc_id, coalesce(n_known, 0) AS n_known, POLARITY AS polarity
  FROM (SELECT DISTINCT doc_id FROM documents) LEFT JOIN k USING (doc_id), m)""".replace(
    "POLARITY", r("coalesce(mean - middle, 0)", 6))
ORACLES["quality_lexicon"] = f"WITH {_LEXICON} SELECT word, n_good, n_bad, {r('weight', 6)} AS weight FROM x"
ORACLES["document_quality_sentiment"] = f"""WITH {_LEXICON} SELECT *,
  CASE WHEN polarity > 0 THEN 'positive' WHEN polarity < 0 THEN 'negative' ELSE 'neutral' END AS label FROM s"""
ORACLES["quality_sentiment_agreement"] = f"""WITH {_LEXICON},
h AS (SELECT polarity > 0 AS said, quality = 1 AS good FROM s JOIN labels USING (doc_id) WHERE doc_id % 5 = 0)
SELECT good, count(*) AS n, count(*) FILTER (WHERE said = good) AS n_right,
  {r(pct('count(*) FILTER (WHERE said = good)', 'count(*)'))} AS right_pct FROM h GROUP BY good"""
phrases("ticket", "tickets", "ticket_id", "description", 4, 2, "tickets")
phrases("document", "documents", "doc_id", "text", 3, 3)
_WORDS = ", ".join(f"({q(w)}, {p}::DOUBLE, {s}::DOUBLE)" for w, (p, s) in LEXICON.items())
_STRENGTH = ", ".join(f"({q(w)}, {f}::DOUBLE)" for w, f in INTENSIFIERS.items())


def scored(source: str, key: str, text: str) -> str:
    """(key, polarity, subjectivity) per row of source, by joining the words with the lexicon."""
    turned = f"lx.p * CASE WHEN prev IN ({', '.join(map(q, NEGATIONS))}) THEN -0.5 ELSE coalesce(st.f, 1) END"
    kept = f"avg(greatest(-1, least(1, {turned}))) FILTER (WHERE lx.p IS NOT NULL)"
    return f"""SELECT d.{key}, coalesce({r(kept, 6)}, 0) AS polarity,
      coalesce({r('avg(lx.s)', 6)}, 0) AS subjectivity
    FROM {source} d
    LEFT JOIN (SELECT {key}, word, lag(word) OVER (PARTITION BY {key} ORDER BY pos) AS prev
          FROM (SELECT {key}, unnest(words) AS word, unnest(range(len(words))) AS pos
                FROM (SELECT {key}, regexp_extract_all(lower({text}), '[a-z]+') AS words FROM {source}))) w
      ON w.{key} = d.{key} AND w.word IN (SELECT word FROM (VALUES {_WORDS}) v(word, p, s))
    LEFT JOIN (VALUES {_WORDS}) lx(word, p, s) ON w.word = lx.word
    LEFT JOIN (VALUES {_STRENGTH}) st(word, f) ON w.prev = st.word
    GROUP BY 1"""


def label(x: str) -> str:
    return f"CASE WHEN {x} > 0.1 THEN 'positive' WHEN {x} < -0.1 THEN 'negative' ELSE 'neutral' END"


REVIEWED = f"""SELECT v.review_id, v.merchant_id, v.rating, s.polarity, s.subjectivity,
  {label('s.polarity')} AS sentiment, v.review_text
  FROM reviews v JOIN ({scored('reviews', 'review_id', 'review_text')}) s ON v.review_id = s.review_id"""
oracle("review_sentiment", REVIEWED, "reviews")
oracle("sentiment_counts", f"SELECT sentiment AS label, count(*) AS n FROM ({REVIEWED}) GROUP BY 1", "reviews")
MOOD = f"""SELECT merchant_id, count(*) AS review_count, {r('avg(rating)', 4)} AS avg_rating,
  {r('avg(polarity)', 4)} AS avg_polarity, {r('avg(subjectivity)', 4)} AS avg_subjectivity,
  {n("sentiment = 'positive'")} AS positive_count, {n("sentiment = 'negative'")} AS negative_count,
  {n("sentiment = 'neutral'")} AS neutral_count FROM ({REVIEWED}) GROUP BY 1"""
oracle("merchant_sentiment", MOOD, "reviews")
oracle("merchant_sentiment_page", f"""SELECT s.*, m.merchant_name, m.category, m.city FROM ({MOOD}) s
  JOIN merchants m ON s.merchant_id = m.merchant_id ORDER BY avg_polarity DESC, s.merchant_id LIMIT 25""",
       "reviews", "merchants")
oracle("sentiment_extremes", f"""
(SELECT 'best' AS kind, merchant_id, avg_polarity FROM ({MOOD}) ORDER BY avg_polarity DESC, merchant_id LIMIT 3)
UNION ALL
(SELECT 'worst' AS kind, merchant_id, avg_polarity FROM ({MOOD}) ORDER BY avg_polarity, merchant_id LIMIT 3)""", "reviews")
oracle("insight_sentiment", f"""SELECT {r('coalesce(avg(avg_polarity), 0)', 3)} AS avg_polarity,
  CAST(sum(positive_count) AS BIGINT) AS positive, CAST(sum(negative_count) AS BIGINT) AS negative FROM ({MOOD})""", "reviews")


def has_any(words: list[str]) -> str:
    return "(" + " OR ".join(f"contains(lower(description), {q(w)})" for w in words) + ")"


_POINTS = f"""(CASE WHEN priority = 'High' THEN 3 ELSE 0 END
  + CASE issue_type WHEN 'Fraud Alert' THEN 2 WHEN 'Account Access' THEN 2 WHEN 'Payment Failed' THEN 1 ELSE 0 END
  + CASE WHEN {has_any(URGENT_WORDS)} THEN 2 ELSE 0 END)"""
URGENCY = f"CASE WHEN {_POINTS} >= 4 THEN 'critical' WHEN {_POINTS} >= 2 THEN 'high' ELSE 'normal' END"
_TAGS = "[" + ", ".join(f"CASE WHEN {has_any(ws)} THEN {q(t)} END" for t, ws in TOPICS.items()) + "]"
TAGGED = f"coalesce(nullif(array_to_string(list_filter({_TAGS}, lambda x: x IS NOT NULL), ', '), ''), 'general')"
_MARKED = (r"regexp_replace(regexp_replace(lower(description), '[^a-z ]+', '|', 'g'), "
           rf"'\b(?:{'|'.join(STOP_WORDS)})\b', '|', 'g')")
PHRASES = (f"coalesce(nullif(array_to_string(list_filter(list_transform(string_split({_MARKED}, '|'), "
           "lambda p: trim(regexp_replace(p, ' +', ' ', 'g'))), lambda p: length(p) > 3)[1:5], ', '), ''), 'general')")
oracle("ticket_urgency", f"SELECT ticket_id, issue_type, priority, {URGENCY} AS urgency FROM tickets", "tickets")
oracle("ticket_topics", f"SELECT ticket_id, {TAGGED} AS topics FROM tickets", "tickets")
oracle("ticket_keywords", f"SELECT ticket_id, {PHRASES} AS keywords FROM tickets", "tickets")
TICKETS = f"""SELECT t.ticket_id, t.issue_type, s.polarity AS sentiment, {label('s.polarity')} AS polarity_label,
  {URGENCY} AS urgency, {PHRASES} AS keywords, {TAGGED} AS topics
  FROM tickets t JOIN ({scored('tickets', 'ticket_id', 'description')}) s ON t.ticket_id = s.ticket_id"""
oracle("ticket_nlp", TICKETS, "tickets")
oracle("urgency_counts", f"SELECT urgency AS label, count(*) AS n FROM ({TICKETS}) GROUP BY 1", "tickets")
oracle("report_tickets", f"""SELECT issue_type, count(*) AS ticket_count, {r('avg(sentiment)', 3)} AS avg_sentiment,
  {r(pct(n("urgency = 'critical'"), n()), 1)} AS critical_pct FROM ({TICKETS}) GROUP BY 1""", "tickets")

# -------------------------------------------------------------------- insights
on_tx("insight_kpis", f"""SELECT {n()} AS total_txns, {r(f"coalesce({total('amount', OK)}, 0)")} AS total_revenue,
  {n(HIT)} AS fraud_count, {r(f"coalesce({mean('amount', OK)}, 0)")} AS avg_txn_value FROM transactions""")
on_tx("insight_top_category", f"""SELECT category, {n()} AS txns, {r(total('amount', OK))} AS revenue
  FROM transactions WHERE {last_days(30)} GROUP BY 1 ORDER BY revenue DESC NULLS LAST, category LIMIT 1""")
on_tx("insight_weekend_lift", f"""SELECT a AS weekend_revenue, b AS weekday_revenue,
  {r('(a / greatest(b, 1) - 1) * 100')} AS weekend_lift,
  {r('(a / 2 / greatest(b / 5, 1) - 1) * 100')} AS weekend_lift_per_day
  FROM (SELECT {r(f"coalesce({total('amount', OK + ' AND weekend_flag = 1')}, 0)")} AS a,
          {r(f"coalesce({total('amount', OK + ' AND weekend_flag = 0')}, 0)")} AS b
        FROM transactions WHERE {last_days(30)})""")
on_tx("insight_top_payment", f"""SELECT payment_method, {n()} AS txns, {r(total('amount'))} AS amount
  FROM transactions WHERE {OK} GROUP BY 1 ORDER BY txns DESC, payment_method LIMIT 1""")
on_tx("insight_refund_rate", f"SELECT {r(pct(n(BACK), n()))} AS refund_rate FROM transactions")

# ---------------------------------------------------------------------- report
REPORT = f"""SELECT {n()} AS total_txns, {r(f"coalesce({total('amount', OK)}, 0)")} AS total_revenue,
  {n(HIT)} AS fraud_count, count(DISTINCT customer_id) AS unique_customers, count(DISTINCT merchant_id) AS unique_merchants,
  {r(pct(n(HIT), n()))} AS fraud_rate, {r(f"coalesce({total('amount', OK)}, 0) / greatest(count(*), 1)")} AS avg_ticket
  FROM transactions"""
on_tx("report_kpis", REPORT)
_CARDS = {
    "Revenue": "'₹' || printf('%.2f', total_revenue / 1e6) || 'M'",
    "Transactions": "format('{:,}', total_txns)",
    "Customers": "format('{:,}', unique_customers)",
    "Merchants": "format('{:,}', unique_merchants)",
    "Fraud Rate": "printf('%.2f', fraud_rate) || '%'",
    "Fraud Count": "format('{:,}', fraud_count)",
    "Avg Ticket": "'₹' || printf('%.2f', avg_ticket)",
    "Active Today": "'—'",
}
on_tx("report_kpi_cards", "\nUNION ALL ".join(
    f"SELECT {q(k)} AS label, {v} AS \"value\" FROM ({REPORT})" for k, v in _CARDS.items()))
oracle("report_merchants", f"""SELECT merchant_name, category, city, revenue, total_txns, fraud_pct FROM ({PERFORMANCE})
  ORDER BY revenue DESC, merchant_id LIMIT 10""", TX, "merchants")


PLACES = {"revenue": "revenue", "success": "coalesce(ok_pct, 0)", "kept": "100 - refund_pct", "honest": "100 - fraud_pct"}
PLACED = ", ".join(f"percent_rank() OVER (ORDER BY {x}) AS {n}_rank" for n, x in PLACES.items())
oracle("merchant_percentiles", f"""SELECT merchant_id, {", ".join(f"{r(f'{n}_rank', 4)} AS {n}_rank" for n in PLACES)},
  CASE WHEN total_txns > 0 THEN {r('40 * revenue_rank + 30 * success_rank + 15 * kept_rank + 15 * honest_rank')} ELSE 0 END AS merchant_score
  FROM (SELECT p.merchant_id, total_txns, {PLACED}
    FROM ({PERFORMANCE}) p LEFT JOIN (SELECT merchant_id, {r(pct(n(OK), n()), 4)} AS ok_pct FROM transactions GROUP BY 1) s
    ON p.merchant_id = s.merchant_id)""", TX, "merchants")

# --------------------------------------------------------------------- outlook
GROWN = f"""SELECT merchant_id, {MONTH} AS "month", {r(total('amount'))} AS revenue
  FROM transactions WHERE {OK} GROUP BY 1, 2"""
on_tx("merchant_growth", f"""SELECT *, {r('(revenue - previous_revenue) / nullif(previous_revenue, 0) * 100')} AS growth_pct
  FROM (SELECT a.*, b.revenue AS previous_revenue FROM ({GROWN}) a LEFT JOIN ({GROWN}) b
        ON a.merchant_id = b.merchant_id AND b."month" = CAST(a."month" - INTERVAL 1 MONTH AS DATE))""")
on_tx("rapid_repeat_payments", f"""SELECT transaction_id, customer_id, merchant_id, "timestamp", amount,
  {r('epoch("timestamp" - previous) / 60')} AS gap_minutes
  FROM (SELECT *, lag("timestamp") OVER (PARTITION BY customer_id, merchant_id
          ORDER BY "timestamp", transaction_id) AS previous FROM transactions)
  WHERE epoch("timestamp" - previous) <= 1440 * 60""")
on_tx("repeat_transactions", """SELECT merchant_id, count(*) AS customers, count(*) FILTER (WHERE p >= 2) AS repeat_customers,
  CAST(coalesce(sum(p) FILTER (WHERE p >= 2), 0) AS BIGINT) AS repeat_purchases
  FROM (SELECT merchant_id, customer_id, count(*) AS p FROM transactions WHERE status = 'Success' GROUP BY 1, 2) GROUP BY 1""")
on_tx("hour_weekday_heatmap", "SELECT transaction_hour, " + ", ".join(
    n(f'dayofweek("timestamp") = {i}') + f" AS {d}" for i, d in enumerate("sun mon tue wed thu fri sat".split()))
    + f" FROM transactions WHERE {HIT} GROUP BY 1")
on_tx("regional_summary", f"""SELECT state, city, CAST(grouping(state, city) AS INTEGER) AS level, {n()} AS transactions,
  {r(total('amount'))} AS volume, {r(pct(n(OK), n()))} AS success_rate FROM transactions GROUP BY ROLLUP (state, city)""")


def outliers(key: str, measure: str, least: int, z: float) -> str:
    return f"""SELECT * FROM (SELECT {key}, transactions, "value",
        {r('("value" - avg("value") OVER ()) / nullif(stddev_pop("value") OVER (), 0)', 4)} AS z_score
      FROM (SELECT {key}, count(*) AS transactions, {r(measure, 4)} AS "value" FROM transactions
            WHERE {key} IS NOT NULL GROUP BY 1 HAVING count(*) >= {least})) WHERE z_score >= {z}"""


on_tx("unusual_customers", outliers("customer_id", mean("amount"), 5, 2.0))
on_tx("high_risk_merchants", outliers("merchant_id", pct(n(HIT), n()), 20, 1.5))
oracle("revenue_contribution", f"""SELECT merchant_id, category, revenue,
  {r(pct('revenue', 'sum(revenue) OVER ()'), 4)} AS share_pct,
  {r(pct('revenue', 'sum(revenue) OVER (PARTITION BY category)'), 4)} AS category_share_pct
  FROM ({PERFORMANCE})""", TX, "merchants")
oracle("churn_risk_merchants", f"""SELECT m.merchant_id, m.merchant_name, recent_txns, prior_txns
  FROM merchants m JOIN (SELECT merchant_id,
      {n(f'"timestamp" >= {AS_OF} - INTERVAL 30 DAY')} AS recent_txns,
      {n(f'"timestamp" < {AS_OF} - INTERVAL 30 DAY')} AS prior_txns
    FROM transactions WHERE {last_days(60)} GROUP BY 1) v ON m.merchant_id = v.merchant_id
  WHERE m.status = 'Active' AND recent_txns * 2 < prior_txns""", TX, "merchants")
oracle("geo_mismatch", f"""SELECT c.city AS home_city, count(*) AS transactions, {n('t.city <> c.city')} AS away,
  {r(pct(n('t.city <> c.city'), n()))} AS away_pct, {n('t.city <> c.city AND is_fraud = 1')} AS away_fraud
  FROM transactions t JOIN customers c ON t.customer_id = c.customer_id GROUP BY 1""", TX, "customers")
on_tx("outlier_treatment", """SELECT transaction_id, t.category, amount,
  least(greatest(amount, low), high) AS amount_treated FROM transactions t
  JOIN (SELECT category, quantile_disc(amount, 0.01) AS low, quantile_disc(amount, 0.99) AS high
        FROM transactions GROUP BY 1) q ON t.category = q.category""")

# ------------------------------------------- model consumers over repeatable input
oracle("flagged_page", f"""SELECT t.transaction_id, CAST(1 AS INTEGER) AS model_prediction,
  customer_merchant_distance AS model_score, amount, "timestamp", t.status, risk_level, customer_name, merchant_name
  FROM transactions t JOIN customers c ON t.customer_id = c.customer_id JOIN merchants m ON t.merchant_id = m.merchant_id
  WHERE {GUESS} ORDER BY model_score DESC, t.transaction_id LIMIT 25""", TX, "customers", "merchants")
on_tx("flagged_total", f"SELECT count(*) AS total FROM transactions WHERE {GUESS}")
_RULE = SEGMENTS[SEGMENTS.index("CASE"):SEGMENTS.index(" AS segment")]
_RECENCY = f"coalesce(floor(epoch({AS_OF} + INTERVAL 1 DAY - last_txn) / 86400), 999)"
PROFILE = f"""SELECT {_RULE} AS segment_name, count(*) AS customer_count, {r('avg(total_spend)')} AS avg_spend,
  {r('avg(total_txns)', 1)} AS avg_transactions, {r('avg(unique_merchants)', 1)} AS avg_merchants,
  {r(f'avg({_RECENCY})', 1)} AS avg_recency_days FROM ({SUMMARY}) GROUP BY 1"""
oracle("segment_profile", PROFILE, TX, "customers")
_TITLED = "array_to_string(list_transform(string_split(segment_name, '_'), lambda w: upper(w[1]) || w[2:]), ' ')"
oracle("report_rule_segments", f"""SELECT {_TITLED} AS segment, customer_count, avg_spend, avg_transactions
  FROM ({PROFILE})""", TX, "customers")
_PARAGRAPHS = {
    "revenue_overview": "'Total platform revenue stands at ₹' || printf('%.2f', total_revenue / 1e6) || 'M across ' || "
    "format('{:,}', total_txns) || ' transactions, with an average ticket size of ₹' || printf('%.2f', avg_txn_value) || "
    "'. The ' || category || ' category continues to drive the highest share of revenue at ₹' || "
    "printf('%.1f', revenue / 1e3) || 'K.'",
    "fraud_risk": "'Fraud detection flagged ' || format('{:,}', fraud_count) || ' transactions (' || "
    "printf('%.2f', fraud_count * 100.0::DOUBLE / total_txns) || '%). The ML model (Isolation Forest) shows ' || "
    "printf('%.1f', agreement_pct) || '% alignment with heuristic rules, providing robust dual-layer protection. "
    "High-risk hours remain concentrated in the 00:00–04:00 window.'",
    "weekend_behavior": "'Weekend transaction volume ' || CASE WHEN weekend_lift > 0 THEN 'increased' ELSE 'decreased' END "
    "|| ' by ' || printf('%.1f', abs(weekend_lift)) || '% compared to weekdays over the trailing 30-day period, "
    "indicating ' || CASE WHEN weekend_lift > 0 THEN 'strong leisure-driven spending' ELSE 'weaker weekend engagement' END "
    "|| '.'",
    "payment_trends": "payment_method || ' remains the dominant payment method. UPI continues rapid adoption among "
    "mobile-first users, while credit card usage is concentrated in high-ticket Electronics and Travel categories.'",
    "merchant_health": "'Platform-wide refund rate is ' || printf('%.2f', refund_rate) || '%. NLP sentiment analysis "
    "across merchant reviews reveals an average polarity of ' || printf('%+.3f', avg_polarity) || ', with ' || "
    "CAST(negative AS VARCHAR) || ' negative reviews flagged for follow-up.'",
    "customer_segments": "'The ''' || segment_name || ''' segment leads in value, comprising ' || "
    "format('{:,}', customer_count) || ' customers. Dormant user reactivation and luxury-spender retention remain the "
    "highest-ROI levers for revenue growth.'",
}
_WE, _WD = total("amount", OK + " AND weekend_flag = 1"), total("amount", OK + " AND weekend_flag = 0")
_FACTS = f"""(SELECT {n()} AS total_txns, {r(total('amount', OK))} AS total_revenue, {n(HIT)} AS fraud_count,
    {r(mean('amount', OK))} AS avg_txn_value, {r(pct(n(BACK), n()))} AS refund_rate,
    {pct(n(f'({HIT}) = {GUESS}'), n())} AS agreement_pct FROM transactions),
  (SELECT category, {r(total('amount', OK))} AS revenue FROM transactions WHERE {last_days(30)} GROUP BY 1
    ORDER BY revenue DESC NULLS LAST, category LIMIT 1),
  (SELECT ({_WE} / {_WD} - 1) * 100 AS weekend_lift FROM transactions WHERE {last_days(30)}),
  (SELECT payment_method FROM transactions WHERE {OK} GROUP BY 1 ORDER BY count(*) DESC, payment_method LIMIT 1),
  (SELECT {r('avg(avg_polarity)', 3)} AS avg_polarity, sum(negative_count) AS negative FROM ({MOOD})),
  (SELECT segment_name, customer_count FROM ({PROFILE}) ORDER BY avg_spend DESC, segment_name LIMIT 1)"""
oracle("executive_summaries_rules", "\nUNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS id, {q(topic)} AS topic, {text} AS summary FROM {_FACTS}"
    for i, (topic, text) in enumerate(_PARAGRAPHS.items(), 1)), TX, "customers", "reviews")


# ------------------------------------------------------- texts of the given tables
def told(source: str, key: str) -> str:
    """Polarity, subjectivity and label of the texts of a table with one key column."""
    return f"SELECT {key}, polarity, subjectivity, {label('polarity')} AS sentiment FROM ({scored(source, key, 'text')})"


def ruled(text: str) -> str:
    """The ticket rules over another column."""
    return (f"{TAGGED} AS topics, {PHRASES} AS keywords, {has_any(URGENT_WORDS)} AS urgent"
            .replace("lower(description)", f"lower(coalesce({text}, ''))"))


ORACLES["document_sentiment"] = told("documents", "doc_id")
ORACLES["document_rules"] = f"SELECT doc_id, {ruled('text')} FROM documents"
TALK = "(SELECT *, conv_id * 1000000 + turn AS k FROM conversations)"
TOLD = f"SELECT conv_id, turn, role, polarity, subjectivity, sentiment FROM {TALK} c JOIN ({told(TALK, 'k')}) s ON c.k = s.k"
ORACLES["conversation_sentiment"] = TOLD
ORACLES["conversation_rules"] = f"SELECT conv_id, turn, {ruled('text')} FROM conversations"
ORACLES["role_sentiment"] = f"""SELECT role, sentiment, count(*) AS n, {r('avg(polarity)', 4)} AS avg_polarity
  FROM ({TOLD}) GROUP BY 1, 2"""
ORACLES["document_terms"] = """SELECT term, count(DISTINCT doc_id) AS documents, count(*) AS occurrences
  FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '\\p{L}{2,}')) AS term FROM documents)
  GROUP BY 1"""


def fold(key: str) -> str:
    return f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8) AS BIGINT) % 5 = 0"


ORACLES["complaint_split"] = f"SELECT {fold('doc_id')} AS held_out, toxic AS label, count(*) AS n FROM labels GROUP BY 1, 2"
on_tx("supervised_fraud_split", f"SELECT {fold('transaction_id')} AS held_out, is_fraud AS label, count(*) AS n FROM transactions GROUP BY 1, 2")
on_tx("supervised_fraud_confusion", f"""SELECT {fold('transaction_id')} AS held_out, is_fraud AS label,
  CAST(CASE WHEN risk_level = 'High' THEN 1 ELSE 0 END AS INTEGER) AS predicted, count(*) AS n FROM transactions GROUP BY 1, 2, 3""")

for name, key_, other, alias in (("merchants", "merchant_id", "customer_id", "unique_customers"),
                                 ("customers", "customer_id", "merchant_id", "unique_merchants")):
    on_tx(f"refreshed_{name}", f"""SELECT {key_}, {n()} AS total_txns, {r(f"coalesce({total('amount', OK)}, 0)")} AS revenue,
      count(DISTINCT {other}) AS {alias}, {r(pct(n(OK), n()), 4)} AS success_pct, {r(pct(n(BACK), n()), 4)} AS refund_pct,
      {r(pct(n(HIT), n()), 4)} AS fraud_pct, max("timestamp") AS last_txn FROM transactions GROUP BY 1""")

SCORED = f"""SELECT {fold('transaction_id')} AS held_out, is_fraud AS label, amount AS probability,
  transaction_hour / 100.0::DOUBLE AS hour FROM transactions"""
BY_AMOUNT = f"""SELECT held_out, probability AS s, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg
  FROM ({SCORED}) GROUP BY 1, 2"""
on_tx("ranking_given", f"""SELECT held_out, CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives,
  round(CAST(sum(pos * (2 * (below - neg) + neg)) AS DOUBLE) / nullif(2.0::DOUBLE * sum(pos) * sum(neg), 0), 9) AS auc,
  round(CAST(sum(pos * (tp::DOUBLE / (tp + fp))) AS DOUBLE) / nullif(sum(pos), 0), 9) AS average_precision
  FROM (SELECT *, sum(neg) OVER (PARTITION BY held_out ORDER BY s) AS below,
          sum(pos) OVER (PARTITION BY held_out ORDER BY s DESC) AS tp, sum(neg) OVER (PARTITION BY held_out ORDER BY s DESC) AS fp
        FROM ({BY_AMOUNT})) GROUP BY 1""")
on_tx("precision_recall_given", f"""SELECT held_out, hour AS score, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
  round(tp::DOUBLE / (tp + fp), 9) AS "precision",
  round(tp::DOUBLE / nullif(sum(pos) OVER (PARTITION BY held_out), 0), 9) AS recall
  FROM (SELECT held_out, hour, pos, sum(pos) OVER down AS tp, sum(neg) OVER down AS fp
        FROM (SELECT held_out, hour, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg
              FROM ({SCORED}) GROUP BY 1, 2) WINDOW down AS (PARTITION BY held_out ORDER BY hour DESC))""")
# The isotonic fit at i is the largest, over starts a <= i, of the smallest mean of a to b, over ends b >= i.
on_tx("calibration_given", f"""SELECT * FROM (WITH c AS (SELECT round(hour, 4) AS score, count(*) AS n, count(*) FILTER (WHERE label = 1) AS positives
    FROM ({SCORED}) GROUP BY 1),
  u AS (SELECT *, sum(n) OVER (ORDER BY score) AS cn, sum(positives) OVER (ORDER BY score) AS cp FROM c),
  m AS (SELECT i.score, a.score AS first, min((b.cp - a.cp + a.positives)::DOUBLE / (b.cn - a.cn + a.n)) AS lowest
    FROM u i JOIN u a ON a.score <= i.score JOIN u b ON b.score >= i.score GROUP BY 1, 2)
  SELECT u.score, u.n, u.positives, round(max(lowest), 9) AS calibrated FROM u JOIN m ON m.score = u.score GROUP BY 1, 2, 3)""")

# ------------------------------------------------------------------ single lookups
oracle("transaction_by_id", f"SELECT * FROM ({NAMED}) WHERE transaction_id = 'TXN000000013'", TX, "customers", "merchants")
oracle("merchant_by_id", f"SELECT * FROM ({DIRECTORY}) WHERE merchant_id = 'MER00001'", TX, "merchants")
oracle("customer_by_id", f"SELECT * FROM ({RECENT}) WHERE customer_id = 'CUST00001'", TX, "merchants")

# ----------------------------------------------------------------------- dirty rows
_SPOILT = """SELECT transaction_id, CASE WHEN k % 7 = 0 THEN 'CUST-none' ELSE customer_id END AS customer_id,
  CASE WHEN k % 11 <> 0 THEN merchant_id END AS merchant_id, CASE WHEN k % 13 <> 0 THEN amount END AS amount,
  lower(trim(payment_method)) AS payment_method, CASE WHEN k % 17 <> 0 THEN "timestamp" END AS "timestamp", status
  FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY
          CASE WHEN k % 17 = 0 THEN 'yesterday' ELSE strftime("timestamp", '%Y-%m-%d %H:%M:%S') END,
          CASE WHEN k % 7 = 0 THEN 'CUST-none' ELSE customer_id END, merchant_id,
          CASE WHEN k % 13 = 0 THEN 'n/a' ELSE CAST(amount AS VARCHAR) END, payment_method, status, device_type) AS nth
        FROM (SELECT *, CAST(substr(transaction_id, 4) AS BIGINT) AS k FROM transactions0) WHERE k % 11 <> 0)
  WHERE nth = 1"""
DIRTY = f"SELECT *, CAST(hour(\"timestamp\") AS INTEGER) AS txn_hour FROM ({_SPOILT})"
oracle("dirty_transactions", DIRTY, "transactions0")
oracle("dirty_orphans", f"""SELECT count(*) AS n, {n("customer_id = 'CUST-none'")} AS orphans, {n('amount IS NULL')} AS no_amount,
  {n('"timestamp" IS NULL')} AS no_time FROM ({DIRTY})""", "transactions0")

# ------------------------------------------------ models over given nodes, centres, scores
# The mean path among n rows is 2 H(n - 1) - 2 (n - 1) / n, with H(m) = ln m + Euler's constant.
_PATH = "2 * (ln(255) + 0.5772156649015329) - 2 * 255 / 256.0"
_FIRST = "CASE WHEN amount <= 30000 THEN 2.0 WHEN transaction_hour <= 11.5 THEN 3.5 ELSE 2.5 END"
_SECOND = "CASE WHEN transaction_hour <= 4.5 THEN 1.0 ELSE 4.0 END"
on_tx("forest_scores_given", f"""SELECT transaction_id,
  round(pow(2.0, -(({_FIRST} + {_SECOND}) / 2.0) / ({_PATH})), 9) AS score FROM transactions""")
on_tx("forest_threshold_given", """SELECT * FROM (WITH s AS (
    SELECT customer_merchant_distance / 200 AS score FROM transactions WHERE customer_merchant_distance / 200 > 0),
  q AS (SELECT quantile_cont(score, 0.985) AS cut FROM s)
  SELECT round(any_value(cut), 9) AS cut, count(*) FILTER (WHERE score > cut) AS flagged FROM s, q)""")
oracle("segments_given_centres", f"""SELECT customer_id,
  CAST(CASE WHEN abs(round(coalesce(total_spend, 0) / 1000) - 500) <= abs(round(coalesce(total_spend, 0) / 1000) - 1500)
    THEN 0 ELSE 1 END AS INTEGER) AS segment_id FROM ({SUMMARY})""", TX, "customers")
on_tx("forecast_union_given", f"""SELECT * FROM (WITH h AS (
    SELECT CAST("timestamp" AS DATE) AS ds, CAST(count(*) AS DOUBLE) AS txns, {r(total('amount', OK))} AS revenue
    FROM transactions GROUP BY 1)
  SELECT 'transactions' AS metric, ds, txns AS y, 'history' AS kind FROM h
  UNION ALL SELECT 'revenue', ds, revenue, 'history' FROM h
  UNION ALL SELECT 'revenue', CAST((SELECT max(ds) FROM h) + CAST(i AS INTEGER) AS DATE), 1000.0, 'forecast' FROM range(1, 31) g(i))""")
