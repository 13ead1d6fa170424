"""Shared CTEs of the check SQL: the five entities, silver form, for DuckDB."""

from __future__ import annotations

from tillscope import fixtures, schemas

AS_OF = "DATE '2001-08-01'"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def lst(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def r(x: str, places: int = 2) -> str:
    """Half-away rounding through a decimal."""
    return f"CAST(round(CAST(({x}) AS DECIMAL(30,8)), {places}) AS DOUBLE)"


def pct(part: str, whole: str) -> str:
    return f"coalesce(CAST({part} AS DOUBLE) * 100.0 / nullif({whole}, 0), 0)"


def key(prefix: str, number: str, width: int) -> str:
    t = f"CAST({number} AS VARCHAR)"
    return f"{q(prefix)} || lpad({t}, CAST(greatest({width}, length({t})) AS INTEGER), '0')"


def fill(template: str, **values: str) -> str:
    for name, value in values.items():
        template = f"replace({template}, {q('{' + name + '}')}, {value})"
    return template


_MEAN = "CAST(12000 + (c_custkey % 100) * 300 AS DOUBLE)"

CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, *needs: str, sql: str) -> None:
    CTES[name] = (needs, sql)


cte("customers0", sql=f"""
SELECT {key('CUST', 'c_custkey', 5)} AS customer_id, c_name AS customer_name,
  '  ' || upper(c_name) || '@Example.com ' AS email, {key('9', 'c_custkey', 9)} AS phone,
  n_name AS city, r_name AS state,
  CAST((c_custkey * 37) % 101 AS DOUBLE) AS x_customer_id,
  CAST((c_custkey * 53 + 11) % 101 AS DOUBLE) AS y_customer_id,
  {_MEAN} AS mean_amount, {_MEAN} / 2 AS std_amount,
  CAST(c_custkey % 40 AS DOUBLE) / 10 AS mean_nb_tx_per_day,
  CAST(DATE '1993-01-01' + CAST(c_custkey % 700 AS INTEGER) AS DATE) AS registration_date,
  {lst(schemas.DEVICES)}[CAST(c_custkey % 3 + 1 AS INTEGER)] AS device_preference
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")

cte("merchants0", sql=f"""
SELECT {key('MER', 's_suppkey', 5)} AS merchant_id, s_name AS merchant_name,
  {lst(schemas.CATEGORIES)}[CAST(s_suppkey % 10 + 1 AS INTEGER)] AS category,
  n_name AS city, r_name AS state,
  CAST((s_suppkey * 61 + 7) % 101 AS DOUBLE) AS x_merchant_id,
  CAST((s_suppkey * 29 + 3) % 101 AS DOUBLE) AS y_merchant_id,
  CAST(10 + (s_suppkey * 17) % 85 AS INTEGER) AS risk_score,
  CAST(DATE '1992-01-01' + CAST(s_suppkey % 900 AS INTEGER) AS DATE) AS registration_date,
  CAST(50 + (s_suppkey * 13) % 950 AS DOUBLE) AS avg_transaction_value,
  CASE WHEN s_suppkey % 11 = 0 THEN 'Inactive' ELSE 'Active' END AS status
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")

cte("transactions0", sql=f"""
SELECT {key('TXN', 'l_orderkey * 10 + l_linenumber', 9)} AS transaction_id,
  {key('CUST', 'o_custkey', 5)} AS customer_id, {key('MER', 'l_suppkey', 5)} AS merchant_id,
  l_extendedprice AS amount,
  [' Credit Card', 'Debit Card ', 'UPI', 'Net Banking', 'Wallet'][CAST(left(o_orderpriority, 1) AS INTEGER)] AS payment_method,
  l_shipdate + to_hours(CAST((l_orderkey * 7 + l_linenumber * 5) % 24 AS INTEGER)) AS "timestamp",
  CASE WHEN (l_orderkey + l_linenumber) % 50 = 0 THEN 'Refunded'
       WHEN l_returnflag = 'A' AND l_linenumber <= 2 THEN 'Failed' ELSE 'Success' END AS status,
  {lst(schemas.DEVICES)}[CAST(l_linenumber % 3 + 1 AS INTEGER)] AS device_type
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")

cte("customers", "customers0", sql="""
SELECT customer_id, trim(customer_name) AS customer_name, lower(trim(email)) AS email, phone, city, state,
  x_customer_id, y_customer_id, mean_amount, std_amount, mean_nb_tx_per_day, registration_date, device_preference
FROM customers0 WHERE customer_id IS NOT NULL AND email IS NOT NULL""")

cte("merchants", "merchants0", sql="""
SELECT merchant_id, trim(merchant_name) AS merchant_name, trim(category) AS category, city, state,
  x_merchant_id, y_merchant_id, risk_score, registration_date, avg_transaction_value, status
FROM merchants0 WHERE merchant_id IS NOT NULL""")

cte("clean", "transactions0", sql="""
SELECT transaction_id, customer_id, merchant_id, amount, lower(trim(payment_method)) AS payment_method,
  "timestamp", status, lower(trim(device_type)) AS device_type,
  CAST(hour("timestamp") AS INTEGER) AS txn_hour,
  CASE WHEN dayofweek("timestamp") IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN amount > 5000 THEN 1 ELSE 0 END AS is_high_value,
  CASE WHEN hour("timestamp") BETWEEN 0 AND 4 THEN 1 ELSE 0 END AS is_late_night
FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id
        ORDER BY "timestamp" NULLS LAST, customer_id NULLS LAST, merchant_id NULLS LAST, amount NULLS LAST,
                 payment_method NULLS LAST, status NULLS LAST, device_type NULLS LAST) AS version
      FROM transactions0)
WHERE version = 1 AND transaction_id IS NOT NULL AND customer_id IS NOT NULL AND merchant_id IS NOT NULL""")

cte("scored", "clean", "customers", "merchants", sql=f"""
SELECT b.*, CAST(date_trunc('month', "timestamp") AS DATE) AS txn_month,
  CAST(points / 100.0 AS DOUBLE) AS fraud_score,
  CASE WHEN points < 20 THEN 'Low' WHEN points < 45 THEN 'Medium' ELSE 'High' END AS risk_level,
  {r('raw_distance')} AS customer_merchant_distance
FROM (SELECT a.*,
        CAST((CASE WHEN amount > 3 * mean_amount THEN 30 ELSE 0 END)
           + (CASE WHEN txn_hour <= 4 THEN 20 ELSE 0 END)
           + (CASE WHEN raw_distance > 50 THEN 25 ELSE 0 END)
           + (CASE WHEN merchant_risk > 70 THEN 15 ELSE 0 END) AS INTEGER) AS points
      FROM (SELECT t.transaction_id, c.customer_id, m.merchant_id, t.amount, t.payment_method,
              m.category, m.city, m.state, t."timestamp", t.status, t.device_type,
              t.txn_hour, t.is_weekend, t.is_high_value, t.is_late_night,
              c.mean_amount, m.risk_score AS merchant_risk,
              sqrt((x_customer_id - x_merchant_id) ** 2 + (y_customer_id - y_merchant_id) ** 2) AS raw_distance
            FROM clean t LEFT JOIN customers c ON t.customer_id = c.customer_id
            LEFT JOIN merchants m ON t.merchant_id = m.merchant_id) a) b""")

cte("transactions", "scored", sql="""
SELECT transaction_id, customer_id, merchant_id, amount, payment_method, category, city, state, "timestamp",
  status, device_type, points AS fraud_points, fraud_score, risk_level, txn_hour AS transaction_hour,
  is_weekend AS weekend_flag, customer_merchant_distance, txn_hour, is_weekend, is_high_value, is_late_night,
  txn_month,
  CASE WHEN row_number() OVER (ORDER BY points DESC, transaction_id)
         <= (SELECT greatest(1, floor(CAST(0.015 AS DOUBLE) * count(*))) FROM scored) THEN 1 ELSE 0 END AS is_fraud
FROM scored""")

_TEXTS = [t for stars in sorted(fixtures.REVIEW_TEXTS) for t in fixtures.REVIEW_TEXTS[stars]]
cte("reviews0", "scored", "merchants", sql=f"""
SELECT {key('REV', 'order_key', 9)} AS review_id, transaction_id, customer_id, o.merchant_id,
  CAST(1 + order_key % 5 AS INTEGER) AS rating,
  {fill(f"{lst(_TEXTS)}[CAST((order_key % 5) * 3 + (order_key // 5) % 3 + 1 AS INTEGER)]",
        merchant="coalesce(merchant_name, 'Unknown Merchant')",
        category="coalesce(m.category, 'General')", city="coalesce(m.city, 'Unknown')")}
    || '\\nRef ' || CAST(order_key AS VARCHAR) AS review_text, "timestamp"
FROM (SELECT *, CAST(substr(transaction_id, 4) AS BIGINT) // 10 AS order_key FROM scored
      QUALIFY row_number() OVER (PARTITION BY CAST(substr(transaction_id, 4) AS BIGINT) // 10
                                 ORDER BY CAST(substr(transaction_id, 4) AS BIGINT)) = 1) o
LEFT JOIN merchants m ON o.merchant_id = m.merchant_id""")

cte("reviews", "reviews0", sql="""
SELECT review_id, transaction_id, customer_id, merchant_id, rating,
  replace(review_text, '\\n', ' ') AS review_text, "timestamp",
  CAST(length(replace(review_text, '\\n', ' ')) AS INTEGER) AS review_length FROM reviews0""")

cte("tickets0", sql=f"""
SELECT {key('TKT', 'o_orderkey', 9)} AS ticket_id, {key('CUST', 'o_custkey', 5)} AS customer_id,
  {lst(schemas.ISSUES)}[CAST(o_orderkey % 5 + 1 AS INTEGER)] AS issue_type,
  {fill(f"{lst([fixtures.TICKET_TEXTS[i] for i in schemas.ISSUES])}[CAST(o_orderkey % 5 + 1 AS INTEGER)]",
        amount="CAST(CAST(trunc(o_totalprice) AS BIGINT) AS VARCHAR)",
        date="strftime(o_orderdate, '%Y-%m-%d')", days="CAST(1 + o_orderkey % 14 AS VARCHAR)")}
    || '\\nRef ' || CAST(o_orderkey AS VARCHAR) AS description,
  ['Open', 'Resolved', 'Escalated'][CAST(o_orderkey % 3 + 1 AS INTEGER)] AS status,
  CASE WHEN o_orderkey % 7 = 0 THEN 'High' WHEN o_orderkey % 7 <= 2 THEN 'Low' ELSE 'Medium' END AS priority,
  o_orderdate AS "timestamp"
FROM orders""")

cte("tickets", "tickets0", sql="""
SELECT ticket_id, customer_id, issue_type, replace(description, '\\n', ' ') AS description, status, priority,
  "timestamp", CAST(length(replace(description, '\\n', ' ')) AS INTEGER) AS description_length FROM tickets0""")


def with_(body: str, *needs: str) -> str:
    """The query with the CTEs it needs, in dependency order."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for need in CTES[name][0]:
                visit(need)
            if name not in order:
                order.append(name)

    for need in needs:
        visit(need)
    parts = ",\n".join(f"{name} AS ({CTES[name][1]})" for name in order)
    return f"WITH {parts}\n{body}" if parts else body
