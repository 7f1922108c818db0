"""The queries again in plain SQL over the same tables, written line by line from
the definitions rather than from the way the operators compute them."""

from __future__ import annotations

_ORDERS = """
orders_s AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
    CASE WHEN o_orderstatus = 'F' THEN 'delivered' ELSE lower(o_orderstatus) END AS order_status,
    o_orderdate AS order_purchase_ts,
    o_orderdate + INTERVAL 1 DAY AS order_approved_ts,
    CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 3 DAY END AS order_delivered_carrier_ts,
    CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 9 DAY END AS order_delivered_customer_ts,
    o_orderdate + INTERVAL 20 DAY AS order_estimated_delivery_ts
  FROM orders)"""

_ITEMS = """
items_p AS (
  SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS price_,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS freight_
  FROM lineitem),
items_s AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS BIGINT) AS order_item_id,
    CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
    l_shipdate AS shipping_limit_ts, price_ AS price, freight_ AS freight_value,
    CAST(price_ + freight_ AS DECIMAL(18,2)) AS revenue, l_returnflag
  FROM items_p)"""

_CUSTOMERS = """
customers_s AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, 'U' || CAST(c_custkey // 2 AS VARCHAR) AS customer_unique_id,
    lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
    n_name AS customer_city, r_name AS customer_state
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

_TX = """
tx AS (
  SELECT o.customer_id, i.order_id, i.product_id, i.revenue, CAST(o.order_purchase_ts AS DATE) AS order_date,
    c.customer_unique_id, strftime(o.order_purchase_ts, '%Y-%m') AS year_month
  FROM items_s i JOIN orders_s o ON o.order_id = i.order_id AND o.order_status = 'delivered'
  JOIN customers_s c ON c.customer_id = o.customer_id)"""

_MODEL = """
dim_customer_s AS (
  SELECT DISTINCT customer_unique_id AS customer_key, customer_id, customer_unique_id, customer_city, customer_state
  FROM customers_s WHERE customer_unique_id IS NOT NULL),
dim_date_s AS (
  SELECT DISTINCT CAST(order_purchase_ts AS DATE) AS date_key, strftime(order_purchase_ts, '%Y-%m') AS year_month,
    CAST(year(order_purchase_ts) AS INTEGER) AS year, CAST(month(order_purchase_ts) AS INTEGER) AS month,
    CAST(day(order_purchase_ts) AS INTEGER) AS day
  FROM orders_s WHERE order_purchase_ts IS NOT NULL),
fact_orders_s AS (
  SELECT o.order_id, c.customer_unique_id AS customer_key, o.order_status, CAST(o.order_purchase_ts AS DATE) AS order_date
  FROM orders_s o JOIN customers_s c ON c.customer_id = o.customer_id WHERE o.order_purchase_ts IS NOT NULL),
fact_items_s AS (SELECT order_id, order_item_id, product_id, revenue FROM items_s)"""

_RFM_TX = """
rfm AS (
  SELECT customer_unique_id AS customer_id,
    CAST(date_diff('day', max(order_date), (SELECT max(order_date) FROM tx)) AS INTEGER) AS recency_days,
    count(DISTINCT order_id) AS frequency, CAST(sum(revenue) AS DECIMAL(18,2)) AS monetary,
    max(order_date) AS last_order_date
  FROM tx GROUP BY 1)"""

_DAILY = """
daily AS (
  SELECT order_date, CAST(sum(revenue) AS DECIMAL(18,2)) AS revenue, count(DISTINCT order_id) AS orders
  FROM tx GROUP BY 1)"""

_CUSTOMER_ORDERS = """
customer_orders_s AS (
  SELECT c.customer_unique_id AS customer_id, o.order_id, CAST(o.order_purchase_ts AS DATE) AS order_date,
    CAST(sum(coalesce(i.revenue, 0)) AS DECIMAL(18,2)) AS order_revenue
  FROM orders_s o JOIN customers_s c ON c.customer_id = o.customer_id
  LEFT JOIN items_s i ON i.order_id = o.order_id
  WHERE lower(o.order_status) = 'delivered' AND o.order_purchase_ts IS NOT NULL AND c.customer_unique_id IS NOT NULL
  GROUP BY 1, 2, 3)"""

# The definition taken literally: every customer's history against every snapshot.
_SNAPSHOTS = """
span AS (SELECT CAST(min(order_date) + INTERVAL 120 DAY AS DATE) AS s, CAST(max(order_date) - INTERVAL 30 DAY AS DATE) AS e
  FROM customer_orders_s),
snaps AS (
  SELECT CAST(m AS DATE) AS snapshot_date
  FROM (SELECT unnest(generate_series(date_trunc('month', s), CAST(e AS TIMESTAMP), INTERVAL 1 MONTH)) AS m, s, e FROM span)
  WHERE CAST(m AS DATE) BETWEEN s AND e),
hist AS (
  SELECT snapshot_date, customer_id, max(order_date) AS last_order_date, min(order_date) AS first_order_date,
    count(DISTINCT order_id) AS orders_lifetime, CAST(sum(order_revenue) AS DOUBLE) AS monetary_lifetime,
    count(DISTINCT CASE WHEN date_diff('day', order_date, snapshot_date) < 30 THEN order_id END) AS frequency_30d,
    count(DISTINCT CASE WHEN date_diff('day', order_date, snapshot_date) < 90 THEN order_id END) AS frequency_90d,
    CAST(sum(CASE WHEN date_diff('day', order_date, snapshot_date) < 30 THEN order_revenue ELSE 0 END) AS DOUBLE) AS monetary_30d,
    CAST(sum(CASE WHEN date_diff('day', order_date, snapshot_date) < 90 THEN order_revenue ELSE 0 END) AS DOUBLE) AS monetary_90d
  FROM customer_orders_s JOIN snaps ON order_date <= snapshot_date GROUP BY 1, 2),
future AS (
  SELECT DISTINCT snapshot_date, customer_id FROM customer_orders_s
  JOIN snaps ON order_date > snapshot_date AND date_diff('day', snapshot_date, order_date) <= 30),
ds AS (
  SELECT h.customer_id, h.snapshot_date, last_order_date, first_order_date,
    CAST(date_diff('day', last_order_date, h.snapshot_date) AS INTEGER) AS recency_days,
    CAST(date_diff('day', first_order_date, h.snapshot_date) AS INTEGER) AS tenure_days,
    orders_lifetime, frequency_30d, frequency_90d, monetary_30d, monetary_90d, monetary_lifetime,
    monetary_lifetime / orders_lifetime AS avg_order_value_lifetime,
    CASE WHEN f.customer_id IS NULL THEN 0 ELSE 1 END AS target_1
  FROM hist h LEFT JOIN future f ON f.snapshot_date = h.snapshot_date AND f.customer_id = h.customer_id
  WHERE date_diff('day', last_order_date, h.snapshot_date) <= 120 AND orders_lifetime >= 2)"""

_BASELINE = """
person_orders AS (
  SELECT c.customer_unique_id AS customer_id, o.order_id, CAST(o.order_purchase_ts AS DATE) AS order_date
  FROM orders_s o JOIN customers_s c ON c.customer_id = o.customer_id WHERE o.order_status = 'delivered'),
days AS (
  SELECT order_date, row_number() OVER (ORDER BY order_date) - 1 AS pos, count(*) OVER () AS n
  FROM (SELECT DISTINCT order_date FROM person_orders)),
cut AS (SELECT order_date AS cutoff FROM days WHERE pos = CAST(floor(CAST(n AS DOUBLE) * CAST(0.7 AS DOUBLE)) AS BIGINT)),
past AS (
  SELECT customer_id, max(order_date) AS last_order_date, count(DISTINCT order_id) AS frequency
  FROM person_orders, cut WHERE order_date <= cutoff GROUP BY 1),
fut AS (SELECT customer_id, min(order_date) AS next_order_date FROM person_orders, cut WHERE order_date > cutoff GROUP BY 1),
ev0 AS (
  SELECT p.customer_id, last_order_date, frequency, CAST(date_diff('day', last_order_date, cutoff) AS INTEGER) AS recency_days,
    next_order_date, CAST(date_diff('day', cutoff, next_order_date) AS INTEGER) AS days_to_next
  FROM past p LEFT JOIN fut f ON f.customer_id = p.customer_id, cut),
ev AS (
  SELECT *, CASE WHEN days_to_next IS NULL OR days_to_next > 90 THEN 1 ELSE 0 END AS is_churn,
    CAST(0.75 AS DOUBLE) * (CAST(recency_days - min(recency_days) OVER () AS DOUBLE) / (max(recency_days) OVER () - min(recency_days) OVER ()))
    + CAST(0.25 AS DOUBLE) * (1 - CAST(frequency - min(frequency) OVER () AS DOUBLE) / (max(frequency) OVER () - min(frequency) OVER ())) AS score
  FROM ev0),
scored AS (SELECT customer_id, is_churn AS y, score FROM ev)"""

_RETAIL = ",".join([_ORDERS, _ITEMS, _CUSTOMERS])


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


_TX_ALL = _with(_RETAIL, _TX)
_RFM_ALL = _with(_RETAIL, _TX, _RFM_TX)
_DAILY_ALL = _with(_RETAIL, _TX, _DAILY)
_MODEL_ALL = _with(_RETAIL, _MODEL)
_SNAP_ALL = _with(_RETAIL, _CUSTOMER_ORDERS, _SNAPSHOTS)
_EV_ALL = _with(_RETAIL, _BASELINE)

_RUN = "TIMESTAMP '2024-01-01 00:00:00'"
_OLD = "TIMESTAMP '2001-09-01 00:00:00'"

_RFM_SCORE = """
norms AS (
  SELECT *, CASE WHEN max(recency_days) OVER () = min(recency_days) OVER () THEN 0 ELSE
      CAST(recency_days - min(recency_days) OVER () AS DOUBLE) / (max(recency_days) OVER () - min(recency_days) OVER ()) END AS r,
    CAST(frequency - min(frequency) OVER () AS DOUBLE) / (max(frequency) OVER () - min(frequency) OVER ()) AS f,
    CAST(monetary - min(monetary) OVER () AS DOUBLE) / CAST(max(monetary) OVER () - min(monetary) OVER () AS DOUBLE) AS m
  FROM rfm),
rs AS (SELECT *, CAST(0.6 AS DOUBLE) * r + CAST(0.25 AS DOUBLE) * (1 - f) + CAST(0.15 AS DOUBLE) * (1 - m) AS raw FROM norms),
scored_rfm AS (
  SELECT *, greatest(0.0, least(1.0, raw)) AS s,
    CASE WHEN raw >= 0.67 THEN 'HIGH' WHEN raw >= 0.34 THEN 'MEDIUM' ELSE 'LOW' END AS churn_label FROM rs)"""

_EDGES = """
edges AS (
  SELECT list_distinct(q) AS u, list_sort(list_distinct(q)) AS e FROM (
    SELECT quantile_cont(score, [0.0,0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9,1.0]) AS q FROM scored)),
binned AS (
  SELECT y, score, 1 + len(list_filter(list_slice(e, 2, len(e) - 1), lambda x: x < score)) AS bin FROM scored, edges)"""

_METRICS_BY = """
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY score DESC, k1, k2) AS rn,
    count(*) OVER (PARTITION BY g ORDER BY score DESC) AS at_or_above,
    sum(y) OVER (PARTITION BY g ORDER BY score DESC) AS pos_at_or_above,
    rank() OVER (PARTITION BY g ORDER BY score) + (count(*) OVER (PARTITION BY g, score) - 1) / 2.0 AS mid_rank,
    count(*) OVER (PARTITION BY g) AS n, sum(y) OVER (PARTITION BY g) AS p
  FROM in_rows),
metrics AS (
  SELECT g, CAST(max(n) AS DOUBLE) AS n, CAST(max(p) AS DOUBLE) AS p,
    CASE WHEN max(p) > 0 AND max(p) < max(n) THEN
      (sum(CASE WHEN y = 1 THEN CAST(mid_rank AS DOUBLE) ELSE 0 END) - max(p) * (max(p) + 1) / 2.0)
      / (CAST(max(p) AS DOUBLE) * (max(n) - max(p))) END AS auc,
    CASE WHEN max(p) > 0 AND max(p) < max(n) THEN
      sum(CASE WHEN y = 1 THEN CAST(pos_at_or_above AS DOUBLE) / at_or_above ELSE 0 END) / max(p) END AS pr_auc,
    avg(CASE WHEN rn <= greatest(1, CAST(floor(CAST(n AS DOUBLE) * CAST(0.1 AS DOUBLE)) AS BIGINT)) THEN CAST(y AS DOUBLE) END) AS top_rate
  FROM ranked GROUP BY g)"""

_CANDIDATES = """
ordered_snaps AS (
  SELECT snapshot_date, row_number() OVER (ORDER BY snapshot_date) AS rn, count(*) OVER () AS n
  FROM (SELECT DISTINCT snapshot_date FROM ds)),
splits AS (
  SELECT snapshot_date, CASE WHEN rn > n - least(5, greatest(1, n - 2)) THEN 'holdout' ELSE 'train' END AS split FROM ordered_snaps),
rows_ AS (
  SELECT CASE WHEN split = 'holdout' THEN 'holdout' ELSE 'cv_fold_' || strftime(ds.snapshot_date, '%Y_%m') END AS split_name, ds.*
  FROM ds JOIN splits ON splits.snapshot_date = ds.snapshot_date),
in_rows AS (
  SELECT 'recent_buyers|' || split_name AS g, customer_id AS k1, snapshot_date AS k2, target_1 AS y,
    1 - CAST(recency_days AS DOUBLE) / CAST(120 AS DOUBLE) AS score FROM rows_
  UNION ALL
  SELECT 'frequent_buyers|' || split_name, customer_id, snapshot_date, target_1,
    CAST(orders_lifetime AS DOUBLE) / (CAST(tenure_days AS DOUBLE) + CAST(30 AS DOUBLE)) FROM rows_)"""

_LONG = """
long AS (
  SELECT split_part(g, '|', 1) AS model_name, split_part(g, '|', 2) AS split_name, m.metric_name, m.metric_value
  FROM (SELECT g, unnest([
    {'metric_name': 'auc', 'metric_value': auc}, {'metric_name': 'pr_auc', 'metric_value': pr_auc},
    {'metric_name': 'precision_at_k', 'metric_value': top_rate},
    {'metric_name': 'lift_at_k', 'metric_value': CASE WHEN p > 0 THEN top_rate / (p / n) END},
    {'metric_name': 'positive_rate', 'metric_value': p / n}, {'metric_name': 'sample_size', 'metric_value': n}]) AS m FROM metrics)
  WHERE m.metric_value IS NOT NULL)"""

_LATEST_LINE = """
  SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_ts, price, freight_value, revenue FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id, order_item_id ORDER BY shipping_limit_ts DESC, product_id DESC,
      seller_id DESC, price DESC, freight_value DESC, revenue DESC) AS rn FROM items_s WHERE l_returnflag <> '{flag}') WHERE rn = 1"""


def _upsert(tgt: str, src: str, keys: list[str], values: list[str], touch_matched: bool) -> str:
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    picked = ", ".join(f"CASE WHEN s.{keys[0]} IS NOT NULL THEN s.{v} ELSE t.{v} END AS {v}" for v in values)
    touched = f"s.{keys[0]} IS NOT NULL" + ("" if touch_matched else f" AND t.{keys[0]} IS NULL")
    key_cols = ", ".join(f"coalesce(t.{k}, s.{k}) AS {k}" for k in keys)
    return (
        f", tgt AS ({tgt}), src AS ({src}) SELECT {key_cols}, {picked}, "
        f"CASE WHEN {touched} THEN {_RUN} ELSE {_OLD} END AS updated_at FROM tgt t FULL JOIN src s ON {on}"
    )


_ORDER_VALUES = [
    "customer_id", "order_status", "order_purchase_ts", "order_approved_ts", "order_delivered_carrier_ts",
    "order_delivered_customer_ts", "order_estimated_delivery_ts",
]
_ITEM_VALUES = ["product_id", "seller_id", "shipping_limit_ts", "price", "freight_value", "revenue"]
_CUSTOMER_VALUES = ["customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"]

# The 19 thresholds.
_THRESHOLD_ROWS = ", ".join(
    f"(CAST({t} AS DOUBLE))"
    for t in "0.05 0.1 0.15 0.2 0.25 0.3 0.35 0.4 0.45 0.5 0.55 0.6 0.65 0.7 0.75 0.8 0.85 0.9 0.95".split()
)


def _rounded(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


_SNAP_KEYS = """customer_id, snapshot_date, last_order_date, first_order_date, recency_days, tenure_days, orders_lifetime,
  frequency_30d, frequency_90d, target_1"""

_WINSOR = """
limits AS (
  SELECT {limits} FROM ds),
clipped AS (
  SELECT customer_id, snapshot_date, last_order_date, first_order_date, recency_days, tenure_days, orders_lifetime,
    frequency_30d, frequency_90d, target_1, {clips} FROM ds, limits)""".format(
    limits=", ".join(
        f"quantile_cont({c}, 0.01) AS {c}_lo, quantile_cont({c}, 0.99) AS {c}_hi"
        for c in ("monetary_30d", "monetary_90d", "monetary_lifetime", "avg_order_value_lifetime")
    ),
    clips=", ".join(
        f"greatest({c}_lo, least({c}_hi, {c})) AS {c}"
        for c in ("monetary_30d", "monetary_90d", "monetary_lifetime", "avg_order_value_lifetime")
    ),
)

ORACLES: dict[str, str] = {
    "kpi_monthly_tx": _TX_ALL + """
SELECT year_month, CAST(sum(revenue) AS DECIMAL(18,2)) AS revenue, count(DISTINCT order_id) AS orders,
  count(DISTINCT customer_unique_id) AS unique_customers FROM tx GROUP BY 1""",
    "kpi_daily_tx": _DAILY_ALL + " SELECT * FROM daily",
    "kpi_rfm_tx": _RFM_ALL + " SELECT * FROM rfm",
    "kpi_monthly_model": _MODEL_ALL + """
SELECT d.year_month, CAST(sum(i.revenue) AS DECIMAL(18,2)) AS revenue, count(DISTINCT o.order_id) AS orders,
  count(DISTINCT o.customer_key) AS unique_customers
FROM fact_orders_s o JOIN fact_items_s i ON i.order_id = o.order_id JOIN dim_date_s d ON d.date_key = o.order_date
WHERE o.order_status = 'delivered' GROUP BY 1""",
    "kpi_daily_model": _MODEL_ALL + """
SELECT o.order_date, CAST(sum(i.revenue) AS DECIMAL(18,2)) AS revenue, count(DISTINCT o.order_id) AS orders
FROM fact_orders_s o JOIN fact_items_s i ON i.order_id = o.order_id WHERE o.order_status = 'delivered' GROUP BY 1""",
    "kpi_rfm_model": _MODEL_ALL + """,
base AS (SELECT customer_key AS customer_id, max(order_date) AS last_order_date, count(DISTINCT order_id) AS frequency
  FROM fact_orders_s WHERE order_status = 'delivered' GROUP BY 1),
mon AS (SELECT o.customer_key AS customer_id, sum(i.revenue) AS monetary
  FROM fact_orders_s o JOIN fact_items_s i ON i.order_id = o.order_id WHERE o.order_status = 'delivered' GROUP BY 1)
SELECT b.customer_id, CAST(date_diff('day', b.last_order_date,
    (SELECT max(order_date) FROM fact_orders_s WHERE order_status = 'delivered')) AS INTEGER) AS recency_days,
  b.frequency, CAST(m.monetary AS DECIMAL(18,2)) AS monetary, b.last_order_date
FROM base b JOIN mon m USING (customer_id)""",
    "transaction_lines": _TX_ALL
    + " SELECT customer_id, order_id, product_id, revenue, order_date, customer_unique_id, year_month FROM tx",
    "silver_orders": _with(_ORDERS) + " SELECT * FROM orders_s",
    "silver_items": _with(_ITEMS) + " SELECT * EXCLUDE (l_returnflag) FROM items_s",
    "silver_customers": _with(_CUSTOMERS) + " SELECT * FROM customers_s",
    "dim_customer": _MODEL_ALL + f" SELECT *, {_RUN} AS updated_at FROM dim_customer_s",
    "dim_date": _MODEL_ALL + " SELECT * FROM dim_date_s",
    "fact_orders": _MODEL_ALL + f" SELECT *, {_RUN} AS updated_at FROM fact_orders_s",
    "fact_order_items": _MODEL_ALL + f" SELECT *, {_RUN} AS updated_at FROM fact_items_s",
    "upsert_orders": _with(_ORDERS)
    + _upsert(
        """SELECT * REPLACE ('created' AS order_status, CAST(NULL AS TIMESTAMP) AS order_approved_ts)
           FROM orders_s WHERE order_status <> 'p'""",
        "SELECT * FROM orders_s WHERE order_status <> 'o'",
        ["order_id"],
        _ORDER_VALUES,
        True,
    ),
    "upsert_items": _with(_ITEMS)
    + _upsert(
        f"SELECT * REPLACE (CAST(NULL AS DECIMAL(18,2)) AS freight_value) FROM ({_LATEST_LINE.format(flag='N')})",
        _LATEST_LINE.format(flag="R"),
        ["order_id", "order_item_id"],
        _ITEM_VALUES,
        True,
    ),
    "upsert_customers": _with(_CUSTOMERS)
    + _upsert(
        "SELECT * REPLACE ('unknown' AS customer_city) FROM customers_s WHERE customer_state <> 'ASIA'",
        "SELECT * FROM customers_s WHERE customer_state <> 'EUROPE'",
        ["customer_id"],
        _CUSTOMER_VALUES,
        False,
    ),
    "dq_gold_rowcount": _RFM_ALL + "," + _DAILY + """,
monthly AS (SELECT year_month FROM tx GROUP BY 1)
SELECT 'KPI_MONTHLY_REVENUE rowcount > 0' AS check_name, CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END AS status, count(*) AS metric FROM monthly
UNION ALL SELECT 'KPI_DAILY_REVENUE rowcount > 0', CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END, count(*) FROM daily
UNION ALL SELECT 'KPI_CUSTOMER_RFM rowcount > 0', CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END, count(*) FROM rfm""",
    "dq_gold_notnull": _RFM_ALL + "," + _DAILY + """,
monthly AS (SELECT year_month FROM tx GROUP BY 1)
SELECT 'MONTHLY: YEAR_MONTH is NOT NULL' AS check_name, CASE WHEN sum(CASE WHEN year_month IS NULL THEN 1 ELSE 0 END) = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
  CAST(sum(CASE WHEN year_month IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_rows FROM monthly
UNION ALL SELECT 'DAILY: ORDER_DATE is NOT NULL', CASE WHEN sum(CASE WHEN order_date IS NULL THEN 1 ELSE 0 END) = 0 THEN 'PASS' ELSE 'FAIL' END,
  CAST(sum(CASE WHEN order_date IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM daily
UNION ALL SELECT 'RFM: CUSTOMER_ID is NOT NULL', CASE WHEN sum(CASE WHEN customer_id IS NULL THEN 1 ELSE 0 END) = 0 THEN 'PASS' ELSE 'FAIL' END,
  CAST(sum(CASE WHEN customer_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM rfm""",
    "dq_layer_counts": _MODEL_ALL + """
SELECT 'BRONZE.ORDERS_RAW' AS obj, count(*) AS row_count FROM orders
UNION ALL SELECT 'BRONZE.ORDER_ITEMS_RAW', count(*) FROM lineitem
UNION ALL SELECT 'BRONZE.CUSTOMERS_RAW', count(*) FROM customers_s
UNION ALL SELECT 'SILVER.ORDERS', count(*) FROM orders_s
UNION ALL SELECT 'SILVER.ORDER_ITEMS', count(*) FROM items_s
UNION ALL SELECT 'SILVER.CUSTOMERS', count(*) FROM customers_s
UNION ALL SELECT 'MODEL.DIM_CUSTOMER', count(*) FROM dim_customer_s
UNION ALL SELECT 'MODEL.DIM_DATE', count(*) FROM dim_date_s
UNION ALL SELECT 'MODEL.FACT_ORDERS', count(*) FROM fact_orders_s
UNION ALL SELECT 'MODEL.FACT_ORDER_ITEMS', count(*) FROM fact_items_s""",
    "dq_duplicate_items": _MODEL_ALL + """
SELECT 'MODEL.FACT_ORDER_ITEMS duplicate (ORDER_ID, ORDER_ITEM_ID)' AS check_name,
  CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status, count(*) AS dup_keys
FROM (SELECT order_id, order_item_id FROM fact_items_s GROUP BY 1, 2 HAVING count(*) > 1)""",
    "dq_referential": _MODEL_ALL + """
SELECT 'FACT_ORDERS missing DIM_CUSTOMER' AS check_name, CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status, count(*) AS bad_rows
FROM fact_orders_s f WHERE NOT EXISTS (SELECT 1 FROM dim_customer_s d WHERE d.customer_key = f.customer_key)
UNION ALL
SELECT 'FACT_ORDERS missing DIM_DATE', CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END, count(*)
FROM fact_orders_s f WHERE NOT EXISTS (SELECT 1 FROM dim_date_s d WHERE d.date_key = f.order_date)""",
    "fold_plan": _SNAP_ALL + "," + _CANDIDATES + """,
per_day AS (
  SELECT ds.snapshot_date AS d, count(*) AS n, sum(target_1) AS p, row_number() OVER (ORDER BY ds.snapshot_date) - 1 AS i
  FROM ds JOIN splits ON splits.snapshot_date = ds.snapshot_date WHERE split = 'train' GROUP BY 1),
folds AS (
  SELECT v.d, v.n, v.p, (SELECT min(d) FROM per_day) AS train_start,
    (SELECT sum(n) FROM per_day t WHERE t.d < v.d) AS train_rows, (SELECT sum(p) FROM per_day t WHERE t.d < v.d) AS train_positives
  FROM per_day v WHERE i >= 5)
SELECT 'cv_fold_' || CAST(row_number() OVER (ORDER BY d) AS VARCHAR) AS fold, train_start, d AS validation,
  CAST(train_rows AS BIGINT) AS train_rows, CAST(train_positives AS BIGINT) AS train_positives, n AS rows, CAST(p AS BIGINT) AS positives
FROM folds WHERE train_positives > 0 AND train_positives < train_rows""",
    "customer_features": _with(_ORDERS, _ITEMS) + """
SELECT o.customer_id, CAST(sum(coalesce(price, 0) + coalesce(freight_value, 0)) AS DECIMAL(18,2)) AS total_revenue,
  count(DISTINCT o.order_id) AS order_count, max(CAST(o.order_purchase_ts AS DATE)) AS last_order_date
FROM items_s i JOIN orders_s o ON o.order_id = i.order_id GROUP BY 1""",
    "customer_orders": _with(_RETAIL, _CUSTOMER_ORDERS) + " SELECT * FROM customer_orders_s",
    "churn_score_rfm": _RFM_ALL + "," + _RFM_SCORE + f"""
SELECT customer_id, (SELECT max(order_date) FROM tx) AS snapshot_date, CAST(s AS DECIMAL(9,6)) AS churn_score, churn_label,
  'scoring_rfm_v1' AS model_version, {_RUN} AS scored_at FROM scored_rfm""",
    "churn_score_legacy": _RFM_ALL + "," + _RFM_SCORE + f"""
SELECT customer_id, recency_days, frequency, monetary, CAST(s AS DECIMAL(9,6)) AS churn_score, churn_label, {_RUN} AS scored_at
FROM scored_rfm""",
    "label_churn_recency": _RFM_ALL + " SELECT *, CASE WHEN recency_days >= 90 THEN 1 ELSE 0 END AS is_churn FROM rfm",
    "daily_anomaly": _DAILY_ALL + f""",
z AS (SELECT *, (CAST(revenue AS DOUBLE) - avg(CAST(revenue AS DOUBLE)) OVER ()) / stddev_pop(CAST(revenue AS DOUBLE)) OVER () AS z FROM daily)
SELECT order_date, revenue, orders, CAST(z AS DECIMAL(18,6)) AS z_score, abs(z) >= 3.0 AS is_anomaly, {_RUN} AS scored_at FROM z""",
    "zscore_generic": """
SELECT order_key, total_price, round(z, 6) AS z_score, abs(z) >= 1.5 AS is_anomaly FROM (
  SELECT o_orderkey AS order_key, o_totalprice AS total_price,
    (o_totalprice - avg(o_totalprice) OVER ()) / stddev_pop(o_totalprice) OVER () AS z FROM orders)""",
    "forecast_ma7": _DAILY_ALL + """
SELECT round(avg(CAST(revenue AS DOUBLE)), 6) AS forecast FROM (SELECT * FROM daily ORDER BY order_date DESC LIMIT 7)""",
    "eval_cutoff": _EV_ALL + " SELECT cutoff, cutoff AS test_start, (SELECT max(order_date) FROM person_orders) AS test_end FROM cut",
    "eval_dataset": _EV_ALL + """
SELECT customer_id, last_order_date, frequency, recency_days, next_order_date, days_to_next, is_churn, round(score, 6) AS score FROM ev""",
    "snapshot_dataset": _SNAP_ALL
    + f" SELECT {_SNAP_KEYS}, {_rounded('monetary_30d', 'monetary_90d', 'monetary_lifetime', 'avg_order_value_lifetime')} FROM ds",
    "snapshot_split": _SNAP_ALL + "," + _CANDIDATES + """
SELECT ds.snapshot_date, split, count(*) AS customers, CAST(sum(target_1) AS BIGINT) AS positives
FROM ds JOIN splits ON splits.snapshot_date = ds.snapshot_date GROUP BY 1, 2""",
    "latest_snapshot": _SNAP_ALL + """
SELECT customer_id, snapshot_date, recency_days, target_1 FROM ds WHERE snapshot_date = (SELECT max(snapshot_date) FROM ds)""",
    "winsor_limits": _SNAP_ALL + "," + _WINSOR + " SELECT " + _rounded(
        *[f"{c}_{e}" for c in ("monetary_30d", "monetary_90d", "monetary_lifetime", "avg_order_value_lifetime") for e in ("lo", "hi")]
    ) + " FROM limits",
    "features_noise_reduced": _SNAP_ALL + "," + _WINSOR + f"""
SELECT {_SNAP_KEYS}, {_rounded('monetary_30d', 'monetary_90d', 'monetary_lifetime', 'avg_order_value_lifetime')},
  round(ln(1 + monetary_30d), 6) AS log_monetary_30d, round(ln(1 + monetary_90d), 6) AS log_monetary_90d,
  round(ln(1 + monetary_lifetime), 6) AS log_monetary_lifetime, round(ln(1 + avg_order_value_lifetime), 6) AS log_avg_order_value_lifetime,
  round(CAST(frequency_30d AS DOUBLE) - CAST(frequency_90d AS DOUBLE) / 3, 6) AS freq_delta_30_vs_90,
  round(monetary_30d - monetary_90d / 3, 6) AS monetary_delta_30_vs_90, round(monetary_90d / 90, 6) AS monetary_per_day_90d,
  round(CAST(orders_lifetime AS DOUBLE) / greatest(tenure_days, 1), 6) AS order_rate_lifetime
FROM clipped""",
    "eval_metrics_baseline": _EV_ALL + ", in_rows AS (SELECT 1 AS g, customer_id AS k1, 0 AS k2, y, score FROM scored)," + _METRICS_BY + """
SELECT round(auc, 6) AS auc, round(pr_auc, 6) AS pr_auc, round(top_rate, 6) AS precision_at_k,
  round(CASE WHEN p > 0 THEN top_rate / (p / n) ELSE 0 END, 6) AS lift_at_k, round(p / n, 6) AS positive_rate, n AS sample_size FROM metrics""",
    "best_threshold": _EV_ALL + f""",
t AS (SELECT * FROM (VALUES {_THRESHOLD_ROWS}) AS v(threshold)),
c AS (SELECT threshold, CAST(sum(CASE WHEN score >= threshold AND y = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
  CAST(sum(CASE WHEN score >= threshold THEN 1 ELSE 0 END) AS DOUBLE) AS hit, CAST(sum(y) AS DOUBLE) AS p FROM scored, t GROUP BY 1),
f AS (SELECT threshold, CASE WHEN hit > 0 THEN tp / hit ELSE 0 END AS pr, CASE WHEN p > 0 THEN tp / p ELSE 0 END AS re FROM c)
SELECT round(threshold, 6) AS threshold, round(f1, 6) AS f1 FROM (
  SELECT threshold, CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0 END AS f1 FROM f) ORDER BY f1 DESC, threshold LIMIT 1""",
    "decile_diagnostics": _EV_ALL + "," + _EDGES + """
SELECT bin AS decile, round(min(score), 6) AS min_score, round(max(score), 6) AS max_score, round(avg(score), 6) AS avg_score,
  round(avg(y), 6) AS positive_rate, count(*) AS sample_size FROM binned GROUP BY 1""",
    "calibration_bins": _EV_ALL + "," + _EDGES + """
SELECT bin, round(avg(score), 6) AS avg_pred, round(avg(y), 6) AS actual_rate, count(*) AS sample_size,
  round(abs(avg(score) - avg(y)), 6) AS abs_gap FROM binned GROUP BY 1""",
    "brier": _EV_ALL + " SELECT round(avg((score - y) * (score - y)), 6) AS brier_score FROM scored",
    "candidate_metrics": _SNAP_ALL + "," + _CANDIDATES + "," + _METRICS_BY + "," + _LONG + """
SELECT model_name, split_name, metric_name, round(metric_value, 6) AS metric_value FROM long""",
    "selection_score": _SNAP_ALL + "," + _CANDIDATES + "," + _METRICS_BY + "," + _LONG + """
SELECT model_name, round(CAST(0.5 AS DOUBLE) * avg(CASE WHEN split_name LIKE 'cv\\_fold%' ESCAPE '\\' AND metric_name = 'lift_at_k' THEN metric_value END)
  + CAST(0.4 AS DOUBLE) * max(CASE WHEN split_name = 'holdout' AND metric_name = 'lift_at_k' THEN metric_value END)
  + CAST(0.1 AS DOUBLE) * max(CASE WHEN split_name = 'holdout' AND metric_name = 'auc' THEN metric_value END), 6) AS selection_score
FROM long GROUP BY 1""",
    "baseline_report": _EV_ALL + ", in_rows AS (SELECT 1 AS g, customer_id AS k1, 0 AS k2, y, score FROM scored)," + _METRICS_BY + f"""
SELECT 'churn_baseline' AS model_name, 'v1' AS model_version, {_RUN} AS run_ts, CAST(NULL AS VARCHAR) AS split_name,
  CAST(NULL AS DATE) AS snapshot_start, CAST(NULL AS DATE) AS snapshot_end, cutoff AS train_cutoff, cutoff AS test_start,
  (SELECT max(order_date) FROM person_orders) AS test_end, m.metric_name, round(m.metric_value, 6) AS metric_value,
  'window_days=90, top_k_fraction=0.1' AS notes
FROM (SELECT unnest([
    {{'metric_name': 'auc', 'metric_value': auc}}, {{'metric_name': 'pr_auc', 'metric_value': pr_auc}},
    {{'metric_name': 'precision_at_k', 'metric_value': top_rate}}, {{'metric_name': 'lift_at_k', 'metric_value': top_rate / (p / n)}},
    {{'metric_name': 'sample_size', 'metric_value': n}}, {{'metric_name': 'churn_rate', 'metric_value': p / n}}]) AS m FROM metrics), cut""",
    "registry_choice": _SNAP_ALL + "," + _CANDIDATES + "," + _METRICS_BY + "," + _LONG + """,
sel AS (
  SELECT model_name, CAST(0.5 AS DOUBLE) * avg(CASE WHEN split_name LIKE 'cv\\_fold%' ESCAPE '\\' AND metric_name = 'lift_at_k' THEN metric_value END)
    + CAST(0.4 AS DOUBLE) * max(CASE WHEN split_name = 'holdout' AND metric_name = 'lift_at_k' THEN metric_value END)
    + CAST(0.1 AS DOUBLE) * max(CASE WHEN split_name = 'holdout' AND metric_name = 'auc' THEN metric_value END) AS selection_score
  FROM long GROUP BY 1)
SELECT sel.model_name, CASE WHEN selection_score = (SELECT max(selection_score) FROM sel) THEN 'CHAMPION' ELSE 'CHALLENGER' END AS status,
  'v1' AS model_version, """ + _RUN + """ AS run_ts, 'rules' AS notes, """ + ", ".join(
        f"round(CAST(max(CASE WHEN metric_name = '{m}' THEN metric_value END) AS DOUBLE), 6) AS holdout_{m}"
        for m in ("auc", "pr_auc", "lift_at_k", "precision_at_k", "positive_rate", "sample_size")
    ) + """
FROM sel JOIN long ON long.model_name = sel.model_name WHERE split_name = 'holdout' GROUP BY sel.model_name, selection_score""",
    "metric_table": _SNAP_ALL + "," + _CANDIDATES + "," + _METRICS_BY + "," + _LONG + """,
days AS (SELECT split_part(g, '|', 2) AS split_name, min(k2) AS snapshot_start, max(k2) AS snapshot_end FROM in_rows GROUP BY 1)
SELECT model_name, long.split_name, snapshot_start, snapshot_end, metric_name, round(CAST(metric_value AS DOUBLE), 6) AS metric_value,
  'v1' AS model_version, """ + _RUN + """ AS run_ts
FROM long JOIN days ON days.split_name = long.split_name""",
    "boundary_nulls": """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance, CAST(NULL AS VARCHAR) AS note FROM customer""",
    "load_orders_csv": _with(_ORDERS) + f"""
SELECT order_id, customer_id, order_status, CAST(order_purchase_ts AS VARCHAR) AS order_purchase_timestamp,
  CAST(order_approved_ts AS VARCHAR) AS order_approved_at, CAST(order_delivered_carrier_ts AS VARCHAR) AS order_delivered_carrier_date,
  CAST(order_delivered_customer_ts AS VARCHAR) AS order_delivered_customer_date,
  CAST(order_estimated_delivery_ts AS VARCHAR) AS order_estimated_delivery_date, {_RUN} AS ingested_at FROM orders_s""",
    "load_items_csv": _with(_ITEMS) + f"""
SELECT order_id, order_item_id, product_id, seller_id, CAST(shipping_limit_ts AS VARCHAR) AS shipping_limit_date, price, freight_value,
  {_RUN} AS ingested_at FROM items_s""",
    "load_customers_csv": _with(_CUSTOMERS) + f" SELECT *, {_RUN} AS ingested_at FROM customers_s",
    "raw_items_as_text": _with(_ITEMS) + """
SELECT order_id, CAST(order_item_id AS VARCHAR) AS order_item_id, product_id, seller_id,
  CAST(shipping_limit_ts AS VARCHAR) AS shipping_limit_date, CAST(price AS VARCHAR) AS price, CAST(freight_value AS VARCHAR) AS freight_value
FROM items_s""",
    "table_refresh": _RFM_ALL + " SELECT * REPLACE (CAST(monetary * 2 AS DECIMAL(18,2)) AS monetary) FROM rfm",
    "table_append": _DAILY_ALL + """
SELECT * FROM daily UNION ALL
SELECT DISTINCT CAST(order_purchase_ts AS DATE), CAST(NULL AS DECIMAL(18,2)), CAST(0 AS BIGINT) FROM orders_s
WHERE CAST(order_purchase_ts AS DATE) NOT IN (SELECT order_date FROM daily)""",
    "table_evolve": _with(_CUSTOMERS)
    + _upsert(
        """SELECT * REPLACE (CAST(NULL AS VARCHAR) AS customer_unique_id, CAST(NULL AS VARCHAR) AS customer_zip_code_prefix)
           FROM customers_s WHERE customer_state <> 'ASIA'""",
        "SELECT * FROM customers_s WHERE customer_state <> 'EUROPE'",
        ["customer_id"],
        _CUSTOMER_VALUES,
        False,
    ),
    "merge_arriving_orders": _with(_ORDERS) + f" SELECT *, {_RUN} AS updated_at FROM orders_s",
}

_REFERENTIAL = ORACLES["dq_referential"]
ORACLES["dq_missing_customer"] = f"SELECT * FROM ({_REFERENTIAL}) WHERE check_name LIKE '%DIM_CUSTOMER'"
ORACLES["dq_missing_date"] = f"SELECT * FROM ({_REFERENTIAL}) WHERE check_name LIKE '%DIM_DATE'"

ORACLES["repeat_labels"] = _EV_ALL + f"""
SELECT customer_id, CASE WHEN score >= (SELECT threshold FROM ({ORACLES["best_threshold"]})) THEN 'LIKELY_REPEAT'
  ELSE 'UNLIKELY_REPEAT' END AS churn_label FROM scored"""

# The SQL views say the same as the operators of the model variant.
ORACLES["view_monthly"] = ORACLES["kpi_monthly_model"]
ORACLES["view_daily"] = ORACLES["kpi_daily_model"]
ORACLES["view_rfm"] = ORACLES["kpi_rfm_model"]


def _positions(query: str, order: str) -> str:
    return f"SELECT *, row_number() OVER (ORDER BY {order}) - 1 AS position FROM ({ORACLES[query]})"


ORACLES["ordered_monthly"] = _positions("kpi_monthly_tx", "year_month")
ORACLES["ordered_rfm"] = _positions("kpi_rfm_tx", "monetary DESC NULLS LAST, customer_id DESC NULLS LAST")
ORACLES["ordered_layer_counts"] = _positions("dq_layer_counts", "obj")
ORACLES["ordered_deciles"] = _positions("decile_diagnostics", "decile DESC")

_HOLDOUT_RULE = (
    _SNAP_ALL + "," + _CANDIDATES + """,
scored AS (SELECT y, score, k2 FROM in_rows WHERE g = 'recent_buyers|holdout'),
period AS (SELECT min(k2) AS snapshot_start, max(k2) AS snapshot_end FROM scored),""" + _EDGES
)
_EXTENSION_NOTES = "'extension_cell: winsorize+log+trend+calibration' AS notes"

ORACLES["decile_rows"] = _HOLDOUT_RULE + f"""
SELECT 'recent_buyers' AS model_name, 'v1' AS model_version, {_RUN} AS run_ts, 'holdout' AS split_name, snapshot_start, snapshot_end,
  bin AS decile, round(min(score), 6) AS min_score, round(max(score), 6) AS max_score, round(avg(score), 6) AS avg_score,
  round(avg(y), 6) AS positive_rate, count(*) AS sample_size, 'rules' AS notes
FROM binned, period GROUP BY bin, snapshot_start, snapshot_end"""

ORACLES["extension_calibration"] = _HOLDOUT_RULE + f"""
SELECT 'recent_buyers' AS model_name, 'v1' AS model_version, {_RUN} AS run_ts, 'holdout_ext' AS split_name, bin,
  round(avg(score), 6) AS avg_pred, round(avg(y), 6) AS actual_rate, round(abs(avg(score) - avg(y)), 6) AS abs_gap,
  count(*) AS sample_size, {_EXTENSION_NOTES}
FROM binned GROUP BY bin"""

ORACLES["extension_metrics"] = _SNAP_ALL + "," + _CANDIDATES + "," + _METRICS_BY + "," + _LONG + f""",
rows_ext AS (SELECT * FROM in_rows WHERE g = 'recent_buyers|holdout'),
all_metrics AS (
  SELECT metric_name, CAST(metric_value AS DOUBLE) AS metric_value FROM long WHERE model_name = 'recent_buyers' AND split_name = 'holdout'
  UNION ALL SELECT 'brier_score', avg((score - y) * (score - y)) FROM rows_ext)
SELECT 'recent_buyers' AS model_name, 'holdout_ext' AS split_name, (SELECT min(k2) FROM rows_ext) AS snapshot_start,
  (SELECT max(k2) FROM rows_ext) AS snapshot_end, metric_name, round(metric_value, 6) AS metric_value, {_EXTENSION_NOTES}, {_RUN} AS run_ts
FROM all_metrics"""

# The 17 features in order.
_FEATURES = """recency_days frequency_30d frequency_90d monetary_30d monetary_90d orders_lifetime monetary_lifetime
avg_order_value_lifetime tenure_days log_monetary_30d log_monetary_90d log_monetary_lifetime log_avg_order_value_lifetime
freq_delta_30_vs_90 monetary_delta_30_vs_90 monetary_per_day_90d order_rate_lifetime""".split()


def _extended_scores() -> str:
    margin = " + ".join(f"(CAST({c} AS DOUBLE) - {j}) / 100 * (CAST({(-1) ** j} AS DOUBLE) / {j + 1})" for j, c in enumerate(_FEATURES))
    parts = " + ".join(f"1 / (1 + exp(-(CAST({slope} AS DOUBLE) * m - CAST(0.5 AS DOUBLE))))" for slope in (0.5, 1.0, 1.5))
    return _SNAP_ALL + "," + _WINSOR + f""",
wide AS (
  SELECT *, ln(1 + monetary_30d) AS log_monetary_30d, ln(1 + monetary_90d) AS log_monetary_90d,
    ln(1 + monetary_lifetime) AS log_monetary_lifetime, ln(1 + avg_order_value_lifetime) AS log_avg_order_value_lifetime,
    CAST(frequency_30d AS DOUBLE) - CAST(frequency_90d AS DOUBLE) / 3 AS freq_delta_30_vs_90,
    monetary_30d - monetary_90d / 3 AS monetary_delta_30_vs_90, monetary_90d / 90 AS monetary_per_day_90d,
    CAST(orders_lifetime AS DOUBLE) / greatest(tenure_days, 1) AS order_rate_lifetime
  FROM clipped),
margins AS (SELECT customer_id, snapshot_date, CAST(0.25 AS DOUBLE) + {margin} AS m FROM wide)
SELECT customer_id, snapshot_date, round(({parts}) / 3, 6) AS score FROM margins"""


ORACLES["extended_scores"] = _extended_scores()

ORACLES["bronze_loads"] = _with(_ORDERS) + f"""
SELECT order_id, order_status, {_RUN} AS ingested_at FROM orders_s
UNION ALL SELECT order_id, order_status, {_RUN} FROM orders_s WHERE order_status = 'o'"""

ORACLES["upsert_touched"] = _with(_ORDERS) + """
SELECT count(*) AS rows, CAST(1 AS BIGINT) AS merged, CAST(1 AS BIGINT) AS buckets_rewritten, CAST(0 AS BIGINT) AS rewritten_in_vain FROM orders_s"""
