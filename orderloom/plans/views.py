"""The gold views as SQL over the model tables, for readers who work in SQL.

They say the same as the ``model`` variants in ``operators.kpi``: items are summed
per order before the join, and RFM takes one pass over the facts.
"""

from __future__ import annotations

from orderloom.sources.tables import LayerTables

_SALES = """
  SELECT o.order_id, o.customer_key, o.order_date, i.revenue
  FROM {p}model.fact_orders o
  JOIN (SELECT order_id, sum(revenue) AS revenue FROM {p}model.fact_order_items GROUP BY order_id) i
    ON i.order_id = o.order_id
  WHERE o.order_status = 'delivered'"""

GOLD_VIEWS = {
    "gold.v_kpi_monthly_revenue": """
SELECT d.year_month, CAST(sum(s.revenue) AS decimal(18,2)) AS revenue, count(DISTINCT s.order_id) AS orders,
  count(DISTINCT s.customer_key) AS unique_customers
FROM (""" + _SALES + """) s JOIN {p}model.dim_date d ON d.date_key = s.order_date
GROUP BY d.year_month ORDER BY d.year_month""",
    "gold.v_kpi_daily_revenue": """
SELECT s.order_date, CAST(sum(s.revenue) AS decimal(18,2)) AS revenue, count(DISTINCT s.order_id) AS orders
FROM (""" + _SALES + """) s GROUP BY s.order_date ORDER BY s.order_date""",
    "gold.v_kpi_customer_rfm": """
WITH profiles AS (
  SELECT o.customer_key, max(o.order_date) AS last_order_date, count(DISTINCT o.order_id) AS frequency,
    sum(i.revenue) AS monetary, count(i.order_id) AS matched
  FROM {p}model.fact_orders o
  LEFT JOIN (SELECT order_id, sum(revenue) AS revenue FROM {p}model.fact_order_items GROUP BY order_id) i
    ON i.order_id = o.order_id
  WHERE o.order_status = 'delivered' GROUP BY o.customer_key)
SELECT customer_key AS customer_id,
  datediff((SELECT max(order_date) FROM {p}model.fact_orders WHERE order_status = 'delivered'), last_order_date) AS recency_days,
  frequency, CAST(monetary AS decimal(18,2)) AS monetary, last_order_date
FROM profiles WHERE customer_key IS NOT NULL AND matched > 0""",
}


def create_gold_views(tables: LayerTables) -> None:
    for name, query in GOLD_VIEWS.items():
        tables.replace_view(name, query.format(p=tables.prefix))
