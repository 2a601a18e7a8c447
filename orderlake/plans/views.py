"""The business views as SQL text over stored silver tables.

A view in the catalog outlives the session, so it has to be text. The texts state the same as
``business``, whose functions take frames; tests hold one against the other.
"""

from __future__ import annotations

from orderlake.functions.money import parts_sql, total_sql
from orderlake.plans.business import REVENUE_STATUSES

_PAID = f"""
  SELECT order_id, {total_sql("paid", "")} AS paid
  FROM (SELECT order_id, {parts_sql("payment_value", "paid")} FROM {{silver}}.order_payments GROUP BY order_id)"""
_STATUSES = ", ".join(f"'{status}'" for status in REVENUE_STATUSES)

_DAILY_REVENUE = f"""
WITH per_order AS ({_PAID}),
days AS (
  SELECT to_date(o.order_purchase_ts) AS revenue_date, count(DISTINCT o.order_id) AS orders_count,
         count(p.paid) AS paid_orders
  FROM {{silver}}.orders o JOIN per_order p ON p.order_id = o.order_id
  WHERE o.order_status IN ({_STATUSES}) GROUP BY 1),
revenue AS (
  SELECT to_date(o.order_purchase_ts) AS revenue_date, {parts_sql("p.paid", "paid")}
  FROM {{silver}}.orders o JOIN per_order p ON p.order_id = o.order_id
  WHERE o.order_status IN ({_STATUSES}) GROUP BY 1)
SELECT d.revenue_date, d.orders_count, {total_sql("paid", "")} AS gross_revenue,
       try_divide({total_sql("paid", "")}, d.paid_orders) AS avg_order_value
FROM days d JOIN revenue r ON d.revenue_date <=> r.revenue_date"""

_SALES_BY_CUSTOMER = f"""
WITH per_order AS (
  SELECT order_id, {parts_sql("price", "price")} FROM {{silver}}.order_items GROUP BY order_id)
SELECT purchase_date, customer_id, total_price FROM (
  SELECT to_date(o.order_purchase_ts) AS purchase_date, o.customer_id, o.order_status, {total_sql("price")} AS total_price
  FROM per_order i LEFT JOIN {{silver}}.orders o ON o.order_id = i.order_id
  GROUP BY 1, 2, 3)"""

_AMOUNTS = ("price", "freight", "share", "score")
_PRODUCT_PERFORMANCE = f"""
WITH per_order AS ({_PAID}),
scores AS (SELECT order_id, avg(CAST(review_score AS DOUBLE)) AS score FROM {{silver}}.order_reviews GROUP BY order_id),
totals AS (
  SELECT order_id, {total_sql("price", "")} AS total
  FROM (SELECT order_id, {parts_sql("price", "price")} FROM {{silver}}.order_items GROUP BY order_id)),
firsts AS (
  SELECT customer_id, min(order_purchase_ts) AS first_ts FROM {{silver}}.orders
  WHERE customer_id IS NOT NULL GROUP BY customer_id),
heads AS (
  SELECT o.order_id, o.order_status, o.order_purchase_ts, o.order_delivered_customer_ts AS delivered_ts,
         coalesce(o.order_purchase_ts = f.first_ts, false) AS is_first, p.paid, s.score, t.total
  FROM {{silver}}.orders o LEFT JOIN firsts f ON f.customer_id = o.customer_id
  LEFT JOIN per_order p ON p.order_id = o.order_id
  LEFT JOIN scores s ON s.order_id = o.order_id LEFT JOIN totals t ON t.order_id = o.order_id),
sold AS (
  SELECT i.product_id, i.order_id, i.seller_id, i.price, i.freight_value AS freight, i.shipping_limit_date, h.order_status,
         h.order_purchase_ts, h.delivered_ts, h.is_first, h.score,
         coalesce(CASE WHEN h.total <> 0 THEN h.paid * (i.price / h.total) END, 0.0D) AS share
  FROM {{silver}}.order_items i JOIN heads h ON h.order_id = i.order_id),
lines AS (
  SELECT product_id, seller_id, price, freight, share, score, order_purchase_ts, order_status = 'delivered' AS delivered,
         delivered_ts <= shipping_limit_date AS on_time, is_first AS fresh,
         row_number() OVER (PARTITION BY order_id, product_id ORDER BY order_id) = 1 AS new_order FROM sold),
by_product AS (SELECT * FROM lines DISTRIBUTE BY product_id),
marked AS (
  SELECT *, seller_id IS NOT NULL AND row_number() OVER (PARTITION BY product_id, seller_id ORDER BY seller_id) = 1
         AS new_seller FROM by_product),
per_product AS (
  SELECT product_id, count(*) AS units, count(price) AS priced, count(score) AS scored,
         {", ".join(parts_sql(name, name) for name in _AMOUNTS)}, percentile_approx(price, 0.5) AS median,
         count_if(delivered) AS delivered, count_if(on_time) AS on_time, count_if(fresh) AS fresh,
         count_if(new_order) AS orders, count_if(new_seller) AS sellers,
         min(order_purchase_ts) AS first_seen, max(order_purchase_ts) AS last_seen
  FROM marked GROUP BY product_id),
named AS (
  SELECT p.product_id, coalesce(t.product_category_name_english, p.product_category_name) AS category
  FROM {{silver}}.products p LEFT JOIN {{silver}}.product_category_translation t
  ON t.product_category_name = p.product_category_name WHERE p.IsActive)
SELECT a.product_id, n.category AS product_category, a.units AS units_sold, a.orders AS orders_count,
       a.sellers AS sellers_count, {total_sql("price", "")} AS gmv_item_price,
       {total_sql("freight", "")} AS total_freight_value,
       try_divide({total_sql("price", "")}, a.priced) AS avg_item_price, a.median AS median_item_price,
       {total_sql("share", "")} AS allocated_revenue_paid_value,
       try_divide({total_sql("score", "")}, a.scored) AS avg_review_score, a.delivered AS delivered_units,
       a.on_time AS on_time_delivered_units, a.fresh AS units_from_new_customers,
       a.units - a.fresh AS units_from_returning_customers, a.first_seen AS first_seen_purchase_ts,
       a.last_seen AS last_seen_purchase_ts
FROM per_product a LEFT JOIN named n ON n.product_id = a.product_id"""

# Names of the views.
VIEWS = {
    "v_daily_revenue_analytics": _DAILY_REVENUE,
    "product_performance": _PRODUCT_PERFORMANCE,
    "sales_by_customer": _SALES_BY_CUSTOMER,
}


def text(query: str, silver: str) -> str:
    return query.replace("{silver}", silver)
