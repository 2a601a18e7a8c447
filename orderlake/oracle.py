"""SQL counterparts of the registered queries, for an independent engine.

``FEEDS`` and ``SILVER`` are named subqueries; a report names the ones it reads
and ``sql()`` puts them in front, in order. The texts are ANSI SQL as DuckDB runs
it. They state the result, not the plan: windows and plain sums throughout.
"""

from __future__ import annotations

import re

FEEDS = {
    "a_orders": """
select cast(o_orderkey as varchar) order_id,
       cast(o_custkey as varchar) customer_id,
       case when o_orderstatus = 'F' then 'delivered'
            when o_orderstatus = 'O' then 'shipped'
            when o_orderpriority = '1-URGENT' then 'approved'
            when o_orderpriority = '2-HIGH' then 'invoiced'
            when o_orderpriority = '3-MEDIUM' then 'processing'
            when o_orderpriority = '5-LOW' then 'canceled'
            else 'lost' end order_status,
       o_orderdate order_purchase_ts,
       o_orderdate + cast(o_orderkey % 3 as int) * interval '1' day order_approved_ts,
       case when o_orderstatus <> 'P'
            then o_orderdate + cast(o_orderkey % 7 as int) * interval '1' day end order_delivered_carrier_ts,
       case when o_orderstatus = 'F'
            then o_orderdate + cast(3 + o_orderkey % 40 as int) * interval '1' day end order_delivered_customer_ts,
       o_orderdate + interval '30' day order_estimated_delivery_ts
from orders""",
    "a_orders_raw": """
select case when cast(order_id as bigint) % 97 = 0 then null else order_id end order_id,
       customer_id,
       case when load_no = 2 then 'delivered' else order_status end order_status,
       case when cast(order_id as bigint) % 89 = 0 then null
            else cast(order_purchase_ts as varchar) end order_purchase_timestamp,
       cast(order_approved_ts as varchar) order_approved_at,
       cast(order_delivered_carrier_ts as varchar) order_delivered_carrier_date,
       cast(order_delivered_customer_ts as varchar) order_delivered_customer_date,
       cast(order_estimated_delivery_ts as varchar) order_estimated_delivery_date,
       load_no
from a_orders, (values (1), (2)) k(load_no)
where load_no = 1 or cast(order_id as bigint) % 10 = 0""",
    "a_items": """
select cast(l_orderkey as varchar) order_id, l_linenumber order_item_id,
       cast(l_partkey as varchar) product_id, cast(l_suppkey as varchar) seller_id,
       l_shipdate shipping_limit_date,
       case when l_quantity = 1 then cast(0.0 as double) when l_quantity = 2 then cast(0.004 as double)
            else l_extendedprice + l_linenumber * cast(0.0001 as double) end price,
       l_quantity * cast(0.2525 as double) freight_value
from lineitem""",
    "a_items_raw": """
select order_id, case when freight_value = 3 * cast(0.2525 as double) then '0' else '' end || cast(order_item_id as varchar) order_item_id,
       product_id, seller_id, shipping_limit_date, price, freight_value
from a_items""",
    "a_payments": """
select cast(o_orderkey as varchar) order_id, cast(n as int) payment_sequential,
       case when o_orderpriority = '1-URGENT' then 'credit_card'
            when o_orderpriority = '2-HIGH' then 'boleto'
            when o_orderpriority = '3-MEDIUM' then 'voucher'
            when o_orderpriority = '5-LOW' then 'debit_card'
            else 'cheque' end payment_type,
       cast(1 + o_orderkey % 12 as int) payment_installments,
       case when n = 1 then o_totalprice else cast(o_orderkey % 500 as double) + cast(0.0025 as double) end payment_value
from orders, (values (1), (2)) k(n)
where n = 1 or o_orderkey % 4 = 0""",
    "a_payments_raw": """
select p.*, load_no
from a_payments p, (values (1), (2)) k(load_no)
where load_no = 1 or (cast(order_id as bigint) % 6 = 0 and payment_sequential = 1)""",
    "a_reviews": """
select case when doc_id % 53 = 0 then null else cast(doc_id as varchar) end review_id,
       cast(doc_id * 3 as varchar) order_id,
       cast(doc_id % 7 as varchar) review_score,
       lang review_comment_title,
       text review_comment_message,
       case when doc_id % 11 = 0 then '17/10/2000' when doc_id % 13 <> 0
            then strftime(timestamp '2000-01-01 08:30:00' + cast(doc_id % 700 as int) * interval '1' day, '%Y-%m-%d %H:%M:%S')
            end review_creation_date,
       case when doc_id % 17 = 0 then 'soon' when doc_id % 5 <> 0
            then strftime(timestamp '2000-01-01 09:00:00' + cast(doc_id % 700 + doc_id % 9 as int) * interval '1' day,
                '%Y-%m-%d %H:%M:%S') end review_answer_timestamp
from documents, (values (1), (2)) k(n)
where n = 1 or doc_id % 29 = 0""",
    "a_customers": """
select case when c_custkey % 103 = 0 then null else cast(c_custkey as varchar) end customer_id,
       case when c_custkey % 101 = 0 then null else cast(c_custkey // 2 as varchar) end customer_unique_id,
       cast(c_nationkey as varchar) customer_zip_code_prefix,
       case when load_no = 2 and c_custkey % 2 = 0 then lower(n_name)
            when load_no = 3 and c_custkey % 10 = 0 then upper(n_name[1]) || lower(n_name[2:])
            else n_name end customer_city,
       r_name customer_state,
       load_no,
       timestamp '2024-01-01 00:00:00' + (case when load_no = 2 then 31 else 0 end) * interval '1' day ingested
from customer
join nation on n_nationkey = c_nationkey
join region on r_regionkey = n_regionkey, (values (1), (2), (3)) k(load_no)
where load_no = 1 or (load_no = 2 and c_custkey % 3 = 0) or (load_no = 3 and c_custkey % 5 = 0)""",
    "a_sellers": """
select case when s_suppkey % 37 = 0 then null else cast(s_suppkey as varchar) end seller_id,
       cast(s_nationkey as varchar) seller_zip_code_prefix,
       case when load_no = 2 then lower(n_name) else n_name end seller_city,
       r_name seller_state,
       load_no,
       timestamp '2024-01-01 00:00:00' + (case when load_no = 2 then 31 else 0 end) * interval '1' day ingested
from supplier
join nation on n_nationkey = s_nationkey
join region on r_regionkey = n_regionkey, (values (1), (2)) k(load_no)
where load_no = 1 or s_suppkey % 2 = 0""",
    "a_geo": """
select cast(n_nationkey as varchar) geolocation_zip_code_prefix,
       case when c_custkey % 41 = 0 then null
            else cast(n_nationkey + case when n_nationkey % 5 = 0 then c_custkey % 2 else 0 end as double)
            end geolocation_lat,
       cast(-n_nationkey as double) geolocation_lng,
       lower(n_name) geolocation_city, r_name geolocation_state
from customer
join nation on n_nationkey = c_nationkey
join region on r_regionkey = n_regionkey""",
    "a_products": """
select cast(p_partkey as varchar) product_id,
       case when p_partkey % 13 = 0 then null else lower(p_type) end product_category_name,
       cast(length(p_name) as varchar) product_name_lenght,
       cast(p_size * 10 as varchar) product_description_lenght,
       case when p_partkey % 89 = 0 then 'n/a' else cast(p_partkey % 6 as varchar) end product_photos_qty,
       cast(p_size * 100 + load_no - 1 as varchar) product_weight_g,
       cast(p_size as varchar) product_length_cm,
       cast(p_size + 1 as varchar) product_height_cm,
       cast(p_size + 2 as varchar) product_width_cm,
       timestamp '2024-01-01 00:00:00' + (case when load_no = 2 then 31 else 0 end) * interval '1' day ingested, load_no
from part, (values (1), (2), (3)) k(load_no)
where load_no = 1 or (load_no = 2 and p_partkey % 4 = 0) or (load_no = 3 and p_partkey % 10 = 0)""",
    "a_translation": """
select lower(p_type) product_category_name,
       case when load_no = 2 and lower(p_type) = 'small' then 'en_little'
            when p_type <> 'PROMO' then concat('en_', lower(p_type)) end product_category_name_english,
       load_no
from part, (values (1), (2)) k(load_no)
where load_no = 1 or p_partkey % 2 = 0""",
    "a_changes": """
select user_id, event_type, ts changed_at,
       case when ts >= timestamp '2024-01-15 00:00:00' and user_id % 3 <> 0 then 2 else 1 end batch_no
from events""",
}

SILVER = {
    "s_orders": """
select order_id, customer_id, order_status,
       cast(order_purchase_timestamp as timestamp) order_purchase_ts,
       cast(order_approved_at as timestamp) order_approved_ts,
       cast(order_delivered_carrier_date as timestamp) order_delivered_carrier_ts,
       cast(order_delivered_customer_date as timestamp) order_delivered_customer_ts,
       cast(order_estimated_delivery_date as timestamp) order_estimated_delivery_ts
from a_orders_raw
where order_id is not null and order_purchase_timestamp is not null
qualify row_number() over (partition by order_id order by load_no desc) = 1""",
    "c_items": """
select *, count(*) over (partition by order_id, order_item_id) copies from a_items_raw""",
    "s_items": """
select order_id, cast(order_item_id as int) order_item_id, product_id, seller_id, shipping_limit_date, price, freight_value
from c_items where copies = 1 and price > 0
qualify row_number() over (partition by order_id, cast(order_item_id as int)
    order by product_id desc, seller_id desc, price desc, freight_value desc, shipping_limit_date desc) = 1""",
    "l_payments": """
select * from a_payments_raw
qualify row_number() over (partition by order_id, payment_sequential order by load_no desc) = 1""",
    "s_payments": """
select order_id, payment_sequential, payment_type, payment_installments, payment_value
from l_payments
where payment_type in ('credit_card', 'boleto', 'voucher', 'debit_card', 'not_defined')""",
    "j_reviews": """
select order_id, review_id, review_comment_title, review_comment_message,
       review_creation_date, review_answer_timestamp, review_score raw_score,
       case when regexp_matches(review_score, '^[1-5]$') then cast(review_score as int) end score,
       try_strptime(review_creation_date, '%Y-%m-%d %H:%M:%S') review_creation_ts,
       try_strptime(review_answer_timestamp, '%Y-%m-%d %H:%M:%S') review_answer_ts,
       case when order_id is null or review_id is null then 'NULL_KEY'
            when count(*) over (partition by order_id, review_id) > 1 then 'DUPLICATE_KEY'
            when not regexp_matches(review_score, '^[1-5]$')
              or try_strptime(review_creation_date, '%Y-%m-%d %H:%M:%S') is null then 'INVALID_FORMAT'
       end reason
from a_reviews""",
    "s_reviews": """
select order_id, review_id, score review_score, review_comment_title, review_comment_message,
       review_creation_ts, review_answer_ts
from j_reviews where reason is null""",
    "s_geo": """
select distinct geolocation_zip_code_prefix, geolocation_lat, geolocation_lng,
       geolocation_city, geolocation_state
from a_geo where geolocation_lat is not null""",
    "s_translation": """
select product_category_name, product_category_name_english
from a_translation where product_category_name_english is not null
qualify row_number() over (partition by product_category_name
                           order by load_no desc, product_category_name_english desc) = 1""",
    "k_customers": """
select * from a_customers
where customer_id is not null and customer_unique_id is not null
qualify row_number() over (
  partition by customer_id, ingested, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state
  order by load_no desc) = 1""",
    "s_customers": """
select customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state,
       ingested EffectiveFrom,
       lead(ingested) over (partition by customer_id order by ingested, load_no) EffectiveTo,
       lead(ingested) over (partition by customer_id order by ingested, load_no) is null IsActive
from k_customers""",
    "s_sellers": """
select seller_id, seller_zip_code_prefix, seller_city, seller_state, ingested EffectiveFrom,
       lead(ingested) over (partition by seller_id order by ingested) EffectiveTo,
       lead(ingested) over (partition by seller_id order by ingested) is null IsActive
from a_sellers where seller_id is not null""",
    "k_products": """
select product_id, product_category_name,
       cast(product_name_lenght as int) product_name_length,
       cast(product_description_lenght as int) product_description_length,
       try_cast(product_photos_qty as int) product_photos_qty,
       cast(product_weight_g as int) product_weight_g,
       cast(product_length_cm as int) product_length_cm,
       cast(product_height_cm as int) product_height_cm,
       cast(product_width_cm as int) product_width_cm,
       ingested, load_no
from a_products where product_photos_qty <> 'n/a'""",
    "s_products": """
select product_id, product_category_name, product_name_length, product_description_length,
       product_photos_qty, product_weight_g, product_length_cm, product_height_cm, product_width_cm,
       ingested EffectiveFrom,
       lead(ingested) over (partition by product_id order by ingested, load_no) EffectiveTo,
       lead(ingested) over (partition by product_id order by ingested, load_no) is null IsActive
from k_products""",
    "v_incoming": """
select user_id, event_type, changed_at EffectiveFrom,
       lead(changed_at) over (partition by user_id order by changed_at) EffectiveTo
from a_changes where batch_no = 2""",
    "v_target": """
select user_id, event_type, changed_at EffectiveFrom,
       lead(changed_at) over (partition by user_id order by changed_at) EffectiveTo
from a_changes where batch_no = 1""",
    "v_merged": """
select user_id, event_type, EffectiveFrom,
       case when EffectiveTo is null then first_start else EffectiveTo end EffectiveTo
from v_target left join
     (select user_id, min(EffectiveFrom) first_start from v_incoming group by user_id) using (user_id)
union all
select user_id, event_type, EffectiveFrom, EffectiveTo from v_incoming""",
    "g_geo": """
select distinct geolocation_zip_code_prefix zip, lower(geolocation_city) city, geolocation_state state,
       geolocation_lat, geolocation_lng
from s_geo""",
    "g_customer": """
select c.customer_id, c.customer_unique_id, c.customer_zip_code_prefix, c.customer_city, c.customer_state,
       g.geolocation_lat, g.geolocation_lng
from s_customers c left join g_geo g
  on g.zip = c.customer_zip_code_prefix and g.city = lower(c.customer_city) and g.state = c.customer_state
where c.IsActive""",
    "g_seller": """
select s.seller_id, s.seller_zip_code_prefix, s.seller_city, s.seller_state,
       g.geolocation_lat, g.geolocation_lng
from s_sellers s left join g_geo g
  on g.zip = s.seller_zip_code_prefix and g.city = lower(s.seller_city) and g.state = s.seller_state
where s.IsActive""",
    "g_orders": """
select o.*, c.customer_id known_customer
from a_orders o left join g_customer c on c.customer_id = o.customer_id""",
    "g_orders_one": """
select o.*, c.customer_id known_customer
from a_orders o left join (select distinct customer_id from g_customer) c on c.customer_id = o.customer_id""",
}


def _day_key(column: str) -> str:
    return f"cast(strftime({column}, '%Y%m%d') as int)"


def _names(*checks: tuple[str, str]) -> str:
    """Names of the failed checks, comma-separated, in rule order."""
    parts = ", ".join(f"case when {condition} then '{name}' end" for name, condition in checks)
    return f"concat_ws(',', {parts})"


# A sum in units of 2^-64, in which a double of 2^-11 or more is a whole number: plain sums of
# whole numbers, rounded once at the end.
_TWO_64 = "18446744073709551616"
_UNITS = f"""(sum(cast(trunc({{0}}) as hugeint)) * {_TWO_64}
         + sum(cast(({{0}} - trunc({{0}})) * {_TWO_64}::double as hugeint)))"""
# Whole part, 32 bits and 32 more bits, each exact as a double, added so that one rounding is left.
_WHOLE = f"cast({_UNITS} // {_TWO_64} as double)"
_UPPER = f"(cast({_UNITS} % {_TWO_64} // 4294967296 as double) / 4294967296::double)"
_LOWER = f"(cast({_UNITS} % 4294967296 as double) / {_TWO_64}::double)"
_MONEY = f"(({_WHOLE} + {_UPPER}) + (({_UPPER} - (({_WHOLE} + {_UPPER}) - {_WHOLE})) + {_LOWER}))"
_ROUNDED = f"cast(round(cast({_MONEY} as decimal(38,6)), 2) as double)"
_ITEM_ERRORS = _names(("CustomerKey_is_unique", "copies > 1"), ("price_must_be_positive", "not price > 0"))
_FACT_ITEMS = """
select i.order_id, i.order_item_id, o.known_customer customer_id, {purchase} purchase_date_key,
       p.product_id, s.seller_id, {limit} shipping_limit_date_key,
       i.shipping_limit_date, i.price, i.freight_value
from a_items i left join {orders} o on o.order_id = i.order_id
left join (select product_id from s_products where IsActive) p on p.product_id = i.product_id
left join {sellers} s on s.seller_id = i.seller_id"""
_FACT_ORDERS = f"""
select order_id, known_customer customer_id,
       {_day_key("order_purchase_ts")} purchase_date_key,
       {_day_key("order_approved_ts")} approved_date_key,
       {_day_key("order_delivered_carrier_ts")} delivered_carrier_date_key,
       {_day_key("order_delivered_customer_ts")} delivered_customer_date_key,
       {_day_key("order_estimated_delivery_ts")} estimated_delivery_date_key,
       order_status, order_purchase_ts, order_approved_ts, order_delivered_carrier_ts,
       order_delivered_customer_ts, order_estimated_delivery_ts
from """
_VERSIONS = "select *, EffectiveTo is null IsActive from "
SILVER["paid"] = f"select order_id, {_MONEY.format('payment_value')} paid from a_payments group by order_id"

REPORTS = {
    "dq_orders_split": f"""
select order_id, customer_id, order_status, order_purchase_timestamp, load_no,
       {_names(("order_id_not_null", "order_id is null"),
               ("purchase_ts_not_null", "order_purchase_timestamp is null"))} errors,
       {_names(("order_status_valid", "order_status = 'lost'"))} warnings
from a_orders_raw""",
    "dq_orders_target": f"""
select order_id, order_status, order_approved_ts, order_delivered_carrier_ts,
       {_names(("carrier_after_approval", "order_delivered_carrier_ts < order_approved_ts"))} warnings
from s_orders""",
    "dq_items_split": f"""
select order_id, order_item_id, product_id, seller_id, price, {_ITEM_ERRORS} errors
from c_items""",
    "dq_payments_split": f"""
select order_id, payment_sequential, payment_type,
       {_names(("payment_type_valid", "payment_type = 'cheque'"))} errors
from l_payments""",
    "reject_duplicates": f"""
select order_id, order_item_id, count(*) rows_of_key, {_MONEY.format("price")} price
from a_items group by order_id, order_item_id having count(*) > 1""",
    "duplicate_keys": """
select order_id, order_item_id from a_items group by order_id, order_item_id having count(*) > 1""",
    "reviews_valid": "select * from s_reviews",
    "reviews_quarantine": """
select order_id, review_id,
       case when reason = 'INVALID_FORMAT' then cast(score as varchar) else raw_score end review_score,
       review_creation_date, review_answer_timestamp, reason dq_error_reason
from j_reviews where reason is not null""",
    "items_latest": """
select * from a_items
qualify row_number() over (partition by order_id, order_item_id
    order by shipping_limit_date desc, product_id desc, seller_id desc, price desc, freight_value desc) = 1""",
    "geo_exact_dedup": """
select distinct geolocation_zip_code_prefix, geolocation_lat, geolocation_lng,
       geolocation_city, geolocation_state
from a_geo""",
    "customers_hash_dedup": """
select distinct customer_id, ingested,
       sha256(concat_ws('||', customer_unique_id, customer_zip_code_prefix, customer_city, customer_state)) record_hash
from a_customers""",
    "translation_dedup": "select * from s_translation",
    "silver_orders": "select * from s_orders",
    "silver_items": "select * from s_items",
    "silver_payments": "select * from s_payments",
    "silver_geolocation": "select * from s_geo",
    "silver_translation": "select * from s_translation",
    "silver_customers": "select * from s_customers",
    "silver_sellers": "select * from s_sellers",
    "silver_products": "select * from s_products",
    "silver_customers_keep_ties": "select * from s_customers",
    "silver_customers_collapsed": """
with kept as (
  select * from a_customers
  where customer_id is not null and customer_unique_id is not null
  qualify row_number() over (partition by customer_id, ingested order by load_no desc) = 1)
select customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state,
       ingested EffectiveFrom,
       lead(ingested) over (partition by customer_id order by ingested) EffectiveTo,
       lead(ingested) over (partition by customer_id order by ingested) is null IsActive
from kept""",
    "silver_items_quarantine": f"""
select order_id, order_item_id, product_id, seller_id, {_ITEM_ERRORS} errors, 'source' gate
from c_items where copies > 1 or not price > 0""",
    "silver_products_open_ended": """
select product_id, product_category_name, product_name_length, product_description_length,
       product_photos_qty, product_weight_g, product_length_cm, product_height_cm, product_width_cm,
       ingested EffectiveFrom, true IsActive
from k_products""",
    "customers_quarantine": f"""
select customer_id, customer_unique_id, customer_city, load_no,
       {_names(("customer_id_not_null", "customer_id is null"),
               ("customer_unique_id_not_null", "customer_unique_id is null"))} errors,
       case when customer_id is not null and copies > 1 then 'customer_id_unique' else '' end warnings
from (select *, count(*) over (partition by customer_id) copies from a_customers)
where customer_id is null or customer_unique_id is null""",
    "products_quarantine": f"""
select product_id, product_photos_qty, product_weight_g,
       {_names(("product_photos_qty_castable", "product_photos_qty = 'n/a'"))} errors,
       {_names(("category_not_null", "product_category_name is null"))} warnings
from a_products where product_photos_qty = 'n/a'""",
    "payments_quarantine": """
select order_id, payment_sequential, payment_type, payment_value, 'payment_type_valid' errors
from l_payments where payment_type = 'cheque'""",
    "scd2_versions": f"""
select user_id, event_type, changed_at EffectiveFrom,
       lead(changed_at) over (partition by user_id order by changed_at) EffectiveTo,
       lead(changed_at) over (partition by user_id order by changed_at) is null IsActive
from a_changes""",
    "scd2_merge": f"{_VERSIONS} v_merged",
    "scd2_active": """
select user_id, event_type, EffectiveFrom from v_merged where EffectiveTo is null""",
    "scd2_open_ended": """
select distinct user_id, event_type, changed_at EffectiveFrom, true IsActive from a_changes""",
    "scd2_changes_only": """
with kept as (
  select user_id, event_type, changed_at
  from a_changes
  qualify lag(event_type) over (partition by user_id order by changed_at) is distinct from event_type)
select user_id, event_type, changed_at EffectiveFrom,
       lead(changed_at) over (partition by user_id order by changed_at) EffectiveTo,
       lead(changed_at) over (partition by user_id order by changed_at) is null IsActive
from kept""",
    "scd2_changes_merged": """
with kept as (
  select user_id, event_type, changed_at
  from a_changes
  qualify lag(event_type) over (partition by user_id order by batch_no, changed_at) is distinct from event_type)
select user_id, event_type, changed_at EffectiveFrom,
       lead(changed_at) over (partition by user_id order by changed_at) EffectiveTo,
       lead(changed_at) over (partition by user_id order by changed_at) is null IsActive
from kept""",
    "scd2_rebuild": """
select user_id, event_type, changed_at EffectiveFrom,
       lead(changed_at) over (partition by user_id order by changed_at) EffectiveTo,
       lead(changed_at) over (partition by user_id order by changed_at) is null IsActive
from a_changes""",
    "scd1_upsert": """
select user_id, event_type, changed_at from a_changes
qualify row_number() over (partition by user_id order by batch_no desc, changed_at desc) = 1""",
    "merge_general": """
with target as (
  select user_id, arg_max(event_type, changed_at) event_type, max(changed_at) changed_at, count(*) changes
  from a_changes where batch_no = 1 group by user_id),
source as (
  select user_id, arg_max(event_type, changed_at) event_type, max(changed_at) changed_at, count(*) changes
  from a_changes where batch_no = 2 group by user_id)
select user_id,
       case when s.user_id is not null and t.event_type <> 'error' then s.event_type else t.event_type end event_type,
       case when s.user_id is not null and t.event_type <> 'error' then s.changed_at else t.changed_at end changed_at,
       case when s.user_id is not null and t.event_type <> 'error' then t.changes + s.changes
            else t.changes end changes
from target t left join source s using (user_id)
union all
select user_id, s.event_type, s.changed_at, 0 changes
from source s where user_id not in (select user_id from target where event_type <> 'error')
  and s.event_type <> 'view'""",
    "dim_date": f"""
select {_day_key("d")} date_key, d date_value, cast(year(d) as int) "year", cast(quarter(d) as int) "quarter",
       cast(month(d) as int) "month", monthname(d) month_name, cast(day(d) as int) day_of_month,
       cast(dayofweek(d) + 1 as int) day_of_week, dayname(d) day_name,
       cast(weekofyear(d) as int) week_of_year, dayofweek(d) in (0, 6) is_weekend
from (select cast(unnest(generate_series(
        (select min(date_trunc('day', order_purchase_ts)) from a_orders),
        (select max(date_trunc('day', order_purchase_ts)) from a_orders), interval '1' day)) as date) d)""",
    "dim_geolocation": "select * from s_geo",
    "dim_customer": "select * from g_customer",
    "dim_seller": "select * from g_seller",
    "dim_customer_one_per_place": """
select customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state,
       bool_or(geolocation_lat is not null) has_place
from g_customer group by all""",
    "dim_seller_one_per_place": """
select seller_id, seller_zip_code_prefix, seller_city, seller_state,
       bool_or(geolocation_lat is not null) has_place
from g_seller group by all""",
    "dim_product": """
select p.product_id, p.product_category_name,
       coalesce(t.product_category_name_english, p.product_category_name) product_category_name_english,
       product_name_length, product_description_length, product_photos_qty, product_weight_g,
       product_length_cm, product_height_cm, product_width_cm
from s_products p left join s_translation t using (product_category_name) where IsActive""",
    "surrogate_key_bijection": """
select 'customer' dimension, count(distinct customer_id) naturals, count(distinct customer_id) surrogates
from g_customer
union all select 'product', count(distinct product_id), count(distinct product_id) from s_products where IsActive
union all select 'seller', count(distinct seller_id), count(distinct seller_id) from g_seller
union all select 'geolocation', count(*), count(*) from s_geo""",
    "fact_orders": _FACT_ORDERS + "g_orders",
    "fact_orders_one_per_place": _FACT_ORDERS + "g_orders_one",
    "fact_order_items": _FACT_ITEMS.format(
        purchase=_day_key("o.order_purchase_ts"),
        limit=_day_key("i.shipping_limit_date"),
        orders="g_orders",
        sellers="g_seller",
    ),
    "fact_order_items_one_per_place": _FACT_ITEMS.format(
        purchase=_day_key("o.order_purchase_ts"),
        limit=_day_key("i.shipping_limit_date"),
        orders="g_orders_one",
        sellers="(select distinct seller_id from g_seller)",
    ),
    "fact_payments": f"""
select p.order_id, p.payment_sequential, o.known_customer customer_id,
       {_day_key("o.order_purchase_ts")} purchase_date_key,
       p.payment_type, p.payment_installments, p.payment_value
from a_payments p left join g_orders o on o.order_id = p.order_id""",
    "fact_reviews": f"""
select r.review_id, r.order_id, o.known_customer customer_id,
       {_day_key("o.order_purchase_ts")} purchase_date_key,
       {_day_key("r.review_creation_ts")} review_creation_date_key,
       {_day_key("r.review_answer_ts")} review_answer_date_key,
       r.review_score, r.review_comment_title, r.review_comment_message,
       r.review_creation_ts, r.review_answer_ts
from s_reviews r left join g_orders o on o.order_id = r.order_id""",
    "daily_revenue": f"""
select cast(order_purchase_ts as date) revenue_date, count(distinct o.order_id) orders_count,
       {_MONEY.format("paid")} gross_revenue, {_MONEY.format("paid")} / count(*) avg_order_value
from a_orders o join paid p on p.order_id = o.order_id
where order_status in ('delivered', 'shipped', 'invoiced', 'approved')
group by 1""",
    "sales_by_customer": f"""
select purchase_date, customer_id, total_price from (
  select cast(order_purchase_ts as date) purchase_date, customer_id, order_status,
         {_MONEY.format("price")} total_price
  from a_items i left join a_orders o on o.order_id = i.order_id
  group by 1, 2, 3)""",
    "product_performance": f"""
with scores as (select order_id, avg(cast(review_score as double)) score from s_reviews group by order_id),
totals as (select order_id, {_MONEY.format("price")} total from a_items group by order_id),
firsts as (select customer_id, min(order_purchase_ts) first_ts from a_orders group by customer_id),
lines as (
  select i.*, o.order_status, o.order_purchase_ts, o.order_delivered_customer_ts delivered, sc.score,
         p.product_category_name original, t.product_category_name_english english,
         o.order_purchase_ts = f.first_ts is_first,
         case when tt.total is null or tt.total = 0 then null
              else pd.paid * (i.price / tt.total) end share
  from a_items i join a_orders o on o.order_id = i.order_id
  left join scores sc on sc.order_id = i.order_id
  left join s_products p on p.product_id = i.product_id and p.IsActive
  left join s_translation t on t.product_category_name = p.product_category_name
  left join firsts f on f.customer_id = o.customer_id
  left join totals tt on tt.order_id = i.order_id
  left join paid pd on pd.order_id = i.order_id)
select product_id, coalesce(english, original) product_category,
       count(*) units_sold, count(distinct order_id) orders_count, count(distinct seller_id) sellers_count,
       {_MONEY.format("price")} gmv_item_price, {_MONEY.format("freight_value")} total_freight_value,
       {_MONEY.format("price")} / count(price) avg_item_price,
       quantile_disc(price, 0.5) median_item_price,
       {_MONEY.format("coalesce(share, 0.0)")} allocated_revenue_paid_value,
       {_MONEY.format("score")} / count(score) avg_review_score,
       cast(count(*) filter (order_status = 'delivered') as bigint) delivered_units,
       cast(count(*) filter (delivered <= shipping_limit_date) as bigint) on_time_delivered_units,
       cast(count(*) filter (is_first) as bigint) units_from_new_customers,
       cast(count(*) filter (not is_first) as bigint) units_from_returning_customers,
       min(order_purchase_ts) first_seen_purchase_ts, max(order_purchase_ts) last_seen_purchase_ts
from lines group by 1, 2""",
    "active_customers_by_day": """
select cast(o.order_purchase_ts as date) signup_date, count(distinct c.customer_unique_id) new_customers
from a_orders o join s_customers c on c.customer_id = o.customer_id and c.IsActive
group by 1""",
    "monthly_revenue": f"""
select date_trunc('month', o.order_purchase_ts) "month", {_ROUNDED.format("p.paid")} revenue
from a_orders o join paid p on p.order_id = o.order_id group by 1""",
    "top_categories": f"""
select p.product_category_name, {_ROUNDED.format("i.price")} revenue
from a_items i join s_products p on p.product_id = i.product_id and p.IsActive
group by 1 order by revenue desc, product_category_name nulls first limit 10""",
    "top_sellers": f"""
select s.seller_id, {_ROUNDED.format("i.price")} revenue
from a_items i join s_sellers s on s.seller_id = i.seller_id and s.IsActive
group by 1 order by revenue desc, seller_id limit 10""",
    "bronze_ingest": """
select order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at,
       order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date
from a_orders_raw""",
    "bronze_customers": """
select customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state,
       true has_lineage from a_customers""",
    "bronze_sellers": """
select seller_id, seller_zip_code_prefix, seller_city, seller_state, true has_lineage from a_sellers""",
    "bronze_geolocation": """
select geolocation_zip_code_prefix, cast(geolocation_lat as varchar) geolocation_lat,
       cast(geolocation_lng as varchar) geolocation_lng, geolocation_city, geolocation_state,
       true has_lineage from a_geo""",
    "bronze_products": """
select product_id, product_category_name, product_name_lenght, product_description_lenght, product_photos_qty,
       product_weight_g, product_length_cm, product_height_cm, product_width_cm, true has_lineage
from a_products""",
    "bronze_translation": """
select product_category_name, product_category_name_english, true has_lineage from a_translation""",
    "bronze_items": "select *, true has_lineage, cast(null as varchar) unparsed from a_items",
    "bronze_payments": """
select order_id, payment_sequential, payment_type, payment_installments,
       case when cast(order_id as bigint) % 11 <> 0 then payment_value end payment_value, true has_lineage,
       case when cast(order_id as bigint) % 11 = 0 then concat_ws(',', order_id, payment_sequential, payment_type,
            payment_installments, 'n/a') end unparsed
from a_payments_raw""",
    "bronze_reviews": """
select review_id, order_id, cast(review_score as int) review_score, review_comment_title, 'said' review_comment_message,
       review_creation_date, review_answer_timestamp, true has_lineage, cast(null as varchar) unparsed
from a_reviews""",
    "bronze_inferred": """
with n as (select count(*) filter (payment_sequential = 1) firsts, count(*) n from a_payments)
select way, name, case when way = 'text' then 'string' else kind end kind, case when way = 'text' then firsts else n end known
from n, (values ('text'), ('typed')) w(way),
     (values ('order_id', 'int'), ('payment_sequential', 'int'), ('payment_type', 'string'), ('payment_value', 'double')) c(name, kind)""",
    "bronze_by_header": """
with f as (select customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state,
       'load_' || load_no as load, cast(customer_id as bigint) // 100 % 4 layout, cast(customer_id as bigint) // 100 file
  from a_customers where customer_id is not null)
select customer_id, customer_unique_id, customer_zip_code_prefix, customer_city,
       case when layout <> 2 then customer_state end customer_state,
       case when layout = 1 then load end as load,
       case when layout = 3 then concat_ws(',', customer_id, coalesce(customer_unique_id, ''), customer_zip_code_prefix, customer_city,
            customer_state, 'surplus') end unparsed
from f
union all
select 'customer_id', 'customer_unique_id', 'customer_zip_code_prefix', 'customer_city', 'customer_state', null, null
from f where layout = 3 group by file""",
    "stream_orders_to_silver": "select * from s_orders",
    "stream_customers_to_silver": "select * from s_customers",
    "stream_translation_to_silver": "select * from s_translation",
    "stream_customers_late": "select * from s_customers",
    "stream_products_to_silver": "select * from s_products",
    "reprocess_orders": "select * from s_orders",
    "batch_lineage": """
select cast(load_no - 1 as bigint) batch_id, 1 times, count(distinct order_id) as rows, 1 files
from a_orders_raw
where order_id is not null and order_purchase_timestamp is not null group by load_no""",
    "empty_batch": """
select cast(0 as bigint) batch_id, count(*) as rows from s_orders""",
    "truncate_table": "select *, cast(0 as bigint) left_after_truncate from paid",
    "current_orders": "select * from s_orders",
}

# The same rows by another way: from a table, a view or a stream.
REPORTS |= {
    "quarantine_from_table": f"select * from ({REPORTS['dq_orders_split']}) where errors <> ''",
    "gold_from_tables": REPORTS["fact_order_items"],
    "view_daily_revenue": REPORTS["daily_revenue"],
    "view_product_performance": REPORTS["product_performance"],
    "view_sales_by_customer": REPORTS["sales_by_customer"],
}


def sql(name: str) -> str:
    """The report with every named subquery it needs, directly or not."""
    parts = {**FEEDS, **SILVER}
    order = list(parts)
    needed: set[str] = set()

    def visit(text: str) -> None:
        for part in order:
            if part not in needed and re.search(rf"\b{part}\b", text):
                needed.add(part)
                visit(parts[part])

    report = REPORTS[name]
    visit(report)
    chain = ",\n".join(f"{part} as ({parts[part]})" for part in order if part in needed)
    return f"with {chain}\nselect * from ({report}\n)" if chain else report
