"""The marketplace tables and pipeline stages as SQL, for checking answers in another engine."""

import re

from tradepath.adapters import CATEGORY_NAMES, PRIORITY_PAYMENT, STATE_CODES
from tradepath.functions import reference_data as ref


def _list(values):
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def case_map(values: dict, key: str) -> str:
    """CASE expression for a constant lookup."""
    arms = " ".join(
        f"WHEN '{k}' THEN {'NULL' if v is None else repr(v) if not isinstance(v, str) else chr(39) + v + chr(39)}"
        for k, v in values.items()
    )
    return f"CASE {key} {arms} END"


def secs(end, start):
    return f"((epoch_us({end}) - epoch_us({start})) / 1000000.0)"


def floor_days(end, start):
    return f"CAST(floor({secs(end, start)} / 86400) AS BIGINT)"


VIEWS = {
    "m_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
          CASE WHEN o_orderkey % 37 = 0 THEN 'canceled' WHEN o_orderstatus = 'F' THEN 'delivered'
               WHEN o_orderstatus = 'O' THEN 'shipped' ELSE 'processing' END AS order_status,
          o_orderdate AS order_purchase_timestamp,
          CASE WHEN o_orderkey % 97 <> 0 AND o_orderkey % 1009 <> 0
               THEN o_orderdate + to_hours(o_orderkey % 48) END AS order_approved_at,
          CASE WHEN o_orderstatus <> 'P' AND o_orderkey % 89 <> 0 AND o_orderkey % 1009 <> 0
               THEN o_orderdate + to_hours((o_orderkey % 9 - 1) * 24 + o_orderkey % 7)
               END AS order_delivered_carrier_date,
          CASE WHEN o_orderstatus = 'F' AND o_orderkey % 37 <> 0 AND o_orderkey % 103 <> 0
                AND o_orderkey % 1009 <> 0
               THEN o_orderdate + to_hours((o_orderkey * 37) % 40 * 24 + o_orderkey % 24)
               END AS order_delivered_customer_date,
          o_orderdate + to_hours((7 + o_orderkey % 24) * 24) AS order_estimated_delivery_date
        FROM orders""",
    "m_items": """
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
          l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
          CAST(CASE WHEN (l_orderkey + l_partkey) % 997 = 0 THEN 0
               ELSE CAST(l_extendedprice AS DECIMAL(10,2)) END AS DECIMAL(10,2)) AS price,
          CAST(round(CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_tax AS DECIMAL(4,2)), 2)
               AS DECIMAL(10,2)) AS freight_value
        FROM lineitem""",
    "m_payments": f"""
        SELECT o_orderkey AS order_id, 1 AS payment_sequential,
          {case_map(PRIORITY_PAYMENT, 'o_orderpriority')} AS payment_type,
          CAST(o_orderkey % 10 + 1 AS INTEGER) AS payment_installments,
          CAST(o_totalprice AS DECIMAL(10,2)) AS payment_value
        FROM orders WHERE o_orderkey % 211 <> 0
        UNION ALL
        SELECT o_orderkey, 2, 'voucher', 1,
          CAST(round(CAST(o_totalprice AS DECIMAL(10,2)) * CAST(0.10 AS DECIMAL(3,2)), 2)
               AS DECIMAL(10,2))
        FROM orders WHERE o_orderkey % 211 <> 0 AND o_orderkey % 23 = 0""",
    "m_reviews": """
        SELECT o_orderkey * 2 AS review_id, o_orderkey AS order_id,
          CAST(o_orderkey * 7 % 5 + 1 AS INTEGER) AS review_score,
          o_orderdate + to_hours((o_orderkey * 37 % 40 + o_orderkey % 5 - 1) * 24
                                 + o_orderkey % 13) AS review_creation_date
        FROM orders WHERE o_orderkey % 11 <> 0
        UNION ALL
        SELECT o_orderkey * 2 + 1, o_orderkey, CAST(o_orderkey % 5 + 1 AS INTEGER),
          o_orderdate + to_hours((o_orderkey * 37 % 40 + o_orderkey % 5 + 1) * 24
                                 + o_orderkey % 13)
        FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderkey % 101 = 0""",
    "m_reviews_text": """
        SELECT r.*, d.text AS review_comment_message
        FROM m_reviews r LEFT JOIN documents d
          ON d.doc_id = CASE WHEN r.order_id % 5 >= 3
                        THEN r.order_id % (SELECT count(*) FROM documents) END""",
    "m_nations": f"""
        SELECT n_nationkey, lower(n_name) AS city,
          {_list(STATE_CODES)}[n_nationkey + 1] AS state FROM nation""",
    "m_customers": """
        SELECT c_custkey AS customer_id, c_custkey AS customer_unique_id,
          lpad(CAST(c_custkey % 100 AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
          city AS customer_city, state AS customer_state
        FROM customer LEFT JOIN m_nations ON c_nationkey = n_nationkey""",
    "m_sellers": """
        SELECT s_suppkey AS seller_id,
          lpad(CAST(s_suppkey % 100 AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
          city AS seller_city, state AS seller_state
        FROM supplier LEFT JOIN m_nations ON s_nationkey = n_nationkey""",
    "m_products": f"""
        SELECT p_partkey AS product_id,
          CASE WHEN p_partkey % 61 <> 0 THEN
            {_list(CATEGORY_NAMES)}[CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INTEGER) + 1]
            END AS product_category_name,
          CASE WHEN p_partkey % 61 <> 0 THEN length(p_name) END AS product_name_lenght,
          CASE WHEN p_partkey % 61 <> 0 THEN p_size * 20 + p_partkey % 50 END
            AS product_description_lenght,
          CASE WHEN p_partkey % 61 <> 0 THEN p_partkey % 6 + 1 END AS product_photos_qty,
          CASE WHEN p_partkey % 47 <> 0 THEN p_size * 100 END AS product_weight_g,
          CASE WHEN p_partkey % 47 <> 0 THEN p_size + 10 END AS product_length_cm,
          CASE WHEN p_partkey % 47 <> 0 THEN p_size % 15 + 2 END AS product_height_cm,
          CASE WHEN p_partkey % 47 <> 0 THEN p_size % 20 + 8 END AS product_width_cm
        FROM part""",
    "m_geo": f"""
        SELECT lpad(CAST(m % 90 AS VARCHAR), 5, '0') AS geolocation_zip_code_prefix,
          CASE WHEN m % 53 = 0 THEN 10.0::DOUBLE
               ELSE CAST(m % 35 * 100 - 3000 + m % 7 AS DOUBLE) / 100 END AS geolocation_lat,
          CAST(m % 40 * 100 - 7000 + m % 11 AS DOUBLE) / 100 AS geolocation_lng,
          'nation_' || CAST(m % 25 AS VARCHAR) AS geolocation_city,
          {_list(STATE_CODES)}[m % 25 + 1] AS geolocation_state
        FROM (SELECT c_custkey % 700 AS m FROM customer)""",
    "m_translation": f"""
        SELECT DISTINCT product_category_name,
          {case_map(ref.CATEGORY_ENGLISH, 'product_category_name')}
            AS product_category_name_english
        FROM m_products WHERE product_category_name IS NOT NULL
          AND product_category_name NOT IN ({', '.join(repr(c) for c in ref.CATEGORY_OVERRIDES)})""",
    "m_kafka": """
        SELECT CAST(user_id AS VARCHAR) AS k,
          CASE WHEN event_id % 97 = 0 THEN NULL ELSE event_id END AS p_event_id,
          CASE WHEN event_id % 97 = 0 THEN NULL ELSE user_id END AS p_user_id,
          CASE WHEN event_id % 97 = 0 THEN NULL ELSE event_type END AS p_event_type,
          CASE WHEN event_id % 97 = 0 THEN NULL ELSE value END AS p_value,
          'events' AS topic, CAST(event_id % 3 AS INTEGER) AS part, event_id AS off, ts
        FROM events""",
    # pipeline stages
    "m_clean": """
        SELECT order_id, customer_id, order_status, order_purchase_timestamp,
          coalesce(order_approved_at, order_purchase_timestamp) AS order_approved_at,
          order_delivered_carrier_date,
          coalesce(order_delivered_customer_date, order_estimated_delivery_date)
            AS order_delivered_customer_date,
          order_estimated_delivery_date
        FROM m_orders
        WHERE NOT (order_status = 'delivered' AND order_approved_at IS NULL
          AND order_delivered_carrier_date IS NULL AND order_delivered_customer_date IS NULL)""",
    "m_english": f"""
        SELECT product_id, {case_map(ref.CATEGORY_ENGLISH, "coalesce(product_category_name, 'unknown')")}
          AS product_category_english, * EXCLUDE (product_id)
        FROM m_products""",
    "m_joined": f"""
        SELECT o.*, c.customer_unique_id, c.customer_city, c.customer_state,
          c.customer_zip_code_prefix, i.product_id, i.seller_id, i.price,
          p.product_category_english,
          coalesce(pay.payment_type, 'not_defined') AS payment_type, pay.payment_value,
          pay.payment_installments, r.review_score, r.review_creation_date, s.seller_city,
          {floor_days('o.order_delivered_customer_date', 'o.order_purchase_timestamp')}
            AS delivery_days,
          {floor_days('o.order_delivered_customer_date', 'o.order_estimated_delivery_date')}
            AS delivery_delay,
          coalesce(r.review_score <= 3, FALSE) AS bad_score
        FROM m_clean o
        LEFT JOIN m_customers c USING (customer_id)
        LEFT JOIN m_items i ON i.order_id = o.order_id
        LEFT JOIN m_english p ON p.product_id = i.product_id
        LEFT JOIN m_payments pay ON pay.order_id = o.order_id
        LEFT JOIN m_reviews r ON r.order_id = o.order_id
        LEFT JOIN m_sellers s ON s.seller_id = i.seller_id""",
    "m_delivered": "SELECT * FROM m_joined WHERE order_status = 'delivered'",
    "m_timed": f"""
        SELECT * FROM (
          SELECT *,
            {secs('order_approved_at', 'order_purchase_timestamp')} AS approval_time,
            {secs('order_delivered_carrier_date', 'order_approved_at')} AS waiting_time,
            {secs('order_delivered_customer_date', 'order_delivered_carrier_date')}
              AS shipping_time,
            {secs('order_delivered_customer_date', 'order_purchase_timestamp')} AS total_time,
            {secs('order_estimated_delivery_date', 'order_purchase_timestamp')}
              AS estimated_time,
            CASE WHEN delivery_delay IS NULL THEN 'missing' WHEN delivery_delay < 0 THEN 'early'
                 WHEN delivery_delay > 0 THEN 'late' ELSE 'on_time' END AS delivery_status
          FROM m_joined) t
        WHERE waiting_time >= 0 AND shipping_time >= 0""",
    "m_order_payments": """
        SELECT order_id, sum(payment_value) AS total_payment_value,
          bool_or(payment_type = 'voucher') AS has_voucher,
          max(payment_installments) AS max_installments,
          count(DISTINCT payment_type) AS payment_method_count,
          max(CASE WHEN payment_sequential = 1 THEN payment_type END) AS primary_payment_type
        FROM m_payments GROUP BY order_id""",
    "m_latest_review": """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY order_id
                   ORDER BY review_creation_date DESC, review_id DESC) AS rn
          FROM m_reviews) WHERE rn = 1""",
    "m_zip_centroid": """
        SELECT geolocation_zip_code_prefix AS zip, avg(geolocation_lat) AS lat,
          avg(geolocation_lng) AS lng
        FROM (SELECT DISTINCT * FROM m_geo) GROUP BY 1""",
}

_NAME = re.compile(r"\bm_[a-z_]+\b")


def query(body: str) -> str:
    """Prefix a statement with the views it uses, in dependency order."""
    ordered: list[str] = []

    def visit(text):
        for name in dict.fromkeys(_NAME.findall(text)):
            if name in VIEWS and name not in ordered:
                visit(VIEWS[name])
                ordered.append(name)

    visit(body)
    parts = [f"{name} AS ({VIEWS[name]})" for name in ordered]
    body = body.strip()
    if body[:5].upper() == "WITH ":
        parts.append(body[5:])
        return "WITH " + ",\n".join(parts)
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body
