"""Documented measures at order grain."""

from tradepath.functions import reference_data as ref
from tradepath.plans import measures
from tradepath.registry import register
from tradepath.registry.silver import _LOOKUP, _SILVER_ORDERS, r
from tradepath.registry.sql import secs

AS_OF = "2001-09-01"

_FACTS = _SILVER_ORDERS + """,
    facts AS (SELECT so.*, c.customer_unique_id, c.customer_city, c.customer_state,
        p.* EXCLUDE (order_id), v.review_score
      FROM so LEFT JOIN m_customers c USING (customer_id)
      LEFT JOIN m_order_payments p ON p.order_id = so.order_id
      LEFT JOIN m_latest_review v ON v.order_id = so.order_id)"""
_CAT = _LOOKUP + """,
    cat AS (SELECT i.*, l.product_category_name_english AS category_name_en,
        CASE WHEN price <> 0 THEN CAST(freight_value AS DOUBLE) / CAST(price AS DOUBLE) END AS ratio
      FROM m_items i LEFT JOIN m_products p USING (product_id) LEFT JOIN lookup l
        ON l.product_category_name = coalesce(p.product_category_name, 'unknown'))"""


def month(x):
    return f"strftime({x}, '%Y-%m-01')"


@register("a29_gmv", """
    SELECT CAST(sum(payment_value) AS DOUBLE) AS gmv,
      CAST(sum(payment_value) FILTER (WHERE payment_type <> 'voucher') AS DOUBLE) AS net_of_vouchers,
      CAST(sum(payment_value) FILTER (WHERE payment_type = 'voucher') AS DOUBLE) AS voucher_value
    FROM m_payments""")
def _(m):
    return measures.gmv(m)


@register("a30_monthly_funnel", f"""
    SELECT {month('order_purchase_timestamp')} AS month, order_status, count(*) AS n_orders
    FROM m_orders GROUP BY 1, 2""")
def _(m):
    return measures.monthly_funnel(m)


@register("a31_seller_scorecard", _SILVER_ORDERS + f""",
    po AS (SELECT seller_id, order_id, sum(price) AS price FROM m_items GROUP BY 1, 2)
    SELECT seller_id, count(*) AS seller_total_orders,
      CAST(sum(price) AS DOUBLE) AS seller_total_revenue,
      {r('avg(review_score)')} AS seller_avg_review_score,
      {r('avg(total_delivery_days)')} AS seller_avg_delivery_days,
      {r('''avg(CASE WHEN order_delivered_customer_date IS NOT NULL THEN CAST(NOT is_late AS INT)
           END)''')} AS seller_on_time_rate,
      {r('avg(CAST(review_score <= 3 AS INT))')} AS seller_bad_review_rate
    FROM po LEFT JOIN (SELECT * FROM so LEFT JOIN m_latest_review USING (order_id)) USING (order_id)
    GROUP BY 1""")
def _(m):
    return measures.seller_scorecard(m)


_RECENCY = f"""CAST(floor((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(max(order_purchase_timestamp)))
    / 86400000000.0) AS BIGINT) AS recency_days"""


@register("a32_rfm", _FACTS + f"""
    SELECT customer_unique_id, {_RECENCY}, count(*) AS frequency,
      CAST(coalesce(sum(total_payment_value), 0) AS DOUBLE) AS monetary
    FROM facts WHERE customer_unique_id IS NOT NULL GROUP BY 1""")
def _(m):
    return measures.rfm(m, AS_OF)


@register("a33_churn_features", _FACTS + f""",
    f AS (SELECT o.customer_id AS customer_unique_id, min(order_purchase_timestamp) AS first_order
      FROM m_orders o GROUP BY 1),
    l AS (SELECT f.customer_unique_id, first_order, NOT bool_or(o.order_purchase_timestamp > first_order
        AND o.order_purchase_timestamp <= first_order + INTERVAL 180 DAY) AS churned
      FROM f JOIN m_orders o ON o.customer_id = f.customer_unique_id
      WHERE first_order + INTERVAL 180 DAY <= TIMESTAMP '{AS_OF}' GROUP BY 1, 2)
    SELECT customer_unique_id, churned, {_RECENCY}, count(*) AS frequency,
      CAST(coalesce(sum(total_payment_value), 0) AS DOUBLE) AS monetary,
      {r('avg(total_delivery_days)')} AS avg_delivery_days,
      {r('avg(approval_time_hrs)')} AS avg_approval_hrs,
      {r('avg(CAST(is_late AS INT))')} AS late_rate, {r('avg(review_score)')} AS avg_review_score,
      max(max_installments) AS max_installments,
      coalesce(bool_or(has_voucher), FALSE) AS has_voucher
    FROM facts JOIN l USING (customer_unique_id) WHERE order_purchase_timestamp = first_order
    GROUP BY 1, 2""")
def _(m):
    return measures.churn_features(m, AS_OF, 180)


_MONTHLY = _CAT + f""",
    mc AS (SELECT category_name_en, {month('order_purchase_timestamp')} AS month,
        count(*) AS n_items, sum(price) AS revenue, CAST(sum(price) AS DOUBLE) / count(price) AS avg_price
      FROM cat JOIN m_orders USING (order_id) GROUP BY 1, 2)"""


@register("a34_demand_features", _MONTHLY + f"""
    SELECT category_name_en, month, n_items, {r('avg_price')} AS avg_price,
      lag(n_items, 1) OVER (PARTITION BY category_name_en ORDER BY month) AS lag_1,
      lag(n_items, 2) OVER (PARTITION BY category_name_en ORDER BY month) AS lag_2 FROM mc""")
def _(m):
    return measures.demand_features(m)


@register("a35_spend_by_basket", f"""
    WITH s AS (SELECT order_id, count(*) AS n_items FROM m_items GROUP BY 1),
    o AS (SELECT n_items, total_payment_value AS v
      FROM s JOIN m_order_payments USING (order_id))
    SELECT n_items, count(*) AS n_orders, {r('CAST(sum(v) AS DOUBLE) / count(v)', 4)} AS mean_payment,
      {r('''(SELECT (CAST(sum(v) FILTER (WHERE n_items >= 4) AS DOUBLE) / count(v) FILTER (WHERE n_items >= 4))
           / (CAST(sum(v) FILTER (WHERE n_items = 1) AS DOUBLE) / count(v) FILTER (WHERE n_items = 1))
           FROM o)''', 4)} AS four_plus_vs_one
    FROM o GROUP BY 1""", digits=4)
def _(m):
    return measures.spend_by_basket(m)


def box(x, d=4):
    x = f"CAST({x} AS DOUBLE)"
    return (f"{r(f'min({x})', d)} AS min, {r(f'quantile_cont({x}, 0.25)', d)} AS q1, "
            f"{r(f'quantile_cont({x}, 0.5)', d)} AS median, "
            f"{r(f'quantile_cont({x}, 0.75)', d)} AS q3, {r(f'max({x})', d)} AS max")


@register("a36_box_days_by_score", f"""
    SELECT review_score, {box('delivery_days')} FROM m_joined
    WHERE review_score IS NOT NULL GROUP BY 1""", digits=4)
def _(m):
    return measures.box_days_by_score(m)


@register("a36_box_by_items", """
    WITH c AS (SELECT order_id, count(product_id) AS n_items FROM m_timed GROUP BY 1),
    t AS (SELECT m_timed.*, n_items FROM m_timed JOIN c USING (order_id)
      WHERE n_items BETWEEN 1 AND 10) """ + " UNION ALL ".join(f"""
    SELECT '{x}' AS measure, n_items, {box(x)} FROM t WHERE {x} IS NOT NULL GROUP BY 2"""
        for x in ["review_score", "delivery_delay", "payment_value"]), digits=4)
def _(m):
    return measures.box_by_items(m)


@register("a37_dispatch_sla", f"""
    SELECT seller_id, count(*) AS n_items,
      {r('avg(CAST(order_delivered_carrier_date <= shipping_limit_date AS INT))')}
        AS on_time_dispatch_rate
    FROM m_items JOIN m_orders USING (order_id)
    WHERE order_delivered_carrier_date IS NOT NULL GROUP BY 1""")
def _(m):
    return measures.dispatch_sla(m)


@register("a38_core_state_share", f"""
    SELECT {r(f"avg(CAST(coalesce(customer_state IN ({', '.join(repr(s) for s in ref.CORE_STATES)}), FALSE) AS INT))")}
      AS core_state_share FROM m_orders LEFT JOIN m_customers USING (customer_id)""")
def _(m):
    return measures.core_state_share(m)


@register("a39_score_trend", f"""
    SELECT {month('review_creation_date')} AS month, count(*) AS n_reviews,
      {r('avg(review_score)')} AS avg_score,
      {r('avg(CAST(review_score >= 4 AS INT))')} AS positive_share,
      {r('avg(CAST(review_score = 3 AS INT))')} AS neutral_share,
      {r('avg(CAST(review_score <= 2 AS INT))')} AS negative_share
    FROM m_latest_review GROUP BY 1""")
def _(m):
    return measures.score_trend(m)


@register("a40_freight_by_category", _CAT + f"""
    SELECT category_name_en, {r('avg(ratio)', 8)} AS mean_freight_ratio,
      CAST(sum(freight_value) AS DOUBLE) AS freight FROM cat GROUP BY 1""", digits=8)
def _(m):
    return measures.freight_by_category(m)


@register("a41_cohort_ltv", _FACTS + f""",
    p AS (SELECT customer_unique_id, {month('min(order_purchase_timestamp)')} AS cohort,
        coalesce(sum(total_payment_value), 0) AS ltv
      FROM facts WHERE customer_unique_id IS NOT NULL GROUP BY 1)
    SELECT cohort, count(*) AS n_customers, {r('CAST(sum(ltv) AS DOUBLE) / count(ltv)', 4)} AS mean_ltv FROM p GROUP BY 1""",
          digits=4)
def _(m):
    return measures.cohort_ltv(m)


@register("a42_place_volume", """
    SELECT customer_state, customer_city, count(*) AS n_orders
    FROM m_orders LEFT JOIN m_customers USING (customer_id) GROUP BY 1, 2""")
def _(m):
    return measures.place_volume(m)


@register("a43_cancellation_stage", """
    SELECT CASE WHEN order_delivered_customer_date IS NOT NULL THEN 'delivered'
      WHEN order_delivered_carrier_date IS NOT NULL THEN 'handed_to_carrier'
      WHEN order_approved_at IS NOT NULL THEN 'approved' ELSE 'purchased' END AS stage,
      count(*) AS n_orders
    FROM m_orders WHERE order_status = 'canceled' GROUP BY 1""")
def _(m):
    return measures.cancellation_stage(m)


@register("a44_by_payment_method", f"""
    SELECT primary_payment_type, count(*) AS n_orders,
      {r('CAST(sum(total_payment_value) AS DOUBLE) / count(total_payment_value)', 4)} AS mean_order_value,
      {r('avg(review_score)', 4)} AS mean_score
    FROM m_order_payments LEFT JOIN m_latest_review USING (order_id) GROUP BY 1""", digits=4)
def _(m):
    return measures.by_payment_method(m)


@register("a45_repeat_by_installments", _FACTS + f""",
    p AS (SELECT customer_unique_id, max(max_installments) AS d, count(*) AS n FROM facts
      WHERE customer_unique_id IS NOT NULL GROUP BY 1)
    SELECT CASE WHEN d <= 1 THEN '1' WHEN d <= 5 THEN '2-5' ELSE '6+' END AS installments,
      count(*) AS n_customers, {r('avg(CAST(n > 1 AS INT))')} AS repeat_rate
    FROM p WHERE d IS NOT NULL GROUP BY 1""")
def _(m):
    return measures.repeat_by_installments(m)


@register("a46_late_one_star", _SILVER_ORDERS + f"""
    SELECT is_late, count(*) AS n_reviews, {r('avg(CAST(review_score = 1 AS INT))')} AS one_star_rate
    FROM so JOIN m_latest_review USING (order_id)
    WHERE order_delivered_customer_date IS NOT NULL GROUP BY 1""")
def _(m):
    return measures.late_one_star(m)


@register("a47_size_vs_freight", f"""
    SELECT {r('corr(CAST(product_weight_g AS DOUBLE), CAST(freight_value AS DOUBLE))')}
        AS weight_freight,
      {r('''corr(CAST(product_length_cm * product_height_cm * product_width_cm AS DOUBLE),
           CAST(freight_value AS DOUBLE))''')} AS volume_freight
    FROM m_items LEFT JOIN m_products USING (product_id)""")
def _(m):
    return measures.size_vs_freight(m)


@register("a48_listing_vs_score", f"""
    SELECT {r('corr(CAST(product_photos_qty AS DOUBLE), CAST(review_score AS DOUBLE))')}
        AS photos_score,
      {r('corr(CAST(product_description_lenght AS DOUBLE), CAST(review_score AS DOUBLE))')}
        AS description_score
    FROM m_items LEFT JOIN m_products USING (product_id) JOIN m_latest_review USING (order_id)""")
def _(m):
    return measures.listing_vs_score(m)


@register("a49_category_growth", _MONTHLY + f""",
    g AS (SELECT category_name_en, month, CAST(revenue AS DOUBLE) AS rev,
        lag(CAST(revenue AS DOUBLE)) OVER (PARTITION BY category_name_en ORDER BY month) AS prev,
        CAST(month[1:4] AS INT) * 12 + CAST(month[6:7] AS INT) AS idx FROM mc)
    SELECT category_name_en, month, rev AS revenue,
      {r('CASE WHEN prev <> 0 THEN (rev - prev) / prev END', 4)} AS change,
      {r('regr_slope(rev, idx) OVER (PARTITION BY category_name_en)', 4)} AS trend_slope
    FROM g""", digits=4)
def _(m):
    return measures.category_growth(m)


@register("a50_state_coverage", _SILVER_ORDERS + f""",
    s AS (SELECT seller_state, count(*) AS n_sellers FROM m_sellers GROUP BY 1),
    v AS (SELECT seller_state, avg(total_delivery_days) AS d FROM m_items
      JOIN m_sellers USING (seller_id) JOIN so USING (order_id) GROUP BY 1),
    c AS (SELECT customer_state, count(*) AS n_orders FROM m_orders
      JOIN m_customers USING (customer_id) GROUP BY 1)
    SELECT coalesce(s.seller_state, customer_state) AS state,
      coalesce(n_sellers, 0) AS n_sellers, coalesce(n_orders, 0) AS n_orders,
      {r('d')} AS avg_delivery_days, {r('n_orders / n_sellers')} AS orders_per_seller
    FROM s LEFT JOIN v ON v.seller_state = s.seller_state
      FULL JOIN c ON c.customer_state = s.seller_state""")
def _(m):
    return measures.state_coverage(m)


_DISTANCE = _SILVER_ORDERS + f""",
    dist AS (SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id,
        {secs('so.order_delivered_customer_date', 'so.order_purchase_timestamp')} / 86400 AS days,
        2 * 6371.0 * asin(sqrt(least(1.0, pow(sin((radians(b.lat) - radians(a.lat)) / 2), 2)
          + cos(radians(a.lat)) * cos(radians(b.lat))
          * pow(sin((radians(b.lng) - radians(a.lng)) / 2), 2)))) AS km
      FROM m_items i JOIN so USING (order_id)
      LEFT JOIN m_sellers s ON s.seller_id = i.seller_id
      LEFT JOIN m_zip_centroid a ON a.zip = s.seller_zip_code_prefix
      LEFT JOIN m_customers c ON c.customer_id = so.customer_id
      LEFT JOIN m_zip_centroid b ON b.zip = c.customer_zip_code_prefix)"""


@register("a51_distance_vs_days", _DISTANCE + f"""
    SELECT {r('corr(km, days)')} AS distance_days, count(km + days) AS n FROM dist""")
def _(m):
    return measures.distance_vs_days(m)


@register("j09_item_distances", _DISTANCE + f"""
    SELECT order_id, order_item_id, product_id, seller_id, {r('km', 4)} AS distance_km FROM dist""",
          digits=4)
def _(m):
    return measures.item_distances(m).drop("total_delivery_days")


@register("a52_price_by_category", _CAT + f"""
    SELECT category_name_en, count(price) AS n, {r('avg(CAST(price AS DOUBLE))', 4)} AS mean,
      {r('stddev_samp(CAST(price AS DOUBLE))', 4)} AS std, {box('price')}
    FROM cat GROUP BY 1""", digits=4)
def _(m):
    return measures.price_by_category(m)
