"""Joins (J1 to J7; J8 and J9 are with the warehouse and the measures)."""

from pyspark.sql import functions as F

from tradepath.operators import joins
from tradepath.plans import kpis, silver, stages
from tradepath.registry import register
from tradepath.registry.silver import r


@register("j01_left_join_chain", """
    SELECT order_status, payment_type, seller_city, count(*) AS n,
      CAST(sum(price) AS DOUBLE) AS price, CAST(sum(payment_value) AS DOUBLE) AS paid,
      CAST(sum(review_score) AS BIGINT) AS score
    FROM m_joined GROUP BY 1, 2, 3""")
def _(m):
    rows = stages.joined(m, dims=[stages.PRODUCTS, stages.SELLERS, stages.CUSTOMERS])
    return rows.groupBy("order_status", "payment_type", "seller_city").agg(
        F.count(F.lit(1)).alias("n"), F.sum("price").alias("price"),
        F.sum("payment_value").alias("paid"), F.sum("review_score").alias("score"))


@register("j02_join_on_different_names", f"""
    SELECT customer_id, customer_zip_code_prefix, {r('lat')} AS lat, {r('lng')} AS lng
    FROM m_customers LEFT JOIN m_zip_centroid ON zip = customer_zip_code_prefix""")
def _(m):
    out = joins.left_on(m.customers, stages.zip_centroids(m), "customer_zip_code_prefix", "zip")
    return out.select("customer_id", "customer_zip_code_prefix", "lat", "lng")


@register("j03_group_count_back", """
    SELECT order_id, order_item_id, product_id, n_items
    FROM m_items JOIN (SELECT order_id, count(*) AS n_items FROM m_items GROUP BY 1)
      USING (order_id)""")
def _(m):
    items = m.items.select("order_id", "order_item_id", "product_id")
    return joins.with_group_count(items, ["order_id"], "n_items")


@register("j04_map_as_join", """
    SELECT order_id, n_items FROM m_orders
    LEFT JOIN (SELECT order_id, count(DISTINCT product_id) AS n_items FROM m_items GROUP BY 1)
      USING (order_id)""")
def _(m):
    distinct = m.items.groupBy("order_id").agg(F.count_distinct("product_id").alias("n_items"))
    return m.orders.select("order_id").join(distinct, "order_id", "left")


@register("j05_semi_join", """
    SELECT order_id, order_status FROM m_orders WHERE order_id IN (SELECT order_id FROM m_items)""")
def _(m):
    return joins.matching(m.orders, m.items, ["order_id"]).select("order_id", "order_status")


@register("j05_anti_join", """
    SELECT order_id, order_status FROM m_orders
    WHERE order_id NOT IN (SELECT order_id FROM m_items)""")
def _(m):
    return joins.missing(m.orders, m.items, ["order_id"]).select("order_id", "order_status")


@register("j06_zip_centroids", f"""
    SELECT zip, {r('lat')} AS lat, {r('lng')} AS lng FROM m_zip_centroid""")
def _(m):
    return stages.zip_centroids(m)


@register("j07_payments_before_join", """
    SELECT count(*) AS n_rows, count(DISTINCT order_id) AS n_orders,
      CAST(sum(total_payment_value) AS DOUBLE) AS paid
    FROM m_orders LEFT JOIN m_order_payments USING (order_id)""")
def _(m):
    out = m.orders.select("order_id").join(silver.order_payments(m), "order_id", "left")
    return out.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("order_id").alias("n_orders"),
                   F.sum("total_payment_value").alias("paid"))


@register("w02_group_transform", f"""
    SELECT order_id, order_item_id, i.product_id, {r('quantile_cont(CAST(price AS DOUBLE), 0.5)'
        ' OVER (PARTITION BY product_category_english)', 4)} AS category_median
    FROM m_items i LEFT JOIN m_english USING (product_id)""", digits=4)
def _(m):
    items = m.items.join(
        stages.english_products(m).select("product_id", kpis.CATEGORY), "product_id", "left")
    return joins.with_group_median(items, kpis.CATEGORY, "price", "category_median").select(
        "order_id", "order_item_id", "product_id", "category_median")
