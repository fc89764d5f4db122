"""Windows, sorts, limits and set operations (W1 to W4, L1 to L4) and user rules."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tradepath.operators import quality as q
from tradepath.operators.cleaning import latest_per_key
from tradepath.operators.quantiles import average_ranks
from tradepath.plans import measures
from tradepath.registry import register
from tradepath.registry.measures import _MONTHLY
from tradepath.registry.silver import r
from tradepath.registry.validation import report, result_sql


@register("w01_latest_order_per_customer", """
    SELECT customer_id, order_id, order_status FROM (
      SELECT *, row_number() OVER (PARTITION BY customer_id
        ORDER BY order_purchase_timestamp DESC, order_id DESC) AS rn FROM m_orders) WHERE rn = 1""")
def _(m):
    orders = m.orders.select("customer_id", "order_purchase_timestamp", "order_id", "order_status")
    return latest_per_key(
        orders, ["customer_id"], ["order_purchase_timestamp", "order_id"]
    ).drop("order_purchase_timestamp")


@register("w03_average_rank", f"""
    SELECT CAST(payment_value AS DOUBLE) AS value, count(*) AS n,
      {r('min(rk) + (count(*) - 1) / 2.0', 2)} AS avg_rank
    FROM (SELECT payment_value, rank() OVER (ORDER BY payment_value) AS rk FROM m_payments)
    GROUP BY payment_value""")
def _(m):
    return average_ranks(m.payments, "payment_value", "payment_type").select(
        F.col("v").alias("value"), F.col("n_value").alias("n"), "avg_rank").distinct()


@register("w04_lag_lead", _MONTHLY + """
    SELECT category_name_en, month, n_items,
      lag(n_items) OVER (PARTITION BY category_name_en ORDER BY month) AS before,
      lead(n_items) OVER (PARTITION BY category_name_en ORDER BY month) AS after FROM mc""")
def _(m):
    w = Window.partitionBy(measures.CATEGORY).orderBy("month")
    return measures.monthly_category(m).select(
        measures.CATEGORY, "month", "n_items", F.lag("n_items").over(w).alias("before"),
        F.lead("n_items").over(w).alias("after"))


@register("l01_sort", """
    SELECT order_status, count(*) AS n FROM m_orders GROUP BY 1 ORDER BY n DESC, order_status""")
def _(m):
    return m.orders.groupBy("order_status").agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc("n"), "order_status")


@register("l02_largest_payments", """
    SELECT order_id, payment_sequential, CAST(payment_value AS DOUBLE) AS payment_value
    FROM m_payments ORDER BY m_payments.payment_value DESC, order_id, payment_sequential LIMIT 10""")
def _(m):
    return m.payments.orderBy(F.desc("payment_value"), "order_id", "payment_sequential").limit(
        10).select("order_id", "payment_sequential", "payment_value")


@register("l02_smallest_payments", """
    SELECT order_id, payment_sequential, CAST(payment_value AS DOUBLE) AS payment_value
    FROM m_payments ORDER BY m_payments.payment_value, order_id, payment_sequential LIMIT 10""")
def _(m):
    return m.payments.orderBy("payment_value", "order_id", "payment_sequential").limit(
        10).select("order_id", "payment_sequential", "payment_value")


@register("l03_column_sets", """
    SELECT count(*) AS n_rows, 'review_title' AS missing, 'review_creation_date' AS extra
    FROM m_reviews""")
def _(m):
    check = q.SchemaCheck(["review_id", "order_id", "review_score", "review_title"])
    missing, extra, _wrong = check.findings(m.reviews)
    return m.reviews.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(",".join(missing)).alias("missing"), F.lit(",".join(extra)).alias("extra"))


@register("l04_distinct_values", "SELECT DISTINCT payment_type FROM m_payments")
def _(m):
    return m.payments.select("payment_type").distinct()


_PROMISE = "order_estimated_delivery_date >= order_purchase_timestamp + INTERVAL 10 DAY"


@register("u01_user_rule", result_sql(
    "business_rule_validation", "m_orders", f"NOT ({_PROMISE})",
    {"ten_days_promised": f"NOT ({_PROMISE})"}))
def _(m):
    rule = q.Rule("ten_days_promised", ["order_estimated_delivery_date"],
                  lambda: F.expr("order_estimated_delivery_date >= "
                                 "order_purchase_timestamp + INTERVAL 10 DAYS"))
    return report(q.run_checks(m.orders, [q.RuleCheck([rule])]))
