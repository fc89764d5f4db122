"""Figures of the analysis notebook."""

from tradepath.operators import profile
from tradepath.plans import kpis, stages
from tradepath.registry import register
from tradepath.registry.silver import _GEO_JOINED, r

C = "product_category_english"


@register("a01_value_counts", f"""
    SELECT payment_type, count(*) AS n, {r('count(*) / (SELECT count(*) FROM m_joined)')} AS share
    FROM m_joined GROUP BY 1""")
def _(m):
    rows = stages.joined(m, [stages.PAYMENTS])
    return profile.value_counts(rows, ["payment_type"], "share", "copies")


@register("a01_value_counts_delivery_days", """
    SELECT delivery_days, count(*) AS n FROM m_joined WHERE delivery_days IS NOT NULL GROUP BY 1
    ORDER BY n DESC, delivery_days LIMIT 5""")
def _(m):
    counts = profile.value_counts(stages.joined(m, ()), ["delivery_days"], copies="copies")
    return counts.orderBy(counts.n.desc(), "delivery_days").limit(5)


@register("a02_days_by_score", f"""
    SELECT review_score, {r('quantile_cont(delivery_days, 0.5)')} AS median_days,
      {r('avg(delivery_days)')} AS mean_days, CAST(sum(delivery_days) AS BIGINT) AS total_days,
      count(*) AS n FROM m_joined WHERE review_score IS NOT NULL GROUP BY 1""")
def _(m):
    return kpis.days_by_score(m)


@register("a03_bad_share_by_category", f"""
    SELECT {C}, {r('avg(CAST(bad_score AS INT))')} AS bad_share FROM m_joined
    WHERE {C} IS NOT NULL GROUP BY 1""")
def _(m):
    return kpis.bad_share_by_category(m)


_S = ", ".join(r(f"count(*) FILTER (WHERE review_score = {s}) / count(review_score)")
               + f" AS score_{s}" for s in range(1, 6))


@register("a04_score_crosstab", f"""
    SELECT {C}, count(*) AS category_rows, {_S},
      {r('count(*) FILTER (WHERE review_score <= 3) / count(review_score)')} AS bad_share,
      {r('count(*) FILTER (WHERE review_score >= 4) / count(review_score)')} AS good_share
    FROM m_joined WHERE {C} IS NOT NULL GROUP BY 1 HAVING count(*) > 100
    ORDER BY count(*) FILTER (WHERE review_score <= 3) / count(review_score) DESC, 1 LIMIT 15""")
def _(m):
    return kpis.score_crosstab(m)


@register("a05_comment_share", f"""
    SELECT review_score,
      {r('100 - 100 * avg(CAST(review_comment_message IS NULL AS INT))')} AS comment_share
    FROM m_reviews_text GROUP BY 1""")
def _(m):
    return kpis.comment_share(m)


def _both(value, inner):
    return f"""WITH v AS ({inner})
    (SELECT *, 'top' AS side FROM v WHERE {value} IS NOT NULL ORDER BY {value} DESC, {C} LIMIT 10)
    UNION ALL
    (SELECT *, 'bottom' FROM v WHERE {value} IS NOT NULL ORDER BY {value}, {C} LIMIT 10)"""


@register("a06_category_sales", _both("n", f"""
    SELECT {C}, count(*) AS n FROM m_delivered WHERE {C} IS NOT NULL GROUP BY 1"""))
def _(m):
    return kpis.category_sales(m)


@register("a06_category_rating", _both("rating", f"""
    SELECT {C}, round_even(avg(review_score), 3) AS rating FROM m_delivered
    WHERE {C} IS NOT NULL GROUP BY 1"""))
def _(m):
    return kpis.category_rating(m)


@register("a06_category_delivery_days", _both("days", f"""
    SELECT {C}, CAST(round_even(avg(delivery_days), 0) AS BIGINT) AS days FROM m_delivered
    WHERE {C} IS NOT NULL GROUP BY 1"""))
def _(m):
    return kpis.category_days(m)


@register("a06_category_payment", _both("median_payment", f"""
    SELECT {C}, CAST(round_even(quantile_cont(CAST(payment_value AS DOUBLE), 0.5), 0) AS BIGINT)
      AS median_payment FROM m_delivered WHERE {C} IS NOT NULL GROUP BY 1"""))
def _(m):
    return kpis.category_payment(m)


@register("a07_payment_share", """
    SELECT payment_type, round_even(100 * count(*) / (SELECT count(*) FROM m_joined), 2) AS percent
    FROM m_joined GROUP BY 1 ORDER BY count(*) DESC, payment_type LIMIT 4""")
def _(m):
    return kpis.payment_share(m)


@register("a07_payment_mean", """
    SELECT payment_type, round_even(avg(CAST(payment_value AS DOUBLE)), 0) AS mean_payment
    FROM m_joined GROUP BY 1 HAVING count(payment_value) > 0 ORDER BY 2 DESC, 1 LIMIT 4""")
def _(m):
    return kpis.payment_mean(m)


@register("a08_installment_ratio", f"""
    SELECT {r('100 * avg(CAST(coalesce(payment_installments > 1, FALSE) AS INT))')}
      AS installment_percent FROM m_joined""")
def _(m):
    return kpis.installment_ratio(m)


@register("a08_installments_by_category", f"""
    SELECT {C}, {r('avg(CAST(coalesce(payment_installments > 1, FALSE) AS INT))')} AS ratio
    FROM m_joined WHERE {C} IS NOT NULL GROUP BY 1
    ORDER BY avg(CAST(coalesce(payment_installments > 1, FALSE) AS INT)) DESC, 1 LIMIT 10""")
def _(m):
    return kpis.installments_by_category(m)


@register("a09_city_mean_payment", """
    SELECT customer_city, round_even(avg(CAST(payment_value AS DOUBLE)), 0) AS mean_payment
    FROM m_joined WHERE customer_city IS NOT NULL GROUP BY 1""")
def _(m):
    return kpis.city_mean_payment(m)


@register("a09_state_summary", _GEO_JOINED + f""",
    f2 AS (SELECT * REPLACE (
        coalesce(lat, (SELECT quantile_cont(lat, 0.5) FROM filled)) AS lat,
        coalesce(lng, (SELECT quantile_cont(lng, 0.5) FROM filled)) AS lng) FROM filled)
    SELECT customer_state,
      round_even(quantile_cont(CAST(payment_value AS DOUBLE), 0.5), 0) AS median_payment,
      count(*) AS order_count, {r('quantile_cont(lat, 0.5)')} AS lat,
      {r('quantile_cont(lng, 0.5)')} AS lng,
      CASE WHEN count(*) >= 5000 THEN 'Large (≥ 5000)' WHEN count(*) >= 1000
        THEN 'Medium (1000–4999)' ELSE 'Small (< 1000)' END AS volume_group
    FROM f2 WHERE customer_state IS NOT NULL GROUP BY 1""")
def _(m):
    return kpis.state_summary(m)


@register("a10_stage_durations", " UNION ALL ".join(f"""
    SELECT '{s}' AS stage, {r(f'avg({s})', 3)} AS mean, {r(f'quantile_cont({s}, 0.5)', 3)} AS median,
      {r(f'stddev_samp({s})', 3)} AS std,
      {r(f'round_even(quantile_cont({s}, 0.5), 0) / 3600', 3)} AS median_hours,
      {r(f'round_even(stddev_samp({s}), 0) / 3600', 3)} AS std_hours
    FROM m_timed""" for s in stages.DURATIONS), digits=3)
def _(m):
    return kpis.stage_durations(m)


@register("a11_delivery_status_share", f"""
    SELECT * FROM (SELECT delivery_status,
      {r('100 * count(*) / (SELECT count(*) FROM m_timed)')} AS percent
    FROM m_timed GROUP BY 1) WHERE delivery_status <> 'missing'""")
def _(m):
    return kpis.delivery_status_share(m)


_MIX = ", ".join(r(f"100 * count(*) FILTER (WHERE review_score = {s}) / count(review_score)")
                 + f" AS score_{s}" for s in range(1, 6))


@register("a12_score_by_status", f"""
    SELECT delivery_status, {_MIX} FROM m_timed WHERE review_score IS NOT NULL GROUP BY 1""")
def _(m):
    return kpis.score_by_status(m)


@register("a13_late_early_scores", f"""
    SELECT {r("avg(review_score) FILTER (WHERE delivery_status = 'late')")} AS late_mean_score,
      {r("avg(review_score) FILTER (WHERE delivery_status = 'early')")} AS early_mean_score
    FROM m_timed""")
def _(m):
    return kpis.late_early_scores(m)


@register("a14_state_delay", f"""
    SELECT customer_state, {r('quantile_cont(delivery_delay, 0.5)')} AS median_delay, count(*) AS n
    FROM m_timed WHERE customer_state IS NOT NULL GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10""")
def _(m):
    return kpis.state_delay(m)


def _repeat(view):
    return f"""SELECT count(*) AS n_customers, count(*) FILTER (WHERE n > 1) AS n_repeat,
      {r('count(*) FILTER (WHERE n > 1) / count(*)')} AS repeat_ratio
    FROM (SELECT customer_unique_id, count(DISTINCT order_id) AS n FROM {view}
          WHERE customer_unique_id IS NOT NULL GROUP BY 1)"""


@register("a15_repeat_ratio", _repeat("m_timed"))
def _(m):
    return kpis.repeat_ratio(kpis.timed_orders(m))


@register("a15_retention", _repeat("m_delivered"))
def _(m):
    return kpis.repeat_ratio(kpis.delivered_orders(m))


@register("a16_basket_sizes", """
    SELECT n_items, count(*) AS n_orders FROM (
      SELECT order_id, count(product_id) AS n_items FROM m_timed GROUP BY 1)
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 7""")
def _(m):
    return kpis.basket_sizes(m)


@register("a17_conversion", f"""
    SELECT {r("avg(CAST(order_status = 'delivered' AS INT))")} AS conversion FROM m_timed""")
def _(m):
    return kpis.conversion(m)


_Q = """WITH d AS (SELECT *, CAST(payment_value AS DOUBLE) AS v FROM m_delivered),
    q AS (SELECT quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM d),
    i AS (SELECT * FROM d WHERE v > (SELECT q1 FROM q) AND v < (SELECT q3 FROM q))"""


@register("a18_order_value", _Q + f"""
    SELECT {r('avg(v)', 4)} AS aov, {r('stddev_samp(v)', 4)} AS aov_std,
      (SELECT {r('avg(v)', 4)} FROM i) AS iqr_aov, (SELECT {r('stddev_samp(v)', 4)} FROM i) AS iqr_std,
      (SELECT {r('CAST(sum(payment_value) AS DOUBLE) / count(DISTINCT order_id)', 4)}
       FROM m_payments WHERE order_id IN (SELECT order_id FROM m_delivered)) AS aov_per_order
    FROM d""", digits=4)
def _(m):
    return kpis.order_value(m)


@register("a19_revenue_per_customer", _Q + f"""
    SELECT {r('CAST(sum(payment_value) AS DOUBLE) / count(DISTINCT customer_unique_id)', 4)} AS arpu,
      {r('(SELECT CAST(sum(payment_value) AS DOUBLE) FROM i) / count(DISTINCT customer_unique_id)',
         4)} AS iqr_arpu FROM d""", digits=4)
def _(m):
    return kpis.revenue_per_customer(m)


_LTV = """WITH l AS (SELECT customer_unique_id, CAST(coalesce(sum(payment_value), 0) AS DOUBLE) AS ltv
    FROM m_delivered WHERE customer_unique_id IS NOT NULL GROUP BY 1)"""


@register("a20_lifetime_summary", _LTV + f"""
    SELECT count(*) AS n_customers, {r('avg(ltv)', 4)} AS mean,
      {r('quantile_cont(ltv, 0.5)', 4)} AS median, {r('quantile_cont(ltv, 0.75)', 4)} AS q75 FROM l""",
          digits=4)
def _(m):
    return kpis.lifetime_summary(m)


@register("a20_lifetime_top5", _LTV + f"""
    SELECT customer_unique_id, {r('ltv', 2)} AS ltv FROM l
    WHERE ltv > (SELECT quantile_cont(ltv, 0.75) FROM l)
    ORDER BY l.ltv DESC, customer_unique_id LIMIT 5""", digits=2)
def _(m):
    return kpis.lifetime_top(m)


@register("a21_delivery_accuracy", f"""
    SELECT {r('avg(delivery_delay)')} AS mean_delay_days FROM m_delivered""")
def _(m):
    return kpis.delivery_accuracy(m)


@register("a22_review_figures", f"""
    SELECT {r('avg(review_score)')} AS mean_score, {r('stddev_samp(review_score)')} AS std_score,
      count(*) FILTER (WHERE bad_score) AS bad_reviews,
      {r('100 * avg(CAST(bad_score AS INT))')} AS bad_percent FROM m_delivered""")
def _(m):
    return kpis.review_figures(m)


@register("a23_early_review_share", f"""
    SELECT {r('100 * avg(CAST(coalesce(review_creation_date < order_delivered_customer_date, FALSE) AS INT))')}
      AS early_review_percent FROM m_delivered""")
def _(m):
    return kpis.early_review_share(m)


@register("a24_review_lag", f"""
    SELECT {r('avg(x)', 3)} AS mean_seconds, {r('quantile_cont(x, 0.5)', 3)} AS median_seconds FROM (
      SELECT (epoch_us(review_creation_date) - epoch_us(order_delivered_customer_date)) / 1000000.0
        AS x FROM m_delivered) WHERE x >= 0""", digits=3)
def _(m):
    return kpis.review_lag(m)


@register("a25_seven_day_sla", f"""
    SELECT {r('100 * count(*) FILTER (WHERE total_time <= 604800) / (SELECT count(*) FROM m_delivered)')}
        AS mixed_percent,
      {r('''100 * count(*) FILTER (WHERE total_time <= 604800 AND order_status = 'delivered')
         / count(*) FILTER (WHERE order_status = 'delivered')''')} AS corrected_percent
    FROM m_timed""")
def _(m):
    return kpis.sla_seven_days(m)


@register("a26_category_revenue_top10", f"""
    SELECT {C}, CAST(round_even(CAST(coalesce(sum(payment_value), 0) AS DOUBLE), 0) AS DOUBLE) AS revenue
    FROM m_delivered WHERE {C} IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def _(m):
    return kpis.category_revenue(m)


@register("a27_voucher_share", f"""
    SELECT count(*) FILTER (WHERE payment_type = 'voucher') AS voucher_rows,
      {r("100 * count(*) FILTER (WHERE payment_type = 'voucher') / count(payment_type)")}
        AS voucher_percent FROM m_delivered""")
def _(m):
    return kpis.voucher_share(m)


_BOARD = {
    "Conversion Rate %": "(SELECT 100 * avg(CAST(order_status = 'delivered' AS INT)) FROM m_timed)",
    "Customer Retention %": """(SELECT 100 * count(*) FILTER (WHERE n > 1) / count(*) FROM (
        SELECT customer_unique_id, count(DISTINCT order_id) AS n FROM m_delivered GROUP BY 1))""",
    "AOV R$": "(SELECT avg(CAST(payment_value AS DOUBLE)) FROM m_delivered)",
    "ARPU R$": """(SELECT CAST(sum(payment_value) AS DOUBLE) / count(DISTINCT customer_unique_id)
        FROM m_delivered)""",
    "Avg LTV R$": """(SELECT avg(v) FROM (SELECT CAST(coalesce(sum(payment_value), 0) AS DOUBLE) AS v
        FROM m_delivered WHERE customer_unique_id IS NOT NULL GROUP BY customer_unique_id))""",
    "Delivery Accuracy (d)": "(SELECT -avg(delivery_delay) FROM m_delivered)",
    "Review Score": "(SELECT avg(review_score) FROM m_delivered)",
    "Bad Reviews %": "(SELECT 100 * avg(CAST(bad_score AS INT)) FROM m_delivered)",
    "Shipping Time (d)": "(SELECT quantile_cont(shipping_time, 0.5) / 86400 FROM m_timed)",
    "Voucher Usage %": """(SELECT 100 * avg(CAST(payment_type = 'voucher' AS INT))
        FROM m_delivered)""",
}


@register("a28_scoreboard", " UNION ALL ".join(
    f"SELECT '{k}' AS metric, {r(v, 4)} AS value" for k, v in _BOARD.items()), digits=4)
def _(m):
    return kpis.scoreboard(m)
