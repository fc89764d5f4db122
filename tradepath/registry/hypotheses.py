"""Hypothesis tests (H1 to H8)."""

from tradepath.operators import hypothesis as tests
from tradepath.plans import experiments
from tradepath.registry import register
from tradepath.registry.silver import _SILVER_ORDERS, r

C = "product_category_english"


def _ranks(source):
    """CTEs d (g, v), ranked and per-group sums with the tie term."""
    return f"""WITH d AS ({source}),
    ranked AS (SELECT g, v, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0 AS rk
      FROM d),
    ties AS (SELECT sum(CAST(t AS DOUBLE) * t * t - t) AS tie, CAST(sum(t) AS DOUBLE) AS n
      FROM (SELECT count(*) AS t FROM d GROUP BY v)),
    gs AS (SELECT g, count(*) AS n, sum(rk) AS rs FROM ranked GROUP BY g)"""


def _mwu(source, a, b):
    return _ranks(source) + f""",
    x AS (SELECT (SELECT CAST(n AS DOUBLE) FROM gs WHERE g = '{a}') AS n1,
        (SELECT CAST(n AS DOUBLE) FROM gs WHERE g = '{b}') AS n2,
        (SELECT rs FROM gs WHERE g = '{a}') AS r1, (SELECT tie FROM ties) AS tie),
    y AS (SELECT *, r1 - n1 * (n1 + 1) / 2 AS u FROM x)
    SELECT CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2, {r('u', 2)} AS u,
      {r('''(greatest(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5) / sqrt(n1 * n2 / 12
        * ((n1 + n2 + 1) - tie / ((n1 + n2) * (n1 + n2 - 1))))''')} AS z FROM y"""


def _kw(source):
    return _ranks(source) + f"""
    SELECT (SELECT count(*) FROM gs) AS groups, CAST(n AS BIGINT) AS n,
      {r('''(12 / (n * (n + 1)) * (SELECT sum(rs * rs / gs.n) FROM gs) - 3 * (n + 1))
        / (1 - tie / (n * n * n - n))''')} AS h, (SELECT count(*) - 1 FROM gs) AS dof FROM ties"""


_Z = """abs(a.rs / a.n - b.rs / b.n) / sqrt((t.n * (t.n + 1) / 12 - t.tie / (12 * (t.n - 1)))
        * (1.0 / a.n + 1.0 / b.n))"""


def _dunn(source, z=r(_Z)):
    return _ranks(source) + f"""
    SELECT a.g AS group_a, b.g AS group_b, {z} AS z,
      (SELECT CAST(count(*) * (count(*) - 1) // 2 AS BIGINT) FROM gs) AS n_pairs
    FROM gs a JOIN gs b ON a.g < b.g CROSS JOIN ties t"""


@register("h01_late_bad_reviews", f"""
    WITH c AS (SELECT count(*) FILTER (WHERE bad_score AND delivery_delay > 0) AS a,
      count(*) FILTER (WHERE delivery_delay > 0) AS n1,
      count(*) FILTER (WHERE bad_score AND NOT delivery_delay > 0) AS b,
      count(*) FILTER (WHERE NOT delivery_delay > 0) AS n2
      FROM m_delivered WHERE review_score IS NOT NULL)
    SELECT a AS success_treated, n1 AS n_treated, b AS success_other, n2 AS n_other,
      {r('''(a / n1 - b / n2) / sqrt(((a + b) / (n1 + n2)) * (1 - (a + b) / (n1 + n2))
        * (1 / n1 + 1 / n2))''')} AS z FROM c""")
def _(m):
    return experiments.late_bad_reviews(m)


@register("h02_early_late_scores", _mwu("""
    SELECT delivery_status AS g, review_score AS v FROM m_timed
    WHERE review_score IS NOT NULL AND delivery_status IN ('early', 'late')""", "early", "late"))
def _(m):
    return experiments.early_late_scores(m)


_VALUE = """SELECT payment_type AS g, CAST(payment_value AS DOUBLE) AS v FROM m_delivered
    WHERE payment_value IS NOT NULL"""
_RATIO = """SELECT payment_type AS g, CAST(payment_value AS DOUBLE) / CAST(price AS DOUBLE) AS v
    FROM m_delivered WHERE payment_value IS NOT NULL AND price <> 0"""
_BASKET_ROWS = """SELECT DISTINCT order_id, review_score, n_items,
      CASE n_items WHEN 1 THEN '1 item' WHEN 2 THEN '2 items' ELSE '3+ items' END AS item_group
    FROM m_delivered JOIN (SELECT order_id, count(DISTINCT product_id) AS n_items
      FROM m_delivered GROUP BY 1) USING (order_id)
    WHERE payment_value IS NOT NULL AND review_score IS NOT NULL"""
_BASKET = f"SELECT item_group AS g, review_score AS v FROM ({_BASKET_ROWS})"


@register("h03_payment_value_by_type", _kw(_VALUE))
def _(m):
    return experiments.payment_value_by_type(m)


@register("h03_overpayment_by_type", _kw(_RATIO))
def _(m):
    return experiments.overpayment_by_type(m)


@register("h03_basket_scores", _kw(_BASKET))
def _(m):
    return experiments.basket_test(m)


@register("h04_payment_value_pairs", _dunn(_VALUE))
def _(m):
    return experiments.payment_value_pairs(m)


@register("h04_overpayment_pairs", _dunn(_RATIO))
def _(m):
    return experiments.overpayment_pairs(m)


@register("h04_basket_pairs", _dunn(_BASKET))
def _(m):
    return experiments.basket_pairs(m)


# the upper tail by the series z^(2k+1) / (1 * 3 * ... * (2k+1)); beyond 8 it is 0 in six places
_TAIL = """CASE WHEN z > 8 THEN 0 WHEN z <= 0 THEN 0.5 ELSE 0.5 - exp(-z * z / 2) / sqrt(2 * pi())
    * list_sum(list_transform(range(0, 250), lambda k: exp((2 * k + 1) * ln(z)
      - (lgamma(2 * k + 2) - k * ln(2) - lgamma(k + 1))))) END"""


@register("h04_basket_pairs_probability", f"""
    WITH p AS (SELECT *, least(2 * {_TAIL}, 1.0) AS tails FROM ({_dunn(_BASKET, _Z)}))
    SELECT group_a, group_b, {r('z')} AS z, n_pairs, {r('tails')} AS p_raw,
      {r('least(tails * n_pairs, 1.0)')} AS p_value FROM p""")
def _(m):
    return tests.dunn_bonferroni(
        experiments.basket_scores(m), "review_score", "item_group"
    )


# three groups, so two degrees of freedom, whose upper tail has a closed form
@register("h03_basket_probability", f"""
    SELECT *, {r('exp(-h / 2)')} AS p_value FROM ({_kw(_BASKET)})""")
def _(m):
    return tests.add_chi_square_p(experiments.basket_test(m), "h", "dof")


_COHORT = f"""s AS (SELECT {C}, count(*) AS n_reviews FROM m_delivered
      WHERE payment_value IS NOT NULL AND {C} IS NOT NULL AND review_score IS NOT NULL
      GROUP BY 1 HAVING count(*) >= 30),
    top AS (SELECT * FROM s ORDER BY n_reviews DESC, {C} LIMIT 10),
    low AS (SELECT * FROM s ORDER BY n_reviews, {C} LIMIT 10),
    cohort AS (SELECT *, 'top10' AS popularity_group FROM top UNION ALL
      SELECT *, 'bottom10' FROM low WHERE {C} NOT IN (SELECT {C} FROM top))"""


@register("h05_popularity_cohort", f"WITH {_COHORT} SELECT * FROM cohort")
def _(m):
    return experiments.popularity_cohort(m)


@register("h05_popularity_test", f"WITH {_COHORT}, " + _mwu(f"""
    SELECT popularity_group AS g, review_score AS v FROM m_delivered JOIN cohort USING ({C})
    WHERE payment_value IS NOT NULL AND review_score IS NOT NULL""", "top10", "bottom10")[5:])
def _(m):
    return experiments.popularity_test(m)


@register("h06_distinct_test_unit", f"""
    SELECT item_group, count(*) AS n FROM ({_BASKET_ROWS}) GROUP BY 1""")
def _(m):
    return experiments.basket_scores(m).groupBy("item_group").count().withColumnRenamed(
        "count", "n")


@register("h07_payment_histogram", """
    SELECT payment_type, CASE WHEN x < 0 THEN 0 WHEN x >= 15 THEN 21
      ELSE CAST(floor(x / 0.75) AS BIGINT) + 1 END AS bin, count(*) AS n
    FROM (SELECT payment_type, ln(1 + CAST(payment_value AS DOUBLE)) AS x FROM m_delivered
      WHERE payment_value IS NOT NULL) GROUP BY 1, 2""")
def _(m):
    return experiments.payment_histogram(m)


@register("h08_late_one_star", _SILVER_ORDERS + f""",
    pair AS (SELECT review_score = 1 AS o, is_late AS e FROM so JOIN m_latest_review USING (order_id)
      WHERE order_delivered_customer_date IS NOT NULL),
    k AS (SELECT count(*) FILTER (WHERE e AND o) AS a, count(*) FILTER (WHERE e AND NOT o) AS b,
      count(*) FILTER (WHERE NOT e AND o) AS c, count(*) FILTER (WHERE NOT e AND NOT o) AS d FROM pair)
    SELECT a AS exposed_hit, b AS exposed_miss, c AS other_hit, d AS other_miss,
      {r('''CAST(a + b + c + d AS DOUBLE) * pow(CAST(a AS DOUBLE) * d - CAST(b AS DOUBLE) * c, 2)
        / (CAST(a + b AS DOUBLE) * (c + d) * (a + c) * (b + d))''')} AS chi_square,
      {r('(a / (a + b)) / (c / (c + d))')} AS risk_ratio FROM k""")
def _(m):
    return experiments.late_one_star_association(m)
