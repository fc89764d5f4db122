"""Profiles, cleaning rules and Silver tables."""

from pyspark.sql import functions as F

from tradepath.functions import labels
from tradepath.functions import reference_data as ref
from tradepath.functions.temporal import days_between, floor_days_between, hours_between
from tradepath.operators import cleaning, profile
from tradepath.plans import silver, stages
from tradepath.registry import register
from tradepath.registry.sql import case_map, floor_days, secs
from tradepath.sources.workspace import fresh_path


def r(x, d=6):
    # by way of the printed number, whose halves round up, as they do in Spark
    return f"CAST(round(CAST(CAST(CAST({x} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,15)), {d}) AS DOUBLE)"


def ts(x):
    return f"CAST({x} AS VARCHAR)"


ORDER_COLUMNS = [
    "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
    "order_delivered_carrier_date", "order_delivered_customer_date",
    "order_estimated_delivery_date",
]


@register("p01_table_profile", """
    SELECT count(*) AS n_rows, 8 AS n_columns, 'order_id' AS first_column,
      'timestamp_ntz' AS last_type FROM m_orders""")
def _(m):
    return profile.shape(m.orders).select(
        "n_rows", "n_columns",
        F.col("columns")[0]["column"].alias("first_column"),
        F.element_at("columns", -1)["type"].alias("last_type"),
    )


@register("p02_null_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS null_count FROM m_orders"
    for c in ORDER_COLUMNS))
def _(m):
    return profile.null_profile(m.orders)


@register("p03_duplicate_profile", """
    SELECT count(*) AS n_rows, (SELECT count(*) FROM (SELECT DISTINCT * FROM m_geo)) AS n_distinct,
      count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM m_geo)) AS n_later_copies
    FROM m_geo""")
def _(m):
    return profile.row_copies(m.geolocation).drop("n_with_copy")


ITEM_COLUMNS = ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date",
                "price", "freight_value"]


@register("p04_cardinality", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM m_items"
    for c in ITEM_COLUMNS))
def _(m):
    return profile.cardinality(m.items, ITEM_COLUMNS)


@register("p04_cardinality_approximate", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", TRUE AS close" for c in ITEM_COLUMNS))
def _(m):
    """The approximate counts lie within a tenth of the exact ones."""
    about = profile.cardinality(m.items, ITEM_COLUMNS, True).withColumnRenamed("n_distinct", "about")
    exact = profile.cardinality(m.items, ITEM_COLUMNS)
    return about.join(exact, "column").select("column", (
        F.abs(F.col("about") - F.col("n_distinct")) <= 0.1 * F.col("n_distinct")).alias("close"))


@register("p04_cardinality_of_loads", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(4 AS BIGINT) AS loads, TRUE AS agrees, TRUE AS close"
    for c in ITEM_COLUMNS))
def _(m):
    """Sketches of four loads, stored and merged: they agree with one sketch of all rows to a
    fiftieth, and lie within a twentieth of the exact counts."""
    store = profile.SketchStore(m.spark, fresh_path(m.spark, "sketches"))
    for load in range(4):
        store.add(m.items.where(F.pmod("order_id", F.lit(4)) == load), ITEM_COLUMNS, str(load))
    merged = store.cardinality()
    whole = profile.SketchStore(m.spark, fresh_path(m.spark, "sketches"))
    whole.add(m.items, ITEM_COLUMNS, "all")
    once = whole.cardinality().select("column", F.col("n_distinct").alias("once"))
    exact = profile.cardinality(m.items, ITEM_COLUMNS).withColumnRenamed("n_distinct", "exact")
    return merged.join(once, "column").join(exact, "column").select(
        "column", "loads",
        (F.abs(F.col("n_distinct") - F.col("once")) <= 0.02 * F.col("once")).alias("agrees"),
        (F.abs(F.col("n_distinct") - F.col("exact")) <= 0.05 * F.col("exact")).alias("close"))


def _describe_sql(column):
    q = ", ".join(f"{r(f'quantile_cont(CAST({column} AS DOUBLE), {p})', 4)} AS {n}"
                  for n, p in [("q25", .25), ("q50", .5), ("q75", .75)])
    return f"""SELECT '{column}' AS "column", count({column}) AS count,
      {r(f'avg(CAST({column} AS DOUBLE))', 4)} AS mean,
      {r(f'stddev_samp(CAST({column} AS DOUBLE))', 4)} AS std,
      {r(f'min({column})', 4)} AS min, {r(f'max({column})', 4)} AS max, {q} FROM m_joined"""


@register("p05_describe", " UNION ALL ".join(map(_describe_sql, ["price", "payment_value"])),
          digits=4)
def _(m):
    return profile.describe(stages.joined(m), ["price", "payment_value"])


@register("p06_time_span", f"""
    SELECT {ts('min(order_purchase_timestamp)')} AS "first",
      {ts('max(order_purchase_timestamp)')} AS "last" FROM m_orders""")
def _(m):
    return profile.span(m.orders, "order_purchase_timestamp")


_CORR = ["price", "payment_value", "payment_installments"]


@register("p07_correlation", " UNION ALL ".join(
    f"SELECT '{a}' AS x, '{b}' AS y, "
    f"{r(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))')} AS r FROM m_joined"
    for a in _CORR for b in _CORR))
def _(m):
    return profile.correlation_matrix(stages.joined(m), _CORR)


@register("p08_column_drop", """
    SELECT * EXCLUDE (product_name_lenght, product_description_lenght, product_photos_qty)
    FROM m_products""")
def _(m):
    return m.products.drop("product_name_lenght", "product_description_lenght",
                           "product_photos_qty")


@register("p09_constant_fill", """
    SELECT product_id, coalesce(product_category_name, 'unknown') AS product_category_name
    FROM m_products""")
def _(m):
    return m.products.select("product_id", "product_category_name").fillna(
        "unknown", ["product_category_name"]
    )


_DIMS = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]


@register("p10_global_median_fill", "SELECT product_id, " + ", ".join(
    r(f"coalesce({c}, (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM m_products))")
    + f" AS {c}" for c in _DIMS) + " FROM m_products")
def _(m):
    return cleaning.fill_with_medians(m.products.select("product_id", *_DIMS), _DIMS)


_GEO_JOINED = """
    WITH j AS (SELECT o.*, z.lat, z.lng FROM m_joined o
      LEFT JOIN m_zip_centroid z ON z.zip = o.customer_zip_code_prefix),
    g AS (SELECT customer_city, quantile_cont(lat, 0.5) AS mlat, quantile_cont(lng, 0.5) AS mlng
      FROM j GROUP BY 1),
    filled AS (SELECT j.* REPLACE (coalesce(lat, mlat) AS lat, coalesce(lng, mlng) AS lng)
      FROM j LEFT JOIN g USING (customer_city))"""


@register("p11_group_median_fill", _GEO_JOINED + f"""
    SELECT customer_city, count(*) AS n, count(lat) AS n_lat, {r('min(lat)')} AS min_lat,
      {r('max(lat)')} AS max_lat, {r('avg(lat)', 4)} AS mean_lat, {r('avg(lng)', 4)} AS mean_lng
    FROM filled GROUP BY 1""")
def _(m):
    j = stages.joined(m, (), [stages.CUSTOMERS])
    j = j.join(stages.zip_centroids(m), j.customer_zip_code_prefix == F.col("zip"), "left")
    filled = cleaning.fill_with_group_median(j, ["lat", "lng"], "customer_city", "copies")
    return filled.groupBy("customer_city").agg(
        F.sum("copies").alias("n"),
        F.expr("sum(CASE WHEN lat IS NOT NULL THEN copies ELSE 0L END) AS n_lat"),
        F.min("lat").alias("min_lat"), F.max("lat").alias("max_lat"),
        F.expr("round(sum(lat * copies) / sum(copies), 4) AS mean_lat"),
        F.expr("round(sum(lng * copies) / sum(copies), 4) AS mean_lng"),
    )


@register("p12_column_fill", "SELECT " + ", ".join(
    ts(c) + f" AS {c}" if c.endswith(("timestamp", "at", "date")) else c
    for c in ORDER_COLUMNS) + " FROM m_clean")
def _(m):
    return stages.clean_orders(m)


@register("p13_filters", """
    SELECT order_id, order_status FROM m_orders
    WHERE order_approved_at IS NULL AND order_status IN ('canceled', 'delivered')
      AND order_status NOT IN ('unavailable')""")
def _(m):
    return m.orders.where(
        F.col("order_approved_at").isNull()
        & F.col("order_status").isin("canceled", "delivered")
        & ~F.col("order_status").isin("unavailable")
    ).select("order_id", "order_status")


@register("p14_nulls_by_status", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", order_status, count(*) AS n FROM m_orders "
    f"WHERE {c} IS NULL GROUP BY 2" for c in stages.MILESTONES))
def _(m):
    flags = m.orders.select("order_status", F.explode(F.array(*[
        F.when(F.col(c).isNull(), F.lit(c)) for c in stages.MILESTONES])).alias("column"))
    return flags.where("column is not null").groupBy("column", "order_status").agg(
        F.count(F.lit(1)).alias("n"))


@register("p15_timestamp_cast", f"""
    SELECT order_id, {ts('order_purchase_timestamp')} AS order_purchase_timestamp,
      CASE WHEN order_id % 13 <> 0 THEN {ts('order_approved_at')} END AS order_approved_at
    FROM m_orders""")
def _(m):
    text = m.orders.select(
        "order_id",
        F.col("order_purchase_timestamp").cast("string"),
        F.when(F.col("order_id") % 13 == 0, F.lit("not a date"))
        .otherwise(F.col("order_approved_at").cast("string")).alias("order_approved_at"),
    )
    return cleaning.cast_timestamps(text, ["order_purchase_timestamp", "order_approved_at"])


@register("p16_dedup_full_row", "SELECT DISTINCT * FROM m_geo")
def _(m):
    return m.geolocation.dropDuplicates()


_SILVER_GEO = """
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY geolocation_zip_code_prefix ORDER BY
        geolocation_lat, geolocation_lng, geolocation_city, geolocation_state) AS rn
      FROM m_geo WHERE geolocation_lat BETWEEN -34 AND 5 AND geolocation_lng BETWEEN -74 AND -28)
    WHERE rn = 1"""


@register("p17_dedup_one_per_zip", _SILVER_GEO)
def _(m):
    return silver.geolocation(m)


@register("p18_dedup_latest_review", f"""
    SELECT review_id, order_id, review_score, {ts('review_creation_date')} AS review_creation_date
    FROM m_latest_review""")
def _(m):
    return silver.latest_reviews(m)


@register("p19_bounding_box", """
    SELECT * FROM m_geo WHERE geolocation_lat BETWEEN -34 AND 5
      AND geolocation_lng BETWEEN -74 AND -28""")
def _(m):
    return m.geolocation.where(cleaning.inside_box(
        "geolocation_lat", "geolocation_lng", ref.LATITUDE_RANGE, ref.LONGITUDE_RANGE))


@register("p20_corrupt_rows", """
    SELECT count(*) AS n_rows, count(*) - (SELECT count(*) FROM m_clean) AS n_corrupt
    FROM m_orders""")
def _(m):
    return m.orders.agg(F.count(F.lit(1)).alias("n_rows"),
                        F.count_if(stages.corrupt()).alias("n_corrupt"))


_CARRIER = """coalesce(order_delivered_carrier_date,
                       order_delivered_customer_date - INTERVAL 3 DAY)"""
_SILVER_ORDERS = f"""
    WITH base AS (
      SELECT * REPLACE ({_CARRIER} AS order_delivered_carrier_date) FROM m_orders
      WHERE NOT (order_status = 'delivered' AND order_approved_at IS NULL
        AND order_delivered_carrier_date IS NULL AND order_delivered_customer_date IS NULL)),
    t AS (SELECT *,
      {secs('order_approved_at', 'order_purchase_timestamp')} / 3600 AS approval_time_hrs,
      {secs('order_delivered_carrier_date', 'order_approved_at')} / 86400 AS w,
      {secs('order_delivered_customer_date', 'order_delivered_carrier_date')} / 86400 AS s,
      {secs('order_delivered_customer_date', 'order_purchase_timestamp')} / 86400
        AS total_delivery_days,
      coalesce(order_delivered_customer_date > order_estimated_delivery_date, FALSE) AS is_late
      FROM base),
    so AS (SELECT *, CASE WHEN w < 0 THEN 0 ELSE w END AS waiting_time_days,
      CASE WHEN s < 0 THEN 0 ELSE s END AS shipping_time_days,
      coalesce(w < 0, FALSE) OR coalesce(s < 0, FALSE) AS is_anomalous FROM t)"""


@register("p21_carrier_imputation", f"""
    SELECT order_id, {ts(_CARRIER)} AS order_delivered_carrier_date FROM m_orders
    WHERE order_delivered_carrier_date IS NULL AND order_delivered_customer_date IS NOT NULL""")
def _(m):
    missing = m.orders.where("order_delivered_carrier_date is null "
                             "and order_delivered_customer_date is not null").select("order_id")
    imputed = silver.orders(m).select("order_id", "order_delivered_carrier_date")
    return imputed.join(missing, "order_id", "left_semi")


@register("p22_negative_clamp", _SILVER_ORDERS + f"""
    SELECT order_id, {r('waiting_time_days')} AS waiting_time_days,
      {r('shipping_time_days')} AS shipping_time_days, is_anomalous FROM so""")
def _(m):
    return silver.orders(m).select(
        "order_id", "waiting_time_days", "shipping_time_days", "is_anomalous")


_STAGE_SECS = {
    "approval_time": ("order_approved_at", "order_purchase_timestamp"),
    "waiting_time": ("order_delivered_carrier_date", "order_approved_at"),
    "shipping_time": ("order_delivered_customer_date", "order_delivered_carrier_date"),
    "total_time": ("order_delivered_customer_date", "order_purchase_timestamp"),
    "estimated_time": ("order_estimated_delivery_date", "order_purchase_timestamp"),
}


@register("p23_negative_durations", "SELECT " + ", ".join(
    f"count(*) FILTER (WHERE {secs(a, b)} < 0) AS {n}" for n, (a, b) in _STAGE_SECS.items())
    + ", (SELECT count(*) FROM m_timed) AS kept FROM m_joined")
def _(m):
    rows = stages.with_durations(stages.joined(m, ()))
    return rows.selectExpr(
        *[f"coalesce(sum(copies) FILTER (WHERE {c} < 0), 0L) AS {c}" for c in stages.DURATIONS],
        "sum(copies) FILTER (WHERE waiting_time >= 0 AND shipping_time >= 0) AS kept",
    )


@register("p24_order_durations", f"""
    SELECT order_id,
      {r(secs('order_approved_at', 'order_purchase_timestamp') + ' / 3600')} AS approval_hrs,
      {r(secs('order_delivered_carrier_date', 'order_approved_at') + ' / 86400')} AS waiting_days,
      {r(secs('order_delivered_customer_date', 'order_delivered_carrier_date') + ' / 86400')}
        AS shipping_days,
      {r(secs('order_delivered_customer_date', 'order_purchase_timestamp') + ' / 86400')}
        AS total_days FROM m_orders""")
def _(m):
    return m.orders.select(
        "order_id",
        hours_between("order_approved_at", "order_purchase_timestamp").alias("approval_hrs"),
        days_between("order_delivered_carrier_date", "order_approved_at").alias("waiting_days"),
        days_between("order_delivered_customer_date", "order_delivered_carrier_date")
        .alias("shipping_days"),
        days_between("order_delivered_customer_date", "order_purchase_timestamp")
        .alias("total_days"),
    )


@register("p25_stage_seconds", "SELECT order_id, " + ", ".join(
    f"CAST({secs(a, b)} AS DOUBLE) AS {n}" for n, (a, b) in _STAGE_SECS.items())
    + " FROM m_clean")
def _(m):
    return stages.with_durations(stages.clean_orders(m)).select("order_id", *stages.DURATIONS)


@register("p26_floor_days", f"""
    SELECT order_id,
      {floor_days('order_delivered_customer_date', 'order_purchase_timestamp')} AS delivery_days,
      {floor_days('order_delivered_customer_date', 'order_estimated_delivery_date')}
        AS delivery_delay FROM m_orders""")
def _(m):
    return m.orders.select(
        "order_id",
        floor_days_between("order_delivered_customer_date", "order_purchase_timestamp")
        .alias("delivery_days"),
        floor_days_between("order_delivered_customer_date", "order_estimated_delivery_date")
        .alias("delivery_delay"),
    )


_DELAY = floor_days("order_delivered_customer_date", "order_estimated_delivery_date")


@register("p27_is_late", f"""
    SELECT order_id, coalesce(order_delivered_customer_date > order_estimated_delivery_date, FALSE)
      AS is_late_timestamp, coalesce({_DELAY} > 0, FALSE) AS is_late_days FROM m_orders""")
def _(m):
    delay = floor_days_between("order_delivered_customer_date", "order_estimated_delivery_date")
    return m.orders.select(
        "order_id",
        labels.is_late_by_timestamp(
            "order_delivered_customer_date", "order_estimated_delivery_date"
        ).alias("is_late_timestamp"),
        labels.is_late_by_days(delay).alias("is_late_days"),
    )


@register("p28_delivery_status", f"""
    SELECT order_id, CASE WHEN {_DELAY} IS NULL THEN 'missing' WHEN {_DELAY} < 0 THEN 'early'
      WHEN {_DELAY} > 0 THEN 'late' ELSE 'on_time' END AS delivery_status FROM m_orders""")
def _(m):
    delay = floor_days_between("order_delivered_customer_date", "order_estimated_delivery_date")
    return m.orders.select("order_id", labels.delivery_status(delay).alias("delivery_status"))


@register("p29_item_measures", f"""
    SELECT order_id, order_item_id, product_id, CAST(price + freight_value AS DOUBLE) AS item_total,
      {r('CASE WHEN price <> 0 THEN CAST(freight_value AS DOUBLE) / CAST(price AS DOUBLE) END')}
        AS freight_ratio FROM m_items""")
def _(m):
    return silver.order_items(m).select(
        "order_id", "order_item_id", "product_id", "item_total", "freight_ratio")


@register("p30_overpayment_ratio", f"""
    SELECT count(*) AS n, count(x) AS n_ratio, {r('min(x)')} AS lowest, {r('max(x)')} AS highest
    FROM (SELECT CASE WHEN price <> 0 THEN CAST(payment_value AS DOUBLE) / CAST(price AS DOUBLE)
          END AS x FROM m_delivered)""")
def _(m):
    x = stages.delivered(m).select(labels.ratio("payment_value", "price").alias("x"))
    return x.agg(F.count(F.lit(1)).alias("n"), F.count("x").alias("n_ratio"),
                 F.min("x").alias("lowest"), F.max("x").alias("highest"))


@register("p31_product_volume", """
    SELECT product_id, CAST(product_length_cm AS BIGINT) * product_height_cm * product_width_cm
      AS product_volume_cm3 FROM m_products""")
def _(m):
    return m.products.select("product_id", labels.product_volume().alias("product_volume_cm3"))


@register("p32_payments_per_order", """
    SELECT * REPLACE (CAST(total_payment_value AS DOUBLE) AS total_payment_value)
    FROM m_order_payments""")
def _(m):
    return silver.order_payments(m)


@register("p33_sentiment", """
    SELECT review_id, CASE WHEN review_score >= 4 THEN 'positive' WHEN review_score = 3
      THEN 'neutral' WHEN review_score <= 2 THEN 'negative' END AS review_sentiment
    FROM m_reviews""")
def _(m):
    return m.reviews.select("review_id", labels.sentiment("review_score").alias("review_sentiment"))


@register("p34_hours_to_review", f"""
    SELECT review_id, {r(secs('review_creation_date', 'order_delivered_customer_date') + ' / 3600')}
      AS hours_to_review FROM m_reviews JOIN m_orders USING (order_id)""")
def _(m):
    return m.reviews.join(
        m.orders.select("order_id", "order_delivered_customer_date"), "order_id"
    ).select("review_id", labels.hours_to_review(
        "review_creation_date", "order_delivered_customer_date").alias("hours_to_review"))


def _accented(column):
    """City names gain an accent and odd case, so that there is something to normalise."""
    return F.concat(F.lit(" são "), F.upper(F.replace(column, F.lit("_"), F.lit(" "))))


@register("p35_city_normalisation", """
    SELECT customer_id, 'Sao Nation ' || regexp_extract(customer_city, '([0-9]+)', 1) AS city
    FROM m_customers""")
def _(m):
    return m.customers.select(
        "customer_id", labels.city_name(_accented(F.col("customer_city"))).alias("city"))


_LOOKUP = f"""
    WITH lookup AS (
      SELECT product_category_name, product_category_name_english FROM m_translation
      UNION ALL SELECT * FROM (VALUES {', '.join(
          f"('{k}', '{v}')" for k, v in ref.CATEGORY_OVERRIDES.items())}) AS v(a, b))"""


@register("p36_category_display", _LOOKUP + """
    SELECT product_category_name, array_to_string(list_transform(
      string_split(product_category_name_english, '_'),
      lambda w: upper(w[1]) || w[2:]), ' ') AS category_display FROM lookup""")
def _(m):
    return silver.category_lookup(m).select("product_category_name", "category_display")


@register("p37_category_translation", _LOOKUP + """
    SELECT product_id, product_category_name_english AS category_name_en
    FROM m_products p LEFT JOIN lookup l
      ON l.product_category_name = coalesce(p.product_category_name, 'unknown')""")
def _(m):
    return silver.products(m).select("product_id", "category_name_en")


@register("p38_seller_region", f"""
    SELECT seller_id, {case_map(ref.STATE_REGIONS, 'seller_state')} AS seller_region
    FROM m_sellers""")
def _(m):
    return silver.sellers(m).select("seller_id", "seller_region")


@register("p39_state_name", f"""
    SELECT customer_id, {case_map(ref.STATE_NAMES, 'customer_state')} AS state_name
    FROM m_customers""")
def _(m):
    return m.customers.select("customer_id", labels.state_name("customer_state").alias("state_name"))


@register("p40_buckets", """
    SELECT customer_state, CASE WHEN count(*) >= 5000 THEN 'Large (≥ 5000)'
      WHEN count(*) >= 1000 THEN 'Medium (1000–4999)' ELSE 'Small (< 1000)' END AS volume_group
    FROM m_joined GROUP BY 1""")
def _(m):
    counts = profile.value_counts(
        stages.joined(m, (), [stages.CUSTOMERS]), ["customer_state"], copies="copies")
    return counts.select("customer_state", labels.volume_group("n").alias("volume_group"))


@register("p41_log1p", f"""
    SELECT order_id, payment_sequential, {r('ln(1 + CAST(payment_value AS DOUBLE))')} AS log_value
    FROM m_payments""")
def _(m):
    return m.payments.select("order_id", "payment_sequential",
                             F.log1p(F.col("payment_value").cast("double")).alias("log_value"))


@register("p42_zero_price", """
    SELECT count(*) AS n_items, count(*) FILTER (WHERE price = 0) AS n_zero_price,
      CAST(sum(price) FILTER (WHERE price <> 0) AS DOUBLE) AS revenue FROM m_items""")
def _(m):
    return silver.order_items(m).agg(
        F.count(F.lit(1)).alias("n_items"),
        F.count_if("is_zero_price").alias("n_zero_price"),
        F.sum(F.when(~F.col("is_zero_price"), F.col("price"))).alias("revenue"),
    )


@register("p43_random_sample", "SELECT 100 AS n, 100 AS n_different, 100 AS n_known")
def _(m):
    """A hundred different orders, with the status that they have."""
    orders = m.orders.select("order_id", "order_status")
    sample = cleaning.sample_rows(orders, 100, seed=7)
    known = orders.withColumnsRenamed({"order_id": "id", "order_status": "status"})
    return sample.join(known, (F.col("order_id") == F.col("id")) & (
        F.col("order_status") == F.col("status")), "left").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("order_id").alias("n_different"),
        F.count("id").alias("n_known"))


@register("p44_drop_nulls", """
    SELECT count(*) AS n_any, count(*) FILTER (WHERE order_approved_at IS NOT NULL) AS n_subset,
      count(*) FILTER (WHERE order_approved_at IS NOT NULL AND order_delivered_carrier_date
        IS NOT NULL AND order_delivered_customer_date IS NOT NULL) AS n_all FROM m_orders""")
def _(m):
    n = F.count(F.lit(1)).alias("n")
    return m.orders.agg(F.count(F.lit(1)).alias("n_any")).select(
        "n_any",
        m.orders.dropna(subset=["order_approved_at"]).agg(n).scalar().alias("n_subset"),
        m.orders.dropna().agg(n).scalar().alias("n_all"),
    )


@register("silver_orders", _SILVER_ORDERS + f"""
    SELECT order_id, order_status, {r('approval_time_hrs')} AS approval_time_hrs,
      {r('waiting_time_days')} AS waiting_time_days,
      {r('shipping_time_days')} AS shipping_time_days,
      {r('total_delivery_days')} AS total_delivery_days, is_late, is_anomalous FROM so""")
def _(m):
    return silver.orders(m).select(
        "order_id", "order_status", "approval_time_hrs", "waiting_time_days",
        "shipping_time_days", "total_delivery_days", "is_late", "is_anomalous")


@register("silver_customers", f"""
    WITH g AS ({_SILVER_GEO})
    SELECT customer_id, upper(customer_city[1]) || customer_city[2:] AS customer_city,
      geolocation_lat AS customer_lat, geolocation_lng AS customer_lng
    FROM m_customers LEFT JOIN g ON geolocation_zip_code_prefix = customer_zip_code_prefix""")
def _(m):
    return silver.customers(m).select(
        "customer_id", "customer_city", "customer_lat", "customer_lng")


@register("silver_order_reviews", _SILVER_ORDERS + f"""
    SELECT review_id, order_id, review_score, CASE WHEN review_score >= 4 THEN 'positive'
      WHEN review_score = 3 THEN 'neutral' ELSE 'negative' END AS review_sentiment,
      {r(secs('review_creation_date', 'order_delivered_customer_date') + ' / 3600')}
        AS hours_to_review, is_late
    FROM m_latest_review LEFT JOIN so USING (order_id)""")
def _(m):
    return silver.order_reviews(m).drop("review_creation_date")
