"""Labels, buckets, flags and derived measures as Column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradepath.functions import reference_data as ref
from tradepath.functions.temporal import _col, seconds_between


def literal_map(values: dict, key) -> Column:
    """Constant lookup folded into the expression; null for a key outside the map."""
    pairs = ", ".join(f"'{k}', '{v}'" for k, v in values.items())
    return F.try_element_at(F.expr(f"map({pairs})"), _col(key))


def delivery_status(delay_days) -> Column:
    d = _col(delay_days)
    return (
        F.when(d.isNull(), "missing").when(d < 0, "early").when(d > 0, "late").otherwise("on_time")
    )


def is_late_by_timestamp(delivered, estimated) -> Column:
    """Late at any time past the estimate; undelivered orders are not late."""
    return F.coalesce(_col(delivered) > _col(estimated), F.lit(False))


def is_late_by_days(delay_days) -> Column:
    """Late only from the first whole day past the estimate."""
    return F.coalesce(_col(delay_days) > 0, F.lit(False))


def is_bad_score(score) -> Column:
    """Three stars or fewer; a missing score is not bad."""
    return F.coalesce(_col(score) <= 3, F.lit(False))


def sentiment(score) -> Column:
    s = _col(score)
    return F.when(s >= 4, "positive").when(s == 3, "neutral").when(s <= 2, "negative")


def volume_group(orders) -> Column:
    n = _col(orders)
    return (
        F.when(n >= 5000, "Large (≥ 5000)")
        .when(n >= 1000, "Medium (1000–4999)")
        .otherwise("Small (< 1000)")
    )


def basket_group(n_items) -> Column:
    n = _col(n_items)
    return F.when(n == 1, "1 item").when(n == 2, "2 items").otherwise("3+ items")


def installment_bucket(installments) -> Column:
    n = _col(installments)
    return F.when(n <= 1, "1").when(n <= 5, "2-5").otherwise("6+")


def state_name(state) -> Column:
    return literal_map(ref.STATE_NAMES, state)


def region(state) -> Column:
    return literal_map(ref.STATE_REGIONS, state)


def strip_accents(text) -> Column:
    return F.translate(_col(text), ref.ACCENTED, ref.PLAIN)


def city_name(city) -> Column:
    """Title case without accents or outer spaces."""
    return F.initcap(strip_accents(F.trim(_col(city))))


def category_display(category) -> Column:
    return F.initcap(F.replace(_col(category), F.lit("_"), F.lit(" ")))


def clean_text(text) -> Column:
    """Outer blanks removed; empty text becomes null and the row stays."""
    return F.nullif(F.trim(_col(text)), F.lit(""))


def ratio(numerator, denominator) -> Column:
    """Division as double, null when the denominator is zero."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def item_total(price="price", freight="freight_value") -> Column:
    return _col(price) + _col(freight)


def product_volume() -> Column:
    return (
        F.col("product_length_cm").cast("long")
        * F.col("product_height_cm")
        * F.col("product_width_cm")
    )


def milestone_reached() -> Column:
    """Last lifecycle milestone an order has a date for."""
    return (
        F.when(F.col("order_delivered_customer_date").isNotNull(), "delivered")
        .when(F.col("order_delivered_carrier_date").isNotNull(), "handed_to_carrier")
        .when(F.col("order_approved_at").isNotNull(), "approved")
        .otherwise("purchased")
    )


def haversine_km(lat1, lng1, lat2, lng2) -> Column:
    """Great-circle distance on a sphere of radius 6371 km."""
    a1, g1, a2, g2 = (F.radians(_col(c)) for c in (lat1, lng1, lat2, lng2))
    h = (
        F.pow(F.sin((a2 - a1) / 2), 2)
        + F.cos(a1) * F.cos(a2) * F.pow(F.sin((g2 - g1) / 2), 2)
    )
    return 2 * 6371.0 * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def anomalous(duration) -> Column:
    return F.coalesce(_col(duration) < 0, F.lit(False))


def clamp_negative(duration) -> Column:
    d = _col(duration)
    return F.when(d < 0, F.lit(0.0)).otherwise(d)


def hours_to_review(created, delivered) -> Column:
    return seconds_between(created, delivered) / 3600
