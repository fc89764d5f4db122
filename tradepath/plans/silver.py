"""Silver tables: typed, cleaned, deduplicated and enriched, one row per business key."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradepath.adapters import Marketplace
from tradepath.functions import labels
from tradepath.functions import reference_data as ref
from tradepath.functions.temporal import days_between, hours_between, plus
from tradepath.operators.cleaning import first_per_key, inside_box, latest_per_key
from tradepath.plans.stages import corrupt

CARRIER_LAG_DAYS = 3


def orders(m: Marketplace) -> DataFrame:
    """Corrupt rows removed, carrier date imputed, durations clamped at zero and flagged."""
    carrier = F.coalesce(
        F.col("order_delivered_carrier_date"),
        plus("order_delivered_customer_date", days=-CARRIER_LAG_DAYS),
    )
    timed = (
        m.orders.where(~corrupt())
        .withColumn("order_delivered_carrier_date", carrier)
        .withColumns({
            "approval_time_hrs": hours_between("order_approved_at", "order_purchase_timestamp"),
            "waiting_time_days": days_between(
                "order_delivered_carrier_date", "order_approved_at"
            ),
            "shipping_time_days": days_between(
                "order_delivered_customer_date", "order_delivered_carrier_date"
            ),
            "total_delivery_days": days_between(
                "order_delivered_customer_date", "order_purchase_timestamp"
            ),
            "is_late": labels.is_late_by_timestamp(
                "order_delivered_customer_date", "order_estimated_delivery_date"
            ),
        })
    )
    return timed.withColumns({
        "is_anomalous": labels.anomalous("waiting_time_days")
        | labels.anomalous("shipping_time_days"),
        "waiting_time_days": labels.clamp_negative("waiting_time_days"),
        "shipping_time_days": labels.clamp_negative("shipping_time_days"),
    })


def order_items(m: Marketplace) -> DataFrame:
    return m.items.withColumns({
        "item_total": labels.item_total(),
        "freight_ratio": labels.ratio("freight_value", "price"),
        "is_zero_price": F.col("price") == 0,
    })


def order_payments(m: Marketplace) -> DataFrame:
    """One row per order, so that a join to orders cannot multiply rows."""
    return m.payments.groupBy("order_id").agg(
        F.sum("payment_value").alias("total_payment_value"),
        F.bool_or(F.col("payment_type") == "voucher").alias("has_voucher"),
        F.max("payment_installments").alias("max_installments"),
        # the types are a fixed list of five, so the set stays small
        F.size(F.collect_set("payment_type")).cast("long").alias("payment_method_count"),
        F.max(F.when(F.col("payment_sequential") == 1, F.col("payment_type")))
        .alias("primary_payment_type"),
    )


def latest_reviews(m: Marketplace) -> DataFrame:
    return latest_per_key(m.reviews, ["order_id"], ["review_creation_date", "review_id"])


def order_reviews(m: Marketplace) -> DataFrame:
    """Latest review per order with sentiment, hours since delivery and the late flag."""
    facts = orders(m).select("order_id", "order_delivered_customer_date", "is_late")
    return latest_reviews(m).join(facts, "order_id", "left").select(
        "review_id", "order_id", "review_score", "review_creation_date",
        labels.sentiment("review_score").alias("review_sentiment"),
        labels.hours_to_review("review_creation_date", "order_delivered_customer_date")
        .alias("hours_to_review"),
        "is_late",
    )


def category_lookup(m: Marketplace) -> DataFrame:
    """Translation table completed by the hand-made entries, with a display form."""
    overrides = F.create_map(*[F.lit(x) for kv in ref.CATEGORY_OVERRIDES.items() for x in kv])
    manual = m.spark.range(1).select(
        F.explode(overrides).alias("product_category_name", "product_category_name_english")
    )
    known = m.translation.unionByName(manual)
    return known.withColumn(
        "category_display", labels.category_display("product_category_name_english")
    )


def products(m: Marketplace) -> DataFrame:
    lookup = category_lookup(m).withColumnRenamed(
        "product_category_name_english", "category_name_en"
    )
    return (
        m.products.withColumn(
            "product_category_name", F.coalesce("product_category_name", F.lit("unknown"))
        )
        .join(lookup, "product_category_name", "left")
        .withColumn("product_volume_cm3", labels.product_volume())
    )


def geolocation(m: Marketplace) -> DataFrame:
    """One row per zip prefix inside the country's box: the lowest coordinates."""
    inside = m.geolocation.where(
        inside_box("geolocation_lat", "geolocation_lng", ref.LATITUDE_RANGE, ref.LONGITUDE_RANGE)
    )
    return first_per_key(
        inside,
        ["geolocation_zip_code_prefix"],
        ["geolocation_lat", "geolocation_lng", "geolocation_city", "geolocation_state"],
    )


def _located(df: DataFrame, m: Marketplace, prefix: str) -> DataFrame:
    geo = geolocation(m).select(
        F.col("geolocation_zip_code_prefix").alias(f"{prefix}_zip_code_prefix"),
        F.col("geolocation_lat").alias(f"{prefix}_lat"),
        F.col("geolocation_lng").alias(f"{prefix}_lng"),
    )
    return df.withColumn(f"{prefix}_city", labels.city_name(f"{prefix}_city")).join(
        geo, f"{prefix}_zip_code_prefix", "left"
    )


def customers(m: Marketplace) -> DataFrame:
    return _located(m.customers, m, "customer")


def sellers(m: Marketplace) -> DataFrame:
    return _located(m.sellers, m, "seller").withColumn(
        "seller_region", labels.region("seller_state")
    )
