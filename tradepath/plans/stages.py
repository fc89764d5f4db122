"""The analysis stages, each a lazy DataFrame: clean orders, joined rows, delivered, timed.

`joined` stands for one row per order x item x payment x review. A caller names the
tables whose columns it needs; each of the others shrinks to a row count per order, and
the product of those counts is kept in `copies`, the number of joined rows that a row
stands for. Sums weighted by `copies` equal those over the full product, which an order
with many items and payments would otherwise blow up.

Dimensions are joined to the narrow side that carries their key (products and sellers to
items, centroids to customers), so the wide tables meet on order_id alone and keep one
partitioning.
"""

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradepath.adapters import Marketplace
from tradepath.functions import labels
from tradepath.functions import reference_data as ref
from tradepath.functions.temporal import floor_days_between, seconds_between
from tradepath.operators.cleaning import (
    fill_from,
    fill_with_group_median,
    fill_with_medians,
)
from tradepath.operators.skew import hot_keys, left_join
from tradepath.sources.workspace import materialise

MILESTONES = [
    "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date",
]
DURATIONS = ["approval_time", "waiting_time", "shipping_time", "total_time", "estimated_time"]
ITEMS, PAYMENTS, REVIEWS = "items", "payments", "reviews"
ALL = (ITEMS, PAYMENTS, REVIEWS)
PRODUCTS, CUSTOMERS, SELLERS, GEO = "products", "customers", "sellers", "geo"


def corrupt():
    """Delivered orders without a single milestone date."""
    none = F.lit(True)
    for c in MILESTONES:
        none = none & F.col(c).isNull()
    return (F.col("order_status") == "delivered") & none


def clean_orders(m: Marketplace) -> DataFrame:
    """Corrupt rows removed; approval falls back to purchase, delivery to the estimate."""
    return fill_from(
        m.orders.where(~corrupt()),
        {
            "order_approved_at": "order_purchase_timestamp",
            "order_delivered_customer_date": "order_estimated_delivery_date",
        },
    )


def english_products(m: Marketplace) -> DataFrame:
    category = F.coalesce("product_category_name", F.lit("unknown"))
    return m.products.withColumn(
        "product_category_english", labels.literal_map(ref.CATEGORY_ENGLISH, category)
    )


def zip_centroids(m: Marketplace) -> DataFrame:
    """Mean coordinates per zip prefix over distinct geolocation rows."""
    return (
        m.geolocation.dropDuplicates()
        .groupBy(F.col("geolocation_zip_code_prefix").alias("zip"))
        .agg(F.avg("geolocation_lat").alias("lat"), F.avg("geolocation_lng").alias("lng"))
    )


def _side(m: Marketplace, name: str, dims: Iterable[str] = (), more: Iterable[str] = ()) -> DataFrame:
    if name == PAYMENTS:
        return m.payments.select(
            "order_id", "payment_type", "payment_value", "payment_installments", *more
        )
    if name == REVIEWS:
        return m.reviews.select("order_id", "review_score", "review_creation_date", *more)
    items = m.items.select("order_id", "product_id", "seller_id", "price", *more)
    if PRODUCTS in dims:
        english = english_products(m).select("product_id", "product_category_english")
        items = items.join(english, "product_id", "left")
    if SELLERS in dims:
        items = items.join(m.sellers.select("seller_id", "seller_city"), "seller_id", "left")
    return items


#: A column of each table that tells apart the rows of an order.
ROW = {ITEMS: "order_item_id", PAYMENTS: "payment_sequential", REVIEWS: "review_id"}


def _hot_orders(m: Marketplace, name: str) -> list[tuple]:
    """Orders that hold much of a table; looked for once per marketplace."""
    known = m.__dict__.setdefault("hot_orders", {})
    if name not in known:
        known[name] = hot_keys(_side(m, name), "order_id")
    return known[name]


def located_customers(m: Marketplace) -> DataFrame:
    """Customers with coordinates: zip centroid, else the city's median, else the overall one.

    The medians are over joined rows. A row's coordinates depend on its customer alone, so
    the rows are first summed per city and coordinate, and that small table is written once,
    as is the result.
    """
    coords = ["lat", "lng"]
    located = m.customers.join(
        zip_centroids(m), F.col("customer_zip_code_prefix") == F.col("zip"), "left"
    ).drop("zip")
    weights = joined(m, ()).groupBy("customer_id").agg(F.sum("copies").alias("copies"))
    places = materialise(
        located.join(weights, "customer_id").groupBy("customer_city", *coords)
        .agg(F.sum("copies").alias("copies")),
        "places",
    )
    by_city = dict(group="customer_city", copies="copies", source=places)
    overall = fill_with_group_median(places, coords, **by_city)
    filled = fill_with_medians(
        fill_with_group_median(located, coords, **by_city), coords, "copies", overall
    )
    return materialise(filled, "located-customers")


def joined(m: Marketplace, use: Iterable[str] = ALL, dims: Iterable[str] = ()) -> DataFrame:
    """Orders with the rows of the tables in `use`, and `copies` for the others."""
    use, dims = set(use), set(dims)
    out = clean_orders(m)
    if CUSTOMERS in dims or GEO in dims:
        customers = located_customers(m) if GEO in dims else m.customers
        out = out.join(customers, "customer_id", "left")

    copies = ["1L"]
    for name in ALL:
        if name in use:
            hot = _hot_orders(m, name)
            more = [ROW[name]] if hot else []
            side = _side(m, name, dims, more)
            out = left_join(out, side, "order_id", hot).drop(*more)
        else:
            side = _side(m, name)
            counts = side.groupBy("order_id").agg(F.count(F.lit(1)).alias(f"_n_{name}"))
            copies.append(f"coalesce(_n_{name}, 1L)")
            out = out.join(counts, "order_id", "left")

    derived = {
        "copies": F.expr(" * ".join(copies)),
        "delivery_days": floor_days_between(
            "order_delivered_customer_date", "order_purchase_timestamp"
        ),
        "delivery_delay": floor_days_between(
            "order_delivered_customer_date", "order_estimated_delivery_date"
        ),
    }
    if PAYMENTS in use:
        derived["payment_type"] = F.coalesce("payment_type", F.lit("not_defined"))
    if REVIEWS in use:
        derived["bad_score"] = labels.is_bad_score("review_score")
    return out.withColumns(derived).drop(*[f"_n_{name}" for name in ALL])


def delivered(m: Marketplace, use: Iterable[str] = ALL, dims: Iterable[str] = ()) -> DataFrame:
    return joined(m, use, dims).where(F.col("order_status") == "delivered")


def with_durations(df: DataFrame) -> DataFrame:
    """Five stage durations in seconds."""
    return df.withColumns({
        "approval_time": seconds_between("order_approved_at", "order_purchase_timestamp"),
        "waiting_time": seconds_between("order_delivered_carrier_date", "order_approved_at"),
        "shipping_time": seconds_between(
            "order_delivered_customer_date", "order_delivered_carrier_date"
        ),
        "total_time": seconds_between(
            "order_delivered_customer_date", "order_purchase_timestamp"
        ),
        "estimated_time": seconds_between(
            "order_estimated_delivery_date", "order_purchase_timestamp"
        ),
    })


def timed(m: Marketplace, use: Iterable[str] = ALL, dims: Iterable[str] = ()) -> DataFrame:
    """Joined rows whose waiting and shipping times are known and not negative."""
    return (
        with_durations(joined(m, use, dims))
        .where((F.col("waiting_time") >= 0) & (F.col("shipping_time") >= 0))
        .withColumn("delivery_status", labels.delivery_status("delivery_delay"))
    )
