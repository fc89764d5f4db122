"""Documented business measures at order grain: payments are summed per order before any
join and only the latest review of an order counts, so no join multiplies revenue."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradepath.adapters import Marketplace
from tradepath.functions import labels
from tradepath.functions import reference_data as ref
from tradepath.functions.temporal import floor_days_between, month_of
from tradepath.operators.quantiles import distribution
from tradepath.plans import silver, stages

CATEGORY = "category_name_en"
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def exact_mean(x) -> Column:
    """Average of a decimal column, whose sum does not depend on the order of rows."""
    return F.try_divide(F.sum(x).cast("double"), F.count(x))


def order_facts(m: Marketplace) -> DataFrame:
    """One row per order: durations, customer, payments in total and the latest score."""
    return (
        silver.orders(m)
        .join(m.customers.select("customer_id", "customer_unique_id", "customer_city",
                                 "customer_state", "customer_zip_code_prefix"),
              "customer_id", "left")
        .join(silver.order_payments(m), "order_id", "left")
        .join(silver.latest_reviews(m).select("order_id", "review_score"), "order_id", "left")
    )


def categorised_items(m: Marketplace) -> DataFrame:
    return silver.order_items(m).join(
        silver.products(m).select("product_id", CATEGORY), "product_id", "left"
    )


def gmv(m: Marketplace) -> DataFrame:
    return m.payments.selectExpr(
        "sum(payment_value) AS gmv",
        "sum(payment_value) FILTER (WHERE payment_type <> 'voucher') AS net_of_vouchers",
        "sum(payment_value) FILTER (WHERE payment_type = 'voucher') AS voucher_value",
    )


def monthly_funnel(m: Marketplace) -> DataFrame:
    return m.orders.groupBy(
        month_of("order_purchase_timestamp").alias("month"), "order_status"
    ).agg(F.count(F.lit(1)).alias("n_orders"))


def seller_scorecard(m: Marketplace) -> DataFrame:
    """Per seller over its distinct orders: orders, revenue, score, days, on-time and bad rate."""
    facts = silver.orders(m).select(
        "order_id", "total_delivery_days", "is_late", "order_delivered_customer_date"
    ).join(silver.latest_reviews(m).select("order_id", "review_score"), "order_id", "left")
    per_order = m.items.groupBy("seller_id", "order_id").agg(F.sum("price").alias("price"))
    return per_order.join(facts, "order_id", "left").groupBy("seller_id").agg(
        F.count(F.lit(1)).alias("seller_total_orders"),
        F.sum("price").alias("seller_total_revenue"),
        F.avg("review_score").alias("seller_avg_review_score"),
        F.avg("total_delivery_days").alias("seller_avg_delivery_days"),
        F.expr("""avg(CASE WHEN order_delivered_customer_date IS NOT NULL
                  THEN CAST(NOT is_late AS INT) END)""").alias("seller_on_time_rate"),
        F.expr("avg(CAST(review_score <= 3 AS INT))").alias("seller_bad_review_rate"),
    )


def rfm(m: Marketplace, as_of: str) -> DataFrame:
    """Days since the last order, number of orders and total spend per person."""
    return order_facts(m).where("customer_unique_id IS NOT NULL").groupBy(
        "customer_unique_id"
    ).agg(
        floor_days_between(F.lit(as_of).cast("timestamp_ntz"), F.max("order_purchase_timestamp"))
        .alias("recency_days"),
        F.count(F.lit(1)).alias("frequency"),
        F.coalesce(F.sum("total_payment_value"), F.lit(0)).alias("monetary"),
    )


def churn_features(m: Marketplace, as_of: str, window_days: int) -> DataFrame:
    """Delivery, payment and review features of each person's first order, and whether no second
    one followed within the window.

    Features look at the first order alone, the label at what came after it, so none knows of
    the other. A person whose window is not over at `as_of` has no label yet and is left out.
    """
    facts = order_facts(m).where("customer_unique_id IS NOT NULL")
    orders = m.orders.join(
        m.customers.select("customer_id", "customer_unique_id"), "customer_id"
    ).select("customer_unique_id", F.col("order_purchase_timestamp").alias("at"))
    first = orders.groupBy("customer_unique_id").agg(F.min("at").alias("first_order"))
    window = F.expr(f"first_order + make_dt_interval({window_days})")
    now = F.lit(as_of).cast("timestamp_ntz")
    again = (F.col("at") > F.col("first_order")) & (F.col("at") <= window)
    labelled = orders.join(first.where(window <= now), "customer_unique_id").groupBy(
        "customer_unique_id", "first_order"
    ).agg((~F.coalesce(F.bool_or(again), F.lit(False))).alias("churned"))
    return facts.join(labelled, "customer_unique_id").where(
        "order_purchase_timestamp = first_order"
    ).groupBy("customer_unique_id", "churned").agg(
        floor_days_between(now, F.max("order_purchase_timestamp")).alias("recency_days"),
        F.count(F.lit(1)).alias("frequency"),
        F.coalesce(F.sum("total_payment_value"), F.lit(0)).alias("monetary"),
        F.avg("total_delivery_days").alias("avg_delivery_days"),
        F.avg("approval_time_hrs").alias("avg_approval_hrs"),
        F.avg(F.col("is_late").cast("int")).alias("late_rate"),
        F.avg("review_score").alias("avg_review_score"),
        F.max("max_installments").alias("max_installments"),
        F.coalesce(F.bool_or("has_voucher"), F.lit(False)).alias("has_voucher"),
    )


def monthly_category(m: Marketplace) -> DataFrame:
    dated = m.orders.select("order_id", month_of("order_purchase_timestamp").alias("month"))
    return categorised_items(m).join(dated, "order_id").groupBy(CATEGORY, "month").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.sum("price").alias("revenue"),
        exact_mean("price").alias("avg_price"),
    )


def demand_features(m: Marketplace, lags: int = 2) -> DataFrame:
    """Items and mean price per category and month, with the counts of earlier months.

    A category has one row per month, so its window stays short.
    """
    w = Window.partitionBy(CATEGORY).orderBy("month")
    return monthly_category(m).drop("revenue").withColumns({
        f"lag_{i}": F.lag("n_items", i).over(w) for i in range(1, lags + 1)
    })


def category_growth(m: Marketplace) -> DataFrame:
    """Monthly revenue, its change from the month before, and the category's trend slope."""
    w = Window.partitionBy(CATEGORY).orderBy("month")
    every = Window.partitionBy(CATEGORY)
    revenue = F.col("revenue").cast("double")
    index = F.expr("CAST(year(month) * 12 + month(month) AS DOUBLE)")
    before = F.lag(revenue).over(w)
    return monthly_category(m).select(
        CATEGORY, "month", revenue.alias("revenue"),
        F.try_divide(revenue - before, before).alias("change"),
        F.regr_slope(revenue, index).over(every).alias("trend_slope"),
    )


def spend_by_basket(m: Marketplace) -> DataFrame:
    """Mean payment per number of items, and how much more orders of four or more spend."""
    sizes = m.items.groupBy("order_id").agg(F.count(F.lit(1)).alias("n_items"))
    orders = sizes.join(silver.order_payments(m), "order_id")
    value = F.col("total_payment_value")
    versus = orders.agg(
        exact_mean(F.when(F.col("n_items") >= 4, value))
        / exact_mean(F.when(F.col("n_items") == 1, value))
    ).scalar()
    return orders.groupBy("n_items").agg(
        F.count(F.lit(1)).alias("n_orders"), exact_mean(value).alias("mean_payment")
    ).withColumn("four_plus_vs_one", versus)


def box_days_by_score(m: Marketplace) -> DataFrame:
    rows = stages.joined(m, [stages.REVIEWS])
    return distribution(rows, "delivery_days", ["review_score"], QUARTILES, "copies").select(
        "review_score", "min", "q1", "median", "q3", "max"
    )


def box_by_items(m: Marketplace) -> DataFrame:
    """Five numbers of score, delay and payment for orders of 1 to 10 item rows."""
    per_order = stages.timed(m, [stages.ITEMS]).groupBy("order_id").agg(
        F.sum(F.expr("CASE WHEN product_id IS NOT NULL THEN copies ELSE 0L END")).alias("n_items")
    ).where("n_items BETWEEN 1 AND 10")
    cells = None
    for measure, use in [("review_score", [stages.REVIEWS]), ("delivery_delay", []),
                         ("payment_value", [stages.PAYMENTS])]:
        rows = stages.timed(m, use).select(
            "order_id", F.lit(measure).alias("measure"),
            F.col(measure).cast("double").alias("value"), "copies",
        )
        cells = rows if cells is None else cells.unionByName(rows)
    return distribution(
        cells.join(per_order, "order_id"), "value", ["measure", "n_items"], QUARTILES, "copies"
    ).select("measure", "n_items", "min", "q1", "median", "q3", "max")


def dispatch_sla(m: Marketplace) -> DataFrame:
    """Share of items handed to the carrier by the seller's shipping limit."""
    carrier = m.orders.select("order_id", "order_delivered_carrier_date")
    items = m.items.join(carrier, "order_id").where("order_delivered_carrier_date IS NOT NULL")
    return items.groupBy("seller_id").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.expr("avg(CAST(order_delivered_carrier_date <= shipping_limit_date AS INT))")
        .alias("on_time_dispatch_rate"),
    )


def core_state_share(m: Marketplace) -> DataFrame:
    orders = m.orders.join(m.customers.select("customer_id", "customer_state"),
                           "customer_id", "left")
    inside = F.coalesce(F.col("customer_state").isin(ref.CORE_STATES), F.lit(False))
    return orders.agg(F.avg(inside.cast("int")).alias("core_state_share"))


def score_trend(m: Marketplace) -> DataFrame:
    return silver.latest_reviews(m).groupBy(month_of("review_creation_date").alias("month")).agg(
        F.count(F.lit(1)).alias("n_reviews"),
        F.avg("review_score").alias("avg_score"),
        *[F.avg((labels.sentiment("review_score") == s).cast("int")).alias(f"{s}_share")
          for s in ("positive", "neutral", "negative")],
    )


def freight_by_category(m: Marketplace) -> DataFrame:
    return categorised_items(m).groupBy(CATEGORY).agg(
        F.avg("freight_ratio").alias("mean_freight_ratio"),
        F.sum("freight_value").alias("freight"),
    )


def cohort_ltv(m: Marketplace) -> DataFrame:
    """Customers and mean lifetime value per month of first order."""
    people = order_facts(m).where("customer_unique_id IS NOT NULL").groupBy(
        "customer_unique_id"
    ).agg(
        month_of(F.min("order_purchase_timestamp")).alias("cohort"),
        F.coalesce(F.sum("total_payment_value"), F.lit(0)).alias("ltv"),
    )
    return people.groupBy("cohort").agg(
        F.count(F.lit(1)).alias("n_customers"), exact_mean("ltv").alias("mean_ltv")
    )


def place_volume(m: Marketplace) -> DataFrame:
    return m.orders.join(m.customers, "customer_id", "left").groupBy(
        "customer_state", "customer_city"
    ).agg(F.count(F.lit(1)).alias("n_orders"))


def cancellation_stage(m: Marketplace) -> DataFrame:
    canceled = m.orders.where("order_status = 'canceled'")
    return canceled.groupBy(labels.milestone_reached().alias("stage")).agg(
        F.count(F.lit(1)).alias("n_orders")
    )


def by_payment_method(m: Marketplace) -> DataFrame:
    facts = silver.order_payments(m).join(
        silver.latest_reviews(m).select("order_id", "review_score"), "order_id", "left"
    )
    return facts.groupBy("primary_payment_type").agg(
        F.count(F.lit(1)).alias("n_orders"),
        exact_mean("total_payment_value").alias("mean_order_value"),
        F.avg("review_score").alias("mean_score"),
    )


def repeat_by_installments(m: Marketplace) -> DataFrame:
    people = order_facts(m).where("customer_unique_id IS NOT NULL").groupBy(
        "customer_unique_id"
    ).agg(F.max("max_installments").alias("deepest"), F.count(F.lit(1)).alias("n_orders"))
    return people.where("deepest IS NOT NULL").groupBy(
        labels.installment_bucket("deepest").alias("installments")
    ).agg(
        F.count(F.lit(1)).alias("n_customers"),
        F.avg((F.col("n_orders") > 1).cast("int")).alias("repeat_rate"),
    )


def late_one_star(m: Marketplace) -> DataFrame:
    facts = silver.orders(m).where("order_delivered_customer_date IS NOT NULL").join(
        silver.latest_reviews(m).select("order_id", "review_score"), "order_id"
    )
    return facts.groupBy("is_late").agg(
        F.count(F.lit(1)).alias("n_reviews"),
        F.avg((F.col("review_score") == 1).cast("int")).alias("one_star_rate"),
    )


def size_vs_freight(m: Marketplace) -> DataFrame:
    sizes = m.products.select(
        "product_id", F.col("product_weight_g").cast("double").alias("weight"),
        labels.product_volume().cast("double").alias("volume"),
    )
    freight = F.col("freight_value").cast("double")
    return m.items.join(sizes, "product_id", "left").agg(
        F.corr("weight", freight).alias("weight_freight"),
        F.corr("volume", freight).alias("volume_freight"),
    )


def listing_vs_score(m: Marketplace) -> DataFrame:
    listing = m.products.select(
        "product_id", F.col("product_photos_qty").cast("double").alias("photos"),
        F.col("product_description_lenght").cast("double").alias("description"),
    )
    rows = m.items.select("order_id", "product_id").join(listing, "product_id", "left").join(
        silver.latest_reviews(m).select("order_id", "review_score"), "order_id"
    )
    score = F.col("review_score").cast("double")
    return rows.agg(
        F.corr("photos", score).alias("photos_score"),
        F.corr("description", score).alias("description_score"),
    )


def state_coverage(m: Marketplace) -> DataFrame:
    """Per state: sellers, their delivery speed, and the orders its customers place."""
    supply = m.sellers.groupBy("seller_state").agg(F.count(F.lit(1)).alias("n_sellers"))
    speed = (
        m.items.join(m.sellers.select("seller_id", "seller_state"), "seller_id")
        .join(silver.orders(m).select("order_id", "total_delivery_days"), "order_id")
        .groupBy("seller_state").agg(F.avg("total_delivery_days").alias("avg_delivery_days"))
    )
    demand = m.orders.join(m.customers.select("customer_id", "customer_state"), "customer_id") \
        .groupBy("customer_state").agg(F.count(F.lit(1)).alias("n_orders"))
    return (
        supply.join(speed, "seller_state", "left")
        .join(demand, F.col("seller_state") == F.col("customer_state"), "full")
        .select(
            F.coalesce("seller_state", "customer_state").alias("state"),
            F.coalesce("n_sellers", F.lit(0)).alias("n_sellers"),
            F.coalesce("n_orders", F.lit(0)).alias("n_orders"),
            "avg_delivery_days",
            F.try_divide("n_orders", "n_sellers").alias("orders_per_seller"),
        )
    )


def item_distances(m: Marketplace) -> DataFrame:
    """Distance in km between the zip centroids of seller and customer, per item."""
    centroid = stages.zip_centroids(m)
    sellers = m.sellers.join(
        centroid, F.col("seller_zip_code_prefix") == F.col("zip"), "left"
    ).select("seller_id", F.col("lat").alias("s_lat"), F.col("lng").alias("s_lng"))
    customers = m.customers.join(
        centroid, F.col("customer_zip_code_prefix") == F.col("zip"), "left"
    ).select("customer_id", F.col("lat").alias("c_lat"), F.col("lng").alias("c_lng"))
    orders = silver.orders(m).select("order_id", "customer_id", "total_delivery_days").join(
        customers, "customer_id", "left"
    )
    return (
        m.items.select("order_id", "order_item_id", "product_id", "seller_id")
        .join(sellers, "seller_id", "left")
        .join(orders, "order_id")
        .select("order_id", "order_item_id", "product_id", "seller_id", "total_delivery_days",
                labels.haversine_km("s_lat", "s_lng", "c_lat", "c_lng").alias("distance_km"))
    )


def distance_vs_days(m: Marketplace) -> DataFrame:
    return item_distances(m).agg(
        F.corr("distance_km", "total_delivery_days").alias("distance_days"),
        F.count(F.expr("distance_km + total_delivery_days")).alias("n"),
    )


def price_by_category(m: Marketplace) -> DataFrame:
    return distribution(categorised_items(m), "price", [CATEGORY], QUARTILES).select(
        CATEGORY, F.col("count").alias("n"), "mean", "std", "min", "q1", "median", "q3", "max"
    )
