"""The hypothesis tests of the analysis, each on its own cut of the delivered rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradepath.adapters import Marketplace
from tradepath.functions import labels
from tradepath.operators import hypothesis as tests
from tradepath.plans import kpis, silver, stages
from tradepath.plans.stages import ITEMS, PAYMENTS, PRODUCTS, REVIEWS

CATEGORY = kpis.CATEGORY


def late_bad_reviews(m: Marketplace) -> DataFrame:
    """Are bad scores more frequent among late deliveries?"""
    scored = stages.delivered(m, [REVIEWS]).where("review_score IS NOT NULL")
    late = labels.is_late_by_days("delivery_delay")
    return tests.two_proportions(scored, F.col("bad_score"), late, "copies")


def early_late_scores(m: Marketplace) -> DataFrame:
    return tests.mann_whitney(
        stages.timed(m, [REVIEWS]), "review_score", "delivery_status", "early", "late", "copies"
    )


def paid(m: Marketplace, use=(PAYMENTS,)) -> DataFrame:
    """Delivered rows with a payment and its ratio to the item price."""
    rows = stages.delivered(m, use).where("payment_value IS NOT NULL")
    if ITEMS in use:
        rows = rows.withColumn("overpayment_ratio", labels.ratio("payment_value", "price"))
    return rows


def payment_value_by_type(m: Marketplace) -> DataFrame:
    return tests.kruskal_wallis(paid(m), "payment_value", "payment_type", "copies")


def overpayment_by_type(m: Marketplace) -> DataFrame:
    rows = paid(m, (ITEMS, PAYMENTS))
    return tests.kruskal_wallis(rows, "overpayment_ratio", "payment_type", "copies")


def payment_value_pairs(m: Marketplace) -> DataFrame:
    return tests.dunn(paid(m), "payment_value", "payment_type", "copies")


def overpayment_pairs(m: Marketplace) -> DataFrame:
    rows = paid(m, (ITEMS, PAYMENTS))
    return tests.dunn(rows, "overpayment_ratio", "payment_type", "copies")


def basket_scores(m: Marketplace) -> DataFrame:
    """Distinct (order, score, distinct products) of paid delivered orders, by basket group.

    All joined rows of an order share its product count, so the distinct rows come from
    orders and reviews without building the joined rows.
    """
    products = m.items.groupBy("order_id").agg(F.count_distinct("product_id").alias("n_items"))
    orders = stages.clean_orders(m).where("order_status = 'delivered'").select("order_id")
    scores = m.reviews.select("order_id", "review_score").where("review_score IS NOT NULL")
    return (
        orders.join(m.payments.where("payment_value IS NOT NULL"), "order_id", "left_semi")
        .join(products, "order_id", "left")
        .join(scores, "order_id")
        .select("order_id", "review_score",
                F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"))
        .dropDuplicates(["order_id", "review_score", "n_items"])
        .withColumn("item_group", labels.basket_group("n_items"))
    )


def basket_test(m: Marketplace) -> DataFrame:
    return tests.kruskal_wallis(basket_scores(m), "review_score", "item_group")


def basket_pairs(m: Marketplace) -> DataFrame:
    return tests.dunn(basket_scores(m), "review_score", "item_group")


def popularity_cohort(m: Marketplace, minimum: int = 30, n: int = 10) -> DataFrame:
    """The n categories with the most and the n with the fewest reviews, at least `minimum`.

    A category in both lists counts as top.
    """
    rows = stages.delivered(m, [ITEMS, PAYMENTS, REVIEWS], [PRODUCTS]).where(
        f"payment_value IS NOT NULL AND {CATEGORY} IS NOT NULL AND review_score IS NOT NULL"
    )
    stats = rows.groupBy(CATEGORY).agg(kpis.rows().alias("n_reviews")).where(
        F.col("n_reviews") >= minimum
    )
    top = stats.orderBy(F.desc("n_reviews"), CATEGORY).limit(n)
    low = stats.orderBy("n_reviews", CATEGORY).limit(n)
    both = top.withColumn("popularity_group", F.lit("top10")).unionByName(
        low.withColumn("popularity_group", F.lit("bottom10"))
    )
    return both.groupBy(CATEGORY, "n_reviews").agg(
        F.max("popularity_group").alias("popularity_group")
    )


def popularity_test(m: Marketplace) -> DataFrame:
    """Scores of popular against unpopular categories."""
    rows = stages.delivered(m, [ITEMS, PAYMENTS, REVIEWS], [PRODUCTS]).where(
        "payment_value IS NOT NULL"
    )
    cohort = popularity_cohort(m).select(CATEGORY, "popularity_group")  # at most 2n rows
    return tests.mann_whitney(
        rows.join(F.broadcast(cohort), CATEGORY), "review_score", "popularity_group",
        "top10", "bottom10", "copies",
    )


def payment_histogram(m: Marketplace, bins: int = 20) -> DataFrame:
    """Payments of every type; rows without a payment have no value and no bin."""
    rows = stages.delivered(m, [PAYMENTS])
    return tests.log_histogram(rows, "payment_value", "payment_type", bins, 0.0, 15.0, "copies")


def late_one_star_association(m: Marketplace) -> DataFrame:
    """Late delivery against one-star scores, one row per order."""
    rows = silver.orders(m).where("order_delivered_customer_date IS NOT NULL").join(
        silver.latest_reviews(m).select("order_id", "review_score"), "order_id"
    )
    return tests.chi_square_2x2(rows, F.col("review_score") == 1, F.col("is_late"))
