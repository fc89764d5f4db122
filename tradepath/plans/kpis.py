"""Business figures over the joined rows, each row weighted by `copies`.

Medians of days, scores and instalments use `percentile`, whose state is one entry per
distinct value and so stays small; money and durations use the bucketed quantiles.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradepath.adapters import Marketplace
from tradepath.functions import labels
from tradepath.functions.temporal import seconds_between
from tradepath.operators.profile import melt, value_counts
from tradepath.operators.quantiles import between_quantiles, distribution, medians, moments
from tradepath.plans import stages
from tradepath.plans.stages import (
    CUSTOMERS, DURATIONS, GEO, ITEMS, PAYMENTS, PRODUCTS, REVIEWS, delivered, joined, timed,
)

CATEGORY = "product_category_english"


def rows() -> Column:
    return F.sum("copies")


def mean(x) -> Column:
    """Average over joined rows, nulls left out; integers and money add up exactly."""
    v = F.col(x) if isinstance(x, str) else x
    present = F.sum(F.when(v.isNotNull(), F.col("copies")))
    return F.try_divide(F.sum(v * F.col("copies")).cast("double"), present)


def share(condition) -> Column:
    """Share of joined rows that meet a condition; unknown counts as not met."""
    c = F.coalesce(condition, F.lit(False))
    return F.try_divide(F.sum(F.when(c, F.col("copies")).otherwise(F.lit(0))), rows())


def small_median(x: str) -> Column:
    """Median of a column with few distinct values."""
    return F.percentile(x, F.lit(0.5), F.col("copies"))


def total(x: str) -> Column:
    return F.sum(F.col(x) * F.col("copies"))


def top_and_bottom(df: DataFrame, by: str, label: str, n: int = 10) -> DataFrame:
    """The n highest and n lowest rows; equal values go by label."""
    top = df.orderBy(F.desc(by), F.asc(label)).limit(n).withColumn("side", F.lit("top"))
    low = df.orderBy(F.asc(by), F.asc(label)).limit(n).withColumn("side", F.lit("bottom"))
    return top.unionByName(low)


def _known(df: DataFrame, *columns: str) -> DataFrame:
    return df.where(" AND ".join(f"`{c}` IS NOT NULL" for c in columns))


# reviews and categories

def days_by_score(m: Marketplace) -> DataFrame:
    rows_ = _known(joined(m, [REVIEWS]), "review_score")
    return rows_.groupBy("review_score").agg(
        small_median("delivery_days").alias("median_days"), mean("delivery_days").alias("mean_days"),
        total("delivery_days").alias("total_days"), rows().alias("n"),
    )


def bad_share_by_category(m: Marketplace) -> DataFrame:
    rows_ = _known(joined(m, [ITEMS, REVIEWS], [PRODUCTS]), CATEGORY)
    return rows_.groupBy(CATEGORY).agg(share(F.col("bad_score")).alias("bad_share"))


def score_crosstab(m: Marketplace, minimum: int = 100, n: int = 15) -> DataFrame:
    """Score shares per category with more than `minimum` rows, the worst n by bad share."""
    rows_ = _known(joined(m, [ITEMS, REVIEWS], [PRODUCTS]), CATEGORY)
    table = rows_.groupBy(CATEGORY).agg(
        rows().alias("category_rows"),
        *[F.sum(F.expr(f"CASE WHEN review_score = {s} THEN copies ELSE 0L END")).alias(f"_{s}")
          for s in range(1, 6)],
    )
    scored = F.expr("_1 + _2 + _3 + _4 + _5")
    shares = table.where((F.col("category_rows") > minimum) & (scored > 0)).select(
        CATEGORY, "category_rows",
        *[(F.col(f"_{s}") / scored).alias(f"score_{s}") for s in range(1, 6)],
        (F.expr("_1 + _2 + _3") / scored).alias("bad_share"),
        (F.expr("_4 + _5") / scored).alias("good_share"),
    )
    return shares.orderBy(F.desc("bad_share"), CATEGORY).limit(n)


def comment_share(m: Marketplace) -> DataFrame:
    """Percent of reviews with a comment, per score."""
    return m.reviews_with_text.where("review_score IS NOT NULL").groupBy("review_score").agg(
        F.expr("100 - 100 * avg(CAST(review_comment_message IS NULL AS INT))")
        .alias("comment_share")
    )


def category_sales(m: Marketplace) -> DataFrame:
    rows_ = _known(delivered(m, [ITEMS], [PRODUCTS]), CATEGORY)
    return top_and_bottom(rows_.groupBy(CATEGORY).agg(rows().alias("n")), "n", CATEGORY)


def category_rating(m: Marketplace) -> DataFrame:
    rows_ = _known(delivered(m, [ITEMS, REVIEWS], [PRODUCTS]), CATEGORY)
    rating = rows_.groupBy(CATEGORY).agg(F.bround(mean("review_score"), 3).alias("rating"))
    return top_and_bottom(rating.where("rating IS NOT NULL"), "rating", CATEGORY)


def category_days(m: Marketplace) -> DataFrame:
    rows_ = _known(delivered(m, [ITEMS], [PRODUCTS]), CATEGORY)
    days = rows_.groupBy(CATEGORY).agg(F.bround(mean("delivery_days"), 0).cast("long").alias("days"))
    return top_and_bottom(days, "days", CATEGORY)


def category_payment(m: Marketplace) -> DataFrame:
    rows_ = delivered(m, [ITEMS, PAYMENTS], [PRODUCTS])
    median = medians(rows_, "payment_value", [CATEGORY], "m", "copies")
    value = median.select(CATEGORY, F.bround("m", 0).cast("long").alias("median_payment"))
    return top_and_bottom(value, "median_payment", CATEGORY)


def category_revenue(m: Marketplace, n: int = 10) -> DataFrame:
    rows_ = _known(delivered(m, [ITEMS, PAYMENTS], [PRODUCTS]), CATEGORY)
    revenue = rows_.groupBy(CATEGORY).agg(
        F.bround(F.coalesce(total("payment_value"), F.lit(0)), 0).alias("revenue")
    )
    return revenue.orderBy(F.desc("revenue"), CATEGORY).limit(n)


# payments

def payment_share(m: Marketplace, n: int = 4) -> DataFrame:
    shares = value_counts(joined(m, [PAYMENTS]), ["payment_type"], "share", "copies")
    return (
        shares.orderBy(F.desc("n"), "payment_type").limit(n)
        .select("payment_type", F.bround(F.col("share") * 100, 2).alias("percent"))
    )


def payment_mean(m: Marketplace, n: int = 4) -> DataFrame:
    means = joined(m, [PAYMENTS]).groupBy("payment_type").agg(
        F.bround(mean("payment_value"), 0).alias("mean_payment")
    )
    return (
        means.where("mean_payment IS NOT NULL")
        .orderBy(F.desc("mean_payment"), "payment_type").limit(n)
    )


def installment_ratio(m: Marketplace) -> DataFrame:
    return joined(m, [PAYMENTS]).agg(
        (share(F.col("payment_installments") > 1) * 100).alias("installment_percent")
    )


def installments_by_category(m: Marketplace, n: int = 10) -> DataFrame:
    rows_ = _known(joined(m, [ITEMS, PAYMENTS], [PRODUCTS]), CATEGORY)
    ratio = rows_.groupBy(CATEGORY).agg(share(F.col("payment_installments") > 1).alias("ratio"))
    return ratio.orderBy(F.desc("ratio"), CATEGORY).limit(n)


def city_mean_payment(m: Marketplace) -> DataFrame:
    rows_ = _known(joined(m, [PAYMENTS], [CUSTOMERS]), "customer_city")
    return rows_.groupBy("customer_city").agg(
        F.bround(mean("payment_value"), 0).alias("mean_payment")
    )


def state_summary(m: Marketplace) -> DataFrame:
    """Median payment, rows, median coordinates and volume group per state."""
    rows_ = joined(m, [PAYMENTS], [GEO])
    numbers = rows_.select(
        "customer_state", "copies", F.col("payment_value").cast("double").alias("payment"),
        "lat", "lng",
    )
    cells = melt(numbers, ["payment", "lat", "lng"], keep=["customer_state", "copies"])
    middle = medians(cells, "value", ["customer_state", "column"], "m", "copies")
    wide = middle.groupBy("customer_state").agg(
        F.bround(F.max(F.expr("CASE WHEN column = 'payment' THEN m END")), 0)
        .alias("median_payment"),
        F.max(F.expr("CASE WHEN column = 'lat' THEN m END")).alias("lat"),
        F.max(F.expr("CASE WHEN column = 'lng' THEN m END")).alias("lng"),
    )
    counts = value_counts(
        joined(m, (), [CUSTOMERS]), ["customer_state"], copies="copies"
    ).withColumnRenamed("n", "order_count")
    return counts.join(wide, "customer_state", "left").withColumn(
        "volume_group", labels.volume_group("order_count")
    )


# delivery

def stage_durations(m: Marketplace) -> DataFrame:
    """Mean, median and std of each stage in seconds, median and std in hours."""
    cells = melt(timed(m, ()), DURATIONS, "stage", "seconds", ["copies"])
    return distribution(cells, "seconds", ["stage"], {"median": 0.5}, "copies").select(
        "stage", "mean", "median", "std",
        (F.bround("median", 0) / 3600).alias("median_hours"),
        (F.bround("std", 0) / 3600).alias("std_hours"),
    )


def delivery_status_share(m: Marketplace) -> DataFrame:
    shares = value_counts(timed(m, ()), ["delivery_status"], "share", "copies")
    return shares.where("delivery_status <> 'missing'").select(
        "delivery_status", (F.col("share") * 100).alias("percent")
    )


def score_by_status(m: Marketplace) -> DataFrame:
    """Percent of each score within a delivery status."""
    rows_ = _known(timed(m, [REVIEWS]), "review_score")
    table = rows_.groupBy("delivery_status").agg(
        rows().alias("_n"),
        *[F.sum(F.expr(f"CASE WHEN review_score = {s} THEN copies ELSE 0L END")).alias(f"_{s}")
          for s in range(1, 6)],
    )
    return table.select(
        "delivery_status",
        *[(F.col(f"_{s}") / F.col("_n") * 100).alias(f"score_{s}") for s in range(1, 6)],
    )


def late_early_scores(m: Marketplace) -> DataFrame:
    rows_ = timed(m, [REVIEWS])
    return rows_.agg(*[
        mean(F.when(F.col("delivery_status") == s, F.col("review_score"))).alias(f"{s}_mean_score")
        for s in ("late", "early")
    ])


def state_delay(m: Marketplace, n: int = 10) -> DataFrame:
    """Median delay of the n states with the most rows, lowest median first."""
    rows_ = _known(timed(m, (), [CUSTOMERS]), "customer_state")
    states = rows_.groupBy("customer_state").agg(
        small_median("delivery_delay").alias("median_delay"), rows().alias("n")
    )
    busiest = states.orderBy(F.desc("n"), "customer_state").limit(n)
    return busiest.orderBy("median_delay", "customer_state")


def sla_seven_days(m: Marketplace) -> DataFrame:
    """Share delivered within 7 days: over all delivered rows, and over timed rows only."""
    quick = timed(m, ()).agg(
        F.sum(F.expr("CASE WHEN total_time <= 7 * 86400 THEN copies ELSE 0L END")).alias("quick"),
        F.sum(F.expr("""CASE WHEN total_time <= 7 * 86400 AND order_status = 'delivered'
                        THEN copies ELSE 0L END""")).alias("quick_delivered"),
        F.sum(F.expr("CASE WHEN order_status = 'delivered' THEN copies ELSE 0L END"))
        .alias("timed_delivered"),
    )
    all_delivered = delivered(m, ()).agg(rows()).scalar()
    return quick.select(
        (F.col("quick") / all_delivered * 100).alias("mixed_percent"),
        (F.col("quick_delivered") / F.col("timed_delivered") * 100).alias("corrected_percent"),
    )


# customers

def orders_per_customer(orders: DataFrame) -> DataFrame:
    return _known(orders, "customer_unique_id").groupBy("customer_unique_id").agg(
        F.count_distinct("order_id").alias("n_orders")
    )


def repeat_ratio(orders: DataFrame) -> DataFrame:
    """Customers with more than one distinct order, over all customers."""
    return orders_per_customer(orders).agg(
        F.count(F.lit(1)).alias("n_customers"),
        F.count_if(F.col("n_orders") > 1).alias("n_repeat"),
        F.try_divide(F.count_if(F.col("n_orders") > 1), F.count(F.lit(1))).alias("repeat_ratio"),
    )


def delivered_orders(m: Marketplace) -> DataFrame:
    """Delivered orders with their customer, one row per order."""
    return stages.clean_orders(m).where("order_status = 'delivered'").join(
        m.customers, "customer_id", "left"
    )


def timed_orders(m: Marketplace) -> DataFrame:
    return stages.with_durations(stages.clean_orders(m)).where(
        "waiting_time >= 0 AND shipping_time >= 0"
    ).join(m.customers, "customer_id", "left")


def basket_sizes(m: Marketplace, n: int = 7) -> DataFrame:
    """Orders per number of joined item rows, the n most frequent sizes."""
    per_order = timed(m, [ITEMS]).groupBy("order_id").agg(
        F.sum(F.expr("CASE WHEN product_id IS NOT NULL THEN copies ELSE 0L END")).alias("n_items")
    )
    sizes = per_order.groupBy("n_items").agg(F.count(F.lit(1)).alias("n_orders"))
    return sizes.orderBy(F.desc("n_orders"), "n_items").limit(n)


def conversion(m: Marketplace) -> DataFrame:
    return timed(m, ()).agg(share(F.col("order_status") == "delivered").alias("conversion"))


def _payment_quartiles(rows_: DataFrame) -> DataFrame:
    """One row: count, mean, std and the outer quartiles of payments."""
    return distribution(rows_, "payment_value", (), {"q1": 0.25, "q3": 0.75}, "copies")


def order_value(m: Marketplace) -> DataFrame:
    """Mean and std of payments, the same strictly between the quartiles, and per order."""
    rows_ = between_quantiles(delivered(m, [PAYMENTS]), "payment_value", copies="copies").select(
        F.col("mean").alias("aov"), F.col("std").alias("aov_std"),
        F.col("inner_mean").alias("iqr_aov"), F.col("inner_std").alias("iqr_std"))
    orders = stages.clean_orders(m).where("order_status = 'delivered'").select("order_id")
    paid = m.payments.join(orders, "order_id", "left_semi").groupBy("order_id").agg(
        F.sum("payment_value").alias("paid"))
    per_order = paid.agg(
        (F.sum("paid").cast("double") / F.count(F.lit(1))).alias("aov_per_order"))
    # one row of each, side by side
    both = rows_.unionByName(per_order, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def revenue_per_customer(m: Marketplace) -> DataFrame:
    """Payments per customer; the trimmed sum keeps the untrimmed number of customers."""
    rows_ = delivered(m, [PAYMENTS])
    q = _payment_quartiles(rows_).select(F.struct("q1", "q3")).scalar()
    value = F.col("payment_value").cast("double")
    people = delivered_orders(m).agg(F.count_distinct("customer_unique_id")).scalar()
    inner = F.when((value > q["q1"]) & (value < q["q3"]), F.col("payment_value"))
    return rows_.agg(
        total("payment_value").cast("double").alias("_all"),
        F.sum(inner * F.col("copies")).cast("double").alias("_inner"),
    ).select((F.col("_all") / people).alias("arpu"), (F.col("_inner") / people).alias("iqr_arpu"))


def lifetime_values(m: Marketplace) -> DataFrame:
    rows_ = _known(delivered(m, [PAYMENTS], [CUSTOMERS]), "customer_unique_id")
    return rows_.groupBy("customer_unique_id").agg(
        F.coalesce(total("payment_value"), F.lit(0)).cast("double").alias("ltv")
    )


def lifetime_summary(m: Marketplace) -> DataFrame:
    return distribution(lifetime_values(m), "ltv", (), {"median": 0.5, "q75": 0.75}).select(
        F.col("count").alias("n_customers"), "mean", "median", "q75"
    )


def lifetime_top(m: Marketplace, n: int = 5) -> DataFrame:
    values = lifetime_values(m)
    cut = distribution(values, "ltv", (), {"q75": 0.75}).select("q75").scalar()
    return values.where(F.col("ltv") > cut).orderBy(F.desc("ltv"), "customer_unique_id").limit(n)


# delivered rows in one pass

def review_figures(m: Marketplace) -> DataFrame:
    rows_ = delivered(m, [REVIEWS])
    scores = moments(rows_, "review_score", "copies", F.lit(3)).select(F.struct("mean", "std")).scalar()
    return rows_.agg(
        F.sum(F.expr("CASE WHEN bad_score THEN copies ELSE 0L END")).alias("bad_reviews"),
        (share(F.col("bad_score")) * 100).alias("bad_percent"),
    ).select(
        scores["mean"].alias("mean_score"), scores["std"].alias("std_score"),
        "bad_reviews", "bad_percent",
    )


def delivery_accuracy(m: Marketplace) -> DataFrame:
    return delivered(m, ()).agg(mean("delivery_delay").alias("mean_delay_days"))


def early_review_share(m: Marketplace) -> DataFrame:
    early = F.col("review_creation_date") < F.col("order_delivered_customer_date")
    return delivered(m, [REVIEWS]).agg((share(early) * 100).alias("early_review_percent"))


def review_lag(m: Marketplace) -> DataFrame:
    """Seconds from delivery to review, reviews before delivery left out."""
    lag = seconds_between("review_creation_date", "order_delivered_customer_date")
    rows_ = delivered(m, [REVIEWS]).withColumn("lag", lag).where("lag >= 0")
    return distribution(rows_, "lag", (), {"median": 0.5}, "copies").select(
        F.col("mean").alias("mean_seconds"), F.col("median").alias("median_seconds")
    )


def voucher_share(m: Marketplace) -> DataFrame:
    voucher = F.col("payment_type") == "voucher"
    return delivered(m, [PAYMENTS]).agg(
        F.sum(F.when(voucher, F.col("copies")).otherwise(F.lit(0))).alias("voucher_rows"),
        (share(voucher) * 100).alias("voucher_percent"),
    )


def scoreboard(m: Marketplace) -> DataFrame:
    """Ten headline figures, one row each, from seven passes. Mean lifetime value is the mean of the
    values per person; rows without a person count in the revenue per customer only."""
    people = repeat_ratio(delivered_orders(m))
    customers = people.select("n_customers").scalar()
    paid = delivered(m, [PAYMENTS]).agg(
        mean("payment_value").alias("aov"),
        (total("payment_value").cast("double") / customers).alias("arpu"),
        (share(F.col("payment_type") == "voucher") * 100).alias("voucher"),
    )
    reviewed = delivered(m, [REVIEWS]).agg(
        mean("review_score").alias("score"), (share(F.col("bad_score")) * 100).alias("bad")
    )
    passes: Sequence[tuple[DataFrame, dict[str, str]]] = [
        (conversion(m), {"Conversion Rate %": "conversion * 100"}),
        (people, {"Customer Retention %": "repeat_ratio * 100"}),
        (paid, {"AOV R$": "aov", "ARPU R$": "arpu",
                "Voucher Usage %": "voucher"}),
        (lifetime_values(m).agg(F.avg("ltv").alias("ltv")), {"Avg LTV R$": "ltv"}),
        (delivery_accuracy(m), {"Delivery Accuracy (d)": "-mean_delay_days"}),
        (reviewed, {"Review Score": "score", "Bad Reviews %": "bad"}),
        (distribution(timed(m, ()), "shipping_time", (), {"median": 0.5}, "copies"),
         {"Shipping Time (d)": "median / 86400"}),
    ]
    out = None
    for frame, figures in passes:
        cells = ", ".join(f"'{name}', {value}" for name, value in figures.items())
        rows_ = frame.selectExpr(f"stack({len(figures)}, {cells}) AS (metric, value)")
        out = rows_ if out is None else out.unionByName(rows_)
    return out
