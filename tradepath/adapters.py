"""The marketplace tables, derived from the generated star-schema parquet files.

Identifiers stay in their native integer type and timestamps stay zone-less.
Money is decimal(10,2), so sums do not depend on the order of addition.
Everything that the files lack follows from the integer keys by modulo.
"""

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradepath.functions import reference_data as ref

MONEY = "decimal(10,2)"

# The layout of the parquet files, so that no job is spent on inference.
RAW_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
              "props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
}

# Order priority -> payment type of the first payment.
PRIORITY_PAYMENT = {
    "1-URGENT": "credit_card",
    "2-HIGH": "boleto",
    "3-MEDIUM": "voucher",
    "4-NOT SPECIFIED": "not_defined",
    "5-LOW": "debit_card",
}

STATE_CODES = list(ref.STATE_NAMES)
CATEGORY_NAMES = [c for c in ref.CATEGORY_ENGLISH if c != "unknown"]


def _pick(values: list[str], index: str):
    names = ", ".join(f"'{v}'" for v in values)
    return F.expr(f"element_at(array({names}), CAST({index} + 1 AS INT))")


def _zip(number):
    return F.lpad(number.cast("string"), 5, "0")


class Marketplace:
    """Lazy handles on the nine domain tables and the event feed of one data folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(RAW_SCHEMAS[name]).parquet(f"{self.path}/{name}.parquet")

    @cached_property
    def orders(self) -> DataFrame:
        """Every 37th order is canceled; some milestones are missing or out of order."""
        return self.raw("orders").selectExpr(
            "o_orderkey AS order_id",
            "o_custkey AS customer_id",
            """CASE WHEN o_orderkey % 37 = 0 THEN 'canceled' WHEN o_orderstatus = 'F'
               THEN 'delivered' WHEN o_orderstatus = 'O' THEN 'shipped'
               ELSE 'processing' END AS order_status""",
            "o_orderdate AS order_purchase_timestamp",
            """CASE WHEN o_orderkey % 97 <> 0 AND o_orderkey % 1009 <> 0
               THEN o_orderdate + make_dt_interval(0, CAST(o_orderkey % 48 AS INT)) END
               AS order_approved_at""",
            """CASE WHEN o_orderstatus <> 'P' AND o_orderkey % 89 <> 0 AND o_orderkey % 1009 <> 0
               THEN o_orderdate + make_dt_interval(
                 CAST(o_orderkey % 9 - 1 AS INT), CAST(o_orderkey % 7 AS INT)) END
               AS order_delivered_carrier_date""",
            """CASE WHEN o_orderstatus = 'F' AND o_orderkey % 37 <> 0 AND o_orderkey % 103 <> 0
               AND o_orderkey % 1009 <> 0 THEN o_orderdate + make_dt_interval(
                 CAST(o_orderkey * 37 % 40 AS INT), CAST(o_orderkey % 24 AS INT)) END
               AS order_delivered_customer_date""",
            """o_orderdate + make_dt_interval(CAST(o_orderkey % 24 + 7 AS INT))
               AS order_estimated_delivery_date""",
        )

    @cached_property
    def items(self) -> DataFrame:
        return self.raw("lineitem").selectExpr(
            "l_orderkey AS order_id",
            "l_linenumber AS order_item_id",
            "l_partkey AS product_id",
            "l_suppkey AS seller_id",
            "l_shipdate AS shipping_limit_date",
            f"""CAST(CASE WHEN (l_orderkey + l_partkey) % 997 = 0 THEN 0
                ELSE CAST(l_extendedprice AS {MONEY}) END AS {MONEY}) AS price""",
            f"""CAST(round(CAST(l_extendedprice AS {MONEY}) * CAST(l_tax AS DECIMAL(4,2)), 2)
                AS {MONEY}) AS freight_value""",
        )

    @cached_property
    def payments(self) -> DataFrame:
        """One payment per order plus a voucher on every 23rd; every 211th order has none."""
        kinds = ", ".join(f"'{k}', '{v}'" for k, v in PRIORITY_PAYMENT.items())
        payment = """struct({n} AS payment_sequential, {kind} AS payment_type,
            CAST({months} AS INT) AS payment_installments,
            CAST({value} AS DECIMAL(10,2)) AS payment_value)"""
        first = payment.format(
            n=1, kind=f"map({kinds})[o_orderpriority]", months="o_orderkey % 10 + 1",
            value="o_totalprice",
        )
        second = payment.format(
            n=2, kind="'voucher'", months=1,
            value=f"round(CAST(o_totalprice AS {MONEY}) * 0.10BD, 2)",
        )
        return self.raw("orders").where("o_orderkey % 211 <> 0").selectExpr(
            "o_orderkey AS order_id",
            f"""inline(CASE WHEN o_orderkey % 23 = 0 THEN array({first}, {second})
                ELSE array({first}) END)
                AS (payment_sequential, payment_type, payment_installments, payment_value)""",
        )

    @cached_property
    def reviews(self) -> DataFrame:
        """One review per order but for every 11th; every 101st order has two."""
        review = """struct({id} AS review_id, CAST({score} AS INT) AS review_score,
            o_orderdate + make_dt_interval(
              CAST(o_orderkey * 37 % 40 + o_orderkey % 5 + {shift} AS INT),
              CAST(o_orderkey % 13 AS INT)) AS review_creation_date)"""
        first = review.format(id="o_orderkey * 2", score="o_orderkey * 7 % 5 + 1", shift=-1)
        second = review.format(id="o_orderkey * 2 + 1", score="o_orderkey % 5 + 1", shift=1)
        return self.raw("orders").where("o_orderkey % 11 <> 0").selectExpr(
            "o_orderkey AS order_id",
            f"""inline(CASE WHEN o_orderkey % 101 = 0 THEN array({first}, {second})
                ELSE array({first}) END) AS (review_id, review_score, review_creation_date)""",
        ).select("review_id", "order_id", "review_score", "review_creation_date")

    @cached_property
    def reviews_with_text(self) -> DataFrame:
        """Reviews with a comment from the documents; three in five have none."""
        docs = self.raw("documents")
        total = docs.agg(F.count(F.lit(1)).alias("n")).scalar()
        has_text = F.col("order_id") % 5 >= 3
        return (
            self.reviews.withColumn("doc_id", F.when(has_text, F.col("order_id") % total))
            .join(
                docs.select("doc_id", F.col("text").alias("review_comment_message")),
                "doc_id", "left",
            )
            .drop("doc_id")
        )

    def comments(self, *by) -> DataFrame:
        """Each comment text once (per group in `by`) with the number of reviews that carry it.
        Texts that come in fewer splits than there are cores are spread over the cores."""
        docs = self.raw("documents").select(
            "doc_id", F.col("text").alias("review_comment_message"))
        total = self.raw("documents").agg(F.count(F.lit(1)).alias("n")).scalar()
        cores = self.spark.sparkContext.defaultParallelism
        if docs.rdd.getNumPartitions() < cores:
            docs = docs.repartition(cores)
        counts = self.reviews.where("order_id % 5 >= 3").groupBy(
            (F.col("order_id") % total).alias("doc_id"), *by
        ).agg(F.count(F.lit(1)).alias("copies"))
        return docs.join(counts, "doc_id")

    @cached_property
    def _nations(self) -> DataFrame:
        return self.raw("nation").select(
            "n_nationkey",
            F.lower("n_name").alias("city"),
            _pick(STATE_CODES, "n_nationkey").alias("state"),
        )

    @cached_property
    def customers(self) -> DataFrame:
        c = self.raw("customer")
        return c.join(self._nations, c.c_nationkey == F.col("n_nationkey"), "left").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_custkey").alias("customer_unique_id"),
            _zip(F.col("c_custkey") % 100).alias("customer_zip_code_prefix"),
            F.col("city").alias("customer_city"),
            F.col("state").alias("customer_state"),
        )

    @cached_property
    def sellers(self) -> DataFrame:
        s = self.raw("supplier")
        return s.join(self._nations, s.s_nationkey == F.col("n_nationkey"), "left").select(
            F.col("s_suppkey").alias("seller_id"),
            _zip(F.col("s_suppkey") % 100).alias("seller_zip_code_prefix"),
            F.col("city").alias("seller_city"),
            F.col("state").alias("seller_state"),
        )

    @cached_property
    def products(self) -> DataFrame:
        k, size = F.col("p_partkey"), F.col("p_size")
        known = k % 61 != 0
        measured = k % 47 != 0
        return self.raw("part").select(
            k.alias("product_id"),
            F.when(known, _pick(CATEGORY_NAMES, r"CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INT)")).alias("product_category_name"),
            F.when(known, F.length("p_name")).alias("product_name_lenght"),
            F.when(known, size * 20 + k % 50).cast("int").alias("product_description_lenght"),
            F.when(known, k % 6 + 1).cast("int").alias("product_photos_qty"),
            F.when(measured, size * 100).alias("product_weight_g"),
            F.when(measured, size + 10).alias("product_length_cm"),
            F.when(measured, size % 15 + 2).alias("product_height_cm"),
            F.when(measured, size % 20 + 8).alias("product_width_cm"),
        )

    @cached_property
    def geolocation(self) -> DataFrame:
        """One coordinate row per customer, with repeats; prefixes 00090 to 00099 are missing."""
        m = F.col("c_custkey") % 700
        return self.raw("customer").select(
            _zip(m % 90).alias("geolocation_zip_code_prefix"),
            F.when(m % 53 == 0, F.lit(10.0))
            .otherwise((m % 35 * 100 - 3000 + m % 7) / F.lit(100.0))
            .alias("geolocation_lat"),
            ((m % 40 * 100 - 7000 + m % 11) / F.lit(100.0)).alias("geolocation_lng"),
            F.concat(F.lit("nation_"), (m % 25).cast("string")).alias("geolocation_city"),
            _pick(STATE_CODES, "c_custkey % 700 % 25").alias("geolocation_state"),
        )

    @cached_property
    def translation(self) -> DataFrame:
        """English name of every category that occurs, but for those mapped by hand."""
        from tradepath.functions.labels import literal_map

        manual = list(ref.CATEGORY_OVERRIDES)
        return (
            self.products.select("product_category_name").distinct()
            .where(F.col("product_category_name").isNotNull())
            .where(~F.col("product_category_name").isin(manual))
            .withColumn(
                "product_category_name_english",
                literal_map(ref.CATEGORY_ENGLISH, "product_category_name"),
            )
        )

    @cached_property
    def kafka_rows(self) -> DataFrame:
        """Events in the layout of a Kafka source; every 97th value is broken JSON."""
        body = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
        return self.raw("events").select(
            F.col("user_id").cast("string").cast("binary").alias("key"),
            F.when(F.col("event_id") % 97 == 0, F.lit("{broken")).otherwise(body)
            .cast("binary").alias("value"),
            F.lit("events").alias("topic"),
            (F.col("event_id") % 3).cast("int").alias("partition"),
            F.col("event_id").alias("offset"),
            F.col("ts").alias("timestamp"),
        )

    # change feeds: attributes of a key as observed at a time

    @cached_property
    def customer_changes(self) -> DataFrame:
        """A customer as of each of its orders; the zip prefix moves every second year."""
        return self.orders.join(self.customers, "customer_id").select(
            "customer_id", "customer_unique_id", "customer_city", "customer_state",
            _zip(F.expr("(customer_id + (year(order_purchase_timestamp) - 1995) DIV 2) % 100"))
            .alias("customer_zip_code_prefix"),
            F.col("order_purchase_timestamp").alias("changed_at"),
        )

    @cached_property
    def product_changes(self) -> DataFrame:
        """A product as of each shipping limit; its weight is corrected every third year. Items go to
        their product while they are short: after a broadcast each would carry all attributes into
        the shuffle of the history."""
        return self.items.join(self.products.hint("merge"), "product_id").select(
            "product_id", "product_category_name", "product_name_lenght",
            "product_description_lenght", "product_photos_qty",
            F.expr("product_weight_g + 50 * ((year(shipping_limit_date) - 1995) DIV 3)")
            .cast("int").alias("product_weight_g"),
            "product_length_cm", "product_height_cm", "product_width_cm",
            F.col("shipping_limit_date").alias("changed_at"),
        )

    @cached_property
    def seller_changes(self) -> DataFrame:
        """A seller as of each shipping limit; its zip prefix moves every fourth year."""
        return self.items.join(self.sellers, "seller_id").select(
            "seller_id", "seller_city", "seller_state",
            _zip(F.expr("(seller_id + (year(shipping_limit_date) - 1995) DIV 4) % 100"))
            .alias("seller_zip_code_prefix"),
            F.col("shipping_limit_date").alias("changed_at"),
        )
