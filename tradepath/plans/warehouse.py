"""The star schema: six dimensions and four facts."""

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradepath.adapters import Marketplace
from tradepath.functions import labels
from tradepath.functions import reference_data as ref
from tradepath.functions.temporal import date_key, floor_days_between
from tradepath.operators.quality import DuplicateCheck, NullCheck, ReferenceCheck, ReferenceRule
from tradepath.operators.quality import run_reports
from tradepath.operators.scd import (
    BEGINNING, CURRENT, END, START, UNKNOWN_KEY, as_of, dense_keys, hash_key, history, wide_key,
)
from tradepath.plans import silver
from tradepath.sources.catalogue import LoadCatalogue, file_state
from tradepath.sources.workspace import own_folder

SOURCE_SYSTEM = "marketplace"
CUSTOMER_ATTRIBUTES = [
    "customer_unique_id", "customer_city", "customer_state", "customer_zip_code_prefix",
]
PRODUCT_ATTRIBUTES = [
    "product_category_name", "product_name_lenght", "product_description_lenght",
    "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm",
    "product_width_cm",
]
SELLER_ATTRIBUTES = ["seller_city", "seller_state", "seller_zip_code_prefix"]
CORRECTED_AT = "1998-01-01"


def _audit():
    return [
        F.lit(SOURCE_SYSTEM).alias("SourceSystem"),
        F.current_timestamp().alias("CreatedAt"),
        F.lit(None).cast("timestamp").alias("UpdatedAt"),
    ]


def _stamps():
    return [F.current_timestamp().alias("CreatedAt"),
            F.lit(None).cast("timestamp").alias("UpdatedAt")]


def _known(key):
    """A key column, with the unknown member's key where there is none."""
    c = F.col(key) if isinstance(key, str) else key
    out = F.coalesce(c, F.lit(UNKNOWN_KEY))
    return out.alias(key) if isinstance(key, str) else out


def _with_unknown(dim: DataFrame, key: str) -> DataFrame:
    """A dimension and the row that facts without a member point to."""
    fixed = {
        key: F.lit(UNKNOWN_KEY), START: F.lit(BEGINNING), CURRENT: F.lit(True),
        "SourceSystem": F.lit(SOURCE_SYSTEM), "CreatedAt": F.current_timestamp(),
    }
    return dim.unionByName(dim.sparkSession.range(1).select(*[
        fixed.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in dim.schema
    ]))


# Every date that a fact has a key for: (table, column).
ORDER_DATES = [
    "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date",
]


class Warehouse:
    """Dimensions and facts as lazy frames; nothing runs while they are built.

    With a `folder` the dimensions are read from there, after `write_dimensions` has put them
    there; with `of_load` a catalogue holds them, and each is written when a fact of the load first
    asks for it and read by all others. Without either, each fact derives those that it needs.
    `orders` stands in for the marketplace's orders in the facts.
    """

    def __init__(self, m: Marketplace, folder: str | None = None, orders: DataFrame | None = None):
        self.m = m
        self.folder = folder
        self.orders = m.orders if orders is None else orders
        self.catalogue: LoadCatalogue | None = None
        self.load = ""

    @classmethod
    def of_load(cls, m: Marketplace, catalogue: LoadCatalogue | None = None,
                load: str | None = None, orders: DataFrame | None = None) -> "Warehouse":
        """A warehouse on the dimensions of one load. By default the load is the state of the
        marketplace's files, and the catalogue lies in the application's folder; a job that is to
        share dimensions with later ones names a folder that stays."""
        out = cls(m, orders=orders)
        out.catalogue = catalogue or LoadCatalogue(m.spark, f"{own_folder(m.spark)}/warehouse")
        out.load = load or file_state(m.spark, m.path)
        return out

    DIMENSIONS = ("dates", "geography", "customers", "products", "sellers", "payment_types")

    def write_dimensions(self, folder: str) -> "Warehouse":
        """Write every dimension to the folder, and return a warehouse that reads them there. Each
        is derived from those already written."""
        out = Warehouse(self.m, folder, self.orders)
        for name in self.DIMENSIONS:
            derived = getattr(Warehouse, f"_{name}")(out)
            derived.write.mode("overwrite").parquet(f"{folder}/{name}")
            out.__dict__[name] = self.m.spark.read.schema(derived.schema).parquet(f"{folder}/{name}")
        return out

    def _dimension(self, name: str, derive) -> DataFrame:
        if self.catalogue is not None:
            return self.catalogue.table(self.load, name, derive)
        if self.folder is None:
            return derive()
        return self.m.spark.read.parquet(f"{self.folder}/{name}")

    # dimensions

    dates = cached_property(lambda self: self._dimension("dates", self._dates))
    geography = cached_property(lambda self: self._dimension("geography", self._geography))
    customers = cached_property(lambda self: self._dimension("customers", self._customers))
    products = cached_property(lambda self: self._dimension("products", self._products))
    sellers = cached_property(lambda self: self._dimension("sellers", self._sellers))
    payment_types = cached_property(
        lambda self: self._dimension("payment_types", self._payment_types))

    def _dates(self) -> DataFrame:
        """One row per day from the first to the last date of any fact."""
        days = self.m.orders.agg(
            F.least(*[F.min(c) for c in ORDER_DATES]).cast("date").alias("a"),
            F.greatest(*[F.max(c) for c in ORDER_DATES]).cast("date").alias("b"),
        ).unionByName(self.m.reviews.agg(
            F.min("review_creation_date").cast("date").alias("a"),
            F.max("review_creation_date").cast("date").alias("b"),
        ))
        span = days.agg(F.min("a").alias("a"), F.max("b").alias("b"))
        d = F.col("d")
        weekday = F.weekday(d) + 1
        return _with_unknown(span.select(F.explode(F.sequence("a", "b")).alias("d")).select(
            date_key(d).alias("DateKey"),
            d.alias("FullDate"),
            weekday.alias("DayNumberOfWeek"),
            F.date_format(d, "EEEE").alias("DayName"),
            F.dayofmonth(d).alias("DayNumberOfMonth"),
            F.dayofyear(d).alias("DayNumberOfYear"),
            F.weekofyear(d).alias("WeekNumberOfYear"),
            F.month(d).alias("MonthNumber"),
            F.date_format(d, "MMMM").alias("MonthName"),
            F.quarter(d).alias("CalendarQuarter"),
            F.year(d).alias("CalendarYear"),
            F.date_format(d, "yyyy-MM").alias("YearMonth"),
            (weekday >= 6).alias("IsWeekend"),
            F.current_timestamp().alias("CreatedAt"),
        ), "DateKey")

    def _geography(self) -> DataFrame:
        """Zip prefixes: first load with coordinates to one decimal, corrected later."""
        exact = silver.geolocation(self.m)
        rough = exact.withColumns({
            c: F.round(c, 1) for c in ("geolocation_lat", "geolocation_lng")
        })
        at = "timestamp_ntz"
        feed = rough.withColumn("at", F.lit(BEGINNING).cast(at)).unionByName(
            exact.withColumn("at", F.lit(CORRECTED_AT).cast(at))
        )
        versions = history(
            feed, ["geolocation_zip_code_prefix", "geolocation_city", "geolocation_state"],
            ["geolocation_lat", "geolocation_lng"], "at",
        )
        return _with_unknown(versions.select(
            hash_key("geolocation_zip_code_prefix", "geolocation_city", "geolocation_state", START)
            .alias("GeographyKey"),
            F.col("geolocation_zip_code_prefix").alias("ZipCodePrefix"),
            labels.city_name("geolocation_city").alias("City"),
            F.col("geolocation_state").alias("StateCode"),
            labels.state_name("geolocation_state").alias("StateName"),
            F.lit("BR").alias("CountryCode"),
            F.lit("Brazil").alias("CountryName"),
            F.col("geolocation_lat").cast("decimal(9,6)").alias("Latitude"),
            F.col("geolocation_lng").cast("decimal(9,6)").alias("Longitude"),
            START, END, CURRENT, *_audit(),
        ), "GeographyKey")

    def _placed(self, versions: DataFrame, zip_column: str, name: str) -> DataFrame:
        return as_of(versions, self.geography, {zip_column: "ZipCodePrefix"}, START,
                     {"GeographyKey": name})

    def _customers(self) -> DataFrame:
        versions = history(
            self.m.customer_changes, ["customer_id"], CUSTOMER_ATTRIBUTES, "changed_at"
        )
        placed = self._placed(versions, "customer_zip_code_prefix", "CustomerGeographyKey")
        return _with_unknown(placed.select(
            hash_key("customer_id", START).alias("CustomerKey"),
            F.col("customer_id").alias("CustomerId"),
            F.col("customer_unique_id").alias("CustomerUniqueId"),
            "CustomerGeographyKey",
            F.col("customer_city").alias("CustomerCity"),
            F.col("customer_state").alias("CustomerState"),
            F.col("customer_zip_code_prefix").alias("CustomerZipCodePrefix"),
            START, END, CURRENT, *_audit(),
        ), "CustomerKey")

    def _products(self) -> DataFrame:
        versions = history(
            self.m.product_changes, ["product_id"], PRODUCT_ATTRIBUTES, "changed_at"
        )
        english = silver.category_lookup(self.m).select(
            F.col("product_category_name").alias("_c"), "product_category_name_english"
        )
        named = versions.join(
            english, F.coalesce("product_category_name", F.lit("unknown")) == F.col("_c"), "left"
        )

        def amount(c):
            return F.col(c).cast("decimal(18,4)")

        return _with_unknown(named.select(
            hash_key("product_id", START).alias("ProductKey"),
            F.col("product_id").alias("ProductId"),
            F.col("product_category_name").alias("ProductCategoryName"),
            F.col("product_category_name_english").alias("ProductCategoryNameEnglish"),
            F.col("product_name_lenght").alias("ProductNameLength"),
            F.col("product_description_lenght").alias("ProductDescriptionLength"),
            F.col("product_photos_qty").alias("ProductPhotosQty"),
            amount("product_weight_g").alias("ProductWeightGrams"),
            amount("product_length_cm").alias("ProductLengthCm"),
            amount("product_height_cm").alias("ProductHeightCm"),
            amount("product_width_cm").alias("ProductWidthCm"),
            START, END, CURRENT, *_audit(),
        ), "ProductKey")

    def _sellers(self) -> DataFrame:
        versions = history(self.m.seller_changes, ["seller_id"], SELLER_ATTRIBUTES, "changed_at")
        placed = self._placed(versions, "seller_zip_code_prefix", "SellerGeographyKey")
        return _with_unknown(placed.select(
            hash_key("seller_id", START).alias("SellerKey"),
            F.col("seller_id").alias("SellerId"),
            "SellerGeographyKey",
            F.col("seller_city").alias("SellerCity"),
            F.col("seller_state").alias("SellerState"),
            F.col("seller_zip_code_prefix").alias("SellerZipCodePrefix"),
            START, END, CURRENT, *_audit(),
        ), "SellerKey")

    def _payment_types(self) -> DataFrame:
        """One row per code that occurs; labels are overwritten, not versioned."""
        details = {k: f"'{n}'" for k, (n, _, _) in ref.PAYMENT_TYPE_DETAILS.items()}
        groups = {k: f"'{g}'" for k, (_, g, _) in ref.PAYMENT_TYPE_DETAILS.items()}
        digital = {k: str(d).upper() if d is not None else "CAST(NULL AS BOOLEAN)"
                   for k, (_, _, d) in ref.PAYMENT_TYPE_DETAILS.items()}

        def lookup(values):
            arms = " ".join(f"WHEN '{k}' THEN {v}" for k, v in values.items())
            return F.expr(f"CASE PaymentTypeCode {arms} END")

        codes = self.m.payments.select(F.col("payment_type").alias("PaymentTypeCode")).distinct()
        return _with_unknown(dense_keys(codes, ["PaymentTypeCode"], "PaymentTypeKey", 1).select(
            F.col("PaymentTypeKey").cast("int").alias("PaymentTypeKey"),
            "PaymentTypeCode",
            lookup(details).alias("PaymentTypeName"),
            lookup(groups).alias("PaymentCategory"),
            lookup(digital).alias("IsDigitalPayment"),
        ), "PaymentTypeKey")

    # facts

    def _orders(self) -> DataFrame:
        """Orders with the customer version valid at purchase. The keys of the later dates, which are
        short, and the durations are taken before the joins, so that these need not carry the dates."""
        def days(end, start):
            return floor_days_between(end, start).cast("int")

        dated = self.orders.withColumns({
            "OrderApprovedDateKey": date_key("order_approved_at"),
            "CarrierDeliveredDateKey": date_key("order_delivered_carrier_date"),
            "CustomerDeliveredDateKey": date_key("order_delivered_customer_date"),
            "EstimatedDeliveryDateKey": date_key("order_estimated_delivery_date"),
            "DaysToCarrier": days("order_delivered_carrier_date", "order_purchase_timestamp"),
            "DaysToCustomer": days("order_delivered_customer_date", "order_purchase_timestamp"),
            "EstimatedDeliveryDays": days(
                "order_estimated_delivery_date", "order_purchase_timestamp"),
            "DeliveryDelayDays": days(
                "order_delivered_customer_date", "order_estimated_delivery_date"),
            "IsDelivered": F.col("order_delivered_customer_date").isNotNull(),
            "IsLateDelivery": F.col("order_delivered_customer_date")
            > F.col("order_estimated_delivery_date"),
        })
        return as_of(
            dated, self.customers, {"customer_id": "CustomerId"},
            "order_purchase_timestamp",
            {"CustomerKey": "CustomerKey", "CustomerZipCodePrefix": "_zip"},
        )

    def fact_sales(self) -> DataFrame:
        """One row per order item; items of an unknown order point to the unknown members."""
        orders = self._orders().select(
            "order_id", "CustomerKey", "order_status", "order_purchase_timestamp",
            "OrderApprovedDateKey",
        )
        rows = self.m.items.join(orders, "order_id", "left")
        rows = as_of(rows, self.products, {"product_id": "ProductId"},
                     "order_purchase_timestamp", {"ProductKey": "ProductKey"})
        rows = as_of(rows, self.sellers, {"seller_id": "SellerId"},
                     "order_purchase_timestamp", {"SellerKey": "SellerKey"})
        price, freight = F.col("price").cast("decimal(18,2)"), F.col("freight_value")
        quantity = F.lit(1)
        return rows.select(
            wide_key("order_id", "order_item_id").alias("SalesKey"),
            F.col("order_id").alias("OrderId"),
            F.col("order_item_id").alias("OrderItemId"),
            _known("CustomerKey"), _known("ProductKey"), _known("SellerKey"),
            _known(date_key("order_purchase_timestamp")).alias("OrderPurchaseDateKey"),
            "OrderApprovedDateKey",
            F.coalesce("order_status", F.lit("unknown")).alias("OrderStatus"),
            quantity.alias("Quantity"),
            price.alias("ItemPriceAmount"),
            freight.cast("decimal(18,2)").alias("FreightAmount"),
            (price * quantity).cast("decimal(18,2)").alias("GrossSalesAmount"),
            (price * quantity + freight).cast("decimal(18,2)").alias("TotalItemAmount"),
            *_stamps(),
        )

    def fact_payments(self) -> DataFrame:
        """One row per payment; payments of an unknown order point to the unknown customer."""
        orders = self._orders().select("order_id", "CustomerKey", "order_purchase_timestamp")
        kinds = self.payment_types.select("PaymentTypeKey", "PaymentTypeCode")
        return (
            self.m.payments.join(orders, "order_id", "left")
            .join(kinds, F.col("payment_type") == F.col("PaymentTypeCode"), "left")
            .select(
                wide_key("order_id", "payment_sequential").alias("PaymentKey"),
                F.col("order_id").alias("OrderId"),
                F.col("payment_sequential").alias("PaymentSequence"),
                _known("CustomerKey"),
                _known("PaymentTypeKey"),
                _known(date_key("order_purchase_timestamp")).alias("OrderPurchaseDateKey"),
                F.col("payment_installments").alias("PaymentInstallments"),
                F.col("payment_value").cast("decimal(18,2)").alias("PaymentValueAmount"),
                *_stamps(),
            )
        )

    def fact_delivery(self) -> DataFrame:
        """One row per order."""
        rows = as_of(self._orders(), self.geography, {"_zip": "ZipCodePrefix"},
                     "order_purchase_timestamp", {"GeographyKey": "CustomerGeographyKey"})
        return rows.select(
            wide_key("order_id").alias("DeliveryKey"),
            F.col("order_id").alias("OrderId"),
            _known("CustomerKey"),
            "CustomerGeographyKey",
            _known(date_key("order_purchase_timestamp")).alias("OrderPurchaseDateKey"),
            "OrderApprovedDateKey", "CarrierDeliveredDateKey", "CustomerDeliveredDateKey",
            "EstimatedDeliveryDateKey",
            F.col("order_status").alias("OrderStatus"),
            "DaysToCarrier", "DaysToCustomer", "EstimatedDeliveryDays", "DeliveryDelayDays",
            "IsDelivered", "IsLateDelivery",
            *_stamps(),
        )

    def fact_reviews(self) -> DataFrame:
        """Latest review per order with sentiment, lag and the late flag."""
        customers = self._orders().select("order_id", "CustomerKey")
        return silver.order_reviews(self.m).join(customers, "order_id", "left").select(
            wide_key("review_id").alias("ReviewKey"),
            F.col("review_id").alias("ReviewId"),
            F.col("order_id").alias("OrderId"),
            _known("CustomerKey"),
            date_key("review_creation_date").alias("ReviewDateKey"),
            F.col("review_score").alias("ReviewScore"),
            F.col("review_sentiment").alias("ReviewSentiment"),
            F.col("hours_to_review").alias("HoursToReview"),
            F.col("is_late").alias("IsLateDelivery"),
        )

    def key_tests(self) -> DataFrame:
        """Unique and present keys of each dimension and fact, and foreign keys that resolve."""
        customer = ReferenceRule("CustomerKey", self.customers.select("CustomerKey"))
        places, days = self.geography.select("GeographyKey"), self.dates.select("DateKey")
        day = ReferenceRule("OrderPurchaseDateKey", days)
        # dates that an order may not have reached, and places that may not be known
        def later(*columns):
            return [ReferenceRule(c, days, allow_nulls=True) for c in columns]

        plans = [
            ("DimDate", self.dates, ["DateKey"], []),
            ("DimGeography", self.geography, ["GeographyKey"], []),
            ("DimCustomer", self.customers, ["CustomerKey"], [
                ReferenceRule("CustomerGeographyKey", places, allow_nulls=True)]),
            ("DimProduct", self.products, ["ProductKey"], []),
            ("DimSeller", self.sellers, ["SellerKey"], [
                ReferenceRule("SellerGeographyKey", places, allow_nulls=True)]),
            ("DimPaymentType", self.payment_types, ["PaymentTypeKey"], []),
            ("FactSales", self.fact_sales(), ["SalesKey"], [
                customer, day, *later("OrderApprovedDateKey"),
                ReferenceRule("ProductKey", self.products.select("ProductKey")),
                ReferenceRule("SellerKey", self.sellers.select("SellerKey")),
            ]),
            ("FactPayments", self.fact_payments(), ["PaymentKey"], [
                customer, day,
                ReferenceRule("PaymentTypeKey", self.payment_types.select("PaymentTypeKey")),
            ]),
            ("FactDelivery", self.fact_delivery(), ["DeliveryKey"], [
                customer, day,
                ReferenceRule("CustomerGeographyKey", places, allow_nulls=True),
                *later("OrderApprovedDateKey", "CarrierDeliveredDateKey",
                       "CustomerDeliveredDateKey", "EstimatedDeliveryDateKey"),
            ]),
            ("FactReviews", self.fact_reviews(), ["ReviewKey"], [
                customer, ReferenceRule("ReviewDateKey", days)]),
        ]
        reports = []
        for table, rows, key, references in plans:
            checks = [NullCheck(key), DuplicateCheck(key, full_row=False)]
            if references:
                checks.append(ReferenceCheck(references))
            reports.append((table, rows, checks))
        return run_reports(reports)
