"""The standard rules per table, run as one report."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradepath.adapters import Marketplace
from tradepath.functions import reference_data as ref
from tradepath.operators.quality import (
    DuplicateCheck, NullCheck, RangeCheck, RangeRule, ReferenceCheck, ReferenceRule, Rule,
    RuleCheck, run_reports,
)
from tradepath.plans import silver


def standard_rules(m: Marketplace) -> list[tuple[str, DataFrame, list]]:
    """(table, rows, checks) for the eleven standard rules."""
    items = m.items
    lookup = silver.category_lookup(m).select("product_category_name")
    categories = m.products.withColumn(
        "product_category_name", F.coalesce("product_category_name", F.lit("unknown"))
    )
    after = Rule(
        "delivered_after_purchase",
        ["order_delivered_customer_date", "order_purchase_timestamp"],
        lambda: F.col("order_delivered_customer_date").isNull()
        | (F.col("order_delivered_customer_date") >= F.col("order_purchase_timestamp")),
    )
    return [
        ("customers", m.customers, [
            DuplicateCheck(["customer_id"], full_row=False, severity="critical"),
            NullCheck(["customer_id"], severity="critical"),
        ]),
        ("orders", m.orders, [
            DuplicateCheck(["order_id"], full_row=False, severity="critical"),
            NullCheck(["order_id"], severity="critical"),
            ReferenceCheck([ReferenceRule("order_status", ref.ORDER_STATUSES)],
                           severity="critical", name="accepted_order_status"),
            RuleCheck([after], severity="warning"),
        ]),
        ("order_payments_aggregated", silver.order_payments(m), [
            DuplicateCheck(["order_id"], full_row=False, severity="critical"),
        ]),
        ("order_payments", m.payments, [
            ReferenceCheck([ReferenceRule("payment_type", ref.PAYMENT_TYPES)],
                           name="accepted_payment_type"),
        ]),
        ("order_items", items, [
            RangeCheck([RangeRule("price", minimum=0, inclusive_min=False)]),
            ReferenceCheck([ReferenceRule("product_id", m.products.select("product_id"))]),
        ]),
        ("geolocation_silver", silver.geolocation(m), [
            DuplicateCheck(["geolocation_zip_code_prefix"], full_row=False, severity="critical"),
        ]),
        ("products", categories, [
            ReferenceCheck([ReferenceRule("product_category_name", lookup)],
                           name="translated_category"),
        ]),
        ("order_reviews", m.reviews, [RangeCheck([RangeRule("review_score", 1, 5)])]),
    ]


def run_standard_rules(m: Marketplace) -> DataFrame:
    """One row per table and check, from one action."""
    return run_reports(standard_rules(m))
