"""Declared shape of each source table: schema, required columns, key and topic."""

from dataclasses import dataclass, field

from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructType

_TYPES = {"string": StringType, "int": IntegerType, "long": LongType, "double": DoubleType}


def struct(ddl: str) -> StructType:
    """A flat schema from "name type, ..." text; needs no running session."""
    out = StructType()
    for column in ddl.split(","):
        name, kind = column.split()
        out = out.add(name, _TYPES[kind]())
    return out


# The column names and types of the nine source tables.
_SCHEMAS = {
    "orders": """order_id string, customer_id string, order_status string,
        order_purchase_timestamp string, order_approved_at string,
        order_delivered_carrier_date string, order_delivered_customer_date string,
        order_estimated_delivery_date string""",
    "customers": """customer_id string, customer_unique_id string,
        customer_zip_code_prefix string, customer_city string, customer_state string""",
    "products": """product_id string, product_category_name string, product_name_lenght int,
        product_description_lenght int, product_photos_qty int, product_weight_g int,
        product_length_cm int, product_height_cm int, product_width_cm int""",
    "sellers": """seller_id string, seller_zip_code_prefix string, seller_city string,
        seller_state string""",
    "order_items": """order_id string, order_item_id int, product_id string, seller_id string,
        shipping_limit_date string, price double, freight_value double""",
    "order_payments": """order_id string, payment_sequential int, payment_type string,
        payment_installments int, payment_value double""",
    "order_reviews": """review_id string, order_id string, review_score string,
        review_comment_title string, review_comment_message string,
        review_creation_date string, review_answer_timestamp string""",
    "geolocation": """geolocation_zip_code_prefix string, geolocation_lat double,
        geolocation_lng double, geolocation_city string, geolocation_state string""",
    "category_translation": """product_category_name string,
        product_category_name_english string""",
}


@dataclass(frozen=True)
class TableContract:
    """What a table must look like before it is published."""

    name: str
    ddl: str
    required: tuple[str, ...]
    not_null: tuple[str, ...]
    key: str
    topic: str = field(default="")

    @property
    def schema(self) -> StructType:
        return struct(self.ddl)


def _contract(name, required, not_null, key):
    ddl = _SCHEMAS[name]
    columns = tuple(f.strip().split()[0] for f in ddl.split(","))
    return TableContract(name, ddl, tuple(required) or columns, tuple(not_null), key, name)


# Required columns, non-null columns and key of each table. An empty
# required list means every column of the schema.
CONTRACTS = {
    c.name: c
    for c in [
        _contract(
            "orders", [],
            ["order_id", "customer_id", "order_status", "order_purchase_timestamp"],
            "order_id",
        ),
        _contract(
            "customers",
            ["customer_id", "customer_unique_id", "customer_zip_code_prefix"],
            ["customer_id", "customer_unique_id"],
            "customer_id",
        ),
        _contract(
            "order_items",
            ["order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"],
            ["order_id", "product_id", "seller_id"],
            "order_id",
        ),
        _contract("order_payments", [], ["order_id", "payment_type"], "order_id"),
        _contract(
            "products", ["product_id", "product_category_name"], ["product_id"], "product_id"
        ),
        _contract(
            "order_reviews",
            ["review_id", "order_id", "review_score"],
            ["review_id", "order_id"],
            "order_id",
        ),
        _contract("sellers", [], ["seller_id"], "seller_id"),
        _contract(
            "geolocation", [], ["geolocation_zip_code_prefix"], "geolocation_zip_code_prefix"
        ),
        _contract(
            "category_translation", [], ["product_category_name"], "product_category_name"
        ),
    ]
}

# Columns that identify a row of each table.
PRIMARY_KEYS = {
    "customers": ["customer_id"],
    "orders": ["order_id"],
    "order_items": ["order_id", "order_item_id"],
    "order_payments": ["order_id", "payment_sequential"],
    "order_reviews": ["review_id"],
    "products": ["product_id"],
    "sellers": ["seller_id"],
    "category_translation": ["product_category_name"],
}
