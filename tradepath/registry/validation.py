"""Data checks."""

from pyspark.sql import functions as F

from tradepath.functions import reference_data as ref
from tradepath.operators import quality as q
from tradepath.plans.rules import run_standard_rules
from tradepath.registry import register
from tradepath.sources.workspace import fresh_path


def report(results, *extra):
    """Result rows with the failures as sorted text."""
    parts = F.transform(F.map_entries("failures"),
                        lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    text = F.coalesce(F.array_join(F.array_sort(parts), ";"), F.lit(""))
    return results.select(*extra, "validation_name", "status", "rows_checked", "rows_failed",
                          "error_count", text.alias("failures"))


def result_sql(name, view, failed, counts, errors=None):
    """One expected result row: `failed` is a predicate, `counts` maps a rule to a predicate."""
    n = {k: f"count(*) FILTER (WHERE {p})" for k, p in sorted(counts.items())}
    text = " || ".join(
        f"CASE WHEN {c} > 0 THEN ';{k}=' || {c} ELSE '' END" for k, c in n.items()) or "''"
    error_count = errors if errors is not None else " + ".join(
        f"CAST({c} > 0 AS BIGINT)" for c in n.values())
    return f"""SELECT '{name}' AS validation_name,
      CASE WHEN {error_count} = 0 THEN 'passed' ELSE 'failed' END AS status,
      count(*) AS rows_checked, count(*) FILTER (WHERE {failed}) AS rows_failed,
      CAST({error_count} AS BIGINT) AS error_count, ltrim({text}, ';') AS failures FROM {view}"""


@register("v01_schema_check", """
    SELECT 'schema_validation' AS validation_name, 'failed' AS status, count(*) AS rows_checked,
      CASE WHEN bad = 'columns' THEN count(*) ELSE 0 END AS rows_failed,
      CAST(CASE WHEN bad = 'columns' THEN 1 ELSE 7 END AS BIGINT) AS error_count, '' AS failures
    FROM m_orders, (VALUES ('columns'), ('types')) AS c(bad) GROUP BY bad""")
def _(m):
    missing = q.SchemaCheck(["order_id", "no_such_column"])
    wrong = q.SchemaCheck(["order_id"], {"order_id": "string"}, allow_extra=False)
    # one wrong type; six of the seven other columns are extra, one is typed and right
    typed = q.SchemaCheck(["order_id"], {**wrong.types, "order_status": "string"}, False)
    return report(q.run_checks(m.orders, [missing, typed]))


_DATES = ["order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date"]


@register("v02_null_check", result_sql(
    "null_validation", "m_orders", " OR ".join(f"{c} IS NULL" for c in _DATES),
    {c: f"{c} IS NULL" for c in _DATES}))
def _(m):
    return report(q.run_checks(m.orders, [q.NullCheck(_DATES)]))


@register("v02_null_check_threshold", f"""
    SELECT 'null_validation' AS validation_name, 'failed' AS status, count(*) AS rows_checked,
      count(*) FILTER (WHERE {' OR '.join(f'{c} IS NULL' for c in _DATES[1:])}) AS rows_failed,
      CAST(2 AS BIGINT) AS error_count, '{_DATES[1]}=' || (count(*) - count({_DATES[1]}))
      || ';{_DATES[2]}=' || (count(*) - count({_DATES[2]})) AS failures FROM m_orders""")
def _(m):
    return report(q.run_checks(m.orders, [q.NullCheck(_DATES, threshold_percent=5.0)]))


def duplicate_sql(view, columns, label):
    """The expected row of a duplicate check over some columns."""
    return f"""
      SELECT 'duplicate_validation' AS validation_name,
        CASE WHEN d = 0 THEN 'passed' ELSE 'failed' END AS status, n AS rows_checked,
        d AS rows_failed, CAST(d > 0 AS BIGINT) AS error_count,
        CASE WHEN d = 0 THEN '' ELSE '{label}=' || d END AS failures
      FROM (SELECT CAST(sum(k) AS BIGINT) AS n,
              CAST(coalesce(sum(k) FILTER (WHERE k > 1), 0) AS BIGINT) AS d
            FROM (SELECT count(*) AS k FROM {view} GROUP BY {columns}))"""


@register("v03_full_row_duplicates", duplicate_sql(
    "m_geo", """geolocation_zip_code_prefix, geolocation_lat, geolocation_lng, geolocation_city,
    geolocation_state""", "full_row"))
def _(m):
    return report(q.run_checks(m.geolocation, [q.DuplicateCheck()]))


@register("v04_key_duplicates", duplicate_sql("m_items", "order_id, order_item_id", "key"))
def _(m):
    check = q.DuplicateCheck(["order_id", "order_item_id"], full_row=False)
    return report(q.run_checks(m.items, [check]))


@register("v05_range_check", result_sql(
    "range_validation", "m_items", "price <= 0 OR price > 100000 OR freight_value > 5000",
    {"price": "price <= 0 OR price > 100000", "freight_value": "freight_value > 5000"}))
def _(m):
    return report(q.run_checks(m.items, [q.RangeCheck([
        q.RangeRule("price", 0, 100000, inclusive_min=False),
        q.RangeRule("freight_value", maximum=5000),
    ])]))


_DELIVERED = "coalesce(order_delivered_customer_date >= order_purchase_timestamp, FALSE)"
_SHIPPED = "coalesce(order_delivered_carrier_date >= order_approved_at, FALSE)"


@register("v06_business_rules", result_sql(
    "business_rule_validation", "m_orders", f"NOT {_DELIVERED} OR NOT {_SHIPPED}",
    {"delivered_after_purchase": f"NOT {_DELIVERED}", "shipped_after_approval": f"NOT {_SHIPPED}"}))
def _(m):
    return report(q.run_checks(m.orders, [q.RuleCheck([
        q.Rule("delivered_after_purchase", ["order_delivered_customer_date"],
               lambda: F.col("order_delivered_customer_date") >= F.col("order_purchase_timestamp")),
        q.Rule("shipped_after_approval", ["order_delivered_carrier_date", "order_approved_at"],
               lambda: F.col("order_delivered_carrier_date") >= F.col("order_approved_at")),
    ])]))


_IN = "product_id IN (SELECT p_partkey FROM part WHERE p_partkey % 19 <> 0)"
_SIN = "seller_id IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 17 <> 0)"


@register("v07_referential_check", result_sql(
    "referential_integrity_validation", "m_items", f"NOT {_IN} OR NOT {_SIN}",
    {"products": f"NOT {_IN}", "sellers": f"NOT {_SIN}"}))
def _(m):
    return report(q.run_checks(m.items, [q.ReferenceCheck([
        q.ReferenceRule("product_id", m.products.where("product_id % 19 <> 0")
                        .select("product_id"), name="products"),
        q.ReferenceRule("seller_id", m.sellers.where("seller_id % 17 <> 0")
                        .select("seller_id"), name="sellers"),
    ])]))


@register("v08_accepted_values", result_sql(
    "accepted_order_status", "m_orders", "order_status NOT IN ('delivered', 'shipped')",
    {"order_status": "order_status NOT IN ('delivered', 'shipped')"}) + " UNION ALL " + result_sql(
    "accepted_payment_type", "m_payments", "FALSE", {"payment_type": "FALSE"}))
def _(m):
    status = q.ReferenceCheck([q.ReferenceRule("order_status", ["delivered", "shipped"])],
                              name="accepted_order_status")
    kind = q.ReferenceCheck([q.ReferenceRule("payment_type", ref.PAYMENT_TYPES)],
                            name="accepted_payment_type")
    return report(q.run_checks(m.orders, [status]).unionByName(q.run_checks(m.payments, [kind])))


_PACK = [
    ("customers", "duplicate_validation", "m_customers", "FALSE"),
    ("customers", "null_validation", "m_customers", "customer_id IS NULL"),
    ("orders", "duplicate_validation", "m_orders", "FALSE"),
    ("orders", "null_validation", "m_orders", "order_id IS NULL"),
    ("orders", "accepted_order_status", "m_orders", "FALSE"),
    ("orders", "business_rule_validation", "m_orders",
     "order_delivered_customer_date < order_purchase_timestamp"),
    ("order_payments_aggregated", "duplicate_validation", "m_order_payments", "FALSE"),
    ("order_payments", "accepted_payment_type", "m_payments", "FALSE"),
    ("order_items", "range_validation", "m_items", "price <= 0"),
    ("order_items", "referential_integrity_validation", "m_items",
     "product_id NOT IN (SELECT p_partkey FROM part)"),
    ("geolocation_silver", "duplicate_validation",
     """(SELECT DISTINCT geolocation_zip_code_prefix FROM m_geo WHERE geolocation_lat
        BETWEEN -34 AND 5 AND geolocation_lng BETWEEN -74 AND -28)""", "FALSE"),
    ("products", "translated_category", "m_products", "FALSE"),
    ("order_reviews", "range_validation", "m_reviews", "review_score NOT BETWEEN 1 AND 5"),
]


@register("v09_standard_rules", " UNION ALL ".join(f"""
    SELECT '{t}' AS table_name, '{c}' AS validation_name,
      CASE WHEN count(*) FILTER (WHERE {p}) = 0 THEN 'passed' ELSE 'failed' END AS status,
      count(*) AS rows_checked, count(*) FILTER (WHERE {p}) AS rows_failed FROM {v}"""
    for t, c, v, p in _PACK))
def _(m):
    return run_standard_rules(m).select(
        "table_name", "validation_name", "status", "rows_checked", "rows_failed")


def engine_checks():
    crash = q.Rule("unreadable", [], lambda: F.col("no_such_column") > 0)
    return [
        q.SchemaCheck(["order_id", "price"]),
        q.NullCheck(["order_id", "product_id"]),
        q.DuplicateCheck(["order_id", "order_item_id"], full_row=False),
        q.RangeCheck([q.RangeRule("price", 0, inclusive_min=False)]),
        q.RuleCheck([crash], name="broken_rule"),
    ]


_ENGINE = """
    WITH n AS (SELECT count(*) AS n, count(*) FILTER (WHERE price <= 0) AS free,
      (SELECT CAST(sum(k) FILTER (WHERE k > 1) AS BIGINT) FROM (
         SELECT count(*) AS k FROM m_items GROUP BY order_id, order_item_id)) AS dup FROM m_items)
    SELECT 'schema_validation' AS validation_name, 'passed' AS status, n AS rows_checked,
      CAST(0 AS BIGINT) AS rows_failed, CAST(0 AS BIGINT) AS error_count, 'error' AS severity FROM n
    UNION ALL SELECT 'null_validation', 'passed', n, 0, 0, 'error' FROM n
    UNION ALL SELECT 'duplicate_validation', 'failed', n, dup, 1, 'error' FROM n
    UNION ALL SELECT 'range_validation', 'failed', n, free, 1, 'error' FROM n
    UNION ALL SELECT 'broken_rule', 'failed', n, n, 1, 'critical' FROM n"""


@register("v10_engine_run", _ENGINE)
def _(m):
    return q.run_checks(m.items, engine_checks()).select(
        "validation_name", "status", "rows_checked", "rows_failed", "error_count", "severity")


@register("v11_quality_score", f"""
    WITH r AS ({_ENGINE})
    SELECT count(*) AS total_checks, count(*) FILTER (WHERE status = 'passed') AS passed_checks,
      count(*) FILTER (WHERE status = 'failed') AS failed_checks, CAST(0 AS BIGINT) AS warnings,
      round_even(100.0 * count(*) FILTER (WHERE status = 'passed') / count(*), 2)
        AS overall_quality_score FROM r""")
def _(m):
    return q.quality_score(q.run_checks(m.items, engine_checks()))


@register("v12_report", f"""
    SELECT *, status AS status_group, 'first' AS run_id, TRUE AS timed FROM ({_ENGINE})""")
def _(m):
    path = fresh_path(m.spark, "quality")
    return q.write_report(m.items, engine_checks(), path, "first").select(
        "validation_name", "status", "rows_checked", "rows_failed", "error_count", "severity",
        "status_group", "run_id", (F.col("execution_time_seconds") > 0).alias("timed"))


@register("v10_failing_rule", """
    WITH n AS (SELECT count(*) AS n FROM m_items)
    SELECT 'null_validation' AS validation_name, 'passed' AS status, n AS rows_checked,
      CAST(0 AS BIGINT) AS rows_failed, 'error' AS severity FROM n
    UNION ALL SELECT 'division', 'failed', n, n, 'critical' FROM n""")
def _(m):
    """A rule that divides by zero on some rows; the other check reports as it always does."""
    rule = q.Rule("ratio", ["price"], lambda: F.lit(1) / (F.col("order_id") % 2) > 0)
    checks = [q.NullCheck(["order_id"]), q.RuleCheck([rule], name="division")]
    return q.run_checks(m.items, checks).select(
        "validation_name", "status", "rows_checked", "rows_failed", "severity")


@register("v13_row_flags", """
    WITH k AS (SELECT order_id, order_item_id FROM m_items GROUP BY 1, 2 HAVING count(*) > 1)
    SELECT i.order_id, i.order_item_id, i.product_id,
      ltrim(CASE WHEN k.order_id IS NOT NULL THEN ',duplicate_validation' ELSE '' END
        || CASE WHEN price <= 0 THEN ',range_validation' ELSE '' END
        || CASE WHEN product_id % 19 = 0 THEN ',referential_integrity_validation' ELSE '' END, ',')
        AS failed_checks
    FROM m_items i LEFT JOIN k ON k.order_id = i.order_id AND k.order_item_id = i.order_item_id""")
def _(m):
    known = m.products.where("product_id % 19 <> 0").select("product_id")
    checks = [*engine_checks()[:4], q.ReferenceCheck([q.ReferenceRule("product_id", known)])]
    return q.flag_rows(m.items, checks).select(
        "order_id", "order_item_id", "product_id",
        F.array_join("_failed_checks", ",").alias("failed_checks"))
