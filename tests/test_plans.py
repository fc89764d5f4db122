"""Shape of the physical plans."""

import re
import statistics
from collections import Counter

from pyspark.sql import functions as F

from tradepath.adapters import Marketplace
from tradepath.operators import profile, skew
from tradepath.operators.quantiles import between_quantiles
from tradepath.plans import kpis, stages
from tradepath.registry import load
from tradepath.session import tune

QUERIES, _ = load()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_read_what_is_needed(spark, sf):
    plan = plan_of(QUERIES["a29_gmv"](spark, sf))
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,o_orderpriority:string>" in plan
    plan = plan_of(QUERIES["l01_sort"](spark, sf))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan


def test_filters_reach_the_files(spark, market):
    late = market.raw("lineitem").where(F.col("l_shipdate") > F.lit("2000-01-01").cast("timestamp_ntz"))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThan(l_shipdate" in plan_of(late)


def test_histogram_exchange_is_shared(spark, sf):
    df = QUERIES["a52_price_by_category"](spark, sf)
    df.collect()
    assert "ReusedExchange" in plan_of(df)


def test_wide_tables_meet_on_one_partitioning(spark, sf):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = stages.joined(Marketplace(spark, sf), ())
        plan = plan_of(df)
        # orders and the three counts are each shuffled once
        assert plan.count("Exchange hashpartitioning(order_id") == 4
        assert plan.count("SortMergeJoin") == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def hot_market(spark, sf):
    """One order holds a third of all items."""
    hot = Marketplace(tune(spark), sf)
    moved = F.when(F.col("product_id") % 3 == 0, F.lit(1).cast("long")).otherwise(F.col("order_id"))
    hot.__dict__["items"] = hot.items.withColumn("order_id", moved).repartition(8)
    return hot


def test_a_hot_order_is_split(spark):
    """Adaptive execution splits the partition of the hot order in the joined rows."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1000",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        hot = hot_market(spark, "/root/testdata/sf0.01")
        df = stages.joined(hot, ["items", "payments"]).agg(
            F.count(F.lit(1)).alias("n"), F.count("product_id").alias("items"),
            kpis.total("payment_value").alias("paid"))
        got = df.collect()[0]
        assert "skew=true" in plan_of(df)
        orders = stages.clean_orders(hot).select("order_id")
        plain = orders.join(hot.items, "order_id", "left").join(hot.payments, "order_id", "left")
        want = plain.agg(F.count(F.lit(1)), F.count("product_id")).first()
        assert (got["n"], got["items"]) == tuple(want)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stored(spark, sf, path):
    """A marketplace whose order tables are files of their own."""
    out = Marketplace(tune(spark), sf)
    for name in ("orders", "items", "payments", "reviews"):
        getattr(out, name).write.mode("overwrite").parquet(f"{path}/{name}")
        out.__dict__[name] = spark.read.parquet(f"{path}/{name}")
    return out


def scans(df, path):
    """How often the plan reads each table below a path."""
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", 1000)
    try:
        found = re.findall(rf"FileScan [^\n]*{re.escape(str(path))}/(\w+)", plan_of(df))
    finally:
        df.sparkSession.conf.unset("spark.sql.maxMetadataStringLength")
    return Counter(found)


def test_joined_rows_read_each_table_once(spark, sf, tmp_path):
    m = stored(spark, sf, tmp_path)
    once = {"orders": 1, "items": 1, "payments": 1, "reviews": 1}
    assert scans(stages.joined(m), tmp_path) == once
    assert scans(profile.correlation_matrix(stages.joined(m), ["price", "payment_value"]),
                 tmp_path) == once
    assert set(scans(stages.joined(m, ["items"]), tmp_path).values()) == {1}


def test_salts_change_no_row(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b2"), (3, "c"), (None, "n")], "k long, x string")
    right = spark.createDataFrame(
        [(2, i % 7) for i in range(200)] + [(1, 5), (9, 9), (None, 1)], "k long, y int")
    plain = sorted(map(repr, left.join(right, "k", "left").collect()))
    for hot in ([(2, 5)], [(2, 3), (1, 40)]):
        dealt = skew.left_join(left, right, "k", hot)
        assert dealt.columns == ["k", "x", "y"]
        assert sorted(map(repr, dealt.collect())) == plain


def test_hot_keys_are_found_by_the_settings_of_spark(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), "id")
    old = spark.conf.get("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")
    try:
        assert skew.hot_keys(df, "k") == []
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "100k")
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.1")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
        [(key, salts)] = skew.hot_keys(df, "k")
        assert key == 7 and salts == -(-10_000 * 32 // 65536)
        assert skew.hot_keys(df.limit(0), "k") == []
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", old)
        spark.conf.unset("spark.sql.adaptive.skewJoin.skewedPartitionFactor")
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_trimmed_moments_read_the_payments_once(spark, sf, tmp_path):
    m = stored(spark, sf, tmp_path)
    df = between_quantiles(stages.delivered(m, ["payments"]), "payment_value", copies="copies")
    assert "Subquery" not in plan_of(df)
    rows = [float(r[0]) for r in stages.delivered(m, ["payments"]).where("payment_value IS NOT NULL")
            .selectExpr("explode(array_repeat(payment_value, CAST(copies AS INT)))").collect()]
    low, high = statistics.quantiles(rows, n=4, method="inclusive")[::2]
    inner = [x for x in rows if low < x < high]
    got = df.first()
    assert got["inner_count"] == len(inner)
    assert abs(got["inner_mean"] - statistics.mean(inner)) < 1e-6
    assert abs(got["inner_std"] - statistics.stdev(inner)) < 1e-6
    df.collect()
    assert max(scans(df, tmp_path).values()) == 1 or "ReusedExchange" in plan_of(df)
