"""Rules whose exact reading changes answers."""

import os
import random
import subprocess
import sys

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tradepath.contracts import CONTRACTS
from tradepath.functions import labels, temporal
from tradepath.operators import cleaning, profile, scd, terms
from tradepath.plans import kpis, silver, stages
from tradepath.registry.warehouse import _member
from tradepath.sources import bronze, csv, kafka, workspace


def one(spark, **columns):
    values = ", ".join(f"{v} AS {k}" for k, v in columns.items())
    return spark.sql(f"SELECT {values}")


def test_floor_days_round_down(spark):
    df = one(spark, a="timestamp_ntz'2020-01-01 00:00:00'", b="timestamp_ntz'2020-01-01 00:00:01'",
             c="timestamp_ntz'2020-01-02 00:00:00'")
    row = df.select(
        temporal.floor_days_between("a", "b").alias("early"),
        temporal.floor_days_between("c", "a").alias("full"),
        temporal.floor_days_between("c", "b").alias("short"),
        temporal.seconds_between("a", "b").alias("s"),
    ).first()
    assert (row["early"], row["full"], row["short"], row["s"]) == (-1, 1, 0, -1.0)


def test_durations_ignore_the_session_zone(spark):
    df = one(spark, a="timestamp_ntz'2020-03-29 04:00:00'", b="timestamp_ntz'2020-03-29 00:00:00'")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")  # clocks change that night
        assert df.select(temporal.hours_between("a", "b")).first()[0] == 4.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_two_readings_of_late(spark):
    df = one(spark, d="timestamp_ntz'2020-01-01 05:00:00'", e="timestamp_ntz'2020-01-01 00:00:00'")
    row = df.select(
        labels.is_late_by_timestamp("d", "e").alias("by_time"),
        labels.is_late_by_days(temporal.floor_days_between("d", "e")).alias("by_days"),
        labels.delivery_status(temporal.floor_days_between("d", "e")).alias("status"),
    ).first()
    assert (row["by_time"], row["by_days"], row["status"]) == (True, False, "on_time")


def test_missing_values_compare_false(spark):
    df = one(spark, s="CAST(NULL AS INT)", d="CAST(NULL AS TIMESTAMP_NTZ)",
             e="timestamp_ntz'2020-01-01'", z="0", p="5")
    row = df.select(
        labels.is_bad_score("s").alias("bad"), labels.is_late_by_timestamp("d", "e").alias("late"),
        labels.sentiment("s").alias("mood"), labels.delivery_status("s").alias("status"),
        labels.ratio("p", "z").alias("ratio"),
    ).first()
    assert list(row) == [False, False, None, "missing", None]


def test_half_even_rounding(spark):
    rows = [(0.5,), (1.5,), (2.5,)]
    df = spark.createDataFrame(rows, "x double")
    assert [r[0] for r in df.select(F.bround("x", 0)).collect()] == [0.0, 2.0, 2.0]


def test_groups_drop_null_keys_and_ties_go_by_label(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), (None, 9), ("c", 0)], "k string, n long")
    counts = profile.value_counts(df, ["k"], "share")
    assert {r["k"] for r in counts.collect()} == {"a", "b", "c"}
    top = kpis.top_and_bottom(df.where("k is not null"), "n", "k", 1).collect()
    assert [(r["k"], r["side"]) for r in top] == [("a", "top"), ("c", "bottom")]


def test_text_helpers(spark):
    df = one(spark, city="' são josé dos campos '", cat="'bed_bath_table'", blank="'  '")
    row = df.select(labels.city_name("city"), labels.category_display("cat"),
                    labels.clean_text("blank")).first()
    assert list(row) == ["Sao Jose Dos Campos", "Bed Bath Table", None]


def test_haversine(spark):
    df = one(spark, a="0D", b="0D", c="0D", d="180D")
    assert abs(df.select(labels.haversine_km("a", "b", "c", "d")).first()[0] - 20015.0868) < 1e-3


def test_fills(spark):
    df = spark.createDataFrame(
        [("x", 1.0), ("x", None), ("x", 4.0), ("y", None), ("z", 10.0)], "g string, v double")
    grouped = cleaning.fill_with_group_median(df, ["v"], "g")
    assert sorted(r["v"] for r in grouped.where("g = 'x'").collect()) == [1.0, 2.5, 4.0]
    assert grouped.where("g = 'y'").first()["v"] is None
    assert cleaning.fill_with_medians(df, ["v"]).where("g = 'y'").first()["v"] == 4.0


def test_latest_and_first_per_key(spark):
    df = spark.createDataFrame(
        [(1, 5, "b"), (1, 7, "a"), (1, 7, None), (2, None, "n")], "k long, t long, x string")
    best = {r["k"]: r for r in cleaning.latest_per_key(df, ["k"], ["t"]).collect()}
    assert (best[1]["t"], best[1]["x"]) == (7, "a")
    assert best[2]["x"] == "n"
    assert cleaning.first_per_key(df.where("k = 1"), ["k"], ["t"]).first()["t"] == 5


def test_timestamps_that_do_not_parse(spark):
    df = spark.createDataFrame([("2020-01-02 03:04:05",), ("soon",), (None,)], "t string")
    rows = [r["t"] for r in cleaning.cast_timestamps(df, ["t"]).collect()]
    assert rows[0].year == 2020 and rows[1:] == [None, None]


def test_weighted_rows_equal_the_full_product(market):
    full = stages.joined(market)
    for use in ((), ("payments",), ("items", "reviews")):
        small = stages.joined(market, use)
        assert small.agg(F.sum("copies")).first()[0] == full.count()
    exact = full.agg(F.sum("payment_value")).first()[0]
    assert stages.joined(market, ["payments"]).agg(kpis.total("payment_value")).first()[0] == exact


def test_payments_do_not_multiply_orders(market):
    orders = market.orders.count()
    assert market.orders.join(silver.order_payments(market), "order_id", "left").count() == orders


def test_csv(spark, tmp_path):
    text = 'said "no",\nthen left'
    df = spark.createDataFrame([("00123", text), ("00045", None)], "zip string, note string")
    csv.write_csv(df, f"{tmp_path}/t")
    back = csv.read_csv(spark, f"{tmp_path}/t", df.schema, multi_line=True)
    assert {tuple(r) for r in back.collect()} == {("00123", text), ("00045", None)}
    assert csv.row_count(back).first()[0] == 2
    assert csv.preview(back, 1).count() == 1
    with pytest.raises(ValueError):
        csv.preview(back, 0)
    with pytest.raises(AnalysisException):
        csv.read_csv(spark, f"{tmp_path}/none", df.schema)


def test_kafka_options():
    plain = kafka.kafka_options("host:9092", "orders")
    assert plain["startingOffsets"] == "earliest" and plain["failOnDataLoss"] == "false"
    assert "kafka.security.protocol" not in plain
    safe = kafka.kafka_options("host:9092", "orders", 'us"er', "se\\cret")
    assert safe["kafka.security.protocol"] == "SASL_SSL"
    assert 'username="us\\"er"' in safe["kafka.sasl.jaas.config"]
    assert 'password="se\\\\cret"' in safe["kafka.sasl.jaas.config"]


def test_json_keeps_nulls(spark):
    row = kafka.encode(one(spark, id="7", name="CAST(NULL AS STRING)"), "id").first()
    assert (row["key"], row["value"]) == ("7", '{"id":7,"name":null}')


def test_publish_counts_what_it_writes(spark, tmp_path):
    rows = spark.createDataFrame(
        [("s1", "00001", "x", "SP"), (None, "00002", "y", "RJ"), ("s3", None, None, None)],
        "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string")
    counts = csv.publish(rows, CONTRACTS["sellers"], lambda r: r.write.parquet(f"{tmp_path}/p"))
    got = counts.first().asDict()
    assert got == {"processed": 3, "published": 2, "skipped_invalid": 1, "failed": 0}
    assert {r["key"] for r in spark.read.parquet(f"{tmp_path}/p").collect()} == {"s1", "s3"}


def test_incremental_load(spark):
    source = spark.createDataFrame([(1, 10), (2, 20), (3, 30), (1, 40)], "k long, t long")
    target = spark.createDataFrame([(1, 10), (9, 15)], "k long, t long")
    new = bronze.above_watermark(source, target, "t", ["k"])
    assert {r["k"] for r in new.collect()} == {2, 3}
    tied = spark.createDataFrame([(4, 15), (5, 14), (6, None)], "k long, t long")
    assert {r["k"] for r in bronze.above_watermark(tied, target, "t", ["k"]).collect()} == {4}
    assert {r["k"] for r in bronze.below_watermark(tied, target, "t", ["k"]).collect()} == {5, 6}
    assert bronze.above_watermark(source, target.where("false"), "t", ["k"]).count() == 4


def test_upsert_prefers_updates_on_a_tie(spark):
    old = spark.createDataFrame([(1, 5, "old"), (2, 5, "keep")], "k long, t long, x string")
    new = spark.createDataFrame([(1, 5, "new"), (3, 1, "add"), (2, 4, "stale")],
                                "k long, t long, x string")
    rows = {r["k"]: r["x"] for r in bronze.upsert(old, new, ["k"], ["t"]).collect()}
    assert rows == {1: "new", 2: "keep", 3: "add"}


def test_partitioned_write_prunes(spark, market, tmp_path):
    bronze.write_partitioned(market.orders, "orders", str(tmp_path))
    one_year = spark.read.parquet(str(tmp_path)).where("order_purchase_year = 1997")
    plan = one_year._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_purchase_year" in plan
    assert one_year.count() == market.orders.where("year(order_purchase_timestamp) = 1997").count()


def test_dense_keys(spark):
    df = spark.range(5000).select((F.col("id") * 7919).alias("k"))
    keyed = scd.dense_keys(df, ["k"], "n", buckets=16)
    row = keyed.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first()
    assert tuple(row) == (1, 5000, 5000)


def feed(spark, rows):
    return spark.createDataFrame(rows, "k long, a string, t string").withColumn(
        "t", F.col("t").cast("timestamp_ntz"))


def test_history_keeps_changes_only(spark):
    rows = [(1, "x", "2020-01-01"), (1, "x", "2020-01-01 05:00:00"), (1, "y", "2020-01-01 09:00:00"),
            (1, "y", "2020-02-01"), (1, None, "2020-03-01"), (1, None, "2020-03-02"),
            (1, "x", "2020-04-01"), (2, "q", "2020-01-05")]
    out = scd.history(feed(spark, rows), ["k"], ["a"], "t").orderBy("k", scd.START).collect()
    got = [(r["k"], r["a"], str(r[scd.START]), r[scd.END] and str(r[scd.END]), r[scd.CURRENT])
           for r in out]
    assert got == [
        (1, "x", "1900-01-01 00:00:00", "2020-01-01 09:00:00", False),
        (1, "y", "2020-01-01 09:00:00", "2020-03-01 00:00:00", False),
        (1, None, "2020-03-01 00:00:00", "2020-04-01 00:00:00", False),
        (1, "x", "2020-04-01 00:00:00", None, True),
        (2, "q", "1900-01-01 00:00:00", None, True),
    ]


def test_history_takes_the_feed_once_where_no_value_comes_back(spark):
    rows = [(k, "ab"[d > 5], f"2020-01-{d:02d}") for k in range(20) for d in range(1, 11)]
    out = scd.history(feed(spark, rows), ["k"], ["a"], "t")
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 40 and out.where(scd.CURRENT).count() == 20


def test_history_of_values_that_come_back(spark):
    rng = random.Random(5)
    rows = [(k, rng.choice(["x", "y", None]), f"2020-01-{rng.randint(1, 9):02d} 0{rng.randint(0, 3)}:00:00")
            for k in range(30) for _ in range(rng.randint(1, 12))]
    rows += [(100, "x", "2020-01-01"), (100, "y", "2020-01-02"), (None, "x", "2020-01-01")]
    want = []
    for k in {r[0] for r in rows} - {None}:
        at = {}
        for _, a, t in (r for r in rows if r[0] == k):
            at[t] = max(at.get(t, (False, "")), (a is not None, a or ""))
        changes = []
        for t in sorted(at):
            if not changes or changes[-1][1] != at[t]:
                changes.append((t, at[t]))
        starts = ["1900-01-01"] + [t for t, _ in changes[1:]]
        for (_, v), s, e in zip(changes, starts, starts[1:] + [None]):
            want.append((k, v[1] if v[0] else None, s[:10], e and e[:13], e is None))
    got = [(r["k"], r["a"], str(r[scd.START])[:10], r[scd.END] and str(r[scd.END])[:13], r[scd.CURRENT])
           for r in scd.history(feed(spark, rows), ["k"], ["a"], "t").collect()]
    want = [(k, a, s, e and (e + " 00")[:13], c) for k, a, s, e, c in want]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_rows_of_the_unknown_member_are_dealt(spark):
    dim = spark.createDataFrame([(-1, None, "1900-01-01"), (7, 70, "2020-01-01")],
                                f"CustomerKey long, CustomerId long, {scd.START} string")
    fact = spark.range(2000).select(F.col("id").alias("OrderId"), F.when(
        F.col("id") % 10 == 0, 7).otherwise(-1).cast("long").alias("CustomerKey"))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        out = _member(fact, dim, "Customer")
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        rows = out.select("OrderId", "CustomerId", "CustomerFrom").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(sizes) == 4 and max(sizes) < 1000
    assert sorted(tuple(r) for r in rows if r["CustomerId"]) == [
        (i, 70, "2020-01-01") for i in range(0, 2000, 10)]
    assert len(rows) == 2000 and sum(r["CustomerFrom"] is None for r in rows) == 1800


def test_csv_files_of_bounded_size(spark, tmp_path):
    df = spark.range(3000).select("id", F.expr(
        "CASE WHEN id % 3 > 0 THEN concat(id, '\\n\"q\", ', repeat('x', 80)) END").alias("t")).coalesce(1)
    csv.write_csv(df, f"{tmp_path}/t", 20_000)
    sizes = [p.stat().st_size for p in (tmp_path / "t").glob("*.csv")]
    assert len(sizes) > 10 and max(sizes) <= 20_000 + len("id,t\n")
    back = csv.read_csv(spark, f"{tmp_path}/t", df.schema, multi_line=True)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_history_merge_and_lookup(spark):
    dim = scd.history(feed(spark, [(1, "x", "2020-01-01"), (2, "q", "2020-01-01")]), ["k"], ["a"], "t")
    updates = feed(spark, [(1, "y", "2020-06-01"), (2, "q", "2020-06-01"), (3, "n", "2020-06-01")])
    seen = feed(spark, [(1, "x", "2020-01-01"), (2, "q", "2020-01-01")]).union(updates)
    merged = scd.merge(dim, seen, updates, ["k"], ["a"], "t")
    rows = {(r["k"], r["a"]): (r[scd.END] is None, r[scd.CURRENT]) for r in merged.collect()}
    assert rows == {(1, "x"): (False, False), (1, "y"): (True, True), (2, "q"): (True, True),
                    (3, "n"): (True, True)}
    facts = feed(spark, [(1, "f", "2020-05-31 23:59:59"), (1, "f", "2020-06-01"), (4, "f", "2020-01-01")])
    found = scd.as_of(facts, merged, {"k": "k"}, "t", {"a": "version"})
    assert sorted((r["k"], r["version"] or "") for r in found.collect()) == [(1, "x"), (1, "y"), (4, "")]


def test_merge_does_not_depend_on_the_order_of_arrival(spark):
    rows = [(1, "a", "2020-01-01"), (1, "b", "2020-03-01"), (1, "a", "2020-05-01"),
            (1, "z", "2020-02-01"), (1, "z", "2020-06-01"), (2, "q", "2020-01-01"),
            (2, "r", "2020-01-02"), (2, "q", "2020-01-03"), (3, "n", "2021-01-01")]
    want = sorted(map(str, scd.history(feed(spark, rows), ["k"], ["a"], "t").collect()))
    for order in ([0, 1, 2, 3, 4, 5, 6, 7, 8], [8, 4, 7, 2, 5, 0, 6, 1, 3], [3, 1, 0, 6, 2, 7, 4, 8, 5]):
        came = [rows[i] for i in order]
        dim = scd.history(feed(spark, came[:3]), ["k"], ["a"], "t")
        for upto in (6, 9):
            dim = scd.merge(dim, feed(spark, came[:upto]), feed(spark, came[upto - 3:upto]),
                            ["k"], ["a"], "t")
        assert sorted(map(str, dim.collect())) == want


def test_keys_tell_nulls_apart(spark):
    df = spark.createDataFrame([("z", None, "x"), ("z", "x", None)], "a string, b string, c string")
    for make in (scd.hash_key, scd.wide_key):
        assert df.select(make("a", "b", "c").alias("k")).distinct().count() == 2


def test_words(spark):
    df = spark.createDataFrame([("L'été d'Ana's 42 is a's ''quoted'' x",), (None,)], "t string")
    got = {r["word"]: r["n"] for r in terms.word_counts(df, "t").collect()}
    assert got == {"l'été": 1, "d'ana": 1, "quoted''": 1}


def test_a_cluster_must_name_its_folder():
    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "spark://host:7077"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace.shared_folder(Session())


def test_nothing_is_left_behind(tmp_path):
    """A session's working copies go with it, whether it named a folder or not."""
    code = """
import sys
from pyspark.sql import SparkSession
from tradepath.sources import workspace
builder = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
if sys.argv[1]:
    builder = builder.config("spark.checkpoint.dir", sys.argv[1])
spark = builder.getOrCreate()
assert workspace.materialise(spark.range(5), "x").count() == 5
print("FOLDER", workspace.shared_folder(spark))
spark.stop()
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for folder in (str(tmp_path / "shared"), ""):
        out = subprocess.run([sys.executable, "-c", code, folder], cwd=root, capture_output=True,
                             text=True, timeout=120, check=True).stdout
        place = out.split("FOLDER ")[1].strip()
        assert not [f for _, _, files in os.walk(place) for f in files]


def test_shared_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert workspace.fresh_path(spark, "x").startswith(folder)
    assert workspace.fresh_path(spark, "x") != workspace.fresh_path(spark, "x")


def test_repeated_orders_join_as_pandas_does(spark, market):
    """An order listed twice without items gives two joined rows, one with two items gives four."""
    from types import SimpleNamespace

    orders = market.orders.where("order_status = 'delivered'").limit(1)
    twice = orders.union(orders)
    item = market.items.limit(1).drop("order_id").crossJoin(orders.select("order_id"))
    empty = {t: getattr(market, t).where("false") for t in ("payments", "reviews")}
    for items, n in ((item.where("false"), 2), (item.union(item), 4)):
        m = SimpleNamespace(orders=twice, items=items, **empty)
        assert stages.joined(m, [stages.ITEMS]).count() == n
