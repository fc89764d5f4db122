import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradepath.contracts import struct
from tradepath.operators.quality import DuplicateCheck, NullCheck, SchemaCheck
from tradepath.streaming import bronze, progress, quarantine, seen

SCHEMA = struct("id long, name string")
KAFKA = ("key string, value string, topic string, partition int, offset long, "
         "timestamp timestamp_ntz")


def add(spark, path, values, start=0):
    rows = [("k", v, "t", 0, start + i) for i, v in enumerate(values)]
    spark.createDataFrame(rows, "key string, value string, topic string, partition int, offset long") \
        .withColumn("timestamp", F.lit("2024-01-01").cast("timestamp_ntz")) \
        .write.mode("append").parquet(path)


def source(spark, path):
    return spark.readStream.schema(KAFKA).parquet(path)


def config(tmp_path, **changes):
    settings = dict(topic="t", schema=SCHEMA, output_path=f"{tmp_path}/out",
                    checkpoint_path=f"{tmp_path}/check")
    return bronze.StreamConfig(**(settings | changes))


def test_restart_adds_only_new_rows(spark, tmp_path):
    feed = f"{tmp_path}/feed"
    add(spark, feed, ['{"id":1,"name":"a"}', "{broken", '{"id":"x"}'])
    bronze.run(source(spark, feed), config(tmp_path), once=True)
    bronze.run(source(spark, feed), config(tmp_path), once=True)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3
    add(spark, feed, ['{"id":2}'], start=3)
    bronze.run(source(spark, feed), config(tmp_path), once=True)
    rows = {r["kafka_offset"]: (r["id"], r["name"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert rows == {0: (1, "a"), 1: (None, None), 2: (None, None), 3: (2, None)}


def test_settings_are_checked(tmp_path):
    with pytest.raises(ValueError, match="topic, output_path"):
        config(tmp_path, topic="", output_path="")
    with pytest.raises(ValueError, match="at least one field"):
        config(tmp_path, schema=StructType([]))
    assert bronze.table_stream("orders", "/base").checkpoint_path == "/base/checkpoints/orders"
    assert bronze.table_stream("orders", "/base", topic="shop.orders").topic == "shop.orders"


def test_failure_stops_the_stream_and_names_the_topic(spark, tmp_path):
    feed = f"{tmp_path}/feed"
    add(spark, feed, ['{"id":1}'])
    failing = source(spark, feed).withColumn("value", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(RuntimeError, match="topic 't'"):
        bronze.run(failing, config(tmp_path), once=True)
    assert not spark.streams.active


def test_progress_is_kept(spark, tmp_path):
    feed = f"{tmp_path}/feed"
    add(spark, feed, ['{"id":1}', '{"id":2}'])
    log = progress.ProgressTable(spark, f"{tmp_path}/progress")
    query = bronze.run(source(spark, feed), config(tmp_path), once=True, log=log, every=0.2)
    table = log.read()
    assert table.agg(F.sum("input_rows")).first()[0] == 2
    assert table.where("ended = 'stopped'").count() == 1
    log.record(query)  # nothing twice
    assert log.read().agg(F.sum("input_rows")).first()[0] == 2
    seen = progress.latest(query)
    assert (seen["name"], seen["active"]) == ("bronze_t", False)


def test_quarantine_in_a_stream(spark, tmp_path):
    feed = f"{tmp_path}/feed"
    add(spark, feed, ['{"id":1,"name":"a"}', "{broken"])

    def go():
        rows = bronze.bronze_rows(source(spark, feed), SCHEMA)
        quarantine.start(
            rows, [SchemaCheck(["id"]), NullCheck(["id"])], f"{tmp_path}/rows", f"{tmp_path}/check",
            once=True,
        ).awaitTermination()

    go()
    add(spark, feed, ['{"id":2}'], start=2)
    go()
    valid, bad = quarantine.read(spark, f"{tmp_path}/rows")
    assert sorted(r["id"] for r in valid.collect()) == [1, 2]
    assert [r["_failed_checks"] for r in bad.collect()] == [["null_validation"]]


def test_checks_of_a_whole_table_are_refused_in_a_stream(spark, tmp_path):
    feed = f"{tmp_path}/feed"
    add(spark, feed, ['{"id":1}'])
    rows = bronze.bronze_rows(source(spark, feed), SCHEMA)
    for check in (NullCheck(["id"], threshold_percent=5), DuplicateCheck(["id"], name="null_validation")):
        with pytest.raises(ValueError, match="whole table"):
            quarantine.start(rows, [check], f"{tmp_path}/rows", f"{tmp_path}/check", once=True)


def test_a_duplicate_two_batches_later_is_held_back(spark, tmp_path):
    feed, base = f"{tmp_path}/feed", str(tmp_path)
    checks = [NullCheck(["id"]), DuplicateCheck(["id"], full_row=False)]

    def go():
        rows = bronze.bronze_rows(source(spark, feed), SCHEMA)
        quarantine.start(rows, checks, f"{base}/rows", f"{base}/check", [c.name for c in checks],
                         once=True, at="kafka_timestamp").awaitTermination()

    for n, values in enumerate([['{"id":1}', '{"id":2}', '{"id":2,"name":"again"}'], ['{"id":3}'],
                                ['{"id":1,"name":"late"}', '{"id":4}']]):
        add(spark, feed, values, start=10 * n)
        go()
    valid, bad = quarantine.read(spark, f"{base}/rows")
    assert sorted(r["id"] for r in valid.collect()) == [1, 2, 3, 4]
    assert sorted((r["id"], r["_failed_checks"]) for r in bad.collect()) == [
        (1, ["duplicate_validation"]), (2, ["duplicate_validation"])]


def test_seen_keys(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(seen.SeenKeys, "COMPACT", 3)
    state = seen.SeenKeys(spark, f"{tmp_path}/s", ["k", "l"], "t", "2 hours")

    def batch(number, *rows):
        df = spark.createDataFrame(rows, "k int, l string, t string").withColumn(
            "t", F.concat(F.lit("2024-01-01 "), "t").cast("timestamp_ntz"))
        return [r["_repeat"] for r in state.repeats(df.coalesce(1), number).orderBy("t").collect()]

    assert batch(0, (1, "a", "01:00"), (None, "a", "01:01"), (None, "a", "01:02")) == [False, False, True]
    assert batch(1, (1, None, "01:10"), (1, "a", "01:30"), (2, "b", "01:40")) == [False, True, False]
    again = batch(1, (1, None, "01:10"), (1, "a", "01:30"), (2, "b", "01:40"))  # a retry
    assert again == [False, True, False]
    # 1:30 is within two hours of 3:29, not of 3:31; the third batch compacts
    assert batch(2, (1, "a", "03:29")) == [True]
    assert {p.name for p in (tmp_path / "s").iterdir()} == {"new=0", "new=1", "all=2"}
    assert batch(3, (2, "b", "03:41"), (1, "a", "03:50")) == [False, True]
    assert {p.name for p in (tmp_path / "s").iterdir()} == {"all=2", "new=3"}
    kept = spark.read.parquet(f"{tmp_path}/s/all=2").collect()
    assert {(r["k"], r["l"]) for r in kept} == {(1, "a"), (2, "b")}  # 01:02 and 01:10 have gone
    assert batch(4, (7, "x", None), (7, "x", None)) in ([False, True], [True, False])
    assert batch(5, *[(9, "hot", "04:00")] * 50).count(False) == 1
