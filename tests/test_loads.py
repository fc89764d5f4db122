"""Bucketed tables, loads by a mark, and sketches of loads."""

import os

import pytest
from pyspark.sql import functions as F

from tradepath.operators import profile, scd
from tradepath.sources import marks
from tradepath.sources.buckets import BucketedTable


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def read_files(df):
    """How many files a frame reads rows from."""
    return df.select("*", F.input_file_name().alias("_f")).select("_f").distinct().count()


def test_upsert_leaves_untouched_files(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = spark.range(2000).selectExpr("id AS k", "1L AS t", "'old' AS x")
    table = BucketedTable(spark, path, rows.schema, ["k"], 32)
    table.append(rows)
    before = files(path)
    updates = spark.createDataFrame([(5, 2, "new"), (5, 1, "stale"), (9999, 1, "add")], rows.schema)
    touched = table.upsert(updates, ["t"])
    after = files(path)
    assert 1 <= len(touched) <= 2
    inside = [f"_bucket={b}/" for b in touched]
    for f, at in before.items():
        if any(i in f for i in inside):
            assert f not in after
        else:
            assert after[f] == at
    got = {r["k"]: r["x"] for r in table.read().collect()}
    assert len(got) == 2001 and got[5] == "new" and got[9999] == "add" and got[6] == "old"
    assert table.read().count() == 2001
    near = table.near(updates.where("k = 5"))
    assert near.where("k = 5").count() == 1 and near.count() < 200
    assert read_files(near) < len(before) and table.upsert(updates.limit(0), ["t"]) == []


def test_bucketed_edges(spark, tmp_path):
    shape = spark.createDataFrame([], "k string, t long, x string").schema
    table = BucketedTable(spark, f"{tmp_path}/t", shape, ["k"], 4)
    assert table.read().count() == 0
    rows = spark.createDataFrame([(None, 1, "a"), ("", 1, "b"), ("z", 1, "c")], shape)
    table.upsert(rows, ["t"])
    table.upsert(spark.createDataFrame([(None, 2, "d"), ("z", 1, "tie")], shape), ["t"])
    assert {(r["k"], r["x"]) for r in table.read().collect()} == {(None, "d"), ("", "b"), ("z", "tie")}
    with pytest.raises(ValueError):
        BucketedTable(spark, "x", shape.add("_bucket", "int"), ["k"])


def test_merge_reads_touched_buckets_only(spark, tmp_path):
    feed = spark.range(400).selectExpr(
        "id % 100 AS k", "CONCAT('v', id % 7) AS a",
        "TIMESTAMP_NTZ'2020-01-01' + make_dt_interval(CAST(id AS INT)) AS t")
    shape = scd.history(feed, ["k"], ["a"], "t").schema
    seen = BucketedTable(spark, f"{tmp_path}/feed", feed.schema, ["k"], 16)
    dim = BucketedTable(spark, f"{tmp_path}/dim", shape, ["k"], 16)
    scd.merge_buckets(dim, seen, feed.where("k <> 3 OR a <> 'v5'"), ["a"], "t")
    before = files(f"{tmp_path}/dim")
    late = feed.where("k = 3 AND a = 'v5'")
    touched = scd.merge_buckets(dim, seen, late, ["a"], "t")
    assert len(touched) == 1 and scd.merge_buckets(dim, seen, late, ["a"], "t") == touched  # run again
    kept = {f: at for f, at in before.items() if f"_bucket={touched[0]}/" not in f}
    assert kept and all(files(f"{tmp_path}/dim")[f] == at for f, at in kept.items())
    pruned = seen.read(touched)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in pruned or "PartitionFilters: [(_bucket" in pruned
    assert read_files(seen.read(touched)) < read_files(seen.read())
    want = sorted(map(str, scd.history(feed, ["k"], ["a"], "t").collect()))
    assert sorted(map(str, dim.read().collect())) == want


def marked(spark, base):
    return marks.MarkedLoad(spark, "t", f"{base}/rows", f"{base}/marks", "t", ["k"])


def test_a_load_that_dies_loses_and_repeats_nothing(spark, tmp_path, monkeypatch):
    source = spark.createDataFrame([(k, k // 3) for k in range(30)], "k long, t long")
    load = marked(spark, tmp_path)
    load.run(source.where("k < 10"))
    assert load.mark() == (1, 3)

    def die(*_):
        raise RuntimeError("died")

    with monkeypatch.context() as patch:  # after the rows, before the mark
        patch.setattr(marks.MarkedLoad, "_commit", die)
        with pytest.raises(RuntimeError):
            load.run(source.where("k < 20"))
    assert load.mark() == (1, 3) and spark.read.parquet(f"{tmp_path}/rows").count() == 20
    again = marked(spark, tmp_path)
    assert again.run(source.where("k < 20")).count() == 0
    assert again.mark() == (2, 6)  # the dead load's rows count
    again.run(source)
    rows = [r["k"] for r in spark.read.parquet(f"{tmp_path}/rows").collect()]
    assert sorted(rows) == list(range(30)) and again.mark() == (3, 9)
    assert [r["n_rows"] for r in again.marks().orderBy("load").collect()] == [10, 0, 10]


def test_late_rows_are_counted(spark, tmp_path):
    kind = "k long, t timestamp_ntz"
    day = "2024-01-%02d"
    rows = spark.createDataFrame([(k, day % (k + 1)) for k in range(10)], "k long, t string").selectExpr(
        "k", "CAST(t AS TIMESTAMP_NTZ) AS t")
    load = marked(spark, tmp_path)
    load.run(rows.where("k % 2 = 0"))
    more = rows.unionByName(spark.createDataFrame([(50, None)], kind))
    assert {r["k"] for r in load.late(more).collect()} == {1, 3, 5, 7, 50}
    assert {r["k"] for r in load.run(more).collect()} == {9}
    last = load.marks().orderBy(F.desc("load")).first()
    assert (last["late_rows"], last["n_rows"], str(last["mark"])) == (5, 1, "2024-01-10 00:00:00")
    other = marks.MarkedLoad(spark, "u", f"{tmp_path}/u", f"{tmp_path}/marks", "t", ["k"])
    assert other.mark() == (0, None) and other.run(rows.limit(0)).count() == 0
    assert other.mark() == (1, None) and other.run(rows).count() == 10


def test_sketches_of_loads(spark, tmp_path):
    df = spark.range(30_000).selectExpr("id", "id % 100 AS few", "CAST(NULL AS STRING) AS none")
    store = profile.SketchStore(spark, f"{tmp_path}/s")
    for n in range(3):
        store.add(df.where(F.col("id") % 3 == n), ["id", "few", "none"], str(n))
    store.add(df.where("id % 3 = 1"), ["id", "few", "none"], "1")  # the same load again
    got = {r["column"]: (r["loads"], r["n_distinct"]) for r in store.cardinality().collect()}
    assert got["few"] == (3, 100) and got["none"] == (3, 0) and abs(got["id"][1] - 30_000) < 900
    part = {r["column"]: r["n_distinct"] for r in store.cardinality(["0"]).collect()}
    assert abs(part["id"] - 10_000) < 300
