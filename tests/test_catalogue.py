"""Tables that are written once per load."""

import pytest
from pyspark.sql import functions as F

from tradepath.adapters import Marketplace
from tradepath.plans.warehouse import Warehouse
from tradepath.sources.catalogue import LoadCatalogue, file_state
from tradepath.session import tune


def test_a_table_is_derived_once_per_load(spark, tmp_path):
    catalogue, made = LoadCatalogue(spark, str(tmp_path / "c")), []

    def derive():
        made.append(1)
        return spark.range(3).withColumn("x", F.lit(len(made)))

    for _ in range(3):
        assert {r["x"] for r in catalogue.table("a", "t", derive).collect()} == {1}
    again = LoadCatalogue(spark, str(tmp_path / "c"))  # another session
    assert {r["x"] for r in again.table("a", "t", derive).collect()} == {1}
    assert {r["x"] for r in again.table("b", "t", derive).collect()} == {2}
    assert len(made) == 2 and again.entries().count() == 2
    [gone] = again.prune(["b"])
    assert gone.startswith(str(tmp_path)) and {r["load"] for r in again.entries().collect()} == {"b"}
    assert {r["x"] for r in again.table("b", "t", derive).collect()} == {2}
    assert {r["x"] for r in LoadCatalogue(spark, str(tmp_path / "c")).table("a", "t", derive).collect()} == {3}


def test_a_load_that_dies_leaves_no_entry(spark, tmp_path):
    catalogue = LoadCatalogue(spark, str(tmp_path / "c"))
    broken = spark.range(3).withColumn("x", F.raise_error(F.lit("gone")).cast("int"))
    with pytest.raises(Exception, match="gone"):
        catalogue.table("a", "t", lambda: broken)
    assert catalogue.entries().count() == 0
    assert catalogue.table("a", "t", lambda: spark.range(2)).count() == 2


def test_the_first_entry_counts(spark, tmp_path):
    one, two = (LoadCatalogue(spark, str(tmp_path / "c")) for _ in range(2))

    def late():
        one.table("a", "t", lambda: spark.range(1))  # another load is quicker
        return spark.range(2)

    assert two.table("a", "t", late).count() == 1 and one.table("a", "t", late).count() == 1


def test_file_state_follows_the_files(spark, tmp_path):
    path = str(tmp_path / "data")
    spark.range(3).coalesce(1).write.parquet(path)
    before = file_state(spark, path)
    assert before == file_state(spark, path)
    spark.range(3).coalesce(1).write.mode("append").parquet(path)
    assert before != file_state(spark, path)


def test_facts_share_the_dimensions_of_a_load(spark, sf, tmp_path, monkeypatch):
    built = []
    for name in Warehouse.DIMENSIONS:
        old = getattr(Warehouse, f"_{name}")
        monkeypatch.setattr(Warehouse, f"_{name}", lambda self, n=name, f=old: built.append(n) or f(self))
    catalogue = LoadCatalogue(spark, str(tmp_path / "c"))
    facts = []
    for _ in range(2):
        w = Warehouse.of_load(Marketplace(tune(spark), sf), catalogue)
        facts = [w.fact_sales(), w.fact_payments(), w.fact_delivery(), w.fact_reviews()]
        for fact in facts:
            plan = fact._jdf.queryExecution().optimizedPlan().toString()
            assert "Window" not in plan.replace("row_number", "") or fact is facts[3]
            fact.count()
    assert sorted(built) == sorted(["geography", "customers", "products", "sellers", "payment_types"])
    Warehouse.of_load(Marketplace(spark, sf), catalogue, load="next").fact_delivery().count()
    assert sorted(built)[:4] == ["customers", "customers", "geography", "geography"]
