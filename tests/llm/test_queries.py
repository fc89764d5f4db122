"""Every query of the folder on the smallest data: its SQL, or its columns and rows."""

import os

import duckdb
import pytest

from tradepath.llm.queries import ORACLES, QUERIES

COLUMNS = {
    "op1": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op2": "doc_id held_out lang_pred score",
    "op3": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op4": "doc_id n_tokens",
    "op6": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op7": "doc_id held_out score predicted",
    "op8": "doc_id class_id n_links",
    "op9": "doc_id piece start length ids_crc32 sequence_id offset",
    "op10": "doc_id held_out score predicted",
    "op11": "doc_id size text_crc32 law shard slot grown_shard",
    "op12": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows(spark, sf, name):
    out = QUERIES[name](spark, sf)
    wanted = COLUMNS[name.split("_")[0]].split()
    assert out.columns[:len(wanted)] == wanted
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = out.select("doc_id").toPandas()["doc_id"]
    assert set(rows) == set(docs.toPandas()["doc_id"])
    assert name.startswith("op9") or len(rows) == docs.count()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, sf, name):
    con = duckdb.connect()
    for f in os.listdir(sf):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{f}'")
    want = con.execute(ORACLES[name]).df()
    got = QUERIES[name](spark, sf).toPandas()
    assert sorted(want.columns) == sorted(got.columns)
    columns = sorted(got.columns)
    assert sorted(map(tuple, got[columns].values.tolist())) == sorted(
        map(tuple, want[columns].values.tolist()))
