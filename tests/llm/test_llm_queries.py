"""The registered queries: those with SQL against it, and the pipeline's stages."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from rosterlake.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(SQL))
def test_sql(spark, key):
    con = duckdb.connect()
    for file in os.listdir(SF):
        con.execute(f"create view {file.removesuffix('.parquet')} as select * from '{SF}/{file}'")
    df = QUERIES[key](spark, SF)
    columns = sorted(df.columns)
    result = con.execute(SQL[key])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    plain = lambda v: round(v, 6) if isinstance(v, float) else v
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall()), key=repr)
    assert sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr) == want


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry_points.queries()) and set(SQL) <= set(entry_points.oracle_sql())
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))


def test_pipeline(spark):
    SF = "/root/testdata/sf0.01"  # enough labels to train on
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    given, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.written(stage(spark, given, SF), name)
        seen[name] = out.collect()
        if name != "packing":
            assert out.columns == docs.columns
        given = out
    clean = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    kept = {r.doc_id for r in seen["quality"]}
    assert len(clean - kept) <= 1
    assert {r.doc_id for r in seen["near_duplicates"]} <= kept and len(seen["near_duplicates"]) == len({r.doc_id for r in seen["near_duplicates"]})
    assert {r.doc_id for r in seen["mixing"]} == {r.doc_id for r in seen["packing"]}
    assert sorted(map(repr, corpus_pipeline.run(spark, SF).drop("sequence_id", "offset", "tier", "step_group", "start", "length", "ids_crc32").distinct().collect())) == sorted(
        {repr(r) for r in corpus_pipeline.written(given, "again").drop("sequence_id", "offset", "tier", "step_group", "start", "length", "ids_crc32").distinct().collect()})
