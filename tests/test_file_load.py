"""Folders of files end to end."""

import pytest
from pyspark.sql import functions as F

from rosterlake.plans.file_load import STOP, WHOLE_LINES, FileLoad, load_folder
from rosterlake.sources.delimited import Dialect
from rosterlake.sources.manifest import wanted_files


def load(spark, tmp_path, version, **what):
    spark.sql("create database if not exists files_test")
    manifest = load_folder(spark, str(tmp_path / "in"), "files_test", str(tmp_path / "house"), version, FileLoad(**what))
    return {r["blob_name"]: r for r in manifest.collect()}


def test_folder(spark, tmp_path, rows):
    folder = tmp_path / "in" / "day"
    folder.mkdir(parents=True)
    (folder / "trk_Clicks_20240101.csv").write_text('Client ID|SendURLID\n1|"a|b"\n2|"two\nlines"\n3\n4|x|more\n')
    (folder / "trk_Opens_20240101.csv").write_text("Client ID;Name\n1;x\n2;y\n")
    (folder / "other.txt").write_text("no")
    naming = dict(blob_path="day/", file_prefix="trk_", file_type_filter="csv", remove_prefix=True, remove_tail="_",
                  add_prefix="l2_", dialect=Dialect())
    first = load(spark, tmp_path, "1", **naming)
    clicks, opens = first["day/trk_Clicks_20240101.csv"], first["day/trk_Opens_20240101.csv"]
    assert set(first) == {"day/trk_Clicks_20240101.csv", "day/trk_Opens_20240101.csv"}
    assert (clicks["table_name"], clicks["is_table_new"], clicks["table_rows_loaded"], clicks["table_loaded_successfully"]) == ("l2_clicks", "y", 3, "y")
    assert (clicks["dialect_field_delimiter"], opens["dialect_field_delimiter"]) == (None, ";")
    assert rows(spark.table("files_test.l2_clicks")) == [("1", "a|b"), ("2", "two\nlines"), ("4", "x")]
    assert rows(spark.table("files_test.l2_opens")) == [("1", "x"), ("2", "y")]

    # Truncated by default; another column is a changed schema.
    (folder / "trk_Clicks_20240101.csv").write_text("Client ID|Other\n9|z\n")
    second = load(spark, tmp_path, "2", save_manifest=str(tmp_path / "manifest"), **naming)
    clicks, opens = second["day/trk_Clicks_20240101.csv"], second["day/trk_Opens_20240101.csv"]
    assert (clicks["is_table_new"], clicks["has_table_schema_changed"], opens["has_table_schema_changed"]) == ("n", "y", "n")
    assert rows(spark.table("files_test.l2_clicks")) == [("9", "z")]
    assert spark.table("files_test.l2_opens").count() == 2
    assert spark.read.json(str(tmp_path / "manifest")).count() == 2

    load(spark, tmp_path, "3", write="append", **naming)
    assert spark.table("files_test.l2_opens").count() == 4


def test_dictionary_named_files_and_whole_lines(spark, tmp_path, rows):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "One.csv").write_text("a,b\n1,2\n")
    (folder / "Two.csv").write_text("n,t\n1,x\n5,y\n")
    (tmp_path / "dict.csv").write_text("table_name,file_name,column_name,data_type,nullable,ordinal_position\n"
                                       "given,none.csv,First Col,INT64,NULLABLE,1\nx,One.csv,Second,STRING,NULLABLE,2\n")
    load(spark, tmp_path, "1", files={"One.csv": "Given", "Two.csv": ""}, dictionary=str(tmp_path / "dict.csv"))
    given = spark.table("files_test.given")
    assert given.dtypes == [("first_col", "bigint"), ("second", "string")] and rows(given) == [(1, "2")]
    # The dictionary knows nothing of this table, so its types are inferred.
    assert spark.table("files_test.two").dtypes == [("n", "int"), ("t", "string")]
    load(spark, tmp_path, "2", files=["Two.csv"], mode=WHOLE_LINES, add_suffix="_raw")
    assert rows(spark.table("files_test.two_raw")) == [("1,x",), ("5,y",)]
    assert load(spark, tmp_path, "3", files="Two.csv") == {}
    assert wanted_files(spark, []) is None


def test_facts_leave_other_records_alone(spark):
    from rosterlake.sources import manifest as M
    files = spark.createDataFrame([("a.csv",), ("b.csv",)], "blob_name string")
    m = M.build_manifest(files, F.lit("2024-01-01").cast("timestamp_ntz"))
    facts = spark.createDataFrame([("a.csv", "y", None)], "blob_name string, is_table_new string, dialect_field_delimiter string")
    assert sorted((r["blob_name"], r["is_table_new"]) for r in M.with_file_facts(m, facts).collect()) == [("a.csv", "y"), ("b.csv", "n")]


def test_bad_rows_are_kept_without_a_named_folder(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("x,y\n1,2\n3\n4,5,6\n")
    load(spark, tmp_path, "7", file_type_filter="csv")
    kept = spark.read.parquet(str(tmp_path / "house" / "_rejects" / "a" / "version=7"))
    assert kept.columns == ["_file", "record", "reason"]
    assert [(r._file.rsplit("/", 1)[1], r.record) for r in kept.collect()] == [("a.csv", "3")]


def test_files_without_header(spark, tmp_path, rows):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "plain.csv").write_text("1,x\n2,y\n")
    (folder / "quoted.csv").write_text('1,"two\nlines"\n2,y\n')
    heading = "table_name,file_name,column_name,data_type,nullable,ordinal_position\n"
    (tmp_path / "dict.csv").write_text(heading + "".join(f"{t},-,{c},{kind},NULLABLE,{i}\n" for t in ("plain", "quoted")
                                                         for i, (c, kind) in enumerate((("Key No", "INT64"), ("Text", "STRING")), 1)))
    load(spark, tmp_path, "1", header=False, dictionary=str(tmp_path / "dict.csv"))
    assert spark.table("files_test.plain").dtypes == [("key_no", "bigint"), ("text", "string")]
    assert rows(spark.table("files_test.plain")) == [(1, "x"), (2, "y")]
    assert rows(spark.table("files_test.quoted")) == [(1, "two\nlines"), (2, "y")]
    load(spark, tmp_path, "2", header=False, mode=WHOLE_LINES, files=["plain.csv"], add_suffix="_lines")
    assert rows(spark.table("files_test.plain_lines")) == [("1,x",), ("2,y",)]
    with pytest.raises(ValueError, match="need a dictionary"):
        load(spark, tmp_path, "3", header=False)
    (tmp_path / "dict.csv").write_text(heading + "plain,-,Key No,INT64,NULLABLE,1\nplain,-,Text,STRING,NULLABLE,2\n")
    with pytest.raises(ValueError, match="does not describe.*quoted.csv"):
        load(spark, tmp_path, "4", header=False, dictionary=str(tmp_path / "dict.csv"))


def test_changed_columns_can_stop_the_load(spark, tmp_path, rows):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "steady.csv").write_text("a,b\n1,2\n")
    (folder / "shifting.csv").write_text("a,b\n1,2\n")
    load(spark, tmp_path, "1", on_change=STOP)
    (folder / "steady.csv").write_text("a,b\n3,4\n")
    (folder / "shifting.csv").write_text("a,c\n3,4\n")
    with pytest.raises(ValueError, match=r"\{'shifting': \[\('b', 'existing'\), \('c', 'new'\)\]\}"):
        load(spark, tmp_path, "2", on_change=STOP)
    # Not even the table that did not change was written.
    assert rows(spark.table("files_test.steady")) == rows(spark.table("files_test.shifting")) == [("1", "2")]
    third = load(spark, tmp_path, "3", write="append")
    assert {k: r["has_table_schema_changed"] for k, r in third.items()} == {"steady.csv": "n", "shifting.csv": "y"}
    assert rows(spark.table("files_test.steady")) == [("1", "2"), ("3", "4")] and rows(spark.table("files_test.shifting")) == [("3", "4")]
