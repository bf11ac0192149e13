import io
import zipfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rosterlake.sources import archive as A
from rosterlake.sources import delimited as D
from rosterlake.sources import dictionary as X
from rosterlake.sources import manifest as M
from rosterlake.sources.feeds import feed_counts, landed_files, read_landed

COLUMNS = ["a", "b", "c"]
RECORDS = {
    'x|y|z': ("ok", ("x", "y", "z")),
    'x|"y|1"|z': ("ok", ("x", "y|1", "z")),
    'x|"two\nlines"|z': ("ok", ("x", "two\nlines", "z")),
    'x|"say ""hi"""|z': ("ok", ("x", 'say "hi"', "z")),
    'x||': ("ok", ("x", None, None)),
    'x|y|z|more': ("surplus", ("x", "y", "z")),
    'x|y|z|': ("surplus", ("x", "y", "z")),
    'x|y|z||last': ("surplus", ("x", "y", "z")),
    'x|y': ("short", None),
    'x': ("short", None),
    'x|"open|z': ("short", None),
    'x|5" pipe|z': ("ok", ("x", '5" pipe', "z")),
}


def test_record_status(spark):
    df = spark.createDataFrame([(r,) for r in RECORDS], "record string")
    got = {r[D.BAD]: r for r in D.parse_records(df, "record", COLUMNS).collect()}
    for record, (status, values) in RECORDS.items():
        assert got[record][D.STATUS] == status, record
        if values:
            assert tuple(got[record][c] for c in COLUMNS) == values, record


def test_file_status(spark, tmp_path):
    single = {r: v for r, v in RECORDS.items() if "\n" not in r}
    (tmp_path / "one.csv").write_text("a|b|c\n" + "\n".join(single) + "\n")
    rows = D.read_delimited(spark, str(tmp_path / "one.csv"), COLUMNS)
    assert rows.groupBy(D.STATUS).count().where("_row_status = 'short'").head()["count"] == 3
    assert D.accepted_rows(rows).count() == len(single) - 3
    assert {r[D.STATUS] for r in rows.select(D.STATUS).collect()} == {"ok", "surplus", "short"}


def test_quoted_line_ends_need_a_whole_read(spark, tmp_path):
    (tmp_path / "multi.csv").write_text('a|b|c\nx|"two\nlines"|z\nx|y|z\n')
    (tmp_path / "single.csv").write_text("a|b|c\nx|y|z\n")
    profiles = {r["_file"].rsplit("/", 1)[1]: r["quoted_line_ends"] for r in D.file_profiles(D.read_lines(spark, str(tmp_path))).collect()}
    assert profiles == {"multi.csv": True, "single.csv": False}
    rows = D.read_delimited(spark, str(tmp_path / "multi.csv"), COLUMNS, multi_line=True)
    assert sorted(r["b"] for r in rows.collect()) == ["two\nlines", "y"]


def test_bad_row_limit(spark, tmp_path):
    (tmp_path / "f.csv").write_text("a|b|c\n" + "x|y\n" * 5 + "x|y|z\n" * 3)
    rows = D.read_delimited(spark, str(tmp_path / "f.csv"), COLUMNS)
    D.require_few_bad_rows(rows, limit=5)
    with pytest.raises(ValueError, match="5 bad rows, 4 allowed"):
        D.require_few_bad_rows(rows, limit=4)


def test_colliding_columns_are_refused(spark):
    with pytest.raises(ValueError, match="collide"):
        D.read_delimited(spark, "nowhere", ["a", "a"])


def test_profiles(spark):
    def profile(lines, configured=D.Dialect()):
        df = spark.createDataFrame([("f", x) for x in lines], "_file string, value string")
        r = D.file_profiles(df, configured).head()
        return r["field_delimiter"], r["quote_delimiter"], r["dialect_field_delimiter"], r["dialect_quote_delimiter"]
    assert profile(["a,b,c", "1,2,3"]) == (",", '"', ",", None)
    assert profile(["a|b|c", "1|x,y|3"]) == ("|", '"', None, None)
    assert profile(["word", "other"]) == (",", '"', ",", None)
    assert profile(["a;'b'", "1;'2;3'"]) == (";", "'", ";", "'")
    assert profile(["a~b", "1~2"], D.Dialect("~", "%")) == ("~", "%", None, None)
    assert profile(["a~b", "1~2"], D.Dialect("~")) == ("~", '"', None, None)


def archive(members):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for name, text in members.items():
            z.writestr(name, text)
    return buffer.getvalue()


def test_zip_members(spark, tmp_path):
    text = '﻿a|b\n1|"two\nlines ""q"""\r\n2|5" pipe\n3|x'
    (tmp_path / "drop_level2_20240131.zip").write_bytes(archive({"ClickImpression.csv": text, "notes.txt": "no", "sub/": ""}))
    records = A.with_feed(A.expand_archives(A.read_archives(spark, str(tmp_path))))
    got = [(r["feed"], r["file_stem"], r["record_no"], r["record"]) for r in records.orderBy("record_no").collect()]
    assert got == [("level2", "clickimpression", i, t) for i, t in enumerate(
        ["a|b", '1|"two\nlines ""q"""', '2|5" pipe', "3|x"])]


def test_packed_members():
    members = {"a.csv": "x|y\n" * 5000, "b.csv": "short\n", "c.csv": ""}
    for method in (zipfile.ZIP_DEFLATED, zipfile.ZIP_STORED):
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", method) as z:
            for name, text in members.items():
                z.writestr(name, text)
        packed = list(A.packed_members("p", buffer.getvalue(), "csv"))
        assert {m[1]: io.BufferedReader(A.Unpacked(m[1], *m[2:4], [m[4]])).read().decode() for m in packed} == members
        with pytest.raises(ValueError, match="damaged"):
            io.BufferedReader(A.Unpacked("b", packed[1][2], packed[1][3] ^ 1, [packed[1][4]])).read()


def test_landed_feeds(spark, tmp_path):
    for feed in ("level2", "all_bu"):
        (tmp_path / f"drop_{feed}").mkdir()
        (tmp_path / f"drop_{feed}" / "Lists.csv").write_text("a|b|c\n1|2|3\n4|5|6\n")
    rows = read_landed(spark, landed_files(spark, str(tmp_path)), COLUMNS)
    assert sorted((r["feed"], r["landed"]) for r in feed_counts(rows, ("all_bu", "level2", "pilots")).collect()) == [
        ("all_bu", 2), ("level2", 2), ("pilots", 0)]


def test_manifest(spark):
    files = spark.createDataFrame([(n,) for n in ("in/", "in/trk_Clicks_20240101.csv", "in/trk_Opens_20240101.txt",
                                                  "in/Sent_1.csv", "old/in/x.csv")], "blob_name string")
    ts = F.lit(datetime(2024, 2, 1, 3, 4, 5))

    def names(**kw):
        return sorted((r["file_name"], r["table_name"]) for r in M.build_manifest(files, ts, blob_path="in/", **kw).collect())
    assert names() == [("Sent_1.csv", "sent_1"), ("trk_Clicks_20240101.csv", "trk_clicks_20240101"), ("trk_Opens_20240101.txt", "trk_opens_20240101")]
    assert names(file_prefix="trk_", file_type_filter="csv", remove_prefix=True, remove_tail="_", add_prefix="L_", add_suffix="_X") == [
        ("trk_Clicks_20240101.csv", "l_clicks_x")]
    # A named table is taken as it is, whatever the filters say.
    only = M.wanted_files(spark, {"Sent_1.csv": "Given", "trk_Opens_20240101.txt": ""})
    assert names(only=only, file_prefix="trk_", remove_tail="_") == [("Sent_1.csv", "given"), ("trk_Opens_20240101.txt", "trk_opens")]
    listed = M.wanted_files(spark, ["Sent_1.csv"])
    r = M.build_manifest(files, ts, blob_path="in/", only=listed).head()
    assert (r["table_load_date"], r["table_rows_loaded"], r["table_loaded_successfully"]) == ("20240201_030405", 0, "n")
    loaded = spark.createDataFrame([("sent_1",)] * 3, "table_name string")
    r = M.with_load_results(M.build_manifest(files, ts, blob_path="in/", only=listed), loaded).head()
    assert (r["table_rows_loaded"], r["table_loaded_successfully"]) == (3, "y")


def test_file_listing_does_not_read_contents(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a")
    files = M.list_files(spark, str(tmp_path))
    assert files.columns == ["path", "length", "modificationTime"]
    assert "content" not in files._jdf.queryExecution().executedPlan().toString()
    assert files.select(M.relative_to(F.col("path"), str(tmp_path))).head()[0] == "x.csv"


def test_dictionaries(spark, tmp_path):
    headers = spark.createDataFrame([("t", "f.csv", '﻿Client ID|"E-mail|Addr"|"say ""x"""|')], "table_name string, file_name string, header string")
    d = X.dictionary_from_headers(headers)
    assert [(r["tgt_col_ord"], r["src_col_name"], r["tgt_col_name"]) for r in d.orderBy("tgt_col_ord").collect()] == [
        (1, "Client ID", "client_id"), (2, "E-mail|Addr", "e_mail__addr"), (3, 'say "x"', "say__x_"), (4, "", "")]
    (tmp_path / "dict.csv").write_text(
        "table_name,file_name,column_name,data_type,nullable,ordinal_position\n"
        "t,other.csv,Client ID,INT64,NULLABLE,1\nother,f.csv,Name,STRING,REQUIRED,2\nother,other.csv,No,STRING,NULLABLE,3\nt,f.csv,Both,STRING,NULLABLE,3\n")
    files = spark.createDataFrame([("t", "f.csv")], "table_name string, file_name string")
    d = X.dictionary_from_external(files, X.read_external(spark, str(tmp_path / "dict.csv")))
    schema = X.struct_type(d, "t")
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in schema] == [
        ("client_id", "bigint", True), ("name", "string", False), ("both", "string", True)]
    assert schema["client_id"].metadata == {"description": "f.csv~Client ID"}
    assert X.schema_json(d).head()["schema_json"].startswith('[{"description":"f.csv~Client ID","name":"client_id","type":"INT64","mode":"NULLABLE"}')


def test_schema_differences(spark):
    shape = "ordinal_position bigint, table_name string, column_name string"
    a = spark.createDataFrame([(1, "t", "x"), (2, "t", "y")], shape)
    b = spark.createDataFrame([(1, "t", "x"), (2, "t", "z"), (3, "t", "y")], shape)
    assert X.same_columns(a, a) and not X.same_columns(a, b)
    sides = lambda d: {(r["ordinal_position"], r["column_name"], r["side"]) for r in d.collect()}
    assert sides(X.column_differences(a, b)) == {(2, "y", "new"), (2, "z", "existing"), (3, "y", "existing")}
    # The same the other way round, but for the side.
    assert {(o, c) for o, c, _ in sides(X.column_differences(b, a))} == {(2, "y"), (2, "z"), (3, "y")}
    twice = spark.createDataFrame([("t", "f", "a"), ("t", "f", "a")], "table_name string, src_file_name string, tgt_col_name string")
    assert X.name_collisions(twice).count() == 1
