"""No record is lost or changed on its way from text to rows."""

import zipfile

import pytest

from pyspark.sql import functions as F

from rosterlake.plans import daily_load as P
from rosterlake.plans.catalog import ENTITIES
from rosterlake.plans.file_load import WHOLE_LINES, FileLoad, load_folder
from rosterlake.session import scratch_dir
from rosterlake.sinks import tables
from rosterlake.sources import archive as A
from rosterlake.sources import delimited as D
from rosterlake.sources import dictionary as C
from rosterlake.sources import quoted_lines as Q
from rosterlake.sources.feeds import landed_files, read_landed

END = "\u0002"


@pytest.mark.parametrize("sep", [",", ";", "|", "\t", ":"])
def test_whole_texts_under_each_delimiter(spark, tmp_path, sep):
    """Texts with line ends, quotes and control characters, loaded by a folder load that is told another delimiter."""
    spark.sql("create database if not exists texts_test")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        F.col("doc_id").cast("string").alias("id"),
        F.concat(F.regexp_replace("text", "\r\n?", "\n"), F.when(F.col("doc_id") % 3 == 0, F.lit(f' "x{sep}" {END}')).otherwise(F.lit(""))).alias("body"),
        F.concat("lang", F.lit(END)).alias("lang"))
    quoted = [F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')) for c in docs.columns]
    lines = "\n".join([sep.join(docs.columns), *(r[0] for r in docs.select(F.concat_ws(sep, *quoted)).collect())]) + "\n"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "docs.csv").write_text(lines, encoding="utf-8", newline="")
    load_folder(spark, str(tmp_path / "in"), "texts_test", str(tmp_path / "house"), sep.encode().hex(), FileLoad(max_bad_rows=0))
    assert sorted(spark.table("texts_test.docs").collect()) == sorted(docs.collect())


def test_a_field_may_end_in_the_mark(spark):
    records = spark.createDataFrame([(f"a{END}|b|c",), (f"a|b|c{END}",), (f"a|b{END}",), (f'a|"{END}|x"|c|d',), (f"{END}|{END}|{END}",)], "r string")
    got = [(r[D.STATUS], r.x, r.y, r.z) for r in D.parse_records(records, "r", ["x", "y", "z"]).collect()]
    assert got == [("ok", "a" + END, "b", "c"), ("ok", "a", "b", "c" + END), ("short", "a", "b" + END, got[2][3]), ("surplus", "a", END + "|x", "c"), ("ok", END, END, END)]
    with pytest.raises(ValueError):
        D.Dialect(END)


def test_quoted_line_ends_under_the_delimiter_found(spark, tmp_path, rows):
    spark.sql("create database if not exists texts_test")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "found.csv").write_text('a|b\n1|"two\nlines"\n2|x\n3|y\n')
    load_folder(spark, str(tmp_path / "in"), "texts_test", str(tmp_path / "house"), "1", FileLoad())
    assert rows(spark.table("texts_test.found")) == [("1", "two\nlines"), ("2", "x"), ("3", "y")]


def test_whole_lines_keep_every_character(spark, tmp_path, rows):
    spark.sql("create database if not exists texts_test")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "lines.csv").write_text('head\nwith ` tick and more\n\n"open quote\nhead\n')
    load_folder(spark, str(tmp_path / "in"), "texts_test", str(tmp_path / "house"), "1", FileLoad(mode=WHOLE_LINES))
    assert rows(spark.table("texts_test.lines")) == [('"open quote',), ("",), ("head",), ("with ` tick and more",)]


def test_rejects_are_kept(spark, tmp_path):
    spark.sql("create database if not exists texts_test")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "bad.csv").write_text("a,b\n1,2\n3\n4\n")
    load = FileLoad(rejects=str(tmp_path / "rejects"))
    load_folder(spark, str(tmp_path / "in"), "texts_test", str(tmp_path / "house"), "1", load)
    got = spark.read.parquet(str(tmp_path / "rejects")).collect()
    assert sorted((r._file[-7:], r.record, r.reason) for r in got) == [("bad.csv", "3", "short"), ("bad.csv", "4", "short")]
    with pytest.raises(ValueError, match="2 bad rows, 1 allowed"):
        load_folder(spark, str(tmp_path / "in"), "texts_test", str(tmp_path / "house"), "2", FileLoad(max_bad_rows=1))


@pytest.mark.parametrize("split", [64, 1000])
def test_the_record_limit_does_not_depend_on_the_split(spark, tmp_path, split):
    (tmp_path / "open.csv").write_text('a|b\n1|"' + "never\n" * 100)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        with pytest.raises(Exception, match="never closed"):
            Q.read_records(spark, str(tmp_path), max_record_bytes=200).collect()
        assert Q.read_records(spark, str(tmp_path), max_record_bytes=2000).count() == 2
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_the_record_limit_of_archives():
    with pytest.raises(ValueError, match="never closed"):
        list(A.records_of(iter(['1|"', *["never"] * 100]), "|", '"', longest=200))


def test_feed_of_a_root_that_looks_like_one(spark, tmp_path):
    root = tmp_path / "data_level2"
    for feed in ("level2", "pilots"):
        (root / f"drop_{feed}").mkdir(parents=True)
        (root / f"drop_{feed}" / "a.csv").write_text(f"a|b\n1|{feed}\n")
    got = read_landed(spark, landed_files(spark, str(root)), ["a", "b"]).collect()
    assert sorted((r.b, r.feed) for r in got) == [("level2", "level2"), ("pilots", "pilots")]


def test_dictionary_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "d.csv").write_text("ordinal_position,nullable,file_name,data_type,table_name,column_name\n2,NULLABLE,f.csv,INT64,t,c\n")
    row = C.read_external(spark, str(tmp_path / "d.csv")).collect()[0]
    assert (row.table_name, row.file_name, row.column_name, row.data_type, row.nullable, row.ordinal_position) == ("t", "f.csv", "c", "INT64", "NULLABLE", 2)


def test_a_new_column_of_two_files_is_seen(spark, rows):
    listed = "ordinal_position bigint, table_name string, column_name string"
    new = spark.createDataFrame([(1, "t", "a"), (1, "t", "a"), (2, "t", "b"), (2, "t", "b")], listed)
    old = spark.createDataFrame([(1, "t", "a"), (3, "t", "c"), (3, "t", "c"), (3, "t", "c")], listed)
    assert rows(C.column_differences(new, old)) == [(2, "t", "b", "new"), (3, "t", "c", "existing")]


def test_blank_records_are_no_bad_rows(spark, tmp_path):
    entity = ENTITIES["lists"]
    line = "|".join(["1"] * len(entity.columns))
    with zipfile.ZipFile(tmp_path / "drop_level2_20240101.zip", "w") as z:
        z.writestr("Lists.csv", "\n".join(["|".join(entity.columns), *[""] * 150, line, "short|"]) + "\n")
    records = A.with_feed(A.expand_archives(A.read_archives(spark, str(tmp_path))))
    house = P.Warehouse(str(tmp_path / "house"))
    tables.overwrite(records, house.path("landing", "r"), "feed", "file_stem")
    P.load_text(spark, house, "r", "v", entity)
    assert spark.read.parquet(house.path("text", entity.name, "v")).count() == 1
    assert [(r.record, r.reason) for r in spark.read.parquet(house.path("rejects", entity.name, "v")).collect()] == [("short|", "short")]


def test_a_repeat_without_rows_leaves_none(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_partition(spark.range(3).withColumn("run", F.lit("a")), path, "run", "a")
    tables.replace_partition(spark.range(2).withColumn("run", F.lit("b")), path, "run", "b")
    tables.replace_partition(spark.range(0).withColumn("run", F.lit("a")), path, "run", "a")
    assert spark.read.schema("id long, run string").parquet(path).groupBy("run").count().collect() == [("b", 2)]


def test_scratch_folder_of_a_cluster_has_to_be_shared(spark):
    class Elsewhere:
        class conf:
            @staticmethod
            def get(key, default):
                return default

        class sparkContext:
            master = "spark://host:7077"

            @staticmethod
            def getCheckpointDir():
                return None

    with pytest.raises(ValueError, match="share"):
        scratch_dir(Elsewhere, "x")
