import random

import pytest

from rosterlake.sources import delimited as D
from rosterlake.sources import quoted_lines as Q
from rosterlake.sources.archive import ends_quoted, records_of

PIECES = ["a", "bc", '5" pipe', '"x"', '"p|q"', '"two\nlines"', '"say ""hi"""', '"""\n\n"" |"', '""', "", '"end\n"', '"a"b']


def text_of(seed, records):
    r = random.Random(seed)
    lines = ["|".join(r.choice(PIECES) for _ in range(3)) for _ in range(records)]
    return "a|b|c\n" + "\n".join(lines) + "\n"


@pytest.mark.parametrize("line", ['a|b', '"a', 'a|"b', '"a"|"b', 'x"|"', '"a""', '""', '"""', 'a"b', '|"', '"a"x"|b', '"a|b"|c', '', 'q"|r', 'q""|"r'])
def test_line_states(spark, line):
    df = spark.createDataFrame([(line,)], "line string").select(
        D.opens_quote(Q.F.col("line"), D.Dialect()), D.stays_quoted(Q.F.col("line"), D.Dialect()))
    assert tuple(df.head()) == (ends_quoted(line, False, "|", '"'), ends_quoted(line, True, "|", '"'))


@pytest.mark.parametrize("split", [40, 97, 1000, 10_000_000])
def test_records_over_splits(spark, tmp_path, split):
    texts = {f"f{i}.csv": text_of(i, 60) for i in range(3)}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        got = {}
        for r in Q.read_records(spark, str(tmp_path)).orderBy("_file", "record_no").collect():
            got.setdefault(r["_file"].rsplit("/", 1)[1], []).append(r["record"])
        assert got == {n: list(records_of(iter(t.splitlines(keepends=True)), "|", '"')) for n, t in texts.items()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_files_are_read_by_what_they_hold(spark, tmp_path):
    (tmp_path / "multi.csv").write_text('a|b|c\r\nx|"two\nlines"|z\r\nx|y\n')
    (tmp_path / "plain.csv").write_text("a|b|c\n1|2|3\n4|5|6|7\n")
    rows = Q.read_files(spark, str(tmp_path), ["a", "b", "c"])
    got = sorted((r["_file"][-9:], r["_row_status"], r["a"], r["b"]) for r in D.accepted_rows(rows).collect())
    assert got == [("multi.csv", "ok", "x", "two\nlines"), ("plain.csv", "ok", "1", "2"), ("plain.csv", "surplus", "4", "5")]
    assert D.rejected_rows(rows).count() == 1


def test_a_quote_never_closed_stops_the_load(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(Q, "MAX_RECORD_BYTES", 20)
    (tmp_path / "open.csv").write_text('a|b|c\nx|"never\n' + "text text text\n" * 40)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        with pytest.raises(Exception, match="never closed"):
            Q.read_records(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
