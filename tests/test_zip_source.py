"""Archives read by range: the same records as whole archives give, in planned partitions."""

import io
import json
import zipfile

import pytest

from rosterlake.sources import archive as A
from rosterlake.sources import zip_source as Z

TEXT = '﻿a|b\n1|"two\nlines ""q"""\r\n2|5" pipe\n3|x'


def packed(members, method=zipfile.ZIP_DEFLATED):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", method) as z:
        for name, text in members.items():
            z.writestr(name, text)
    return buffer.getvalue()


def reader(paths, tasks=4):
    return Z.ZipRecordsReader({"paths": json.dumps([str(p) for p in paths]), "extension": "csv", "sep": "|", "quote": '"',
                               "longest": "1000000", "tasks": str(tasks)})


@pytest.fixture
def drops(tmp_path):
    (tmp_path / "sub").mkdir()
    big = "x|y\n" + "".join(f'{i}|"line\n{i * 7919 % 1000}"\n' for i in range(30_000))
    (tmp_path / "drop_level2_1.zip").write_bytes(packed({"Clicks.csv": TEXT, "notes.txt": "no", "sub/": "", "Empty.csv": ""}))
    (tmp_path / "sub" / "drop_pilots_1.zip").write_bytes(packed({"Big.CSV": big, "Lists.csv": TEXT}, zipfile.ZIP_STORED))
    (tmp_path / "sub" / "drop_pilots_2.zip").write_bytes(packed({"Big.csv": big, "in/Lists.csv": "h\n1\n"}))
    (tmp_path / "sub" / "none.zip").write_bytes(packed({"readme.txt": "x"}))
    (tmp_path / "sub" / "other.csv").write_text("a|b\n")
    return tmp_path


def test_equals_whole_archives(spark, drops, rows):
    def local(df):
        return rows(df.selectExpr("replace(archive, 'file:', '') as archive", "member", "record_no", "record"))
    want = local(A.expand_archives(A.read_archives(spark, str(drops))))
    assert len(want) == 60_000 + 2 + 4 + 4 + 2
    assert local(Z.read_zip_records(spark, str(drops))) == want
    # As URIs, and as a list in which a file occurs once more on its own.
    assert local(Z.read_zip_records(spark, [f"file:{drops}", f"file:{drops}/drop_level2_1.zip"])) == want


def test_partitions_follow_packed_size(drops):
    plan = reader([drops])
    listed = [json.loads(p.value) for p in plan.partitions()]
    members = [tuple(m) for share in listed for m in share]
    assert len(members) == len(set(members)) == 6
    total = sum(m[5] for m in members)
    assert all(len(share) == 1 or sum(m[5] for m in share) <= -(-total // 4) for share in listed)
    assert max(m[5] for m in members) == listed[0][0][5]


def test_no_members(spark, tmp_path):
    (tmp_path / "a.zip").write_bytes(packed({"readme.txt": "x"}))
    assert Z.read_zip_records(spark, str(tmp_path)).count() == 0
    with pytest.raises(FileNotFoundError):
        reader([tmp_path / "missing"]).partitions()


def test_an_archive_beyond_two_gigabytes(spark, tmp_path):
    # A zip file may have anything in front of it; a hole of 3 GB takes no disk.
    path = tmp_path / "drop_level2_20240131.zip"
    with open(path, "wb") as f:
        f.truncate(3 << 30)
        f.seek(0, 2)
        f.write(packed({"Lists.csv": TEXT}))
    got = A.with_feed(Z.read_zip_records(spark, str(tmp_path))).orderBy("record_no").collect()
    assert [r["record"] for r in got] == ["a|b", '1|"two\nlines ""q"""', '2|5" pipe', "3|x"]
    assert {(r["feed"], r["file_stem"]) for r in got} == {("level2", "lists")}


def test_chunks_and_batches_of_any_size(drops, monkeypatch):
    def records(plan):
        return [(r["archive"], r["member"], r["record_no"], r["record"])
                for p in plan.partitions() for batch in plan.read(p) for r in batch.to_pylist()]
    want = records(reader([drops]))
    for chunk, batch in ((1, 10_000), (7, 3), (1000, 1)):
        monkeypatch.setattr(Z, "CHUNK", chunk)
        monkeypatch.setattr(Z, "BATCH_ROWS", batch)
        got = records(reader([drops / "drop_level2_1.zip"]))
        assert got == [r for r in want if r[0].endswith("drop_level2_1.zip")]


def test_damage_fails_the_read(tmp_path):
    content = bytearray(packed({"a.csv": "plain text\n" * 100}, zipfile.ZIP_STORED))
    content[content.index(b"plain")] ^= 1
    (tmp_path / "a.zip").write_bytes(bytes(content))
    plan = reader([tmp_path])
    with pytest.raises(ValueError, match="damaged"):
        list(plan.read(plan.partitions()[0]))
