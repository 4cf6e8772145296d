import pytest

from ternion.sources import files
from ternion.streaming.ingest import ingest


def test_scan_and_state(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"caf\xc3\xa9 \xff end")
    (tmp_path / "b.json").write_text('{"name": "A"}')
    (tmp_path / "c.csv").write_text("x")
    (tmp_path / "empty.txt").write_text("")
    found = files.scan_files(spark, str(tmp_path), "*.txt, *.json,*.txt")
    got = {r["path"].rsplit("/", 1)[1]: r["text"] for r in found.collect()}
    assert got == {"a.txt": "caf\u00e9  end", "b.json": '{"name": "A"}'}  # empty files are left out
    none = spark.createDataFrame([], files.STATE)
    assert files.changed_files(found, none).count() == 2
    rows = [(r["path"], r["sha256"]) for r in files.merged_state(none, found).collect()]
    state = spark.createDataFrame(rows, files.STATE)
    assert files.changed_files(found, state).count() == 0
    (tmp_path / "a.txt").write_text("changed")
    again = files.scan_files(spark, str(tmp_path), "*.txt,*.json")
    assert [r["text"] for r in files.changed_files(again, state).collect()] == ["changed"]
    assert files.merged_state(state, again).count() == 2


def test_no_match_is_an_error(spark, tmp_path):
    (tmp_path / "c.csv").write_text("x")
    with pytest.raises(FileNotFoundError):
        files.scan_files(spark, str(tmp_path), "*.txt")
    with pytest.raises(ValueError):
        files.glob_of(" , ")


def test_latest_version(spark):
    paths = spark.createDataFrame([("p/x-v2.md",), ("p/x-v10.md",), ("p/y-v1.md",), ("p/z.md",), (None,)], "path string")
    assert {tuple(r) for r in files.latest_version(paths).collect()} == {("p/x", "p/x-v10.md"), ("p/y", "p/y-v1.md")}


def test_stream_takes_new_files_once(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text('{"name": "A", "zone": "1"}')
    where = str(folder), str(tmp_path / "out"), str(tmp_path / "log")
    ingest(spark, *where).awaitTermination()
    read = lambda: sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out" / "triplets")).select("subject", "predicate", "object").collect())
    assert read() == [("A", "zone", "1")]
    (folder / "b.json").write_text('{"name": "B", "zone": "2"}')
    ingest(spark, *where).awaitTermination()
    assert read() == [("A", "zone", "1"), ("B", "zone", "2")]
