import hashlib
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from yearloom.sources import landing, readers
from yearloom.specs import DatasetSpec, PeriodSpec


@pytest.fixture
def files(tmp_path):
    contents = {
        "one.csv": os.urandom(2500),
        "with blank é.csv": b"a,b\r\n1,2\r\n",
        "empty.csv": b"",
    }
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    return tmp_path, contents


def test_ranges_hold_every_byte(spark, files):
    path, contents = files
    manifest = landing.raw_manifest(spark, {"d": f"{path}/*.csv"})
    assert {(r["file_name"], r["length"]) for r in manifest.collect()} == {
        (name, len(content)) for name, content in contents.items()
    }
    rows = landing.raw_ranges(manifest, range_bytes=1000).orderBy("path", "range_no").collect()
    found = {}
    for r in rows:
        assert r["offset"] == r["range_no"] * 1000 and len(r["content"]) <= 1000
        found[r["file_name"]] = found.get(r["file_name"], b"") + bytes(r["content"])
    assert found == contents


def test_ingest_raw(spark, files, tmp_path_factory):
    path, contents = files
    target = str(tmp_path_factory.mktemp("landing"))
    landing.ingest_raw(spark, {"d": f"{path}/*.csv"}, target)
    stored = spark.read.parquet(f"{target}/d/raw")
    assert stored.select("path").distinct().count() == len(contents)
    digest = F.sha2("content", 256) == F.col("sha256")
    assert stored.where(~digest).isEmpty()
    mtime = stored.where("file_name = 'one.csv'").first()["modification_time"]
    assert abs(mtime.timestamp() - os.path.getmtime(path / "one.csv")) < 1
    with pytest.raises(Exception, match="(?i)already exists"):
        landing.ingest_raw(spark, {"d": f"{path}/*.csv"}, target)


def test_manifest_does_not_read_contents(spark, files, plan):
    path, _ = files
    text = plan(landing.raw_manifest(spark, {"d": f"{path}/*.csv"}))
    assert "ReadSchema: struct<path:string,modificationTime:timestamp,length:bigint>" in text
    assert "content" not in text


def test_profile(spark):
    rows = [(1, "b", -0.0, (1, 2)), (2, None, 3.5, None), (2, "a", None, (3, 4))]
    df = spark.createDataFrame(rows, "n int, `a b` string, x double, s struct<p: int, q: int>")
    found = {r["column_name"]: tuple(r)[1:] for r in landing.profile(df).collect()}
    assert found == {
        "n": ("int", 3, 0, "1", "2", 2),
        "a b": ("string", 3, 1, "a", "b", 2),
        "x": ("double", 3, 1, "0.0", "3.5", 2),
        "s": ("struct<p:int,q:int>", 3, 1, None, None, 2),
    }


def test_exact_numbers_of_values(spark):
    rows = [(1, "b", -0.0, (1, 2)), (2, None, 0.0, None), (2, "a", None, (3, 4))]
    df = spark.createDataFrame(rows, "n int, `a b` string, x double, s struct<p: int, q: int>")
    found = {r["column_name"]: r["n_distinct"] for r in landing.exact_distinct(df).collect()}
    assert found == {"n": 2, "a b": 2, "x": 1, "s": 2}


def test_ranges_are_read_by_as_many_tasks_as_their_bytes_need(spark, files, monkeypatch):
    path, contents = files
    monkeypatch.setattr(landing, "TASK_BYTES", 500)
    ranges = landing.raw_ranges(landing.raw_manifest(spark, {"d": f"{path}/*"}), range_bytes=100)
    tasks = ranges.select(F.spark_partition_id().alias("task")).distinct().count()
    assert tasks >= 4


def test_profile_is_one_pass(spark, folder, plan):
    profile = landing.profile(spark.read.parquet(f"{folder}/orders.parquet"))
    assert plan(profile).count("FileScan") == 1


def test_preview(spark):
    df = spark.range(100).select(F.col("id"))
    assert landing.preview(df).count() == 5
    assert [r["id"] for r in landing.preview(df, 3, ["id"]).collect()] == [0, 1, 2]


def spec(schema="a int, b string"):
    return DatasetSpec("d", "csv", "*.csv", schema, "b", PeriodSpec("column", ("a",)))


def test_line_breaks_in_fields(spark, tmp_path):
    """How a file is read is declared, and does not depend on its size."""
    (tmp_path / "x.csv").write_bytes('a,b\r\n1,"é ""x"", y"\r\n2,"two\r\nlines"\r\n3,"a\rb"\r\n'.encode())
    rows = readers.read_dataset(spark, spec(), str(tmp_path)).orderBy("a").collect()
    assert rows[1]["b"].split() == ["two", "lines"] and rows[2]["b"].split() == ["a", "b"] and len(rows) == 3
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_dataset(spark, replace(spec(), multi_line=False), str(tmp_path)).collect()


@pytest.mark.parametrize("multi_line", [True, False])
def test_many_small_files_read_as_one_large_one(spark, tmp_path, multi_line):
    other = {"quote": "'", "escape": "'"}
    lines = [f"{k},'x, {k}'" for k in range(300)]
    (tmp_path / "one").mkdir()
    (tmp_path / "many").mkdir()
    (tmp_path / "one" / "x.csv").write_text("a,b\n" + "\n".join(lines) + "\n")
    for k in range(30):
        part = "\n".join(lines[k * 10 : k * 10 + 10])
        (tmp_path / "many" / f"{k}.csv").write_text(f"a,b\n{part}\n")
    declared = replace(spec(), options=other, multi_line=multi_line)
    found = [
        sorted(tuple(r) for r in readers.read_dataset(spark, declared, f"{tmp_path}/{name}").collect())
        for name in ("one", "many")
    ]
    assert found[0] == found[1] and len(found[0]) == 300 and found[0][7] == (7, "x, 7")


def test_bad_json_is_an_error_or_is_put_aside(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"a": 1, "b": "x"}\n{"a": "2,5", "b": "y"}\n{"a": 3, "b"\n')
    declared = DatasetSpec("d", "json", "*.json", "a int, b string", "b", PeriodSpec("column", ("a",)))
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_dataset(spark, declared, str(tmp_path)).collect()
    kept = replace(declared, corrupt_column="_bad")
    rows = readers.read_dataset(spark, kept, str(tmp_path))
    assert [tuple(r) for r in readers.good_records(rows, kept).collect()] == [(1, "x")]
    bad = readers.corrupt_records(rows, kept).collect()
    assert len(bad) == 2 and {r["file_name"] for r in bad} == {"x.json"}


def test_undeclared_fields(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"a": 1}\n')
    (tmp_path / "y.json").write_text('{"a": 1, "c": 2}\n')
    declared = DatasetSpec("d", "json", "*.json", "A int, b string", "b", PeriodSpec("column", ("A",)))
    assert readers.undeclared_fields(spark, declared, str(tmp_path)) == ["c"]


def test_files_come_back_from_ranges(spark, files, tmp_path_factory):
    path, contents = files
    target, back = str(tmp_path_factory.mktemp("landing")), tmp_path_factory.mktemp("back")
    landing.ingest_raw(spark, {"d": f"{path}/*.csv"}, target)
    landed = spark.read.parquet(f"{target}/d/raw")
    written = landing.restore_files(landed, str(back)).collect()
    assert {r["length"] for r in written} == {len(c) for c in contents.values()}
    assert {p.name: p.read_bytes() for p in (back / "d").iterdir() if p.suffix == ".csv"} == contents
    times = {p.name: p.stat().st_mtime for p in (back / "d").iterdir() if p.read_bytes()}
    known = {r["file_name"]: r["modification_time"].timestamp() for r in landed.where("modification_time IS NOT NULL").collect()}
    assert known and all(times[name] == pytest.approx(t, abs=0.01) for name, t in known.items())
    with pytest.raises(ValueError, match="share a name"):
        landing.restore_files(landed.unionByName(landed), str(back))


def test_digests_of_whole_files(spark, files):
    path, contents = files
    rows = landing.file_digests(landing.raw_manifest(spark, {"d": f"{path}/*.csv"})).collect()
    assert {r["file_name"]: r["sha256"] for r in rows} == {
        name: hashlib.sha256(content).hexdigest() for name, content in contents.items()
    }


def test_changed_header_is_an_error(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,x\n")
    (tmp_path / "y.csv").write_text("b,a\nx,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_dataset(spark, spec(), str(tmp_path)).collect()


def test_preview_dataset_reads_csv_as_strings(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,x\n")
    assert readers.preview_dataset(spark, spec(), str(tmp_path)).dtypes == [
        ("a", "string"),
        ("b", "string"),
    ]
