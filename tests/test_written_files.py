"""JSON arrays in one file, and loads that can be repeated."""

import json
import random

import pytest

from ledgerleaf.sources import csv
from ledgerleaf.plans import profile
from ledgerleaf.sources.json_array import read_json_array, write_json_array
from ledgerleaf.sources.load_once import file_digests, load_once


@pytest.mark.parametrize("parts", [1, 5])
def test_json_array_is_one_sorted_array(spark, tmp_path, parts):
    rng = random.Random(parts)
    rows = [(rng.randrange(50), rng.choice(['a"b', "é\n", None, "漢,[]"]), i) for i in range(400)]
    df = spark.createDataFrame(rows, "ts long, name string, `part` int").repartition(parts)
    path = tmp_path / "trace.json"
    path.write_text("old")
    write_json_array(df, str(path), ["ts", "name"])
    found = json.loads(path.read_text())
    wanted = [{k: v for k, v in zip(("ts", "name", "part"), row, strict=True) if v is not None} for row in rows]
    assert sorted(map(str, found)) == sorted(map(str, wanted))
    keys = [(r["ts"], r.get("name") or "") for r in found]
    assert keys == sorted(keys)
    assert [p.name for p in tmp_path.iterdir()] == ["trace.json"]
    again = spark.read.schema(df.schema).option("multiLine", True).json(str(path))
    assert sorted(map(str, again.collect())) == sorted(map(str, df.collect()))


def test_json_array_is_read_by_several_tasks(spark, tmp_path):
    names = ['a"b,', "é\n", None, "漢,[]", "[", "]", "},", ""]
    rows = [(i, names[i % len(names)], None if i % 3 else i / 7) for i in range(20_000)]
    df = spark.createDataFrame(rows, "ts long, name string, d double").repartition(4)
    path = str(tmp_path / "a.json")
    write_json_array(df, path, ["ts"])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        found = read_json_array(spark, path, df.schema)
        assert found.rdd.getNumPartitions() > 4
        assert found.columns == df.columns
        assert sorted(map(str, found.collect())) == sorted(map(str, df.collect()))
        trace = profile.read_trace_array(spark, path, df.schema)
        assert trace.rdd.getNumPartitions() > 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    write_json_array(df.limit(0), path, ["ts"])
    assert read_json_array(spark, path, df.schema).count() == 0


def test_a_line_that_is_no_object_is_an_error(spark, tmp_path):
    (tmp_path / "a.json").write_text('[\n{"ts":1},\n{"ts":\n]\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        schema = spark.range(1).withColumnRenamed("id", "ts").schema
        read_json_array(spark, str(tmp_path / "a.json"), schema).collect()


def test_json_array_without_rows(spark, tmp_path):
    write_json_array(spark.createDataFrame([], "ts long"), f"file://{tmp_path}/a.json", ["ts"])
    assert json.loads((tmp_path / "a.json").read_text()) == []
    with pytest.raises(ValueError, match="shared folder"):
        write_json_array(spark.range(1), "s3://bucket/a.json", ["id"])


def test_a_repeated_load_gives_each_row_once(spark, tmp_path):
    schema = "id int, `a b` string"
    (tmp_path / "one.csv").write_text('id,a b\n1,"x\ny"\n1,"x\ny"\n')
    (tmp_path / "two.csv").write_text("id,a b\n2,z\n")
    (tmp_path / "same.csv").write_text("id,a b\n2,z\n")
    try:
        for names in (["one"], ["one"], ["one", "two", "same"], ["two"], ["same"]):
            paths = [str(tmp_path / f"{name}.csv") for name in names]
            table = load_once(spark, paths, "loaded_once", schema, path=str(tmp_path / "table"))
        assert table.columns == ["id", "a b"]
        assert sorted(map(tuple, table.collect())) == [(1, "x\ny"), (1, "x\ny"), (2, "z")]
        # A partition that was lost is loaded again, the others stay.
        digest = {r.file.rsplit("/", 1)[1]: r.digest for r in file_digests(spark, str(tmp_path / "*.csv")).collect()}
        assert digest["two.csv"] == digest["same.csv"] != digest["one.csv"]
        spark.sql(f"ALTER TABLE loaded_once DROP PARTITION (load_digest = '{digest['two.csv']}')")
        again = load_once(spark, str(tmp_path / "*.csv"), "loaded_once", schema)
        assert sorted(r.id for r in again.collect()) == [1, 1, 2]
    finally:
        spark.sql("DROP TABLE IF EXISTS loaded_once")


def test_digests_of_blocks(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"x" * 100)
    (tmp_path / "b").write_bytes(b"x" * 99 + b"y")
    (tmp_path / "c").write_bytes(b"")
    found = {r.file[-1]: r.digest for r in file_digests(spark, str(tmp_path), 7).collect()}
    assert sorted(found) == ["a", "b"] and found["a"] != found["b"]


def test_load_of_an_empty_file(spark, tmp_path):
    csv.write_csv(spark.createDataFrame([], "id int"), str(tmp_path / "none"))
    (tmp_path / "none" / "e.csv").write_text("id\n")
    try:
        assert load_once(spark, str(tmp_path / "none"), "loaded_none", "id int").collect() == []
    finally:
        spark.sql("DROP TABLE IF EXISTS loaded_none")
