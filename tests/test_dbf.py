import datetime
import struct
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerleaf.sources import dbf, manifest

SAMPLE = [
    (11, "Quay", 61, 1250.5, False, datetime.date(1999, 12, 31)),
    (12, "Fjord", 44, 98.25, True, datetime.date(2004, 2, 29)),
    (13, "Moor", 19, 0.0, True, datetime.date(2012, 6, 1)),
    (14, "Isthmus", 7, 31007.75, False, datetime.date(2015, 10, 9)),
    (15, "Dell", 52, -4.5, True, datetime.date(2023, 3, 3)),
]
SCHEMA = "ID long, NAME string, AGE long, SALARY double, ACTIVE boolean, HIRE_DATE date"
SPECS = {
    "ID": {"type": "N", "length": 9, "decimal": 0},
    "NAME": {"type": "C", "length": 24},
    "AGE": {"type": "N", "length": 3, "decimal": 0},
    "SALARY": {"type": "F", "length": 11, "decimal": 3},
    "ACTIVE": {"type": "L", "length": 1},
    "HIRE_DATE": {"type": "D", "length": 8},
}


def _file(path, fields, records, n_records=None, tail=b"\x1a"):
    """A DBF file put together by hand from the published layout."""
    length = 1 + sum(f[2] for f in fields)
    header = struct.pack(
        "<BBBBIHH20s", 3, 123, 4, 5, len(records) if n_records is None else n_records,
        32 + 32 * len(fields) + 1, length, b"",
    )
    descriptors = b"".join(
        struct.pack("<11sc4sBB14s", name.encode("latin-1"), kind.encode(), b"", size, decimals, b"")
        for name, kind, size, decimals in fields
    )
    path.write_bytes(header + descriptors + b"\r" + b"".join(records) + tail)
    return str(path)


@pytest.mark.parametrize("specs", [None, SPECS])
def test_roundtrip(spark, tmp_path, specs):
    df = spark.createDataFrame(SAMPLE, SCHEMA)
    dbf.write_dbf(df, str(tmp_path), specs)
    back = dbf.read_dbf(spark, str(tmp_path))
    assert back.schema.simpleString() == df.schema.simpleString()
    assert sorted(tuple(r) for r in back.collect()) == SAMPLE


def test_written_bytes(spark, tmp_path):
    dbf.write_dbf(spark.createDataFrame(SAMPLE, SCHEMA).coalesce(1), str(tmp_path), SPECS)
    (file,) = tmp_path.glob("*.dbf")
    data = file.read_bytes()
    assert struct.unpack("<IHH", data[4:12]) == (5, 32 + 6 * 32 + 1, 57)
    assert data[32:43] == b"ID" + b"\0" * 9 and data[43:44] == b"N"
    assert data[32 + 6 * 32] == 0x0D and data[-1] == 0x1A
    first = data[225:282]
    assert first == b" " + b"       11" + b"Quay".ljust(24) + b" 61" + b"   1250.500" + b"F" + b"19991231"


def test_hand_made_file(spark, tmp_path):
    fields = [
        ("CODE", "C", 4, 0), ("NUM", "N", 5, 0), ("AMT", "N", 8, 2),
        ("OK", "L", 1, 0), ("DAY", "D", 8, 0), ("NOTE", "M", 4, 0), ("ODD", "G", 2, 0),
    ]
    records = [
        b" ab  " + b"   12" + b"    1.50" + b"y" + b"20230131" + b"memo" + b"zz",
        b"*del " + b"   99" + b"    9.99" + b"T" + b"20230131" + b"gone" + b"zz",
        b" \xe9t  " + b"     " + b"        " + b" " + b"20231331" + b"    " + b"  ",
        b" x   " + b"   -3" + b"-1.00e+1" + b"0" + b"2023    " + b"\t  \n" + b" z",
    ]
    path = _file(tmp_path / "a.dbf", fields, records)
    df = dbf.read_dbf(spark, path)
    assert dict(df.dtypes) == {
        "CODE": "string", "NUM": "bigint", "AMT": "double", "OK": "boolean",
        "DAY": "date", "NOTE": "string", "ODD": "string",
    }
    assert [tuple(r) for r in df.collect()] == [
        ("ab", 12, 1.5, True, datetime.date(2023, 1, 31), "memo", "zz"),
        ("ét", None, None, None, None, None, None),
        ("x", -3, -10.0, False, None, None, "z"),
    ]
    assert dbf.read_dbf(spark, path, limit=2).count() == 2


def test_long_whole_numbers_are_decimals(spark, tmp_path):
    path = _file(tmp_path / "a.dbf", [("BIG", "N", 20, 0)], [b" " + b"12345678901234567890"])
    df = dbf.read_dbf(spark, path)
    assert dict(df.dtypes) == {"BIG": "decimal(20,0)"}
    assert int(df.first().BIG) == 12345678901234567890


def test_bad_value(spark, tmp_path):
    path = _file(tmp_path / "a.dbf", [("NUM", "N", 4, 0)], [b"   1x", b"   12", b" 1.50"])
    with pytest.raises(PySparkException, match="field NUM: not a number"):
        dbf.read_dbf(spark, path).collect()
    values = [r.NUM for r in dbf.read_dbf(spark, path, mode=dbf.PERMISSIVE).collect()]
    assert values == [None, 12, None]
    with pytest.raises(ValueError, match="mode"):
        dbf.read_dbf(spark, path, mode="LOOSE")


def test_bad_descriptor(spark, tmp_path):
    fields = [("A", "C", 2, 0), ("\x01\x02", "C", 2, 0)]
    path = _file(tmp_path / "a.dbf", fields, [b" aabb"])
    with pytest.raises(ValueError, match="cannot be read"):
        dbf.read_dbf(spark, path)
    assert [tuple(r) for r in dbf.read_dbf(spark, path, mode=dbf.PERMISSIVE).collect()] == [("aa",)]


def test_short_file(spark, tmp_path):
    path = _file(tmp_path / "a.dbf", [("A", "C", 2, 0)], [b" aa", b" bb"], n_records=5, tail=b" c")
    with pytest.raises(PySparkException, match="2 whole records"):
        dbf.read_dbf(spark, path).collect()
    assert dbf.read_dbf(spark, path, mode=dbf.PERMISSIVE).count() == 2


def test_ranges_cover_every_record_once(spark, tmp_path):
    df = spark.range(1000).select(F.col("id").alias("ID"), F.lpad(F.col("id"), 7, "0").alias("T"))
    dbf.write_dbf(df.repartition(3), str(tmp_path))
    for size in (100, 999, 4096):
        back = dbf.read_dbf(spark, str(tmp_path), range_bytes=size)
        assert sorted(tuple(r) for r in back.collect()) == [(i, f"{i:07d}") for i in range(1000)]
    assert dbf.read_dbf(spark, str(tmp_path), range_bytes=999).rdd.getNumPartitions() > 10


def test_small_files_share_a_task(spark, tmp_path):
    dbf.write_dbf(spark.range(40).withColumnRenamed("id", "ID").repartition(20), str(tmp_path))
    assert len(list(tmp_path.glob("*.dbf"))) > 5
    assert dbf.read_dbf(spark, str(tmp_path)).rdd.getNumPartitions() == 1


def test_large_parts_are_cut_into_files(spark, tmp_path):
    df = spark.range(100).withColumnRenamed("id", "ID").coalesce(1)
    fields = dbf.infer_fields(df)
    spark.dataSource.register(dbf.DbfRecords)
    dbf.encode_records(df, fields).write.format("dbf_records").mode("overwrite").options(
        fields=dbf._fields_json(fields), fileBytes=19 * 30
    ).save(str(tmp_path))
    assert len(list(tmp_path.glob("*.dbf"))) == 4
    assert sorted(r.ID for r in dbf.read_dbf(spark, str(tmp_path)).collect()) == list(range(100))


def test_overwrite_leaves_no_old_files(spark, tmp_path):
    for n in (30, 2):
        dbf.write_dbf(spark.range(n).withColumnRenamed("id", "ID"), str(tmp_path))
    assert dbf.read_dbf(spark, str(tmp_path)).count() == 2
    assert not list(tmp_path.glob("_staging*"))


def test_failed_write_keeps_the_old_files(spark, tmp_path):
    dbf.write_dbf(spark.range(3).withColumnRenamed("id", "ID"), str(tmp_path))
    wide = spark.range(10, 100_000, 9_000).withColumnRenamed("id", "ID")
    with pytest.raises(PySparkException, match="wider than 3"):
        dbf.write_dbf(wide, str(tmp_path), {"ID": {"type": "N", "length": 3}})
    assert dbf.read_dbf(spark, str(tmp_path)).count() == 3
    assert not list(tmp_path.glob("_staging*"))


def test_no_rows(spark, tmp_path):
    dbf.write_dbf(spark.createDataFrame([], SCHEMA), str(tmp_path))
    back = dbf.read_dbf(spark, str(tmp_path))
    assert back.count() == 0 and "NAME" in back.columns


def test_files_must_agree(spark, tmp_path):
    _file(tmp_path / "a.dbf", [("A", "C", 2, 0)], [b" aa"])
    _file(tmp_path / "b.dbf", [("B", "C", 2, 0)], [b" bb"])
    with pytest.raises(PySparkException, match="other fields"):
        dbf.read_dbf(spark, str(tmp_path)).collect()


def test_names_are_cut_and_must_stay_different(spark, tmp_path):
    df = spark.createDataFrame([("a", "b")], "long_name_one string, long_name_two string")
    with pytest.raises(ValueError, match="collide"):
        dbf.write_dbf(df.toDF("same_start_1", "same_start_2"), str(tmp_path / "y"))
    dbf.write_dbf(df.toDF("customer_segment", "b"), str(tmp_path / "z"))
    assert dbf.read_dbf(spark, str(tmp_path / "z")).columns == ["customer_s", "b"]


def test_inferred_fields(spark):
    df = spark.createDataFrame(
        [("x" * 300, None, 1, 1.0, True, datetime.date(2020, 1, 1), [1])],
        "a string, b string, c int, d float, e boolean, f date, g array<int>",
    )
    fields = {f.name: (f.type, f.length, f.decimals) for f in dbf.infer_fields(df, cut=True)}
    assert fields == {
        "a": ("C", 254, 0), "b": ("C", 10, 0), "c": ("N", 18, 0), "d": ("F", 20, 6),
        "e": ("L", 1, 0), "f": ("D", 8, 0), "g": ("C", 50, 0),
    }


def test_pruned_fields_are_not_decoded(spark, tmp_path):
    dbf.write_dbf(spark.createDataFrame(SAMPLE, SCHEMA), str(tmp_path))
    plan = dbf.read_dbf(spark, str(tmp_path)).select("AGE")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ISO-8859-1") == 1


def test_catalog(spark, tmp_path):
    good = _file(tmp_path / "a.dbf", [("A", "C", 2, 0), ("B", "N", 8, 2)], [b" aa    1.00"])
    (tmp_path / "a.cdx").write_bytes(b"12345")
    bad = tmp_path / "b.dbf"
    bad.write_bytes(b"short")
    rows = dbf.dbf_catalog(spark, str(tmp_path)).collect()
    fields = sorted((r.field_no, r.field_name, r.field_type, r.field_length, r.field_decimals) for r in rows if not r.error)
    assert fields == [(1, "A", "C", 2, 0), (2, "B", "N", 8, 2)]
    described = next(r for r in rows if r.field_no == 1)
    assert (described.record_count, described.index_exists, described.index_size) == (1, True, 5)
    assert [r.error for r in rows if r.error] == ["header has 5 bytes instead of 32"]
    listed = {r.path: r for r in dbf.dbf_catalog(spark, [good, str(tmp_path / "none.dbf")]).collect()}
    assert listed[good].file_exists and not listed[str(tmp_path / "none.dbf")].file_exists


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.integers(-(10**17) + 1, 10**17),
            st.text(alphabet="abZ 09.,~", max_size=12),
            st.one_of(st.none(), st.integers(-(10**9), 10**9).map(lambda i: i / 64)),
            st.one_of(st.none(), st.booleans()),
            st.one_of(st.none(), st.dates(datetime.date(1600, 1, 1))),
        ),
        min_size=1,
        max_size=25,
    )
)
def test_any_rows_roundtrip(spark, tmp_path_factory, rows):
    path = str(tmp_path_factory.mktemp("dbf"))
    df = spark.createDataFrame(rows, "I long, T string, D double, L boolean, W date")
    dbf.write_dbf(df, path)
    wanted = [(i, t.strip() or None, d, flag, day) for i, t, d, flag, day in rows]
    back = [tuple(r) for r in dbf.read_dbf(spark, path).collect()]
    assert sorted(back, key=str) == sorted(wanted, key=str)


def test_values_that_do_not_fit_are_errors(spark, tmp_path):
    long_text = spark.createDataFrame([("x" * 300,)], "A string")
    with pytest.raises(ValueError, match="300 characters"):
        dbf.write_dbf(long_text, str(tmp_path / "a"))
    dbf.write_dbf(long_text, str(tmp_path / "b"), cut=True)
    assert len(dbf.read_dbf(spark, str(tmp_path / "b")).first().A) == 254
    with pytest.raises(Exception, match="MALFORMED_CHARACTER_CODING|漢|unmappable"):
        dbf.write_dbf(spark.createDataFrame([("漢",)], "A string"), str(tmp_path / "c"))
    third = spark.createDataFrame([(1 / 3 * 1e-9,)], "A double")
    with pytest.raises(PySparkException, match="more than 15 decimals"):
        dbf.write_dbf(third, str(tmp_path / "d"))


def test_exact_values_come_back(spark, tmp_path):
    moment = datetime.datetime(2020, 1, 2, 3, 4, 5, 678901)
    rows = [("é", 1.23456789, Decimal("12.345"), moment, ["a", "b"])]
    df = spark.createDataFrame(rows, "T string, D double, M decimal(9,3), S timestamp, L array<string>")
    dbf.write_dbf(df, str(tmp_path))
    back = dbf.read_dbf(spark, str(tmp_path)).first()
    assert (back.T, back.D, back.M) == ("é", 1.23456789, 12.345)
    assert back.S == "2020-01-02 03:04:05.678901" and back.L == "[a, b]"


# --- writes are seen as a whole ----------------------------------------------


def numbers_of(spark, path):
    return sorted(r.ID for r in dbf.read_dbf(spark, str(path)).collect())


def test_files_without_a_list_entry_do_not_count(spark, tmp_path):
    dbf.write_dbf(spark.range(3).withColumnRenamed("id", "ID"), str(tmp_path))
    (tmp_path / "part-other.dbf").write_bytes(next(tmp_path.glob("*.dbf")).read_bytes())
    assert numbers_of(spark, tmp_path) == [0, 1, 2]


def test_reading_during_an_overwrite(spark, tmp_path):
    old = spark.range(8).withColumnRenamed("id", "ID")
    dbf.write_dbf(old.repartition(4), str(tmp_path))
    fields = dbf.infer_fields(old)
    new = dbf.encode_records(spark.range(20, 25).withColumnRenamed("id", "ID"), fields)
    options = {"path": str(tmp_path), "fields": dbf._fields_json(fields), "keepversions": "1"}
    writer = dbf._RecordWriter(options, overwrite=True)
    begun = dbf._RecordReader({"path": str(tmp_path), "fields": options["fields"], "rangebytes": "999"})
    parts = begun.partitions()
    written = [writer.write(iter([batch])) for batch in new.toArrow().to_batches()]
    writer.write(iter(new.toArrow().to_batches()))  # an attempt whose result is not used
    assert numbers_of(spark, tmp_path) == list(range(8))
    writer.commit(written)
    assert numbers_of(spark, tmp_path) == list(range(20, 25))
    assert sum(batch.num_rows for part in parts for batch in begun.read(part)) == 8
    dbf.write_dbf(old.limit(2), str(tmp_path))
    listed = manifest.current_files(*dbf.open_path(str(tmp_path)))
    assert {p.name for p in tmp_path.glob("*.dbf")} == {name for name, _ in listed}
    assert len(list(tmp_path.glob("_*"))) == 1


def test_append_and_abort(spark, tmp_path):
    first = spark.range(3).withColumnRenamed("id", "ID")
    fields = dbf.infer_fields(first)
    plain = tmp_path / "sub"
    dbf.write_dbf(first, str(plain))
    next(plain.glob("_manifest*")).unlink()  # files that no list names, in a folder below
    options = {"path": str(tmp_path), "fields": dbf._fields_json(fields)}
    batches = dbf.encode_records(first, fields).toArrow().to_batches()
    failed = dbf._RecordWriter(options, overwrite=True)
    failed.write(iter(batches))
    failed.abort([])
    assert not list(tmp_path.glob("*.dbf")) and not list(tmp_path.glob("_*"))
    assert numbers_of(spark, tmp_path) == [0, 1, 2]
    added = dbf._RecordWriter(options, overwrite=False)
    added.commit([added.write(iter(batches))])
    assert numbers_of(spark, tmp_path) == [0, 0, 1, 1, 2, 2]
