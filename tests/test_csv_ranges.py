"""CSV files cut at any byte give the rows of the whole file."""

import csv as plain_csv
import datetime
import io
import random
from decimal import Decimal

import pytest

from ledgerleaf.sources import csv, csv_ranges

SCHEMA = "id int, text string, other string"


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def nasty_text(rng):
    pieces = ['"', '""', ",", "\n", "\r\n", "a", " ", "é", "\\", "漢字", '",\n"', "'", "#"]
    return "".join(rng.choice(pieces) for _ in range(rng.randrange(9)))


def test_every_range_size(tmp_path):
    """Each record of a file belongs to one range, wherever ranges begin."""
    rng = random.Random(1)
    out = io.StringIO()
    writer = plain_csv.writer(out, quoting=plain_csv.QUOTE_ALL, lineterminator="\n")
    rows = [[str(i), nasty_text(rng), nasty_text(rng)] for i in range(60)]
    writer.writerows([["id", "text", "other"], *rows])
    data = out.getvalue().encode()
    path = tmp_path / "a.csv"
    path.write_bytes(data)
    for size in [*range(1, 40), 97, 1000, len(data) - 1, len(data), len(data) + 9]:
        found = b""
        for start in range(0, len(data), size):
            inside = data[:start].count(b'"') % 2 == 1
            for batch in csv_ranges._records(str(path), start, min(len(data), start + size), inside):
                found += b"".join(batch.column(0).to_pylist())
        assert found == data, size


def test_chunks_within_a_range(tmp_path, monkeypatch):
    path = tmp_path / "a.csv"
    path.write_bytes(b'h\n"a\nb"\nc\n\n"d""\n"\nlast')
    for chunk in range(1, 25):
        monkeypatch.setattr(csv_ranges, "CHUNK_BYTES", chunk)
        batches = csv_ranges._records(str(path), 0, 100, False)
        found = [r for batch in batches for r in batch.column(0).to_pylist()]
        assert found == [b"h\n", b'"a\nb"\n', b"c\n", b"\n", b'"d""\n"\n', b"last"]


@pytest.mark.parametrize("range_bytes", [7, 64, 1 << 20])
def test_rows_of_several_files(spark, tmp_path, range_bytes):
    rng = random.Random(range_bytes)
    texts = [None, "", "  lead", "trail ", "two\nlines", '"', 'say "x"\n', "\r\n", "end\\", "long " * 50]
    rows = [(i, rng.choice([*texts, nasty_text(rng)]), rng.choice(texts)) for i in range(90)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    csv.write_csv(df, str(tmp_path / "out"))
    found = csv.read_csv(spark, str(tmp_path / "out"), SCHEMA, range_bytes=range_bytes)
    assert found.schema == df.schema
    key = lambda r: r[0]
    assert sorted(map(tuple, found.collect()), key=key) == rows


def test_types_and_line_ends(spark, tmp_path):
    schema = "id int, amount decimal(12,2), at timestamp, `day of` date, none string"
    moment = datetime.datetime(2020, 2, 29, 23, 59, 58, 123456)
    rows = [(i, Decimal("1.10"), moment, moment.date(), None) for i in range(5)]
    csv.write_csv(spark.createDataFrame(rows, schema), str(tmp_path / "out"))
    found = csv.read_csv(spark, str(tmp_path / "out"), schema, range_bytes=50)
    assert sorted(map(tuple, found.collect())) == rows and found.columns[3] == "day of"
    (tmp_path / "dos.csv").write_bytes(b'id,text,other\r\n1,"a\r\nb",c\r\n\r\n2,d,\r\n')
    found = csv.read_csv(spark, str(tmp_path / "dos.csv"), SCHEMA, range_bytes=5)
    assert sorted(map(tuple, found.collect())) == [(1, "a\r\nb", "c"), (2, "d", None)]


def test_one_file_is_many_tasks(spark, tmp_path):
    rows = spark.range(20_000).selectExpr("cast(id AS int) id", "concat('a\n', id) text", "'x' other")
    csv.write_csv(rows.coalesce(1), str(tmp_path / "out"))
    found = csv.read_csv(spark, str(tmp_path / "out"), SCHEMA, range_bytes=10_000)
    assert found.selectExpr("spark_partition_id() p").distinct().count() > 20
    assert found.exceptAll(rows).isEmpty() and found.count() == 20_000


def test_what_cannot_be_cut(spark, tmp_path):
    bad = {
        "open.csv": 'id,text,other\n1,"a,b\n2,c,d\n',
        "inner.csv": 'id,text,other\n1,5" pipe,b\n2,6" pipe,d\n',
        "short.csv": "id,text,other\nx,a,b\n",
    }
    for name, text in bad.items():
        (tmp_path / name).write_text(text)
        with pytest.raises(Exception, match="not closed|unquoted value|MALFORMED"):
            csv.read_csv(spark, str(tmp_path / name), SCHEMA, range_bytes=9).collect()
    (tmp_path / "a.csv.gz").write_bytes(b"x")
    with pytest.raises(ValueError, match="compressed"):
        csv.read_csv(spark, str(tmp_path / "a.csv.gz"), SCHEMA, range_bytes=9)
    for wrong in ({"schema": None}, {"schema": SCHEMA, "quoted_newlines": False}):
        with pytest.raises(ValueError, match="range_bytes"):
            csv.read_csv(spark, str(tmp_path / "open.csv"), **wrong, range_bytes=9)


def test_empty_files(spark, tmp_path):
    (tmp_path / "e.csv").write_text("")
    (tmp_path / "h.csv").write_text("id,text,other\n")
    assert csv.read_csv(spark, [str(tmp_path / n) for n in ("e.csv", "h.csv")], SCHEMA, range_bytes=4).collect() == []
    assert csv.read_csv(spark, str(tmp_path / "e.csv"), SCHEMA, range_bytes=4).collect() == []


def test_bulk_load_in_ranges(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,text,other\n1,"two\nlines",x\n2,plain,\n')
    try:
        table = csv.csv_to_table(
            spark, str(tmp_path / "a.csv"), "ranges", SCHEMA, path=str(tmp_path / "table"), range_bytes=8
        )
        assert sorted(map(tuple, table.collect())) == [(1, "two\nlines", "x"), (2, "plain", None)]
    finally:
        spark.sql("DROP TABLE IF EXISTS ranges")


def test_queries_read_files_with_line_breaks_by_ranges(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(csv, "RANGE_BYTES", 20_000)
    cut = []
    read = csv.read_csv_ranges

    def noted(spark, path, schema, options, range_bytes):
        cut.append(range_bytes)
        return read(spark, path, schema, options, range_bytes)

    monkeypatch.setattr(csv, "read_csv_ranges", noted)
    from ledgerleaf.workload.queries import QUERIES

    for name, table in (("csv_whitespace", "documents"), ("csv_text_roundtrip", "conversations")):
        rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
        assert QUERIES[name](spark, sf_dir).select(rows.columns[0]).count() == rows.count()
    assert cut == [20_000, 20_000]
