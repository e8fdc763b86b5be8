import datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerleaf import scratch
from ledgerleaf.plans.scenario_pack import scenario_pack
from ledgerleaf.sources import csv, tables


def test_csv_with_quoted_line_breaks(spark, tmp_path):
    path = tmp_path / "log.csv"
    path.write_text('Id,No,Details\n1,8169,"Run ""all""\nnext line"\n2,7473,plain\n3,,\n')
    df = csv.read_csv(spark, str(path))
    assert dict(df.dtypes) == {"Id": "int", "No": "int", "Details": "string"}
    assert [tuple(r) for r in df.collect()] == [
        (1, 8169, 'Run "all"\nnext line'), (2, 7473, "plain"), (3, None, None),
    ]


def test_csv_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a,"b"\nc', 1.5), (2, None, None)], "id int, text string, x double")
    csv.write_csv(df, str(tmp_path / "out"))
    back = csv.read_csv(spark, str(tmp_path / "out"), df.schema)
    assert sorted(map(tuple, back.collect())) == [(1, 'a,"b"\nc', 1.5), (2, None, None)]


def test_bulk_load_creates_then_appends(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,x\n2,y\n")
    for times in (1, 2):
        table = csv.csv_to_table(spark, str(tmp_path / "a.csv"), "loaded", path=str(tmp_path / "table"))
        assert table.count() == 2 * times
    assert dict(table.dtypes) == {"id": "int", "name": "string"}
    spark.sql("DROP TABLE loaded")


def test_read_table(spark, tmp_path):
    spark.createDataFrame([(1, "a", 2.0), (2, "b", 3.0)], "`group id` int, k string, v double").createOrReplaceTempView("rows_view")
    df = tables.read_table(spark, "rows_view", ["k", "v"], {"group id": 2})
    assert [tuple(r) for r in df.collect()] == [("b", 3.0)]
    assert tables.read_table(spark, "rows_view").count() == 2


def test_query_texts(spark, tmp_path):
    spark.range(5).createOrReplaceTempView("numbers")
    text = "SELECT id FROM IDENTIFIER(:t) WHERE id > :low -- comment"
    args = {"t": "numbers", "low": 2}
    assert tables.run_query_text(spark, text, args).columns == ["id"]
    (tmp_path / "q.sql").write_text(text)
    rows = tables.run_query_file(spark, str(tmp_path / "q.sql"), args).collect()
    assert [r.id for r in rows] == [3, 4]


def test_jdbc_arguments(spark):
    with pytest.raises(ValueError, match="either"):
        tables.read_jdbc(spark, "jdbc:x:y")
    with pytest.raises(ValueError, match="parts"):
        tables.read_jdbc(spark, "jdbc:x:y", query="SELECT 1", split_by=("id", 0, 9, 3))


def test_scenario_pack(spark):
    spark.createDataFrame(
        [(1, 0, 0, 5.0), (1, 1, 1, 7.0), (2, 1, 1, 9.0)], "ScnNumber int, RowNo int, Step int, death double"
    ).createOrReplaceTempView("cf_view")
    spark.createDataFrame(
        [(1, 0, 1.0), (1, 1, 0.9), (2, 5, 0.5)], "ScnNumber int, ProjMonth int, Discount_Factor double"
    ).createOrReplaceTempView("scn_view")
    pack = scenario_pack(spark, "cf_view", "scn_view")
    assert pack.joined.columns == [
        "ScnNumber", "RowNo", "Step", "death", "discount_ScnNumber", "ProjMonth", "Discount_Factor",
    ]
    assert sorted(r.death for r in pack.joined.collect()) == [5.0, 7.0]
    assert pack.total_death.first().total_death == 16.0
    assert pack.discount_count.first().cnt == 3


def test_settled_table_is_small_enough_to_broadcast(spark):
    big = spark.range(1000)
    small = scratch.settle(big.groupBy((F.col("id") % 3).alias("k")).count())
    assert small.count() == 3
    plan = big.join(small, big.id == small.k)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_scratch_is_below_the_configured_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch.scratch_path(spark, "x"), scratch.scratch_path(spark, "x")
    assert first.startswith(root + "/x-") and first != second


def test_paths_get_the_scheme_of_the_default_file_system(spark):
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    before = hadoop.get("fs.defaultFS")
    assert scratch.qualified(spark, "/a/b") == "/a/b"
    hadoop.set("fs.defaultFS", "hdfs://host:8020/")
    try:
        assert scratch.qualified(spark, "/a/b") == "hdfs://host:8020/a/b"
        assert scratch.qualified(spark, "s3a://bucket/b") == "s3a://bucket/b"
    finally:
        hadoop.set("fs.defaultFS", before)


def _stored(spark):
    return {p.name.rsplit("-", 1)[0] for p in Path(spark.conf.get("spark.checkpoint.dir")).glob("passing*")}


def test_passing_tables_go_at_the_end_of_their_block(spark):
    with scratch.passing_tables(spark):
        first = scratch.settle(spark.range(5), "passing-a")
        with scratch.passing_tables(spark):
            scratch.settle(first, "passing-b")
            kept = scratch.settle_outside(first.where("id > 2"), "passing-c")
        assert _stored(spark) == {"passing-a", "passing-c"}
        result = scratch.settle_outside(kept, "passing-d")
    assert _stored(spark) == {"passing-d"} and result.count() == 2
    with pytest.raises(ZeroDivisionError), scratch.passing_tables(spark):
        1 / 0
    with scratch.noted_tables() as paths:
        noted = scratch.settle(spark.range(1), "passing-f")
    assert scratch.reads_any(noted.select("id"), paths) and not scratch.reads_any(result, paths)
    assert not scratch.reads_any(noted, [])
    assert _stored(spark) == {"passing-d", "passing-f"}
    for _ in range(2):
        scratch.remove_tables(spark, paths)
        assert _stored(spark) == {"passing-d"}


class _Cluster:
    """Stands for a session on a cluster without the setting."""

    class conf:  # noqa: N801
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:  # noqa: N801
        master = "spark://host:7077"


def test_cluster_needs_the_setting():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.shared_root(_Cluster)


NASTY = [
    "  lead", "trail  ", "a\n\n", " ", "", None, 'say "x"', "back\\slash\\", 'end\\"', "a,b",
    "\r\n line", "tab\t", "#no comment", "'single'", "é漢", '"', "\\N", "null",
]


@pytest.mark.parametrize("quoted_newlines", [True, False])
def test_csv_keeps_every_value(spark, tmp_path, quoted_newlines):
    texts = [t for t in NASTY if quoted_newlines or not t or not {"\n", "\r"} & set(t)]
    moment = datetime.datetime(2020, 2, 29, 23, 59, 58, 123456)
    rows = [(i, t, Decimal("1.10"), moment, moment.date(), None) for i, t in enumerate(texts)]
    schema = "id int, text string, amount decimal(12,2), at timestamp, day date, none string"
    df = spark.createDataFrame(rows, schema)
    csv.write_csv(df, str(tmp_path / "out"))
    back = csv.read_csv(spark, str(tmp_path / "out"), df.schema, quoted_newlines)
    assert sorted(back.collect()) == sorted(df.collect(), key=lambda r: r.id)


def test_bulk_load_keeps_quoted_breaks_and_types(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,code,note\n1,007,"two\nlines"\n2,8,plain\n')
    (tmp_path / "b.csv").write_text("id,code,note\n3,abc,x\n")
    name = "bulk_types"
    try:
        first = csv.csv_to_table(
            spark, str(tmp_path / "a.csv"), name, "id int, code string, note string",
            path=str(tmp_path / "table"),
        )
        assert sorted(tuple(r) for r in first.collect()) == [(1, "007", "two\nlines"), (2, "8", "plain")]
        again = csv.csv_to_table(spark, str(tmp_path / "b.csv"), name)
        assert (3, "abc", "x") in [tuple(r) for r in again.collect()]
        with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
            csv.csv_to_table(spark, str(tmp_path / "a.csv"), name, quoted_newlines=False).collect()
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
