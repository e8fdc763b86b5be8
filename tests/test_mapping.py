import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerleaf.operators import coverage, mapping
from ledgerleaf.plans.policies import add_policy_info
from ledgerleaf.scratch import noted_tables

TAGS = "tag_plan_code string, tag_gender string, tag_risk_class string"


def _python_matches(cell, tags):
    """Python's own matching of one cell against one mapping row."""
    key, pattern = ("~".join("nan" if v is None else v for v in part) for part in (cell, tags))
    return re.match("^" + pattern + "$", key)


def test_map_of_many_cells(spark):
    plans = [("QX7", "u", "K"), ("QX8", "v", "t"), ("ZZ1", "u", "L")]
    cells = spark.range(3000).select(
        *[
            F.element_at(F.array(*[F.lit(p[i]) for p in plans]), (F.col("id") % 3 + 1).cast("int")).alias(tag)
            for i, tag in enumerate(["tag_plan_code", "tag_gender", "tag_risk_class"])
        ],
        F.lit("").alias("table_premium"),
    )
    keys = [("QX7", g, r) for g in "uv" for r in "KLM"] + [(p, ".*", ".*") for p in ("QX8", "ZZ1")]
    rows = [(*k, "Rate_" + "_".join(k), "Min_" + "_".join(k)) for k in keys]
    table = spark.createDataFrame(rows, TAGS + ", table_premium string, table_min_premium string")
    result = mapping.map_with_wildcard(cells, table)
    assert result.columns == [
        "tag_plan_code", "tag_gender", "tag_risk_class", "table_premium", "table_min_premium",
    ]
    found = {r.table_premium: r["count"] for r in result.groupBy("table_premium").count().collect()}
    assert found == {
        "Rate_QX7_u_K": 1000,
        "Rate_QX8_.*_.*": 1000,
        "Rate_ZZ1_.*_.*": 1000,
    }


def test_wildcards_like_python(spark):
    values = ["A", "AB", "a", "a~b", "b~c", "c", "", "x\n", "1.5", None]
    cells = [(i * 10 + j, a, b) for i, a in enumerate(values) for j, b in enumerate(values)]
    rows = [
        ("A", "AB", "plain"),
        ("A", ".*", "one wildcard"),
        (".*", ".*", "all"),
        ("A.?", "1.5", "dot is any"),
        ("A|AB", "1.5", "alternatives split the whole key"),
        ("(A", "B?)", "group over both tags"),
        ("[A-Z]+", "", "class"),
        ("a", "b", "separator in the value"),
        ("a~b", "c", "same text from other tags"),
        ("a", "b~c", "same text again"),
        ("", "~?A", "separator in the pattern"),
        (None, "A", "missing tag"),
        ("AB", "x", "line feed at the end"),
        ("A", "*B", "quantified separator"),
        ("A", "AB", "same pattern again"),
    ]
    cell_table = spark.createDataFrame(cells, "id int, tag_a string, tag_b string")
    row_table = spark.createDataFrame(rows, "tag_a string, tag_b string, found string")
    result = mapping.map_with_wildcard(cell_table, row_table)
    wanted = [(*c, r[2]) for c in cells for r in rows if _python_matches(c[1:], r[:2])]
    mine = [(r.id, r.tag_a, r.tag_b, r.found) for r in result.collect()]
    assert sorted(mine, key=str) == sorted(wanted, key=str)


def test_mapping_needs_its_tags(spark):
    cells = spark.createDataFrame([("a",)], "tag_a string")
    rows = spark.createDataFrame([("a", "b", "x")], "tag_a string, tag_b string, found string")
    with pytest.raises(ValueError, match="tag_b"):
        mapping.map_with_wildcard(cells, rows)


def test_regex_join_like_python(spark):
    keys = ["abc", "xabc", "ab\n", "b|c", "a", ""]
    patterns = [
        "abc", "^ab$", "a|x", "[ab].*", "b\\|c", "z", ".*c$",
        "abcd?", "abx*", "a{0}b", "a+b", "^a$", "", "xab", "(?i)ABC", "abc$", "^^ab", "a\\.",
    ]
    main = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id int, key string")
    table = spark.createDataFrame([(p, f"n{i}") for i, p in enumerate(patterns)], "pattern string, name string")
    result = mapping.regex_join(main, table, "key", "pattern")
    assert result.columns == ["id", "key", "pattern", "name"]
    wanted = [
        (i, k, p, f"n{j}")
        for i, k in enumerate(keys)
        for j, p in enumerate(patterns)
        if re.match(p, k)
    ]
    assert sorted(tuple(r) for r in result.collect()) == sorted(wanted)


def test_regex_join_without_match_is_empty(spark):
    main = spark.createDataFrame([("a",)], "key string")
    table = spark.createDataFrame([("b", 1)], "pattern string, n int")
    assert mapping.regex_join(main, table, "key", "pattern").count() == 0


def test_regex_join_stores_pairs_of_patterns_that_repeat_only_once(spark):
    main = spark.range(100).select("id", F.format_string("key%03d", "id").alias("k"))
    texts = F.element_at(F.array(*[F.lit(p) for p in (".*[0-4].*", "key0.*", "k.*9")]), (F.col("id") % 3 + 1).cast("int"))
    patterns = spark.range(150).select(texts.alias("p"), F.col("id").alias("n"))
    with noted_tables() as paths:
        result = mapping.regex_join(main, patterns, "k", "p").count()
    assert result == 50 * sum(bool(re.match(p, f"key{i:03d}")) for i in range(100) for p in (".*[0-4].*", "key0.*", "k.*9"))
    stored = max(spark.read.parquet(path).count() for path in paths)
    assert stored * 10 < result


def test_regex_join_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(mapping, "PIECE_ROWS", 3)
    monkeypatch.setattr(mapping, "ROWS_PER_TASK", 10)
    keys = ["abc", "abd", "xab", "abc", None, "", "zz", "abe", "abf", "ab\n"]
    patterns = ["ab.*"] * 11 + [".b"] * 4 + ["", None, "never", "[a-x]+c", "zz|abc", "zz|abc"]
    main = spark.createDataFrame([(i, {k or "": i}, k) for i, k in enumerate(keys)], "id int, `m.x` map<string,int>, `the.key` string")
    table = spark.createDataFrame([(i // 2, p) for i, p in enumerate(patterns)], "_left int, pattern string")
    result = mapping.regex_join(main, table, "the.key", "pattern")
    assert result.columns == ["id", "m.x", "the.key", "_left", "pattern"]
    wanted = [
        (i, {k: i}, k, j // 2, p)
        for i, k in enumerate(keys)
        for j, p in enumerate(patterns)
        if k is not None and p is not None and re.match(p, k)
    ]
    assert sorted((tuple(r) for r in result.collect()), key=repr) == sorted(wanted, key=repr)


def test_coverage(spark):
    rows = spark.createDataFrame(
        [(34, "m", "R0"), (33, "f", "R0"), (40, "m", "R1")], "age int, gender string, rating string"
    )
    combos = coverage.combos(rows, ["age", "gender"])
    assert sorted(r.combo for r in combos.collect()) == ["33|f", "34|m", "40|m"]
    more = combos.unionByName(spark.createDataFrame([("ss",), ("ss",)], "combo string"))
    assert [r.combo for r in coverage.missing_combos(more, combos).collect()] == ["ss"]
    assert coverage.covers_all(combos, combos).first().covered is True
    assert coverage.covers_all(more, combos).first().covered is False
    with pytest.raises(ValueError, match="ddd"):
        coverage.combos(rows, ["ddd"])


def test_coverage_agrees_with_the_map(spark):
    """Without wildcards, the missing combinations are those the mapping leaves out."""
    cells = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1"), (None, "1")], "tag_x string, tag_y string")
    rows = spark.createDataFrame([("a", "1", "f"), ("b", "1", "g")], "tag_x string, tag_y string, v string")
    missing = coverage.check_coverage(cells, rows, {"g": ["tag_x", "tag_y"]})
    assert sorted(r.combo for r in missing.collect()) == ["a|2", "nan|1"]
    assert mapping.map_with_wildcard(cells, rows).count() == 2


def test_exists_flag(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    right = spark.createDataFrame([(2,), (2,), (3,)], "ref int")
    flagged = {r.id: r.there for r in mapping.exists_flag(left, "id", right, "ref", "there").collect()}
    assert flagged == {1: False, 2: True, None: False}


def test_policy_info(spark):
    schema = "policy_id string, lpolicy_id string"
    rows = spark.createDataFrame([("aaa", "aaa"), ("bbb", "x"), ("ccc", None)], schema)
    found = [(r.stat_code, r.system) for r in add_policy_info(rows).collect()]
    assert found == [("CSO80", "flex"), ("CET80", "mips"), ("CET80", "schd")]
    unknown = spark.createDataFrame([("zzz", "aaa")], schema)
    assert add_policy_info(unknown, strict=False).first().system is None
    with pytest.raises(PySparkException, match="no entry for key zzz"):
        add_policy_info(unknown).collect()


def test_null_keys_and_patterns_match_nothing(spark):
    main = spark.createDataFrame([("ab",), (None,), ("",)], "k string")
    patterns = spark.createDataFrame([("a.*", 1), (None, 2), ("", 3), (".b", 4)], "p string, n int")
    found = mapping.regex_join(main, patterns, "k", "p").collect()
    assert sorted((r.k, r.n) for r in found) == [("", 3), ("ab", 1), ("ab", 3), ("ab", 4)]
    nothing = mapping.regex_join(main, patterns.where("p is null"), "k", "p")
    assert nothing.count() == 0


def test_own_names_are_refused(spark):
    frame = spark.createDataFrame([("a", "b")], "_key string, k string")
    with pytest.raises(ValueError):
        mapping.regex_join(frame, frame.selectExpr("k as p"), "k", "p")


def test_no_cartesian_product_without_broadcast(spark, capsys, monkeypatch):
    monkeypatch.setattr(mapping, "PATTERNS_PER_CHUNK", 2)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        main = spark.createDataFrame([(f"key{i}",) for i in range(30)], "k string")
        rows = [(p,) for p in (".*1$", "key[2-4]$", "key5", ".e", "[a-k]ey6$")]
        found = mapping.pattern_pairs(
            main.select(F.col("k").alias("_key")), spark.createDataFrame(rows, "_pattern string")
        )
        wanted = sum(bool(re.match(p, f"key{i}")) for i in range(30) for (p,) in rows)
        assert found.count() == wanted
        found.explain()
        plan = capsys.readouterr().out
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
