import random
import tracemalloc

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerleaf.functions import text
from ledgerleaf.functions.text import lcs_length, lcs_text
from ledgerleaf.plans import notes, snapshots
from ledgerleaf.workload.queries import QUERIES


def _table(left, right):
    best = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
    for i, a in enumerate(left, 1):
        for j, b in enumerate(right, 1):
            best[i][j] = best[i - 1][j - 1] + 1 if a == b else max(best[i - 1][j], best[i][j - 1])
    return best


def _text(left, right, best):
    """The defined choice: equal ends are taken, and ties drop the end of the left text."""
    i, j, taken = len(left), len(right), ""
    while i and j:
        if left[i - 1] == right[j - 1]:
            taken, i, j = left[i - 1] + taken, i - 1, j - 1
        elif best[i][j - 1] > best[i - 1][j]:
            j -= 1
        else:
            i -= 1
    return taken


def _check(spark, pairs):
    df = spark.createDataFrame(pairs, "a string, b string")
    rows = df.select("a", "b", lcs_length(F.col("a"), F.col("b")).alias("n"), lcs_text(F.col("a"), F.col("b")).alias("t"))
    for r in rows.collect():
        if r.a is None or r.b is None:
            assert r.n is None and r.t is None
            continue
        best = _table(r.a, r.b)
        assert (r.n, r.t) == (best[-1][-1], _text(r.a, r.b, best))


def test_common_subsequence_examples(spark):
    _check(spark, [("ABCBDAB", "BDCABA"), ("sunday", "saturday"), ("", "x"), ("x", ""), ("a", None), (None, "a"), ("a_b", "a_b")])


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.text("abcé😀", max_size=14), st.text("abcé😀", max_size=14)), min_size=1, max_size=40))
def test_common_subsequence_of_any_texts(spark, pairs):
    _check(spark, pairs)


def test_common_subsequence_of_long_texts(spark):
    rng = random.Random(3)
    long = ["".join(rng.choice("abcd ") for _ in range(900)) for _ in range(4)]
    _check(spark, [(long[0], long[1]), (long[2], long[3])])


LIEN = "LTCC: $3,540.50(M), $7,081.00(C) LIEN MMDDYYYY"


@pytest.mark.parametrize(
    ("lines", "amount"),
    [
        ([LIEN], 7081.0),
        (["opened", "paid"], 0.0),
        ([], 0.0),
        ([LIEN, "LTCC: $1.00(M), $12,345,678.25(C) LIEN x", "closed"], 12345678.25),
        ([LIEN, "LIEN released"], 0.0),
        ([LIEN, "lien released"], 7081.0),
        (["LTCC: $5(C) $7.5(C) LIEN LIEN"], 7.5),
        (["LTCC: $ 8 (C) LIEN"], 8.0),
        ([LIEN, "LTCC: $oops(C) LIEN"], None),
    ],
)
def test_latest_lien(spark, lines, amount):
    for end in ("\n", "\r\n"):
        whole = spark.createDataFrame([("p", end.join(lines))], "policy_id string, text string")
        assert notes.latest_lien(whole).first().lien_amount == amount
    rows = [("p", i, line) for i, line in enumerate(lines)] or [("p", 0, "")]
    split = spark.createDataFrame(rows[::-1], "policy_id string, line_no int, line string")
    assert notes.latest_lien_of_lines(split).first().lien_amount == amount


def test_lines_are_aggregated_by_hashing(spark):
    df = spark.createDataFrame([("p", 1, LIEN)], "policy_id string, line_no int, line string")
    plan = notes.latest_lien_of_lines(df)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_null_note(spark):
    df = spark.createDataFrame([("p", None)], "policy_id string, text string")
    assert notes.latest_lien(df).first().lien_amount == 0


MODULES = "name string, text string"


@pytest.fixture(scope="module")
def snapshot_tables(spark):
    old = spark.createDataFrame([("Mod1", "a\n"), ("Mod2", "b"), ("Gone", "x")], MODULES)
    new = spark.createDataFrame(
        [("Mod1", "a\n"), ("Mod2", "B"), ("Mod3", "c"), ("Empty", ""), ("Sheet1", "d"), ("None", None)], MODULES
    )
    return old, new


def test_snapshot_status(snapshot_tables):
    old, new = snapshot_tables
    kept = snapshots.snapshot_diff(old, new, exclude="^sheet")
    assert {r.name: r.status for r in kept.collect()} == {"Mod1": "Unchanged", "Mod2": "Conflict", "Mod3": "New"}
    forced = snapshots.snapshot_diff(old, new, force=True)
    assert {r.name: r.status for r in forced.collect()} == {
        "Mod1": "Unchanged", "Mod2": "Changed", "Mod3": "New", "Sheet1": "New",
    }


def test_snapshot_merge(snapshot_tables):
    old, new = snapshot_tables
    for force, second in ((False, "b"), (True, "B")):
        diff = snapshots.snapshot_diff(old, new, force=force, exclude="sheet")
        merged = {r.name: r.text for r in snapshots.merge_snapshot(old, new, diff).collect()}
        assert merged == {"Mod1": "a\n", "Mod2": second, "Mod3": "c", "Gone": "x"}


def test_texts_are_not_shuffled(snapshot_tables):
    diff = snapshots.snapshot_diff(*snapshot_tables)
    plan = diff._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert exchanges and "text#" not in "".join(exchanges)


def test_module_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "Mod1.vb").write_text("Sub a()\nEnd Sub\n")
    (tmp_path / "sub" / "Mod.2.cls").write_text("x")
    (tmp_path / "book.xlsm").write_text("no module")
    found = {r["name"]: r.text for r in snapshots.read_modules(spark, str(tmp_path)).collect()}
    assert found == {"Mod1": "Sub a()\nEnd Sub\n", "Mod.2": "x"}


def whole_table(left, right):
    """The subsequence by the whole table, dropping the end of the left text first."""
    lengths = [[0] * (len(right) + 1)]
    for a in left:
        row = [0]
        for j, b in enumerate(right):
            row.append(lengths[-1][j] + 1 if a == b else max(row[-1], lengths[-1][j + 1]))
        lengths.append(row)
    i, j, taken = len(left), len(right), []
    while i and j:
        if left[i - 1] == right[j - 1]:
            taken.append(left[i - 1])
            i, j = i - 1, j - 1
        elif lengths[i][j - 1] > lengths[i - 1][j]:
            j -= 1
        else:
            i -= 1
    return "".join(reversed(taken))


def test_subsequence_in_halves_is_that_of_the_whole_table(monkeypatch):
    random.seed(12)
    for small in (0, 6, 40):
        monkeypatch.setattr(text, "SMALL_TABLE", small)
        for _ in range(300):
            letters = "abcé😀"[: random.randrange(2, 6)]
            left, right = ("".join(random.choices(letters, k=random.randrange(16))) for _ in "lr")
            wanted = whole_table(left, right)
            assert text._subsequence(left, right) == wanted
            assert text.subsequence_length(left, right) == len(wanted)


def test_long_subsequence_takes_little_memory():
    random.seed(13)
    left, right = ("".join(random.choices("abcdefghij", k=30_000)) for _ in "lr")
    tracemalloc.start()
    try:
        common = text._subsequence(left, right)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(common) == text.subsequence_length(left, right)
    assert most < 10_000_000
    places = iter(left)
    assert all(char in places for char in common)


def test_replies_against_the_whole_table(spark, tmp_path):
    random.seed(14)
    turns = [(c, t, "".join(random.choices("abcd \n", k=random.randrange(40)))) for c in range(8) for t in range(5)]
    turns += [(90, 0, None), (90, 1, "abc"), (91, 0, "alone"), (None, 0, "abc"), (92, 0, ""), (92, 1, "x")]
    frame = spark.createDataFrame([(*turn, "user") for turn in turns], "conv_id long, turn int, text string, role string")
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    texts = {(c, t): body for c, t, body in turns if c is not None}
    wanted = {
        (c, t): None if None in (body, texts[c, t + 1]) else len(whole_table(body, texts[c, t + 1]))
        for (c, t), body in texts.items()
        if (c, t + 1) in texts
    }
    found = QUERIES["lcs_replies"](spark, str(tmp_path)).collect()
    assert {(r.conv_id, r.turn): r.lcs_length for r in found} == wanted
