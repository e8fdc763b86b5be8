"""Documents whose other columns have the names that steps use inside."""

from pathlib import Path

import pytest

from ledgerleaf.llm import line_dedup, near_dedup

NAMES = ["_row", "_id", "_h1", "_h2", "_first", "_n", "_number", "doc", "cuts", "line", "c0", "c1", "n"]
LINE = "one two three four five six seven"
TEXT = " ".join(f"word{i}" for i in range(40))


def documents(spark, rows):
    schema = ", ".join(["`_row` string", "doc_id long", "text string", *[f"`{n}` string" for n in NAMES[1:]]])
    full = [(f"r{k}", i, text, *[f"{n}{k}" for n in NAMES[1:]]) for k, (i, text) in enumerate(rows)]
    return spark.createDataFrame(full, schema)


@pytest.mark.parametrize("shared", [False, True])
def test_other_columns_come_back(spark, shared):
    rows = [(1, f"{LINE}\nfirst own line of this text"), (2, f"a b c d e f g\n{LINE}"), (3, None)]
    # Rows that share an id take the way with numbers of their own.
    docs = documents(spark, rows + ([(3, LINE), (None, LINE)] if shared else []))
    found = line_dedup.dedup_lines(docs)
    assert found.columns == docs.columns
    before, after = ({r["_row"]: r for r in frame.collect()} for frame in (docs, found))
    assert set(after) == set(before)
    for name, row in after.items():
        assert [row[n] for n in NAMES] == [before[name][n] for n in NAMES]
        assert row.doc_id == before[name].doc_id
    assert after["r0"].text == rows[0][1] and after["r1"].text == "a b c d e f g" and after["r2"].text is None

    rows = [(1, TEXT), (2, TEXT + " more"), (3, "something else"), (4, None)]
    docs = documents(spark, rows + ([(3, "of the same id"), (None, TEXT)] if shared else []))
    found = near_dedup.keep_one(docs)
    assert found.columns == docs.columns
    before = {r["_row"]: r for r in docs.collect()}
    kept = {r["_row"]: r for r in found.collect()}
    assert sorted(kept) == ["r0", "r2", "r3"] + ["r4"] * shared
    assert all(tuple(row) == tuple(before[name]) for name, row in kept.items())


def test_only_what_goes_is_left_in_the_shared_folder(spark):
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    docs = documents(spark, [(1, f"{LINE}\n{TEXT}"), (2, f"{LINE}\n{TEXT} more"), (3, TEXT)])
    for step in (line_dedup.dedup_lines, near_dedup.keep_one):
        before = set(folder.iterdir())
        assert step(docs).count() > 0
        assert {p.name.rsplit("-", 1)[0] for p in set(folder.iterdir()) - before} == {"gone"}
