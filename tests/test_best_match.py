"""Best match by longest common subsequence, against all pairs in plain Python."""

import random

from ledgerleaf.functions.text import subsequence_length
from ledgerleaf.operators import best_match
from ledgerleaf.operators.best_match import lcs_best

LEFT = "id int, name string, area string, key string"
RIGHT = "code int, title string, area string, left string"


def matched(spark, left, right):
    lefts = spark.createDataFrame([(*row, "x") for row in left], LEFT).repartition(3)
    rights = spark.createDataFrame([(*row, "y") for row in right], RIGHT).repartition(3)
    return lcs_best(lefts, rights, "id", "name", "code", "title", "area", "area")


def brute_force(left, right):
    result = {}
    for key, name, area in left:
        pairs = [
            (-subsequence_length(name, title), code)
            for code, title, other in right
            if None not in (name, area, title, code) and other == area
        ]
        length, code = min(pairs, default=(None, None))
        result[key] = (code, None if length is None else -length)
    return result


def words(vocabulary, most):
    return " ".join(random.choices(vocabulary, k=random.randrange(most)))


def test_best_match_against_all_pairs(spark):
    random.seed(3)
    vocabulary = ["".join(random.choices("abcdeéñ😀", k=random.randrange(2, 7))) for _ in range(40)]
    left = [(i, words(vocabulary, 5), random.choice("pqr")) for i in range(150)]
    left += [(900, None, "p"), (901, "abc", None), (902, "", "p"), (903, "abc", "none"), (904, "ab" * 3000, "p")]
    right = [(i, words(vocabulary, 6), random.choice("pqr")) for i in range(1, 400)]
    right += [(5000, None, "p"), (None, "abc", "p"), (5001, "abc", None), (0, "", "q"), (5002, "ba" * 2000, "p")]
    right += right[:50]
    found = matched(spark, left, right)
    assert found.columns == ["id", "name", "area", "key", "best_key", "best_length", "n_tested"]
    assert {r.id: (r.best_key, r.best_length) for r in found.collect()} == brute_force(left, right)


def test_repeated_rows_and_empty_tables(spark):
    left = [(1, "abc", "p"), (1, "abc", "p"), (2, "abc", "p")]
    right = [(7, "xabc", "p"), (8, "ab", "p")]
    assert sorted((r.id, r.best_key) for r in matched(spark, left, right).collect()) == [(1, 7), (1, 7), (2, 7)]
    assert [r.best_key for r in matched(spark, left, []).collect()] == [None] * 3
    assert matched(spark, [], right).count() == 0


def test_a_large_block_compares_few_pairs(spark):
    random.seed(5)
    vocabulary = ["".join(random.choices("abcdefghijklmnopqrstuvwxyz", k=random.randrange(3, 9))) for _ in range(2000)]
    titles = [" ".join(random.choices(vocabulary, k=4)) for _ in range(10_000)]
    right = [(i, title, "all") for i, title in enumerate(titles)]
    left = []
    for i in range(300):
        chosen = list(titles[random.randrange(10_000)])
        for _ in range(3):
            chosen.pop(random.randrange(len(chosen)))
        left.append((i, "".join(chosen), "all"))
    found = matched(spark, left, right)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    rows = found.collect()
    assert sum(r.n_tested for r in rows) < 0.06 * len(left) * len(right)
    some = {r.id: (r.best_key, r.best_length) for r in rows if r.id < 30}
    assert some == brute_force(left[:30], right)


def test_texts_of_a_large_block_travel_in_chunks(spark, monkeypatch):
    random.seed(11)
    right = [(i, f"Supplier#{random.randrange(10**6):09d}", "p") for i in range(700)]
    left = [(i, f"Customer#{i:09d}", "p") for i in range(300)]
    moved = []
    compare = best_match._best

    def noted(chunks, pieces):
        moved.append((chunks.count(), pieces.count()))
        return compare(chunks, pieces)

    monkeypatch.setattr(best_match, "_best", noted)
    monkeypatch.setattr(best_match, "CHUNK", 64)
    monkeypatch.setattr(best_match, "PIECE", 128)
    found = matched(spark, left, right)
    assert {r.id: (r.best_key, r.best_length) for r in found.collect()} == brute_force(left, right)
    # Rows that carry texts of both sides: not one for each left text and leaf of the right.
    chunks, pieces = moved[0]
    assert chunks <= 300 // 64 + 9 and pieces <= 700 // 128 + 9
