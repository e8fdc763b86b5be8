"""Texts that expressions require, and the pairs that are tested for them."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerleaf.operators import mapping
from ledgerleaf.operators.patterns import required_texts


@pytest.mark.parametrize(
    ("pattern", "wanted"),
    [
        (".*word.*", [["", "word"]]),
        ("[ab]c.*", [["ac"], ["bc"]]),
        ("one|two.*x", [["one"], ["two", "x"]]),
        ("x(one|two)?y", [["xoney"], ["xtwoy"], ["xy"]]),
        (r"a\.b{2}c+d*", [["a.bbc"]]),
        ("(?=q)a(?!z)b", [["ab"]]),
        ("[a-z]7$", [["", "7"]]),
        (".*", None),
        ("a?", None),
        ("(?i)abc", None),
        ("[a-z&&[^b]]x", None),
        (r"\Qa.b\E", None),
        ("(", None),
        ("a(b", None),
        ("*a", None),
        ("", None),
    ],
)
def test_required_texts(pattern, wanted):
    assert required_texts(pattern) == wanted


PIECES = ["a", "b", "ab", ".", ".*", "[ab]", "[^a]", "[a-c]", "(a|bc)", "(?:ab)?", "c+", "b{2}", "a{1,2}", "|", "^", "$", "(c|)"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=6), st.text("abc", max_size=6))
def test_a_match_holds_the_required_texts(pieces, key):
    pattern = "".join(pieces)
    try:
        matched = re.match(f"(?:{pattern})", key)
    except re.error:
        return
    required = required_texts(pattern)
    if matched and required is not None:
        assert any(key.startswith(a[0]) and all(t in key for t in a) for a in required)


def test_patterns_meet_few_keys(spark):
    random.seed(4)
    words = ["".join(random.choices("abcdefghijklmnop", k=6)) for _ in range(400)]
    texts = sorted({f"{random.choice('xyz')}{random.choice(words)}-{random.choice(words)}" for _ in range(4000)})
    texts += ["", "a", "😀bc😀", "x\nword"]
    rules = [f".*{word}.*" for word in words[:150]] + [f"[xy]{word}.*" for word in words[:100]]
    rules += [f"z{a}|.*{b}$" for a, b in zip(words[:60], words[60:120])] + [".*😀$", "(?i)XA.*", "[^x]$", "a?"]
    keys = spark.createDataFrame([(t,) for t in texts], "_key string")
    patterns = spark.createDataFrame([(r,) for r in rules], "_pattern string")
    candidates, others = mapping.candidate_pairs(keys, patterns)
    assert sorted(r[0] for r in others.collect()) == sorted(["(?i)XA.*", "[^x]$", "a?"])
    assert candidates.count() < 0.02 * len(texts) * len(rules)
    found = mapping.pattern_pairs(keys, patterns)
    wanted = sorted((t, r) for r in rules for t in texts if re.match(r, t))
    assert sorted(tuple(r) for r in found.select("_key", "_pattern").collect()) == wanted
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_no_keys_or_patterns(spark):
    keys = spark.createDataFrame([("abc",)], "_key string")
    patterns = spark.createDataFrame([("a.*",)], "_pattern string")
    assert mapping.pattern_pairs(keys.limit(0), patterns).count() == 0
    assert mapping.pattern_pairs(keys, patterns.limit(0)).count() == 0
