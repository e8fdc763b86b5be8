"""Secrets in texts: fixed patterns, and strings that look random.

Method: besides the patterns, every candidate string (a long run of letters,
digits and ``+/_=-`` with a digit in it) is measured by Shannon entropy in a
sliding window. The counts of the window's characters are carried from window to
window: one character leaves, one enters, and the sum of ``c * log2(c)`` changes
by those two counts. The highest entropy decides by the limit of the candidate's
character class (hexadecimal or other). Candidates that an allow-list pattern
finds, or that lie inside a span of a fixed pattern, are passed over.

Only built-in functions are used and every text is judged by itself, so nothing
is shuffled. Null and empty texts have no spans; repeated rows each get their
own; other columns are ignored. Positions count code points, ends are exclusive.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf.llm.common import let, text_or_empty

# The patterns and their least lengths. A run that is too short for
# its kind can be left out of the pattern of `access` and `hex` from the start,
# as no shorter match can hide a longer one there.
ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_LEAST = 8
ACCESS = r"AKIA[A-Z0-9]{12,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}+"

CANDIDATE = (
    r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{%d,}+"
)
KINDS = ("assign", "access", "hex", "entropy")


@dataclass(frozen=True)
class EntropyRule:
    """Width of the window, least entropy in bits by class, and what is let pass."""

    window: int = 20
    hex_bits: float = 3.0
    other_bits: float = 3.8
    allowed: tuple[str, ...] = (
        r"(?i)example|sample|placeholder|dummy",
        r"(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}",
        r"^sha(1|256|384|512)-",
        r"^[0-9+/_=-]+$",
    )


def _places(text: Column, pattern: str) -> Column:
    """Every match of ``pattern`` from the left, as (start, found)."""

    def with_starts(found: Column) -> Column:
        between = F.split(text, pattern, -1)
        steps = F.zip_with(
            between,
            found,
            lambda gap, hit: F.struct(F.length(gap).alias("gap"), hit.alias("hit")),
        )
        walked = F.aggregate(
            F.filter(steps, lambda s: s["hit"].isNotNull()),
            F.struct(
                F.lit(0).alias("end"),
                F.array().cast("array<struct<start:int,found:string>>").alias("out"),
            ),
            lambda acc, s: F.struct(
                (acc["end"] + s["gap"] + F.length(s["hit"])).alias("end"),
                F.concat(
                    acc["out"],
                    F.array(
                        F.struct(
                            (acc["end"] + s["gap"]).alias("start"), s["hit"].alias("found")
                        )
                    ),
                ).alias("out"),
            ),
        )
        return F.when(
            F.size(found) == 0, F.array().cast("array<struct<start:int,found:string>>")
        ).otherwise(walked["out"])

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), with_starts)


def _weight(count: Column) -> Column:
    return F.when(count > 1, count * F.log2(count.cast("double"))).otherwise(F.lit(0.0))


def window_entropy(candidate: Column, window: int) -> Column:
    """Highest Shannon entropy, in bits, of ``window`` neighbouring ASCII characters."""

    def slide(codes: Column) -> Column:
        first = F.slice(codes, 1, window)
        counts = F.transform(
            F.sequence(F.lit(0), F.lit(127)),
            lambda code: F.size(F.filter(first, lambda c: c == code)),
        )
        moves = F.zip_with(
            F.slice(codes, 1, F.size(codes) - window),
            F.slice(codes, window + 1, F.size(codes)),
            lambda out, into: F.struct(out.alias("out"), into.alias("into")),
        )

        def step(state: Column, move: Column) -> Column:
            out, into = move["out"], move["into"]
            leaving = F.element_at(state["counts"], out + 1)
            entering = F.element_at(state["counts"], into + 1)
            moved = (
                state["sum"]
                + _weight(leaving - 1)
                - _weight(leaving)
                + _weight(entering + 1)
                - _weight(entering)
            )
            counts = F.transform(
                state["counts"],
                lambda c, i: c
                + F.when(i == into, 1).otherwise(0)
                - F.when(i == out, 1).otherwise(0),
            )
            after = F.struct(
                counts.alias("counts"),
                moved.alias("sum"),
                F.least(state["least"], moved).alias("least"),
            )
            return F.when(out == into, state).otherwise(after)

        def begin(c: Column) -> Column:
            weight = F.aggregate(c, F.lit(0.0), lambda acc, x: acc + _weight(x))
            return F.struct(c.alias("counts"), weight.alias("sum"), weight.alias("least"))

        least = F.aggregate(moves, let(counts, begin), step, lambda s: s["least"])
        return F.lit(math.log2(window)) - least / F.lit(float(window))

    letters = F.filter(F.split(candidate, ""), lambda c: c != "")
    return let(F.transform(letters, F.ascii), slide)


def _looks_random(candidate: Column, rule: EntropyRule) -> Column:
    allowed = F.lit(False)
    for pattern in rule.allowed:
        allowed = allowed | candidate.rlike(pattern)
    least = F.when(candidate.rlike("^([0-9a-f]+|[0-9A-F]+)$"), rule.hex_bits).otherwise(
        rule.other_bits
    )
    return F.when(allowed, F.lit(False)).otherwise(
        window_entropy(candidate, rule.window) >= least
    )


def _spans(places: Column, kind: str) -> Column:
    return F.transform(
        places,
        lambda p: F.struct(
            p["start"].alias("start"),
            F.lit(KINDS.index(kind)).alias("rank"),
            (p["start"] + F.length(p["found"])).alias("end"),
            F.lit(kind).alias("kind"),
        ),
    )


def find_secrets(
    docs: DataFrame, rule: EntropyRule = EntropyRule(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The key of each document and ``spans``: (start, rank, end, kind), by start, then kind."""
    whole = F.col("_text")
    assigned = F.filter(
        _places(whole, ASSIGN),
        lambda p: F.length(F.regexp_extract(p["found"], ASSIGN, 2)) >= ASSIGN_LEAST,
    )

    def with_random(base: Column) -> Column:
        random = F.filter(
            _places(whole, CANDIDATE % rule.window),
            lambda p: ~F.exists(
                base,
                lambda b: (b["start"] <= p["start"])
                & (b["end"] >= p["start"] + F.length(p["found"])),
            )
            & _looks_random(p["found"], rule),
        )
        return F.sort_array(F.concat(base, _spans(random, "entropy")))

    base = F.concat(
        _spans(assigned, "assign"),
        _spans(_places(whole, ACCESS), "access"),
        _spans(_places(whole, HEX), "hex"),
    )
    rows = docs.select(F.col(key).alias("_key"), text_or_empty(text).alias("_text"))
    return rows.select(F.col("_key").alias(key), let(base, with_random).alias("spans"))


def joined_spans(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
