"""Table-driven mapping with regular expressions and wildcards."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerleaf.functions.keys import combo_key, key_part
from ledgerleaf.functions.names import (
    check_unique,
    columns_with_prefix,
    quoted,
    require_columns,
)
from ledgerleaf.operators.patterns import required_texts_of
from ledgerleaf.scratch import settle

TAG_PREFIX = "tag_"
TAG_SEPARATOR = "~"
PATTERNS_PER_CHUNK = 500
GRAM = 3
# Rows of either side of a join by pattern that one pattern brings to one task.
PIECE_ROWS = 1 << 14
# Rows that a task of the last join makes, about, unless that takes too many tasks.
ROWS_PER_TASK = 1 << 22
MOST_TASKS = 10_000

_OWN = ("_key", "_pattern", "_tags")

_PLAIN = r"^[^.^$*+?{}\[\]\\|()~\n]*$"
_CONTAINED = r"^([^^$*+?{}\[\]\\|()~\n][^^$\[\]\\|()~\n]*)?$"


def matches_from_start(text: Column, pattern: Column) -> Column:
    """The pattern matches a leading part of the text.

    The group keeps alternatives together; ``(?d)`` makes ``.`` and ``$`` treat
    only a line feed as the end of a line.
    """
    return F.rlike(text, F.concat(F.lit(r"(?d)\A(?:"), pattern, F.lit(")")))


def _pairs(keys: DataFrame, patterns: DataFrame) -> DataFrame:
    """Matching pairs when nothing but the pattern itself tells which keys fit.

    Patterns meet the keys in chunks, by equality on the number of a chunk and on
    a slice of the keys, so no task needs all patterns or all keys.
    """
    spark = keys.sparkSession
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = -(-patterns.count() // PATTERNS_PER_CHUNK)
    if not chunks:
        return keys.select("_key", F.lit("").alias("_pattern")).limit(0)
    part = F.pmod(F.xxhash64("_pattern"), F.lit(chunks))
    grouped = patterns.groupBy(part.alias("_chunk")).agg(
        F.collect_set("_pattern").alias("_patterns")
    )
    spread = grouped.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    dealt = keys.withColumn("_slice", F.pmod(F.xxhash64("_key"), F.lit(slices)).cast("int"))
    met = dealt.withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long")))
    ).join(spread, ["_chunk", "_slice"])
    fitting = F.filter("_patterns", lambda p: matches_from_start(F.col("_key"), p))
    return met.select("_key", F.explode(fitting).alias("_pattern"))


def _grams(text: Column, size: Column) -> Column:
    """Distinct substrings of ``size`` characters."""
    places = F.sequence(F.lit(1), F.length(text) - size + 1)
    cut = F.array_distinct(F.transform(places, lambda i: F.substr(text, i, size)))
    return F.when(F.length(text) >= size, cut).otherwise(F.array().cast("array<string>"))


def _marks_of(alternatives: DataFrame) -> DataFrame:
    """The marks by which a key of an alternative can be found, any one of them.

    A mark is a start of some length, or a part of ``GRAM`` characters, shorter where
    the text is.
    """
    start, texts = F.get("_texts", F.lit(0)), F.col("_texts")
    filled = F.filter(texts, lambda t: t != "")
    parts = F.flatten(F.transform(filled, lambda t: _grams(t, F.least(F.length(t), F.lit(GRAM)))))
    marks = F.concat(
        F.transform(F.filter(F.array(start), lambda t: t != ""), lambda t: F.struct(F.lit(True).alias("_starts"), t.alias("_mark"))),
        F.transform(F.array_distinct(parts), lambda t: F.struct(F.lit(False).alias("_starts"), t.alias("_mark"))),
    )
    return alternatives.select("_pattern", "_texts", F.inline(marks)).withColumn("_length", F.length("_mark"))


def _marked_keys(keys: DataFrame, shapes: DataFrame) -> DataFrame:
    """Every key under its marks of the given shapes."""
    lengths: dict[bool, list[int]] = {True: [], False: []}
    for row in shapes.collect():
        lengths[row["_starts"]].append(row["_length"])
    marks = [
        F.transform(F.array(*[F.lit(n) for n in lengths[True]]).cast("array<int>"), lambda n: F.struct(F.lit(True).alias("_starts"), F.left("_key", n).alias("_mark"))),
        *[
            F.transform(_grams(F.col("_key"), F.lit(n)), lambda t: F.struct(F.lit(False).alias("_starts"), t.alias("_mark")))
            for n in lengths[False]
        ],
    ]
    return keys.select("_key", F.inline(F.concat(*marks)))


def candidate_pairs(keys: DataFrame, patterns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs of distinct ``_key`` and ``_pattern`` that may match, and patterns without any mark.

    Each alternative of a pattern is looked up by the rarest of its marks among the keys;
    a key has to hold all its texts to stay.
    """
    known = settle(patterns.select("_pattern", required_texts_of("_pattern").alias("_all")), "patterns")
    alternatives = known.where("_all is not null").select("_pattern", F.explode("_all").alias("_texts"))
    marks = settle(_marks_of(alternatives), "marks")
    shapes = marks.select("_starts", "_length").distinct()
    posted = _marked_keys(keys, shapes)
    used = marks.select("_starts", "_mark").distinct()
    counts = posted.join(used, ["_starts", "_mark"], "left_semi").groupBy("_starts", "_mark").count()
    weighed = marks.join(counts, ["_starts", "_mark"], "left")
    mark = F.struct(F.coalesce("count", F.lit(0)).alias("n"), -F.col("_length"), "_starts", "_mark")
    chosen = (
        weighed.groupBy("_pattern", "_texts")
        .agg(F.min(mark).alias("mark"))
        .where("mark.n > 0")
        .select("_pattern", "_texts", "mark._starts", "mark._mark")
    )
    holds = F.forall("_texts", lambda t: F.contains(F.col("_key"), t)) & F.startswith(
        F.col("_key"), F.get("_texts", F.lit(0))
    )
    met = posted.join(settle(chosen, "chosen"), ["_starts", "_mark"]).where(holds)
    return met.select("_key", "_pattern"), known.where("_all is null").select("_pattern")


def pattern_pairs(keys: DataFrame, patterns: DataFrame) -> DataFrame:
    """Pairs of distinct ``_key`` and ``_pattern`` where the pattern matches from the start.

    Keys are found by the plain texts that a pattern requires; only patterns that require
    none are tested against every key.
    """
    candidates, others = candidate_pairs(keys, patterns)
    tested = candidates.where(matches_from_start(F.col("_key"), F.col("_pattern")))
    # A key may be found by several alternatives of a pattern.
    return _pairs(keys, others).unionByName(tested.distinct())


def _piece(df: DataFrame, pieces: Column) -> Column:
    """The piece of a row, by its plain values; not all others have a hash."""
    plain = [
        quoted(field.name)
        for field in df.schema
        if isinstance(field.dataType, T.AtomicType) and not isinstance(field.dataType, T.VariantType)
    ]
    return F.pmod(F.xxhash64(*plain), pieces)


def _expanded(
    main: DataFrame, rows: DataFrame, pairs: DataFrame, sums: DataFrame, key: str, tasks: int
) -> DataFrame:
    """Every row of ``main`` with the pattern rows of its pairs, multiplied in the last step.

    Rows meet by pattern, ``_key`` and ``_tags``, the pieces of the left and the right rows
    of a pattern that has many: each piece of one side meets each piece of the other once.
    """
    pieces = [F.ceil(F.col(side) / PIECE_ROWS).alias(side) for side in ("_left", "_right")]
    cut = settle(
        sums.select("_pattern", F.struct(*pieces).alias("_tags")).where("_tags._left > 1 or _tags._right > 1"),
        "pieces",
    )

    def dealt(df: DataFrame, own: str, other: str, names: tuple[str, str]) -> DataFrame:
        of = {side: F.coalesce(F.col("_tags")[side], F.lit(1).cast("long")) for side in (own, other)}
        every = F.explode(F.sequence(F.lit(0).cast("long"), of[other] - 1))
        places = [_piece(df, of[own]).alias(names[0]), every.alias(names[1])]
        return (
            df.join(cut, "_pattern", "left")
            .select(*[quoted(c) for c in df.columns], *places)
            .repartition(tasks, *_OWN)
        )

    left = main.join(pairs.select("_key", "_pattern"), quoted(key) == F.col("_key")).drop("_key")
    met = dealt(left, "_left", "_right", ("_key", "_tags")).join(
        dealt(rows, "_right", "_left", ("_tags", "_key")), list(_OWN)
    )
    return met.drop(*_OWN)


def regex_join(main: DataFrame, patterns: DataFrame, key: str, pattern: str) -> DataFrame:
    """Every (row, pattern row) pair whose pattern matches the start of the key.

    Only distinct keys are tested, against distinct patterns; rows are brought back by
    equality joins, first those of the side that multiplies the pairs less, so what is
    stored or shuffled does not grow with the product of both. A row without a match is
    left out, a row with several matches appears several times. A null key or pattern
    matches nothing.
    """
    check_unique([*main.columns, *patterns.columns, *_OWN])
    keyed = main.select(quoted(key).alias("_key")).where("_key is not null")
    keys = settle(keyed.groupBy("_key").agg(F.count("*").alias("_left")), "keys")
    rows = settle(
        patterns.withColumn("_pattern", quoted(pattern)).where("_pattern is not null"), "patterns"
    )
    texts = settle(rows.groupBy("_pattern").agg(F.count("*").alias("_right")), "texts")
    found = pattern_pairs(keys.select("_key"), texts.select("_pattern"))
    if not texts.where("_right > 1").isEmpty():
        found = settle(found.join(keys, "_key"), "pairs")
        sums = settle(
            found.groupBy("_pattern")
            .agg(F.count("*").alias("_pairs"), F.sum("_left").alias("_left"))
            .join(texts, "_pattern"),
            "sums",
        )
        pairs, left, right = (F.col(c).cast("double") for c in ("_pairs", "_left", "_right"))
        sizes = (pairs * right, left, left * right)
        by_rows, by_keys, result = sums.select(*[F.coalesce(F.sum(n), F.lit(0.0)) for n in sizes]).first()
        if by_keys < by_rows:
            least = int(main.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            tasks = max(least, min(MOST_TASKS, math.ceil(result / ROWS_PER_TASK)))
            return _expanded(main, rows, found, sums, key, tasks)
        found = found.drop("_left")
    lookup = settle(found.join(rows, "_pattern").drop("_pattern"), "matches")
    return main.join(lookup, quoted(key) == F.col("_key")).drop("_key")


def _masked_tags(tags: Column, plain: Column) -> Column:
    """Tag texts with everything but the plain positions blanked out."""
    return F.concat_ws(
        TAG_SEPARATOR,
        F.zip_with(tags, plain, lambda tag, keep: F.when(keep, tag).otherwise(F.lit(""))),
    )


def wildcard_pairs(keys: DataFrame, patterns: DataFrame) -> DataFrame:
    """Distinct (``_key``, ``_pattern``) pairs that match.

    ``keys`` and ``patterns`` have one row per distinct array ``_tags``. Most
    mapping rows fix at least one tag by plain text. Those are found by equality
    on their plain tags, and only the candidates are tested against the
    pattern. A pattern that could reach across the separator, and a key that
    holds the separator or a line feed itself, is found by the texts that the whole
    pattern requires.
    """
    keys = keys.withColumn("_key", F.concat_ws(TAG_SEPARATOR, "_tags")).withColumn(
        "_simple", ~F.exists("_tags", lambda t: F.rlike(t, F.lit(r"[~\n]")))
    )
    patterns = settle(
        patterns.withColumn(
            "_pattern", F.concat(F.lit("^"), F.concat_ws(TAG_SEPARATOR, "_tags"), F.lit("$"))
        )
        .withColumn("_plain", F.transform("_tags", lambda t: F.rlike(t, F.lit(_PLAIN))))
        .withColumn(
            "_by_tag",
            F.exists("_plain", lambda p: p)
            & F.forall("_tags", lambda t: F.rlike(t, F.lit(_CONTAINED))),
        ),
        "patterns",
    )
    simple = keys.where("_simple").select("_key", "_tags")
    odd = keys.where(~F.col("_simple")).select("_key").distinct()

    by_tag = patterns.where("_by_tag").withColumn("_masked", _masked_tags(F.col("_tags"), F.col("_plain")))
    others = patterns.where(~F.col("_by_tag")).select("_pattern").distinct()
    found = pattern_pairs(simple.select("_key").distinct(), others)
    if not odd.isEmpty():
        every = patterns.select("_pattern").distinct()
        found = found.unionByName(pattern_pairs(odd, every))
    masks = by_tag.agg(F.collect_set("_plain")).scalar()
    candidates = simple.withColumn("_plain", F.explode(masks)).select(
        "_key", "_plain", _masked_tags(F.col("_tags"), F.col("_plain")).alias("_masked")
    )
    tested = candidates.join(
        by_tag.select("_pattern", "_plain", "_masked"),
        ["_plain", "_masked"],
    ).where(matches_from_start(F.col("_key"), F.col("_pattern")))
    return found.unionByName(tested.select("_key", "_pattern"))


def map_with_wildcard(cells: DataFrame, mapping: DataFrame) -> DataFrame:
    """Attach the assumptions of every mapping row that fits a cell's tags.

    Tag columns are those of ``mapping`` named ``tag_*``; their values may be
    regular expressions such as ``.*``. All other columns of ``mapping`` are
    assumptions and replace same-named columns of ``cells``. Cells without a
    match are left out.
    """
    tags = columns_with_prefix(mapping, TAG_PREFIX)
    assumptions = [c for c in mapping.columns if c not in tags]
    require_columns(cells, tags)
    check_unique([*tags, *assumptions, *_OWN])
    kept = cells.drop(*assumptions)

    tag_texts = F.array(*[key_part(c) for c in tags])
    keys = settle(cells.select(tag_texts.alias("_tags")).distinct(), "keys")
    patterns = mapping.select(tag_texts.alias("_tags")).distinct()
    pairs = wildcard_pairs(keys, patterns)

    pattern = F.concat(F.lit("^"), combo_key(tags, TAG_SEPARATOR), F.lit("$"))
    rows = mapping.select(pattern.alias("_pattern"), *[quoted(c) for c in assumptions])
    lookup = settle(pairs.join(rows, "_pattern").drop("_pattern"), "matches")
    keyed = kept.withColumn("_key", combo_key(tags, TAG_SEPARATOR))
    return keyed.join(lookup, "_key").drop("_key")


def exists_flag(df: DataFrame, key: str, other: DataFrame, other_key: str, out: str) -> DataFrame:
    """Add ``out``: whether the key occurs in ``other``."""
    present = other.select(quoted(other_key).alias("_present")).distinct()
    return (
        df.join(present, quoted(key) == F.col("_present"), "left")
        .withColumn(out, F.col("_present").isNotNull())
        .drop("_present")
    )


def literal_map(key: Column, values: dict, strict: bool = False) -> Column:
    """Value for ``key`` from a small fixed table; null, or an error if strict, when absent."""
    entries = [F.lit(x) for pair in values.items() for x in pair]
    found = F.try_element_at(F.create_map(*entries), key)
    if not strict:
        return found
    problem = F.concat(F.lit("no entry for key "), F.coalesce(key.cast("string"), F.lit("null")))
    return F.coalesce(found, F.raise_error(problem))
