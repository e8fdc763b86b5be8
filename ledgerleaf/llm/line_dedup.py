"""Removal of lines that repeat an earlier line, exactly or nearly.

Two lines match when the sets of their words (lower case, between blanks) have a
Jaccard similarity of ``percent`` or more. A line goes when any earlier line
matches it: one of a document with a smaller id, or higher up in the same
document. Lines are judged on the input, all those with a word (``min_words`` more, where
asked); blank lines stay.

Method: exact set-similarity join.

* Texts are split into words once. What later steps need of a line, its place and the
  64-bit hashes of its words, is stored.
* Lines of equal word sets form one class, found by aggregation, so a line that a
  third of all documents hold is one row.
* Words are ordered by rarity: some bits of a hash name one of 2**22 buckets, whose
  lines are counted over the whole corpus. The logarithm of that number takes the
  place of the highest bits of the hash, so a word stays a single number that sorts
  by rarity.
* Prefix filter: two similar sets have a shared word among the first
  ``n - ceil(t * n) + 1`` words of each. One table of keys serves both sides of the
  join, so it is shuffled once, and words take turns. A frequent word is taken together with the
  next shared one, which is among the first words as well. In lines of many different
  words it is taken together with the band of their number instead, so keys grow in
  proportion to the words. Words of a single line are no keys, nor have sets any that
  are too small to be similar to any but their equals.
* Length and positional filters drop pairs whose sizes or remaining words cannot
  reach the similarity, and so does a bound by bits that words flip: 64 of them, 128
  in lines of more than 48 words, which flip most of 64 whatever they are.
* The remaining pairs are verified on the hashes of all words of their lines.

``line_classes`` counts all links between classes. A group of ``m`` variants that are
all similar has ``m * (m - 1) / 2`` of them, so ``repeated_lines``, which takes the
earliest for each class, does not list them:

* Each class first meets the earliest class with the same mark. Marks are a few pairs of
  neighbours among its first words, without words in fewer than 32, 256 or 2048
  lines: words of one variant alone are passed over, those of the whole group stay.
  That is at most one pair for each mark, and what is verified gives the class a bound.
* The join of the prefixes then looks for earlier classes before the bound only (before
  the class itself, where nothing was verified), so the result is exact, whatever the
  marks have found. In a group of variants the bound is mostly the first of them, and
  hardly any pair is left.

Only built-in functions are used. The tables of counts and of bits have a fixed
size. Hot keys are split by adaptive execution, the firsts of marks are aggregated.

Null texts have no lines, an empty text has one empty line. Rows with equal id and
text count as one document: they do not repeat each other. Rows that share an id
but not the text are documents of their own, as is every row without an id; these
come after all others.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf.llm.common import BLANKS, let, own_rows, plain_names
from ledgerleaf.scratch import passing_tables, settle, settle_outside

BUCKET_BITS = 22
GROUP_BITS = 11
REDUCER_BITS = 23
FREQUENT = 40  # code of words in about 1,000 lines or more
ONCE = 4  # code of words in one line
WIDE_LINE = 48  # different words from which on lines have 128 bits
LONG_LINE = 200  # different words from which frequent ones are joined by bands of sizes
TURNS = 2  # of the join of prefixes, a power of two; keys of one lie on disk at a time
HASH_BITS = 56  # the 7 bits above them hold the frequency
MARK_CODES = (20, 32, 44)  # of words in 32, 256, 2048 lines
DICTIONARY_BYTES = 8 << 20  # hashes of words repeat, a million of them fit a dictionary
LAST_ID = (1 << 63) - 1


@dataclass(frozen=True)
class LineDedup:
    """Least similarity in percent, and the fewest different words of a judged line."""

    percent: int = 80
    min_words: int = 1


def _lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, line, content) of every line, in lower case and with plain blanks only."""
    doc = F.coalesce(F.col(key).cast("long"), F.lit(LAST_ID)).alias("doc")
    whole = F.lower(F.col(text).cast("string"))
    odd = BLANKS.replace(" ", "").replace("\n", "")
    plain = F.when(whole.rlike(f"[{odd}]"), F.translate(whole, odd, " " * len(odd))).otherwise(whole)
    return docs.select(doc, F.posexplode(F.split(plain, "\n")).alias("line", "content"))


def _token_lines(docs: DataFrame, rule: LineDedup, key: str, text: str) -> DataFrame:
    """(doc, line, h1, h2, n, upper, tokens) of every judged line, stored.

    ``tokens`` are the different words as hashes, in order, the first ``upper`` of them
    negative; ``h1`` and ``h2`` name the set.
    """
    with_zero = F.sort_array(F.concat("tokens", F.array(F.lit(0).cast("long"))))
    hashes = F.array_distinct(F.transform(F.split("content", " "), lambda w: F.xxhash64(w)))
    tokens = F.sort_array(F.array_remove(hashes, F.xxhash64(F.lit(""))))
    lines = _lines(docs, key, text).select("doc", "line", tokens.alias("tokens"))
    # In a generator, so that the words are not split once more for the filter.
    judged = F.when(F.size("tokens") >= rule.min_words, F.array("tokens"))
    rows = lines.select("doc", "line", F.explode(judged).alias("tokens")).select(
        "doc",
        "line",
        F.xxhash64("tokens").alias("h1"),
        F.xxhash64(F.lit(1), "tokens").alias("h2"),
        F.size("tokens").alias("n"),
        (F.array_position(with_zero, 0) - 1).cast("int").alias("upper"),
        "tokens",
    )
    return settle(rows, "tokens", {"parquet.dictionary.page.size": DICTIONARY_BYTES})


def _bucket(token: Column) -> Column:
    return token.bitwiseAND(F.lit((1 << BUCKET_BITS) - 1))


def bucket_codes(lines: DataFrame) -> DataFrame:
    """One row with an array: for each bucket of hashes, how frequent its words are, 0 to 127.

    Codes are four times the binary logarithm of the number of lines.
    """
    counts = (
        lines.select(F.explode("tokens").alias("token"))
        .groupBy(_bucket(F.col("token")).alias("bucket"))
        .agg(F.count("*").alias("count"))
    )
    every = lines.sparkSession.range(1 << BUCKET_BITS).select(F.col("id").alias("bucket"))
    code = F.least(F.lit(127), F.floor(4 * F.log2(1 + F.coalesce("count", F.lit(0))))).cast("byte")
    listed = every.join(counts, "bucket", "left").select("bucket", code.alias("code"))
    return _as_array(listed, "bucket", "code")


def _as_array(listed: DataFrame, place: str, value: str) -> DataFrame:
    """One row with ``values``: the values of a table of fixed size, in order of place."""
    groups = listed.groupBy(F.shiftright(place, GROUP_BITS).alias("group")).agg(
        F.array_sort(F.collect_list(F.struct(place, value))).alias("part")
    )
    ordered = F.array_sort(F.collect_list(F.struct("group", "part")))
    parts = F.transform(ordered, lambda g: F.transform(g["part"], lambda p: p[value]))
    return groups.agg(F.flatten(parts).alias("values"))


CLASS = ("h1", "h2", "n")


def _classes(lines: DataFrame, codes: Column, rule: LineDedup) -> DataFrame:
    """Classes of equal word sets: h1, h2, n, at (first line), copies, bits, high, prefix.

    ``high`` has the second half of 128 bits, ``bits`` both halves on top of each other.
    """
    none = F.lit(0).cast("long")

    def ranked(token: Column) -> Column:
        code = F.element_at(F.col("codes"), (_bucket(token) + 1).cast("int")).cast("long")
        low = token.bitwiseAND(F.lit((1 << HASH_BITS) - 1))
        # Never null, as Spark sorts arrays without nulls much faster.
        return F.coalesce(F.shiftleft(code, HASH_BITS).bitwiseOR(low), none)

    n = F.col("n")

    def flipped(tokens: Column) -> Column:
        return F.aggregate(tokens, none, lambda bits, t: bits.bitwiseXOR(_one_bit(t)))

    # One use of the codes: they are looked up where they are, not copied to each row.
    ordered = F.sort_array(F.transform("tokens", ranked))
    ranked_lines = lines.withColumn("codes", codes).select(
        *CLASS,
        F.struct("doc", "line").alias("at"),
        "tokens",
        "upper",
        F.slice(ordered, F.lit(1), n - _needed(rule.percent, n) + 2).alias("prefix"),
    )
    halves = ranked_lines.withColumns(
        {
            "half": flipped(F.slice("tokens", F.lit(1), F.col("upper"))),
            "rest": flipped(F.slice("tokens", F.col("upper") + 1, F.size("tokens"))),
        }
    )
    rows = halves.select(
        *CLASS,
        "at",
        F.col("half").bitwiseXOR(F.col("rest")).alias("bits"),
        F.when(n > WIDE_LINE, F.col("half")).otherwise(none).alias("high"),
        "prefix",
    )
    return rows.groupBy(*CLASS).agg(
        F.min("at").alias("at"),
        F.count("*").alias("copies"),
        *[F.first(c).alias(c) for c in ("bits", "high", "prefix")],
    )


def _needed(percent: int, n: Column) -> Column:
    """Least size of a set that is similar to one of ``n``: ceil(t * n)."""
    return F.floor((percent * n + 99) / 100).cast("int")


def _one_bit(place: Column) -> Column:
    """A long with the bit set that the last six bits of ``place`` name."""
    return F.call_function(
        "shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int")
    )


def _keys(longer: Column, n: Column, percent: int, turn: int) -> Column:
    """What a set of ``n`` is found by: (key, place) for the words of its prefix in one of ``TURNS``.

    ``longer`` has the first words, as many as the prefix and one more. A word of one
    line only is no key.
    A rare word is a key by itself. A frequent one is a key together with each
    word after it: similar sets share a second word within the prefix that is longer by
    one, if they share two. In a long line it is a key with the band of ``n``, and the
    next one: sizes of similar sets are less than a band apart. Lines that may be similar
    to both kinds have the keys of both.
    """
    width = math.log(1.01 * 100 / percent)
    band = F.floor(F.log(n.cast("double")) / width)
    bands = F.array(band, band + 1)
    only_long = percent * n > 100 * LONG_LINE
    first = n - _needed(percent, n) + 1
    one_shared = _needed(percent, n) < 2

    def keys(words: Column) -> Column:
        def of(token: Column, i: Column) -> Column:
            alone = F.array(F.struct(token.alias("key"), i.alias("place")))
            paired = F.transform(
                F.slice(words, i + 2, F.size(words)),
                lambda other: F.struct(F.xxhash64(token, other).alias("key"), i.alias("place")),
            )
            banded = F.transform(
                bands, lambda b: F.struct(F.xxhash64(token, b).alias("key"), i.alias("place"))
            )
            by_size = (
                F.when(one_shared, F.concat(alone, paired))
                .when(only_long, banded)
                .when(n < LONG_LINE, paired)
                .otherwise(F.concat(paired, banded))
            )
            code = F.shiftright(token, HASH_BITS)
            known = F.when(code >= FREQUENT, by_size).otherwise(alone)
            other_turn = token.bitwiseAND(F.lit(TURNS - 1)) != turn
            return F.when(other_turn | (code <= ONCE), F.slice(alone, 1, 0)).otherwise(known)

        return F.flatten(F.transform(F.slice(words, 1, first), of))

    has_others = (100 * n >= percent * (n + 1)) | (100 * (n - 1) >= percent * n)
    return F.when(has_others, let(F.slice(longer, 1, first + 1), keys))


def _possible(a: Callable[[str], Column], b: Callable[[str], Column], percent: int) -> Column:
    """Length filter, and a bound by bits: each word in one set only flips one bit."""
    na, nb = a("n"), b("n")
    both = a("bits").bitwiseXOR(b("bits"))
    high = a("high").bitwiseXOR(b("high"))
    apart = F.bit_count(high) + F.bit_count(both.bitwiseXOR(high))
    smaller, most = F.least(na, nb), (100 - percent) * (na + nb)
    return (
        (100 * smaller >= percent * F.greatest(na, nb))
        & ((100 + percent) * F.bit_count(both) <= most)
        & ((smaller <= WIDE_LINE) | ((100 + percent) * apart <= most))
    )


def _prefix_pairs(classes: DataFrame, rule: LineDedup) -> DataFrame:
    """(x, y): an earlier class and a later one, when they pass all filters.

    ``classes`` may have a ``bound``: then only those before it are earlier ones, where
    it is not null. The words take turns, so only a part of the keys is there at once.
    """
    turns = [settle(_pairs_of_turn(classes, rule, turn), "turn") for turn in range(TURNS)]
    return reduce(DataFrame.unionByName, turns).distinct()


def _pairs_of_turn(classes: DataFrame, rule: LineDedup, turn: int) -> DataFrame:
    """The pairs that share a word of one turn."""
    bound = ["bound"] if "bound" in classes.columns else []
    keys = _keys(F.col("prefix"), F.col("n"), rule.percent, turn)
    # The same columns of both sides, so they read one exchange.
    found_by = classes.select("at.doc", "at.line", "n", "bits", "high", *bound, F.inline(keys))
    a, b = found_by.alias("a"), found_by.alias("b")
    na, nb = F.col("a.n"), F.col("b.n")
    # Shared words are at most those left behind both places, this one included.
    room = F.least(na - F.col("a.place"), nb - F.col("b.place"))
    enough = (100 + rule.percent) * room >= rule.percent * (na + nb)
    near = _possible(lambda c: F.col(f"a.{c}"), lambda c: F.col(f"b.{c}"), rule.percent)
    at_a, at_b = F.struct("a.doc", "a.line"), F.struct("b.doc", "b.line")
    same_doc = F.col("a.doc") == F.col("b.doc")
    first_a = (F.col("a.doc") < F.col("b.doc")) | (same_doc & (F.col("a.line") < F.col("b.line")))
    smaller = (na < nb) | ((na == nb) & first_a)
    open_pair = F.lit(True)
    if bound:
        before_a = F.col("a.bound").isNull() | (at_b < F.col("a.bound"))
        before_b = F.col("b.bound").isNull() | (at_a < F.col("b.bound"))
        open_pair = F.when(first_a, before_b).otherwise(before_a)
    return (
        a.join(b, (F.col("a.key") == F.col("b.key")) & smaller & enough & near & open_pair)
        .select(F.least(at_a, at_b).alias("x"), F.greatest(at_a, at_b).alias("y"))
        .distinct()
    )


def _marked_pairs(classes: DataFrame, rule: LineDedup) -> DataFrame:
    """(x, y): classes and the earliest one that shares a mark, when they pass the filters."""

    def marks(code: int) -> Column:
        words = F.filter("prefix", lambda t: F.shiftright(t, HASH_BITS) >= code)
        return let(
            F.slice(words, 1, 3),
            lambda w: F.filter(
                F.transform(
                    F.sequence(F.lit(0), F.lit(1)),
                    lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.lit(0)),
                ),
                lambda _, i: i + 1 < F.size(w),
            ),
        )

    every = F.array_distinct(F.flatten(F.array(*[marks(code) for code in MARK_CODES])))
    rows = classes.select(F.explode(every).alias("mark"), "at", "n", "bits", "high")
    firsts = rows.groupBy("mark").agg(
        F.min(F.struct("at", "n", "bits", "high")).alias("first"), F.count("*").alias("count")
    )
    first = F.col("first")
    near = _possible(lambda c: first[c], F.col, rule.percent)
    return (
        rows.join(firsts.where("count > 1").drop("count"), "mark")
        .where((first["at"] < F.col("at")) & near)
        .select(first["at"].alias("x"), F.col("at").alias("y"))
        .distinct()
    )


def _earliest(classes: DataFrame, lines: DataFrame, rule: LineDedup) -> DataFrame:
    """(y, x): every class that is similar to an earlier one, and the earliest of these."""

    def nearest(pairs: DataFrame) -> DataFrame:
        with passing_tables(lines.sparkSession):
            found = _verified(settle(pairs, "pairs"), lines, rule)
            return settle_outside(found.groupBy("y").agg(F.min("x").alias("x")), "near")

    near = nearest(_marked_pairs(classes, rule))
    bounds = near.select(F.col("y").alias("at"), F.col("x").alias("bound"))
    # Most classes have none and stay where they are.
    named = _maybe_in(bounds)
    rows = classes.select("at", "n", "bits", "high", "prefix")
    unbound = rows.where(~named).withColumn("bound", F.lit(None).cast(bounds.schema["bound"].dataType))
    open_classes = rows.where(named).join(bounds, "at", "left").unionByName(unbound)
    nearer = nearest(_prefix_pairs(open_classes, rule))
    return near.unionByName(nearer).groupBy("y").agg(F.min("x").alias("x"))


def _reducer(places: DataFrame) -> Column:
    """Bits that are set for the places of ``places``, as an array of fixed size."""
    slot = F.xxhash64("at").bitwiseAND(F.lit((1 << REDUCER_BITS) - 1))
    words = places.groupBy(F.shiftright(slot, 6).alias("word")).agg(
        F.bit_or(_one_bit(slot)).alias("bits")
    )
    every = places.sparkSession.range(1 << (REDUCER_BITS - 6)).select(F.col("id").alias("word"))
    listed = every.join(words, "word", "left").select(
        "word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")
    )
    return settle(_as_array(listed, "word", "bits"), "reducer").scalar()


def _maybe_in(places: DataFrame) -> Column:
    """Whether ``at`` may be one of ``places``: true for all of these, false for most others."""
    slot = F.xxhash64("at").bitwiseAND(F.lit((1 << REDUCER_BITS) - 1))
    word = F.element_at(_reducer(places), (F.shiftright(slot, 6) + 1).cast("int"))
    return word.bitwiseAND(_one_bit(slot)) != 0


def _verified(pairs: DataFrame, lines: DataFrame, rule: LineDedup) -> DataFrame:
    """The pairs whose lines are similar enough, compared word by word.

    A set of bits of fixed size drops most other lines before they are shuffled.
    """
    ends = pairs.select(F.explode(F.array("x", "y")).alias("at"))
    places = settle(ends.distinct(), "places")
    lines = lines.select(F.struct("doc", "line").alias("at"), "tokens")
    found = lines.where(_maybe_in(places)).join(places, "at", "left_semi")
    found = settle(found.withColumnRenamed("tokens", "words"), "lines")
    x = found.select(F.col("at").alias("x"), F.col("words").alias("wx"))
    y = found.select(F.col("at").alias("y"), F.col("words").alias("wy"))
    shared = F.size(F.array_intersect("wx", "wy"))
    union = F.size("wx") + F.size("wy") - F.col("shared")
    return (
        pairs.join(x, "x")
        .join(y, "y")
        .withColumn("shared", shared)
        .where(100 * F.col("shared") >= rule.percent * union)
        .select("x", "y")
    )


def _classed(
    docs: DataFrame, rule: LineDedup, key: str, text: str
) -> tuple[DataFrame, DataFrame]:
    """Judged lines and their classes."""
    lines = _token_lines(docs, rule, key, text)
    codes = settle(bucket_codes(lines), "codes").scalar()
    return lines, settle(_classes(lines, codes, rule), "classes")


def line_classes(
    docs: DataFrame, rule: LineDedup = LineDedup(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc, line, class_doc, class_line, copies, n_links) of every judged line.

    A class of equal word sets is named by its first line. ``copies`` is the number
    of its lines, ``n_links`` the number of other classes that are similar to it.
    The key has to tell the documents apart.
    """
    lines, classes = _classed(docs, rule, key, text)
    pairs = settle(_prefix_pairs(classes, rule), "pairs")
    links = settle(_verified(pairs, lines, rule), "links")
    ends = links.select(F.explode(F.array("x", "y")).alias("at")).groupBy("at")
    counts = ends.agg(F.count("*").alias("n_links"))
    named = classes.select(*CLASS, "at", "copies").join(counts, "at", "left")
    return lines.select(*CLASS, "doc", "line").join(named, list(CLASS)).select(
        "doc",
        "line",
        F.col("at.doc").alias("class_doc"),
        F.col("at.line").alias("class_line"),
        "copies",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def repeated_lines(
    docs: DataFrame, rule: LineDedup = LineDedup(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc, line, first_doc, first_line): every line that goes, and an earlier line it matches.

    The earlier line is the first of equal word sets, else the first line of the
    earliest similar class. Rows without an id or with a shared one go by the numbers
    of their rows inside; here they have their ids again.
    """
    rows, numbered = own_rows(docs, key, text, share=True)
    gone = _repeated(rows, rule, "_row", text)
    if not numbered:
        return gone
    gone = settle(gone, "gone")
    names = rows.select("_row", F.col(key).cast("long").alias("id")).distinct()
    first = names.select(F.col("_row").alias("first_doc"), F.col("id").alias("first_id"))
    return (
        gone.join(names.withColumnRenamed("_row", "doc"), "doc")
        .join(first, "first_doc")
        .select(
            F.col("id").alias("doc"), "line", F.col("first_id").alias("first_doc"), "first_line"
        )
    )


def _repeated(docs: DataFrame, rule: LineDedup, key: str, text: str) -> DataFrame:
    """:func:`repeated_lines` of documents that ``key`` tells apart."""
    lines, classes = _classed(docs, rule, key, text)
    near = _earliest(classes, lines, rule)
    copies = classes.where("copies > 1").select(*CLASS, F.col("at").alias("x"))
    equal = (
        lines.select(*CLASS, "doc", "line")
        .join(copies, list(CLASS))
        .select("x", F.struct("doc", "line").alias("y"))
        .where("x <> y")
    )
    return equal.unionByName(near.select("x", "y")).select(
        F.col("y.doc").alias("doc"),
        F.col("y.line").alias("line"),
        F.col("x.doc").alias("first_doc"),
        F.col("x.line").alias("first_line"),
    ).distinct()


def dedup_lines(docs: DataFrame, rule: LineDedup = LineDedup()) -> DataFrame:
    """``docs`` (doc_id, text, any others) with texts that lack their repeated lines.

    Other columns come back as they are, whatever their names.
    """
    plain, back = plain_names(docs, ("doc_id", "text"))
    own, _ = own_rows(plain, "doc_id", "text", share=True)
    with passing_tables(docs.sparkSession):
        gone = settle_outside(_repeated(own, rule, "_row", "text"), "gone")
    cuts = gone.groupBy("doc").agg(F.array_sort(F.collect_set("line")).alias("cuts"))
    rows = own.withColumnRenamed("_row", "doc").withColumn("text", F.col("text").cast("string"))

    def without(parts: Column) -> Column:
        """Lines between the cuts; starts of pieces are the places after a cut."""
        pieces = F.zip_with(
            F.concat(F.array(F.lit(-1)), "cuts"),
            F.concat("cuts", F.array(F.size(parts))),
            lambda a, b: F.slice(parts, a + 2, b - a - 1),
        )
        return F.array_join(F.flatten(pieces), "\n")

    cut = F.when(F.col("cuts").isNull(), F.col("text")).otherwise(
        let(F.split("text", "\n"), without)
    )
    return rows.join(cuts, "doc", "left").withColumn("text", cut).select(*back)
