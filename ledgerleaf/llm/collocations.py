"""Phrases whose words belong together, from counts kept as sorted streams.

1. Words are counted. Phrases are read only where all of their words are frequent, which
   a set of bits of fixed size decides; it may let rare words through, never the reverse.
2. Windows of up to four such words are cut into ranges in prefix order. There all windows
   that begin with a phrase stand together, so one pass over a range counts all phrases.
3. The frequent phrases are kept as two streams, one in prefix order and one in suffix
   order (words from last to first). In prefix order a phrase comes right after the
   phrases it begins with and right before those it begins: one pass merges the counts of
   all first parts and of the best extension to the right. The suffix stream gives the
   last parts and the best extension to the left. No table of counts is looked up.

Ranges may begin anywhere, also inside the phrases of one word. The few phrases open at
the head of a range are carried to it, and what a range knows about them only in part
is added up afterwards, so no word, however frequent, has to fit in one task.

A phrase inside a longer one occurs at least as often as that one, so it is enough to
look at phrases longer by one word.

Rows: null and empty texts have no words; a null language is ``und``, as is a language of
that name. Repeated rows count each. Texts of any length are read whole. Equal scores go
by count, then by the phrase in UTF-8 order. Empty tables give no rows. Columns other than
the text and the language are ignored, whatever their names.
"""

from __future__ import annotations

import re
import sys
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerleaf.llm.common import by_size
from ledgerleaf.scratch import settle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(sys.modules[by_size.__module__])

UNKNOWN = "und"
# Below every byte of a word once those two are written as two, so that phrases which
# begin with the same words stand together.
JOINT = "\x00"
_HIDDEN = {0: "\x01\x02", 1: "\x01\x03"}
_TOKEN = re.compile("[^ \t.,;:!?\n-\r]+|[.,;:!?\n-\r]")
_BREAKS = ".,;:!?\n\x0b\x0c\r"
_BITS = 1 << 22
_HELD_WORDS = 200_000
_BATCH_BYTES = 3 << 20
_PARTS = 64
_BOUND_ROWS = 5_000
_RANGES_A_TASK = 4


@dataclass(frozen=True)
class Collocations:
    """Phrases of 2 to ``words`` words that occur ``least`` times or more.

    A phrase goes when a longer one has ``share`` percent of its places or more; the
    ``top`` best of each language are returned.
    """

    words: int = 4
    least: int = 30
    share: int = 80
    scale: int = 2_000_000
    top: int = 2000


def _lowered(text: str) -> str:
    # Bytes are lowered as ASCII only.
    return text.encode().lower().decode()


def _hidden(word: str) -> str:
    return word.translate(_HIDDEN) if "\x00" in word or "\x01" in word else word


def _tokens(batch: pa.RecordBatch) -> dict[str, list[list[str]]]:
    """Words and break marks of the texts of each language."""
    found: dict[str, list[list[str]]] = {}
    for lang, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
        if text:
            tokens = _TOKEN.findall(_lowered(text))
            found.setdefault(_hidden(UNKNOWN if lang is None else lang), []).append(tokens)
    return found


def _pairs(counts: dict[str, Counter]) -> pa.RecordBatch:
    """Rows (key, n) of counted words, the key in the form of phrases."""
    keys = [f"{lang}{JOINT}{_hidden(w)}" for lang, words in counts.items() for w in words]
    numbers = [n for words in counts.values() for n in words.values()]
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(numbers, pa.int64())], ["key", "n"])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = {}
    for batch in by_size(batches, "text", _BATCH_BYTES):
        for lang, texts in _tokens(batch).items():
            own = counts.setdefault(lang, Counter())
            for tokens in texts:
                own.update(tokens)
        if sum(map(len, counts.values())) > _HELD_WORDS:
            yield _pairs(_without_breaks(counts))
            counts = {}
    yield _pairs(_without_breaks(counts))


def _without_breaks(counts: dict[str, Counter]) -> dict[str, Counter]:
    for words in counts.values():
        for mark in _BREAKS:
            words.pop(mark, None)
    return counts


def _bit(key: Column) -> Column:
    return F.pmod(F.crc32(key), F.lit(_BITS)).cast("int")


def _frequent_bits(words: DataFrame, least: int) -> np.ndarray:
    """Which of a fixed number of slots hold words that may occur ``least`` times."""
    slots = words.groupBy(_bit(F.col("key")).alias("slot")).agg(F.sum("n").alias("n"))
    rows = slots.where(F.col("n") >= least).select("slot").toArrow()
    bits = np.zeros(_BITS, dtype=bool)
    bits[rows["slot"].to_numpy()] = True
    return np.packbits(bits)


def _order_of(columns: list[np.ndarray], bound: int) -> np.ndarray:
    """Order of rows of small numbers from -1, as many columns packed into one as fit."""
    packed: list[np.ndarray] = []
    room = 0
    for column in columns:
        if room < bound + 1:
            packed.append(np.zeros(len(column), dtype=np.int64))
            room = 1 << 62
        packed[-1] = packed[-1] * (bound + 1) + column + 1
        room //= bound + 1
    return np.lexsort(packed[::-1])


def _windows_of(lang: str, texts: list[list[str]], bits: np.ndarray, longest: int) -> pa.RecordBatch:
    """Distinct windows of two to ``longest`` frequent words of one piece with counts, in prefix order."""
    ids: dict[str, int] = {}
    codes = [ids.setdefault(token, len(ids)) for tokens in texts for token in (*tokens, ".")]
    written = [_hidden(word) for word in ids]
    keys = [f"{lang}{JOINT}{word}".encode() for word in written]
    slots = np.fromiter(map(zlib.crc32, keys), np.int64, len(keys)) % _BITS
    frequent = (bits[slots >> 3] >> (7 - (slots & 7)).astype(np.uint8)) & 1 == 1
    for mark in _BREAKS:
        if mark in ids:
            frequent[ids[mark]] = False
    sequence = sorted(range(len(written)), key=written.__getitem__)
    rank = np.empty(len(written), dtype=np.int64)
    rank[sequence] = np.arange(len(written))
    rank[~frequent] = -1
    row = rank[np.array(codes, dtype=np.int64)]
    places = np.flatnonzero((row[:-1] >= 0) & (row[1:] >= 0))
    columns = [row[places], row[places + 1]]
    padded = np.append(row, np.full(longest, -1))
    for step in range(2, longest):
        following = padded[places + step]
        following[columns[-1] < 0] = -1
        columns.append(following)
    order = _order_of(columns, len(ids))
    columns = [column[order] for column in columns]
    new = np.ones(len(order), dtype=bool)
    new[1:] = np.any([column[1:] != column[:-1] for column in columns], axis=0)
    begins = np.flatnonzero(new)
    numbers = np.diff(np.append(begins, len(order)))
    words = pa.array([written[i] for i in sequence], pa.string())
    parts = [
        pc.take(words, pa.array(np.maximum(column[begins], 0), mask=column[begins] < 0))
        for column in columns
    ]
    front = pa.array([lang], pa.string()).take(pa.array(np.zeros(len(begins), dtype=np.int32)))
    joined = pc.binary_join_element_wise(front, *parts, JOINT, null_handling="skip")
    return pa.RecordBatch.from_arrays([joined, pa.array(numbers)], ["key", "n"])


def _with_ranges(windows: pa.RecordBatch, bounds: list[str]) -> pa.RecordBatch:
    """Windows in prefix order with the number of the range that each falls into."""
    keys = windows.column(0)
    cuts = [bisect_left(range(len(keys)), bound, key=lambda i: keys[i].as_py()) for bound in bounds]
    ranges = np.repeat(np.arange(len(bounds) + 1), np.diff([0, *cuts, len(keys)]))
    columns = [pa.array(ranges.astype(np.int32)), keys, windows.column(1)]
    return pa.RecordBatch.from_arrays(columns, ["range", "key", "n"])


def _columns(keys: pa.Array, width: int) -> list[pa.Array]:
    """The parts of each key as columns, null where there are fewer."""
    parts = pc.split_pattern(keys, JOINT)
    offsets = parts.offsets.to_numpy()
    starts, sizes = offsets[:-1], np.diff(offsets)
    flat = parts.values
    return [
        pc.take(flat, pa.array(np.where(sizes > j, starts + j, 0), mask=sizes <= j))
        for j in range(width)
    ]


def _rows(counted: list[tuple[str, int]]) -> pa.RecordBatch:
    keys, numbers = [key for key, _ in counted], [n for _, n in counted]
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(numbers, pa.int64())], ["key", "n"])


class _RangeCounts:
    """Counts of phrases of two words or more, from the windows of one range in prefix order.

    Phrases below ``least`` are left out, save those that the range begins or ends with,
    which may go on in the next one.
    """

    def __init__(self, least: int, longest: int):
        self.least, self.longest = least, longest
        # For each length: the open phrase, its count, and whether the range began with it.
        self.open: dict[int, tuple[str, int, bool]] = {}
        self.heads = True

    def add(self, keys: pa.Array, numbers: np.ndarray) -> list[tuple[str, int]]:
        parts = _columns(keys, self.longest + 1)
        new = np.zeros(len(keys), dtype=bool)
        new[0] = True
        told: list[tuple[str, int]] = []
        for length in range(self.longest + 1):
            part = parts[length]
            there = part.is_valid().to_numpy(zero_copy_only=False)
            part = pc.fill_null(part, "")
            new[1:] |= pc.not_equal(part[1:], part[:-1]).to_numpy(zero_copy_only=False)
            new[1:] |= there[1:] != there[:-1]
            if length >= 2:
                told += self._level(length, parts, np.flatnonzero(new), there, numbers)
        self.heads = False
        return told

    def _level(self, length, parts, begins, there, numbers) -> list[tuple[str, int]]:
        totals = np.add.reduceat(numbers, begins)
        valid = there[begins]
        last = len(begins) - 1

        def key_of(i: int) -> str:
            return JOINT.join(part[int(begins[i])].as_py() for part in parts[: length + 1])

        chosen = set(np.flatnonzero(valid & (totals >= self.least)).tolist())
        # The first and the last phrase may go on in the rows before and behind.
        chosen.update(i for i in (0, last) if valid[i])
        told = []
        known = self.open.pop(length, None)
        if known and not (valid[0] and known[0] == key_of(0)):
            if known[2] or known[1] >= self.least:
                told.append(known[:2])
            known = None
        for i in sorted(chosen):
            key, total, head = key_of(i), int(totals[i]), self.heads and i == 0
            if i == 0 and known:
                total, head = total + known[1], known[2]
            if i == last:
                self.open[length] = (key, total, head)
            elif head or total >= self.least:
                told.append((key, total))
        return told

    def end(self) -> list[tuple[str, int]]:
        return [known[:2] for known in self.open.values()]


def _counts_in_order(least: int, longest: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counts = None, None
        for batch in batches:
            ranges = batch.column(0).to_numpy()
            edges = np.flatnonzero(np.diff(ranges)) + 1
            for start, end in zip([0, *edges], [*edges, len(ranges)], strict=True):
                if start == end:
                    continue
                if ranges[start] != now:
                    if counts:
                        yield _rows(counts.end())
                    now, counts = ranges[start], _RangeCounts(least, longest)
                piece = batch.slice(start, end - start)
                yield _rows(counts.add(piece.column(1), piece.column(2).to_numpy()))
        if counts:
            yield _rows(counts.end())

    return count


def _bounds(windows: DataFrame, ranges: int) -> list[str]:
    """Keys that cut the windows of some documents into about equal parts."""
    parts = windows.repartitionByRange(ranges, "key").select(
        F.spark_partition_id().alias("part"), "key"
    )
    firsts = parts.groupBy("part").agg(F.min("key").alias("first")).orderBy("first").collect()
    return [row["first"] for row in firsts[1:]]


def phrase_counts(docs: DataFrame, plan: Collocations, lang: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Counts of all words, and of the phrases of 1 to ``words`` words with ``least`` places.

    Where ranges are cut is read off the windows of about ``_BOUND_ROWS`` documents; that
    decides how evenly tasks are filled, nothing else.
    """
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    rows = rows.where("text is not null")
    counted = rows.mapInArrow(_count_words, "key string, n long")
    words = settle(counted.groupBy("key").agg(F.sum("n").alias("n")), "words")
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(_frequent_bits(words, plan.least))
    longest = plan.words

    def windows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, "text", _BATCH_BYTES):
            for name, texts in _tokens(batch).items():
                yield _windows_of(name, texts, shared.value, longest)

    some = rows.where(F.rand(7) < _BOUND_ROWS / max(1, docs.count()))
    ranges = _RANGES_A_TASK * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = _bounds(some.mapInArrow(windows_of, "key string, n long"), ranges)

    def windows_in_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for windows in windows_of(batches):
            yield _with_ranges(windows, bounds)

    ordered = (
        rows.mapInArrow(windows_in_ranges, "range int, key string, n long")
        .repartition("range")
        .sortWithinPartitions("key")
        .mapInArrow(_counts_in_order(plan.least, longest), "key string, n long")
    )
    frequent = F.col("n") >= plan.least
    phrases = ordered.groupBy("key").agg(F.sum("n").alias("n")).where(frequent)
    return words, settle(phrases.unionByName(words.where(frequent)), "phrases")


def _merge_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a sorted stream tells of each phrase: counts of the phrases it begins with, best extension.

    Rows carried from earlier ranges only open phrases; for them just the extension is told.
    """
    schema = pa.schema(
        [("key", pa.string()), ("n", pa.int64()), ("parts", pa.list_(pa.int64())), ("longer", pa.int64())]
    )
    path: list[list] = []
    done: list[tuple] = []
    range_now = None

    def close(depth: int) -> None:
        while len(path) > depth:
            key, n, parts, longer, carried = path.pop()
            done.append((key, None if carried else n, None if carried else parts, longer))

    for batch in batches:
        columns = (batch.column(i).to_pylist() for i in range(4))
        for part, key, n, carried in zip(*columns, strict=True):
            if part != range_now:
                close(0)
                range_now = part
            depth = key.count(JOINT) - 1
            close(depth)
            if path:
                path[-1][3] = max(path[-1][3], n)
            path.append([key, n, [entry[1] for entry in path], 0, carried])
        if len(done) > 10_000:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*done, strict=True), schema.types)), schema=schema)
            done.clear()
    close(0)
    arrays = zip(*done, strict=True) if done else [[]] * 4
    yield pa.RecordBatch.from_arrays([pa.array(a, t) for a, t in zip(arrays, schema.types, strict=True)], schema=schema)


def _stream(phrases: DataFrame, key: Column) -> DataFrame:
    """key, n, parts, longer of phrases (key, n), merged in the order of ``key``."""
    keyed = phrases.select(key.alias("key"), "n")
    cut = keyed.repartitionByRange("key").sortWithinPartitions("key")
    stored = settle(cut.withColumn("range", F.spark_partition_id()), "ordered")
    # Phrases that are open where a range begins, at most one of each length.
    heads = stored.groupBy("range").agg(F.min("key").alias("head"))
    words = F.split("head", JOINT)
    shorter = F.transform(
        F.sequence(F.lit(2), F.size("words") - 1), lambda n: F.array_join(F.slice("words", 1, n), JOINT)
    )
    opened = (
        heads.withColumn("words", words)
        .where(F.size("words") > 2)
        .select("range", F.explode(shorter).alias("key"))
    )
    carried = opened.join(keyed, "key").select("range", "key", "n", F.lit(True).alias("carried"))
    both = stored.select("range", "key", "n", F.lit(False).alias("carried")).unionByName(carried)
    return (
        both.repartitionByRange("range")
        .sortWithinPartitions("range", "key")
        .mapInArrow(_merge_stream, "key string, n long, parts array<long>, longer long")
    )


def collocations(
    docs: DataFrame, plan: Collocations = Collocations(), lang: str = "lang", text: str = "text"
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the best phrases of each language."""
    words, phrases = phrase_counts(docs, plan, lang, text)
    scored = _scored(_both_streams(phrases), plan)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # The best of each of many parts first, so that no task ranks a whole language.
    part = F.pmod(F.xxhash64("phrase"), F.lit(_PARTS))
    for keys in (["lang", "part"], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        scored = scored.withColumn("part", part).withColumn("rank", rank.cast("long"))
        scored = scored.where(F.col("rank") <= plan.top)
    totals = words.groupBy(_word_of("key", 1).alias("lang")).agg(F.sum("n").alias("n"))
    return scored.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _word_of(key: str, number: int) -> Column:
    return _shown(F.split_part(key, F.lit(JOINT), F.lit(number)))


def _shown(text: Column) -> Column:
    for plain, written in _HIDDEN.items():
        text = F.replace(text, F.lit(written), F.lit(chr(plain)))
    return text


def _both_streams(phrases: DataFrame) -> DataFrame:
    """key, a, lefts, rights, longer: what both orders tell of a phrase."""
    parts = F.split("key", JOINT)
    turned = F.array_join(
        F.concat(F.slice(parts, 1, 1), F.reverse(F.slice(parts, 2, F.size(parts) - 1))), JOINT
    )
    none = F.lit(None).cast("array<bigint>")
    told = F.col("parts")
    prefixes = _stream(phrases, F.col("key")).select(
        "key", "n", told.alias("lefts"), none.alias("rights"), "longer"
    )
    suffixes = _stream(phrases, turned).select(
        turned.alias("key"), "n", none.alias("lefts"), told.alias("rights"), "longer"
    )
    return (
        prefixes.unionByName(suffixes)
        .groupBy("key")
        .agg(
            F.max("n").alias("a"),
            F.max("lefts").alias("lefts"),
            F.max("rights").alias("rights"),
            F.max("longer").alias("longer"),
        )
    )


def _scored(told: DataFrame, plan: Collocations) -> DataFrame:
    """lang, phrase, a, l, r, score of the phrases that no longer one replaces."""

    def wide(number: Column) -> Column:
        return number.cast("decimal(20,0)")

    def cut(k: Column) -> Column:
        left, right = F.get("lefts", k - 1), F.get("rights", F.size("lefts") - k)
        # Whole division; a quotient of decimals would be rounded to a few digits first.
        score = F.call_function("div", F.lit(plan.scale) * wide(F.col("a")), wide(left) + wide(right))
        return F.struct(score.alias("score"), k.alias("k"), left.alias("l"), right.alias("r"))

    best = F.array_min(F.transform(F.sequence(F.lit(1), F.size("lefts")), cut))
    replaced = 100 * wide(F.col("longer")) >= plan.share * wide(F.col("a"))
    words = F.slice(F.split("key", JOINT), 2, plan.words)
    return (
        told.where(F.size("lefts") > 0)
        .where(~replaced)
        .withColumn("cut", best)
        .select(
            _word_of("key", 1).alias("lang"),
            _shown(F.array_join(words, " ")).alias("phrase"),
            "a",
            "cut.l",
            "cut.r",
            "cut.score",
        )
    )
