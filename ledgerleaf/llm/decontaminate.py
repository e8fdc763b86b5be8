"""Documents that hold passages of a benchmark, also with small changes.

Method: q-gram lemma filtering. Texts are reduced to their letters and digits in
lower case. Benchmark items are cut to overlapping passages of ``passage``
characters, and to excerpts of ``excerpt`` characters, one every ``stride``. Items
of up to ``whole`` characters are one more passage each, with a budget of edits in
proportion to the item. A copy of a passage of ``m`` characters with at most ``e``
edits shares ``m - q + 1 - q * e`` of its q-grams with the passage, all on diagonals
(place in the text minus place in the passage) that differ by at most ``e``. So
shared q-grams are counted in overlapping bands of ``2 * (e + 1)`` diagonals,
bands that reach the bound are kept, and a banded alignment verifies them. A passage of
fewer than ``short`` characters has to be found as whole words; characters of scripts
without blanks are words of their own.

The benchmark is the stated set of queries. It goes to the tasks in blocks of a
bounded number of characters, one pass over the documents for each block; the
documents are neither shuffled nor collected.

Null and empty texts hold nothing. Items whose passages are shorter than ``q``
characters are too short to be recognised. Repeated rows and items are judged one
by one, also items without an id or with a shared one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE = np.uint64(0x9E3779B97F4A7C15)
TABLE_BITS = 20
BLOCK_CHARS = 2_000_000
# Ranges of code points whose scripts are written without blanks.
NO_BLANKS = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0xA4CF), (0xAC00, 0xFAFF))
HITS = "array<struct<item:bigint,start:bigint,stop:bigint,edits:int>>"


@dataclass(frozen=True)
class Decontamination:
    """``edits`` is the share of a passage's characters that may differ, ``whole_edits``
    that of a whole item of up to ``whole`` characters.

    Any exact excerpt of ``excerpt + stride - 1`` characters holds a whole one of those
    that are looked for.
    """

    q: int = 8
    passage: int = 100
    edits: float = 0.05
    whole: int = 400
    whole_edits: float = 0.10
    excerpt: int = 60
    stride: int = 10
    short: int = 25

    def budget(self, length: int, share: float | None = None) -> int:
        """Most edits of a passage; at least one q-gram has to be left."""
        share = self.edits if share is None else share
        return max(0, min(int(share * length), (length - self.q) // self.q))


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Lower case of each letter and digit by code point, 0 for anything else."""
    table = np.zeros(0x110000, np.uint32)
    for code in range(0x110000):
        c = chr(code)
        if c.isalnum():
            low = c.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def _reduce(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Letters and digits of a text in lower case, and their places in it."""
    try:
        codes, table = np.frombuffer(text.encode("latin-1"), np.uint8), _letters()[:256]
    except UnicodeEncodeError:
        codes, table = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), _letters()
    letters = table[codes]
    places = np.flatnonzero(letters != 0)
    return letters[places], places


def _limits(letters: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Whether a word begins or ends before each letter, and after the last one."""
    limits = np.ones(len(letters) + 1, bool)
    limits[1:-1] = np.diff(places) > 1
    if letters.dtype != np.uint8 and len(letters) and letters.max() >= NO_BLANKS[0][0]:
        for low, high in NO_BLANKS:
            alone = (letters >= low) & (letters <= high)
            limits[:-1] |= alone
            limits[1:] |= alone
    return limits


def _grams(letters: np.ndarray, q: int) -> np.ndarray:
    """A hash of each run of ``q`` letters, put together from runs of powers of two."""
    n = len(letters) - q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total: np.ndarray | None = None
    runs, size, at = letters.astype(np.uint64), 1, 0
    while size <= q:
        if q & size:
            part = runs[at : at + n]
            total = part.copy() if total is None else total * _power(size) + part
            at += size
        if 2 * size <= q:
            runs = runs[:-size] * _power(size) + runs[size:]
        size *= 2
    return total ^ (total >> np.uint64(31))


def _power(exponent: int) -> np.uint64:
    return np.uint64(pow(int(BASE), exponent, 1 << 64))


def _starts(n: int, length: int, step: int) -> list[int]:
    """Starts of pieces that cover ``n`` letters, the last one at their end."""
    return [0] if n <= length else [*range(0, n - length, max(1, step)), n - length]


def _passages(letters: np.ndarray, rule: Decontamination) -> Iterator[tuple[np.ndarray, int]]:
    """Pieces of an item, each with its budget of edits: excerpts, passages, the whole."""
    n, seen = len(letters), set()
    if n <= rule.whole:
        seen.add((0, n))
        yield letters, rule.budget(n, rule.whole_edits)
    for length, step in ((rule.passage, rule.passage // 2), (rule.excerpt, rule.stride)):
        for start in _starts(n, length, step):
            stop = min(n, start + length)
            if (start, stop) not in seen:
                seen.add((start, stop))
                yield letters[start:stop], rule.budget(stop - start)


class PassageIndex:
    """The q-grams of all passages of some items, sorted."""

    def __init__(self, items: list[tuple[int | None, str]], rule: Decontamination) -> None:
        self.rule = rule
        self.passages: list[np.ndarray] = []
        owners, keys, places, numbers, budgets = [], [], [], [], []
        self.ids = [item for item, _ in items]
        for item, (_, text) in enumerate(items):
            for passage, budget in _passages(_reduce(text)[0], rule):
                grams = _grams(passage, rule.q)
                if not len(grams):
                    continue
                keys.append(grams)
                places.append(np.arange(len(grams)))
                numbers.append(np.full(len(grams), len(self.passages)))
                owners.append(item)
                budgets.append(budget)
                self.passages.append(passage)
        none = np.empty(0, np.int64)
        key = np.concatenate(keys) if keys else none.astype(np.uint64)
        order = np.argsort(key, kind="stable")
        self.owner = np.array(owners, np.int64)
        self.key = key[order]
        self.place = (np.concatenate(places) if places else none)[order]
        self.number = (np.concatenate(numbers) if numbers else none)[order]
        lengths = np.array([len(p) for p in self.passages], np.int64)
        self.budget = np.array(budgets, np.int64)
        self.bound = np.maximum(1, lengths - rule.q + 1 - rule.q * self.budget)
        self.known = np.zeros(1 << TABLE_BITS, bool)
        self.known[self.key >> np.uint64(64 - TABLE_BITS)] = True

    def _regions(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(passage, first diagonal of a band) where a band has enough shared q-grams."""
        maybe = np.flatnonzero(self.known[grams >> np.uint64(64 - TABLE_BITS)])
        low = np.searchsorted(self.key, grams[maybe], "left")
        count = np.searchsorted(self.key, grams[maybe], "right") - low
        ends = np.cumsum(count)
        at = np.repeat(low - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)
        number = self.number[at]
        width = self.budget[number] + 1
        band = (np.repeat(maybe, count) - self.place[at]) // width
        # Every diagonal lies in two bands, which overlap by half.
        number, band = np.r_[number, number], np.r_[band, band - 1]
        if not len(number):
            return number, band
        order = np.lexsort((band, number))
        number, band = number[order], band[order]
        fresh = np.flatnonzero(np.r_[True, (np.diff(number) != 0) | (np.diff(band) != 0)])
        size = np.diff(np.r_[fresh, len(number)])
        enough = fresh[size >= self.bound[number[fresh]]]
        number, band = number[enough], band[enough]
        return number, band * (self.budget[number] + 1)

    def find(self, text: str) -> list[tuple[int | None, int, int, int]]:
        """(item, start, stop, edits) of verified passages, joined for each item."""
        letters, places = _reduce(text)
        limits = _limits(letters, places)
        best: dict[int, tuple[int, int, int]] = {}
        for number, diagonal in zip(*self._regions(_grams(letters, self.rule.q)), strict=True):
            passage, budget = self.passages[number], int(self.budget[number])
            width = 2 * (budget + 1)
            words = limits if len(passage) < self.rule.short else None
            found = exact_match(passage, letters, int(diagonal), width, words)
            if found is None and budget:
                found = banded_match(passage, letters, int(diagonal), width, budget)
            if found is None:
                continue
            edits, first, last = found
            if words is not None and not (words[first] and words[last]):
                continue
            item = int(self.owner[number])
            start, stop = int(places[first]), int(places[last - 1]) + 1
            old = best.get(item, (start, stop, edits))
            best[item] = (min(old[0], start), max(old[1], stop), min(old[2], edits))
        found = [(self.ids[item], *rest) for item, rest in best.items()]
        return sorted(found, key=lambda hit: (hit[0] is None, hit[0] or 0, *hit[1:]))


def exact_match(
    passage: np.ndarray,
    letters: np.ndarray,
    diagonal: int,
    width: int,
    limits: np.ndarray | None = None,
) -> tuple[int, int, int] | None:
    """(0, start, stop) of an exact copy on the diagonals of a band, as no alignment is needed.

    With ``limits`` it has to begin and end at one of them.
    """
    low, high = max(0, diagonal), min(len(letters) - len(passage), diagonal + width - 1)
    if high < low:
        return None
    runs = np.lib.stride_tricks.sliding_window_view(letters[low : high + len(passage)], len(passage))
    equal = (runs == passage).all(axis=1)
    if limits is not None:
        equal &= limits[low : high + 1] & limits[low + len(passage) : high + len(passage) + 1]
    same = np.flatnonzero(equal)
    return (0, low + int(same[0]), low + int(same[0]) + len(passage)) if len(same) else None


def banded_match(
    passage: np.ndarray, letters: np.ndarray, diagonal: int, width: int, budget: int
) -> tuple[int, int, int] | None:
    """Best alignment of ``passage`` inside a band of diagonals: (edits, start, stop).

    The alignment begins and ends anywhere in the text and stays on the diagonals
    ``diagonal - budget`` to ``diagonal + width + budget``. None if it needs more
    than ``budget`` edits.
    """
    first, size = diagonal - budget, width + 2 * budget + 1
    far = budget + 1
    offsets = np.arange(size)
    inside = (first + offsets >= 0) & (first + offsets <= len(letters))
    cost = np.where(inside, 0, far)
    begin = first + offsets
    for row, letter in enumerate(passage, start=1):
        at = first + offsets + row - 1  # the letter that a step along the diagonal takes
        ok = (at >= 0) & (at < len(letters))
        same = np.zeros(size, bool)
        same[ok] = letters[at[ok]] == letter
        step = cost + ~same
        step[~ok] = far
        down = np.r_[cost[1:] + 1, far]  # the passage's letter is missing in the text
        take = down < step
        cost = np.where(take, down, step)
        begin = np.where(take, np.r_[begin[1:], begin[-1]], begin)
        # A letter of the text that the passage lacks: from the diagonal before.
        reached = np.minimum.accumulate(cost - offsets) + offsets
        source = np.maximum.accumulate(np.where(cost - offsets == reached - offsets, offsets, 0))
        begin = np.where(reached < cost, begin[source], begin)
        cost = np.minimum(np.where(at + 1 <= len(letters), reached, far), far)
        if cost.min() > budget:
            return None
    end = int(cost.argmin())
    start, stop = int(begin[end]), first + end + len(passage)
    if cost[end] > budget or stop <= start:
        return None
    return int(cost[end]), max(0, start), min(stop, len(letters))


def _blocks(benchmark: DataFrame, key: str, text: str) -> Iterator[list[tuple[int | None, str]]]:
    """Items in blocks of a bounded number of characters, one item at least."""
    item, words = F.col(key).cast("long").alias("item"), F.col(text).cast("string").alias("words")
    rows = benchmark.select(item, words)
    block: list[tuple[int | None, str]] = []
    held = 0
    for item, words in rows.where("words is not null").toLocalIterator():
        if block and held + len(words) > BLOCK_CHARS:
            yield block
            block, held = [], 0
        block.append((item, words))
        held += len(words)
    if block:
        yield block


# Indexes of the last blocks a worker has met, each with the block it was built from.
_ready: dict[int, tuple[list, PassageIndex]] = {}
MOST_READY = 4


def _index_of(items: list[tuple[int | None, str]], rule: Decontamination) -> PassageIndex:
    if id(items) not in _ready:
        while len(_ready) >= MOST_READY:
            _ready.pop(next(iter(_ready)))
        _ready[id(items)] = (items, PassageIndex(items, rule))
    return _ready[id(items)][1]


def _hits(block, rule: Decontamination):
    """The passages of one block in a column of texts."""

    def search(column: pa.Array) -> pa.Array:
        index = _index_of(block.value, rule)
        found = [
            [
                dict(zip(("item", "start", "stop", "edits"), hit, strict=True))
                for hit in (index.find(text.as_py()) if text.is_valid else [])
            ]
            for text in column
        ]
        kind = pa.struct(
            [("item", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()), ("edits", pa.int32())]
        )
        return pa.array(found, pa.list_(kind))

    return F.arrow_udf(search, HITS)


def find_passages(
    text: Column,
    benchmark: DataFrame,
    rule: Decontamination = Decontamination(),
    item_key: str = "item_id",
    item_text: str = "text",
) -> Column:
    """A column of (item, start, stop, edits): the benchmark items found in ``text``.

    Start and stop are code points from the first to the last verified passage.
    """
    context = benchmark.sparkSession.sparkContext
    parts = [
        _hits(context.broadcast(block), rule)(text.cast("string"))
        for block in _blocks(benchmark, item_key, item_text)
    ]
    return F.concat(*parts) if parts else F.array().cast(HITS)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    rule: Decontamination = Decontamination(),
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row for each document and item found in it: key, item_id, start, stop, edits."""
    hits = find_passages(F.col(text), benchmark, rule)
    rows = docs.select(F.col(key).alias("_key"), F.explode(hits).alias("hit"))
    return rows.select(
        F.col("_key").alias(key), F.col("hit.item").alias("item_id"), "hit.start", "hit.stop", "hit.edits"
    )


def keep_clean(
    docs: DataFrame, benchmark: DataFrame, rule: Decontamination = Decontamination()
) -> DataFrame:
    """The rows of ``docs`` (text, any others) that hold no passage of the benchmark."""
    return docs.where(F.size(find_passages(docs["text"], benchmark, rule)) == 0)
