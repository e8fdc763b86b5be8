"""The most similar text of the same block, by longest common subsequence.

Comparing all pairs of a block is what this avoids. A common subsequence cannot have more
letters than both texts have of each, so the letter counts of a text bound its similarity
from above, and the largest counts of a set of texts bound all of them at once.

The right texts of a block, ordered by their letters, are cut into pieces of some thousand,
the left texts into chunks of some hundred. A chunk meets the pieces of its block in order
of their bounds; only texts travel, their letters are counted where they arrive. In a piece
the texts stand in leaves with the largest counts of each: a left text takes the leaves that
may hold something better, and tests their texts in order of their bounds until no bound is
above its best, which it carries on to the next piece. Where a block has several pieces, they come
twice: the first time only the most promising texts of each are tested.

Pairs of a chunk and a piece are rows of their own, so a block of any size is spread over
all tasks. What they move is the texts of a block once for each chunk and each piece of the
other side, not once for each text. Equal texts of a block are compared once.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf.functions.names import check_unique, quoted
from ledgerleaf.functions.text import subsequence_length
from ledgerleaf.scratch import settle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Texts of a leaf, a piece of the right and a chunk of the left side, and most letters of the two.
FANOUT = 32
PIECE, PIECE_LETTERS = 4096, 1 << 20
CHUNK, CHUNK_LETTERS = 512, 1 << 18
# Letters share a counter when their code points agree modulo this; that only raises bounds.
COUNTERS = 96
# Tests of a text in each piece the first time, where pieces come twice.
PROMISING = 4
_COUNTS = np.dtype(np.uint32)
_OWN = ("_block", "_text")

_GROUP = "block string, id long, texts array<string>, keys array<long>, top binary"
_GROUP_SCHEMA = pa.schema(
    [
        ("block", pa.string()),
        ("id", pa.int64()),
        ("texts", pa.list_(pa.string())),
        ("keys", pa.list_(pa.int64())),
        ("top", pa.binary()),
    ]
)


def _letter_counts(texts: list[str]) -> np.ndarray:
    """One row of counters for each text."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    rows = np.repeat(np.arange(len(texts)), [len(text) for text in texts])
    found = np.bincount(rows * COUNTERS + codes % COUNTERS, minlength=len(texts) * COUNTERS)
    return found.astype(_COUNTS).reshape(-1, COUNTERS)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    arrays = [pa.array(list(c), t) for c, t in zip(columns, schema.types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _gather(most: int, most_letters: int):
    """Neighbouring texts of a block as one row, with the largest of their counts."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 33, 0
        block, texts, keys, letters = None, [], [], 0
        for batch in batches:
            for own, text, key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                full = len(texts) == most or letters + len(text) > most_letters
                if texts and (own != block or full):
                    top = _letter_counts(texts).max(axis=0).tobytes()
                    yield _batch([(block, base + made, texts, keys, top)], _GROUP_SCHEMA)
                    made, texts, keys, letters = made + 1, [], [], 0
                block = own
                texts.append(text)
                keys.append(key)
                letters += len(text)
        if texts:
            top = _letter_counts(texts).max(axis=0).tobytes()
            yield _batch([(block, base + made, texts, keys, top)], _GROUP_SCHEMA)

    return gather


def _groups(rows: DataFrame, most: int, most_letters: int, label: str) -> DataFrame:
    """Rows (block, text, key) as rows of many texts, ordered by their letters."""
    letters = F.concat_ws("", F.array_sort(F.split("text", "")))
    texts = rows.withColumn("letters", letters).repartitionByRange("block", "letters", "text")
    ordered = texts.sortWithinPartitions("block", "letters", "text").select("block", "text", "key")
    return settle(ordered.mapInArrow(_gather(most, most_letters), _GROUP), label)


_PAIR = "block string, chunk long, piece long, bound long"
_PAIR_SCHEMA = pa.schema(
    [("block", pa.string()), ("chunk", pa.int64()), ("piece", pa.int64()), ("bound", pa.int64())]
)


def _bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bound of all texts of a chunk with all texts of a piece."""
    for batch in batches:
        block, chunk, chunk_top, piece, piece_top = batch.columns
        tops = [
            np.frombuffer(b"".join(column.to_pylist()), dtype=_COUNTS).reshape(-1, COUNTERS)
            for column in (chunk_top, piece_top)
        ]
        bounds = np.minimum(*tops).sum(axis=1, dtype=np.int64)
        yield pa.RecordBatch.from_arrays([block, chunk, piece, pa.array(bounds)], schema=_PAIR_SCHEMA)


class _Piece:
    """The texts of a piece with their counts, a column for each text, and those of their leaves."""

    def __init__(self, texts: list[str], keys: list[int]):
        counts = _letter_counts(texts)
        starts = np.arange(0, len(texts), FANOUT)
        self.texts, self.keys = texts, np.array(keys, dtype=np.int64)
        self.counts = np.ascontiguousarray(counts.T)
        self.tops = np.ascontiguousarray(np.maximum.reduceat(counts, starts).T)
        self.firsts = np.minimum.reduceat(self.keys, starts)

    def better(self, text: str, counts: np.ndarray, best: int, best_key: int | None, most: int) -> tuple:
        """Length and key of the best text, the given ones if no other is better, and tests made.

        Not more than ``most`` are made.
        """
        used = np.flatnonzero(counts)
        own = counts[used, None]

        def promising(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            bounds = np.minimum(table, own).sum(axis=0, dtype=np.int64)
            hope = bounds >= best if best_key is None else (bounds > best) | ((bounds == best) & (keys < best_key))
            return np.flatnonzero(hope), bounds

        leaves, _ = promising(self.tops[used], self.firsts)
        if not len(leaves):
            return best, best_key, 0
        places = (leaves[:, None] * FANOUT + np.arange(FANOUT)).ravel()
        places = places[places < len(self.texts)]
        some = self.counts[used] if len(places) == len(self.texts) else self.counts[np.ix_(used, places)]
        chosen, bounds = promising(some, self.keys[places])
        places, bounds = places[chosen], bounds[chosen]
        keys = self.keys[places]
        order = np.lexsort((keys, -bounds))
        tested = 0
        for i, bound, key in zip(places[order].tolist(), bounds[order].tolist(), keys[order].tolist(), strict=True):
            if bound < best or tested == most:
                break
            if bound == best and best_key is not None and key >= best_key:
                continue
            length = subsequence_length(text, self.texts[i])
            tested += 1
            if length > best or (length == best and (best_key is None or key < best_key)):
                best, best_key = length, key
        return best, best_key, tested


_FOUND = "block string, text string, best long, key long, tested long"
_FOUND_SCHEMA = pa.schema(
    [("block", pa.string()), ("text", pa.string()), *[(n, pa.int64()) for n in ("best", "key", "tested")]]
)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Best text for each of a chunk, which meets its pieces in order of their bounds."""
    now, block, texts, counts, state, held, piece = None, None, [], None, [], None, None
    for batch in batches:
        for row in range(batch.num_rows):
            own, chunk, number, bound, last = (batch.column(i)[row].as_py() for i in range(5))
            if chunk != now:
                if now is not None:
                    yield _batch([(block, t, *s) for t, s in zip(texts, state, strict=True)], _FOUND_SCHEMA)
                now, block, texts = chunk, own, batch.column(5)[row].as_py()
                counts, state = _letter_counts(texts), [(-1, None, 0)] * len(texts)
            if bound < min(best for best, _, _ in state):
                continue
            if number != held:
                held, piece = number, _Piece(*(batch.column(i)[row].as_py() for i in (6, 7)))
            for i, (best, key, tested) in enumerate(state):
                if bound >= best:
                    best, key, more = piece.better(texts[i], counts[i], best, key, len(piece.texts) if last else PROMISING)
                    state[i] = (best, key, tested + more)
    if now is not None:
        yield _batch([(block, t, *s) for t, s in zip(texts, state, strict=True)], _FOUND_SCHEMA)


def _best(chunks: DataFrame, pieces: DataFrame) -> DataFrame:
    """Block, text, best, key, tested of the texts whose block has texts on the right."""
    heads = chunks.select("block", F.col("id").alias("chunk"), F.col("top").alias("chunk_top"))
    twice = pieces.groupBy("block").agg((F.count(F.lit(1)) > 1).alias("twice"))
    tops = pieces.select("block", F.col("id").alias("piece"), F.col("top").alias("piece_top"))
    pairs = heads.join(tops, "block").select("block", "chunk", "chunk_top", "piece", "piece_top")
    times = F.when(F.col("twice"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(True)))
    pairs = pairs.mapInArrow(_bound, _PAIR).join(twice, "block").withColumn("last", F.explode(times))
    lefts = chunks.select(F.col("id").alias("chunk"), F.col("texts").alias("left"))
    rights = pieces.select(F.col("id").alias("piece"), "texts", "keys")
    # A number of tasks of its own: comparing takes long for few bytes, by which they would be merged.
    tasks = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = pairs.join(lefts, "chunk").join(rights, "piece").repartition(tasks, "chunk")
    ordered = rows.sortWithinPartitions("chunk", "last", F.col("bound").desc(), "piece")
    columns = ["block", "chunk", "piece", "bound", "last", "left", "texts", "keys"]
    return ordered.select(*columns).mapInArrow(_compare, _FOUND)


def lcs_best(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    left_text: str,
    right_key: str,
    right_text: str,
    left_block: str,
    right_block: str,
) -> DataFrame:
    """Every left row with the right row of its block that shares the longest subsequence.

    Adds ``best_key``, ``best_length`` and ``n_tested``, the number of texts that the text
    of the row was compared with. Of equally long ones the smallest key wins. A row whose
    text or block is null, or whose block has no text on the right, keeps nulls; so right
    rows with a null text, block or key match nothing. Keys of ``right`` are whole numbers.
    """
    check_unique([*left.columns, "best_key", "best_length", "n_tested", *_OWN])
    own = [quoted(right_block), quoted(right_text), quoted(right_key)]
    names = ["block", "text", "key"]
    types = ["string", "string", "bigint"]
    rights = (
        right.select(*[c.cast(t).alias(n) for c, n, t in zip(own, names, types, strict=True)])
        .dropna()
        .groupBy("block", "text")
        .agg(F.min("key").alias("key"))
    )
    texts = left.select(quoted(left_block).cast("string").alias("block"), quoted(left_text).cast("string").alias("text"))
    distinct = texts.dropna().distinct().withColumn("key", F.lit(None).cast("bigint"))
    pieces = _groups(rights, PIECE, PIECE_LETTERS, "pieces")
    found = _best(_groups(distinct, CHUNK, CHUNK_LETTERS, "chunks"), pieces)
    final = settle(found, "found").select(
        F.col("block").alias("_block"),
        F.col("text").alias("_text"),
        F.col("key").alias("best_key"),
        F.col("best").alias("best_length"),
        F.col("tested").alias("n_tested"),
    )
    same = [
        quoted(left_block).cast("string") == F.col("_block"),
        quoted(left_text).cast("string") == F.col("_text"),
    ]
    return left.join(final, same, "left").drop("_block", "_text")
