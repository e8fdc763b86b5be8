"""Removal of word passages that occur earlier in the corpus.

A window is ``width`` neighbouring words. A word goes when a window that covers
it has the same words as a window that starts earlier: in a document of smaller
id, or earlier in the same document. Windows are judged on the input.

Method: De Bruijn compaction. Every window is an edge of the graph of word
k-mers. Neighbouring windows that share the same smallest inner k-mer form one
path without branches, so a path stands for about seven windows. Spark brings
paths together by that k-mer:

* paths of equal words: all but the earliest repeat it, with all their windows,
* a k-mer with paths of different words is a branching point. The earliest path
  of each kind is opened into its windows again, and these are compared.

Equal windows have the same smallest k-mer at the same place, so a repeated
window is never missed, and its earliest place lies in an earliest path. Words
are compared by two independent 64-bit hashes; coordinates in the source rows
decide which place is the earliest and which words go.

Paths of equal words within a batch are reduced to the earliest one before they
are shuffled, so a passage that a third of all documents share is one row for
each batch, not one for each document. No document leaves its row: what is
collected for one are spans in it.

Null and empty texts have no words. Rows with equal id and text count as one
document: they do not repeat each other. Rows that share an id but not the text
are documents of their own, as is every row without an id; these come after all
others. Other columns are ignored. ``repeated_spans`` alone needs keys that tell
the documents apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerleaf.llm.common import by_size, own_rows
from ledgerleaf.llm.shingles import RunHashes, WordHashes
from ledgerleaf.scratch import settle

WIDTH = 20
INNER = 6
PIECE_WORDS = 1 << 20
BATCH_BYTES = 16 << 20
LAST_ID = np.iinfo(np.int64).max
PLACE_BITS = np.uint64(24)

PATHS = "anchor long, h1 long, h2 long, doc long, start int, size int, done boolean"
WINDOWS = "h1 long, h2 long, doc long, start int, size int, done boolean"


def _pieces(texts: list[str | None], width: int, hashes: WordHashes) -> Iterator[tuple]:
    """(rows, offsets, words): texts cut to pieces that share ``width - 1`` words, in groups."""
    rows, offsets, words, held = [], [], [], 0
    for row, text in enumerate(texts):
        found = hashes.of(text.encode("utf-8", "surrogatepass").split()) if text else ()
        for offset in range(0, max(0, len(found) - width + 1), PIECE_WORDS):
            piece = found[offset : offset + PIECE_WORDS + width - 1]
            rows.append(row)
            offsets.append(offset)
            words.append(piece)
            held += len(piece)
            if held >= PIECE_WORDS:
                yield rows, offsets, words
                rows, offsets, words, held = [], [], [], 0
    if rows:
        yield rows, offsets, words


def _smallest_inner(flat: np.ndarray, runs: RunHashes, width: int, inner: int) -> np.ndarray:
    """For each window start, where its smallest k-mer starts; the leftmost of equal ones."""
    starts = np.arange(len(flat) - inner + 1)
    order = (runs.of(starts, inner) >> PLACE_BITS << PLACE_BITS) | starts.astype(np.uint64)
    span, reach = width - inner + 1, 1
    while reach * 2 <= span:
        order = np.minimum(order[:-reach], order[reach:])
        reach *= 2
    if reach < span:
        order = np.minimum(order[: len(order) - (span - reach)], order[span - reach :])
    return (order & np.uint64((1 << 24) - 1)).astype(np.int64)


def _signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


def _first_of_equal(h1: np.ndarray, h2: np.ndarray, doc: np.ndarray, start: np.ndarray):
    """Which rows repeat an earlier row of equal hashes."""
    order = np.lexsort((start, doc, h2, h1))
    h1, h2, doc, start = h1[order], h2[order], doc[order], start[order]
    fresh = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])] if len(h1) else np.empty(0, bool)
    first = np.maximum.accumulate(np.where(fresh, np.arange(len(h1)), 0))
    later = (doc != doc[first]) | (start != start[first])
    result = np.empty(len(h1), bool)
    result[order] = later
    return result


def _paths(ids: np.ndarray, texts: list[str | None], width: int, hashes: WordHashes):
    """Paths of a batch, as the columns of ``PATHS``."""
    for rows, offsets, words in _pieces(texts, width, hashes):
        flat = np.concatenate(words)
        sizes = np.array([len(w) for w in words])
        piece = np.repeat(np.arange(len(words)), sizes)
        begin = np.cumsum(sizes) - sizes
        runs, again = RunHashes(flat), RunHashes(flat, 1)
        place = _smallest_inner(flat, runs, width, INNER)
        valid = np.flatnonzero(piece[: len(flat) - width + 1] == piece[width - 1 :])
        anchor = place[valid]
        fresh = np.r_[True, (anchor[1:] != anchor[:-1]) | (np.diff(valid) != 1)]
        first = np.flatnonzero(fresh)
        count = np.diff(np.r_[first, len(valid)])
        at = valid[first]
        own = piece[at]
        h1, h2 = _signed(runs.of(at, count + width - 1)), _signed(again.of(at, count + width - 1))
        doc = ids[np.array(rows)[own]]
        start = at - begin[own] + np.array(offsets)[own]
        done = _first_of_equal(h1, h2, doc, start)
        kmer = _signed(runs.of(anchor[first], INNER))
        # Rows that are done need no partner: any key will do.
        yield np.where(done, h1 + doc, kmer), h1, h2, doc, start, count, done


def _batch(columns, schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    names, types = zip(*(part.split() for part in schema.split(", ")), strict=True)
    arrays = [pa.array(c).cast(kinds[t]) for c, t in zip(columns, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, list(names))


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(LAST_ID).to_numpy(zero_copy_only=False)


def _find_paths(rows: DataFrame, width: int) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in by_size(batches, "text", BATCH_BYTES):
            for columns in _paths(_ids(batch.column(0)), batch.column(1).to_pylist(), width, hashes):
                yield _batch(columns, PATHS)

    return rows.mapInArrow(find, PATHS)


def _open_paths(joined: DataFrame, width: int) -> DataFrame:
    """The windows of the paths named in ``opened``, a list of (start, size) for each text."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in by_size(batches, "text", BATCH_BYTES):
            docs, starts, first, second = [], [], [], []
            for doc, text, opened in zip(
                _ids(batch.column(0)), batch.column(1), batch.column(2), strict=True
            ):
                words = hashes.of(text.as_py().encode("utf-8", "surrogatepass").split())
                places = opened.values
                begin = places.field("start").to_numpy().astype(np.int64)
                size = places.field("size").to_numpy().astype(np.int64)
                at = np.unique(
                    np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
                )
                at = at[at + width <= len(words)]
                docs.append(np.full(len(at), doc))
                starts.append(at)
                first.append(RunHashes(words).of(at, width))
                second.append(RunHashes(words, 1).of(at, width))
            if docs:
                h1, h2 = _signed(np.concatenate(first)), _signed(np.concatenate(second))
                doc, start = np.concatenate(docs), np.concatenate(starts)
                done = _first_of_equal(h1, h2, doc, start)
                h1 = np.where(done, h1 + doc, h1)
                yield _batch((h1, h2, doc, start, np.ones(len(doc), int), done), WINDOWS)

    return joined.mapInArrow(find, WINDOWS)


def repeated_spans(
    docs: DataFrame, width: int = WIDTH, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc, spans): for each document with repeats, the sorted (start, stop) words that go."""
    rows = docs.select(
        F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text")
    ).where("text is not null")
    at = Window.partitionBy("anchor").orderBy("done", "h1", "h2", "doc", "start")
    every = at.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    same = (F.lag("h1").over(at) == F.col("h1")) & (F.lag("h2").over(at) == F.col("h2"))
    moved = (F.lag("doc").over(at) != F.col("doc")) | (F.lag("start").over(at) != F.col("start"))
    branches = (F.first("h1").over(every) != F.last("h1").over(every)) | (
        F.first("h2").over(every) != F.last("h2").over(every)
    )
    judged = _find_paths(rows, width).select(
        "doc",
        "start",
        "size",
        F.when(F.col("done"), "later")
        .when(same & ~F.lag("done").over(at), F.when(moved, "later").otherwise("twin"))
        .when(branches, "open")
        .alias("kind"),
    )
    paths = settle(judged.where("kind in ('later', 'open')"), "paths")
    to_open = (
        paths.where("kind = 'open'")
        .groupBy("doc")
        .agg(F.collect_list(F.struct("start", "size")).alias("opened"))
    )
    same_id = F.coalesce(rows["doc"], F.lit(int(LAST_ID))) == to_open["doc"]
    windows = _open_paths(rows.join(to_open, same_id).select(rows["doc"], "text", "opened"), width)
    by_words = Window.partitionBy("h1", "h2").orderBy("done", "doc", "start")
    earliest = F.first(F.struct("doc", "start")).over(by_words)
    later = windows.select(
        "doc",
        "start",
        "size",
        (
            F.col("done")
            | (earliest["doc"] != F.col("doc"))
            | (earliest["start"] != F.col("start"))
        ).alias("later"),
    ).where("later")
    parts = paths.where("kind = 'later'").select("doc", "start", "size")
    parts = parts.unionByName(later.select("doc", "start", "size"))
    return (
        parts.groupBy("doc")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct("start", (F.col("start") + F.col("size") + width - 1).alias("stop"))
                )
            ).alias("spans")
        )
    )


def remove_repeats(
    docs: DataFrame, width: int = WIDTH, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row for each document: key, n_words, n_removed and ``kept``, its other words."""
    own, _ = own_rows(docs, key, text, share=True)
    spans = settle(repeated_spans(own, width, "_row", text), "spans")
    rows = own.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), "_row")
    joined = rows.join(spans, rows["_row"] == spans["doc"], "left").select("key", "text", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, "text"):
            count, removed, kept = [], [], []
            for text, own in zip(batch.column(1), batch.column(2), strict=True):
                words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                n = len(words)
                if own.is_valid:
                    change = np.zeros(n + 1, np.int32)
                    stops = np.minimum(own.values.field("stop").to_numpy(), n)
                    np.add.at(change, np.minimum(own.values.field("start").to_numpy(), n), 1)
                    np.add.at(change, stops, -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(change[:n]) == 0)]
                count.append(n)
                removed.append(n - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(count, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                ["key", "n_words", "n_removed", "kept"],
            )

    kind = rows.schema["key"].dataType.simpleString()
    result = joined.mapInArrow(cut, f"key {kind}, n_words long, n_removed long, kept string")
    return result.withColumnRenamed("key", key)
