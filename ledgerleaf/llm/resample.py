"""Importance resampling of documents towards a target text distribution.

Words and pairs of neighbouring words fall into a fixed number of buckets by their
CRC-32 (``crc_spans``: all spans of a batch at once). The share of a bucket in the
target texts over its share in the documents is its gain; a document weighs the mean
gain of its features. Adding Gumbel noise, drawn from the id alone, and taking the
highest scores draws documents without replacement in proportion to their weights.

Only bucket counts meet in the driver (``buckets`` rows, whatever the input). Texts
are read twice, once for the counts and once for the weights, and never shuffled; the
final order is cut by range, so no task ranks all documents.

Rows: a null or empty text has no features and weighs 0. A null ``doc_id`` draws the
noise of an empty id and comes last among equal scores. Repeated rows count and rank
each on their own; rows equal in all that is returned may swap ranks. Texts of any
length are read whole, in chunks of about a million bytes. Empty tables give no rows;
without target texts all gains favour rare buckets. Columns other than the id and the
text are ignored, whatever their names.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerleaf.llm.common import by_size
from ledgerleaf.llm.crc_spans import SpanCrc
from ledgerleaf.scratch import settle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(sys.modules[by_size.__module__])

SPACE = 0x20


@dataclass(frozen=True)
class Resampling:
    """``percent`` of the documents with ``min_words`` words or more are drawn."""

    buckets: int = 10_000
    percent: int = 25
    min_words: int = 20
    seed: int = 7


def _lowered() -> np.ndarray:
    codes = np.arange(256, dtype=np.uint8)
    codes[ord("A") : ord("Z") + 1] += 32
    return codes


def _of_words() -> np.ndarray:
    """Bytes of words, once A-Z are lowered: digits, a-z, and all beyond ASCII."""
    inside = np.zeros(256, dtype=bool)
    inside[ord("0") : ord("9") + 1] = inside[ord("a") : ord("z") + 1] = inside[0x80:] = True
    return inside


class Features:
    """Buckets of all words and word pairs of a batch of texts."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.crc = SpanCrc()
        self.lowered, self.of_words = _lowered(), _of_words()

    def _words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Words behind each other, one space after each; starts, ends and text numbers of them."""
        texts = texts.cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)
        offsets = offsets[texts.offset : texts.offset + len(texts) + 1]
        values = texts.buffers()[2]
        raw = np.frombuffer(values, dtype=np.uint8) if values else np.zeros(0, dtype=np.uint8)
        data = self.lowered[raw[offsets[0] : offsets[-1]]]
        offsets = offsets - offsets[0]
        inside = self.of_words[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        firsts = offsets[:-1][offsets[:-1] < len(data)]
        begins[firsts] = inside[firsts]
        where = np.flatnonzero(begins)
        number = np.cumsum(begins)[inside]
        kept = data[inside]
        packed = np.full(len(kept) + len(where), SPACE, dtype=np.uint8)
        packed[np.arange(len(kept)) + number - 1] = kept
        sizes = np.bincount(number, minlength=len(where) + 1)[1:]
        starts = np.cumsum(sizes + 1) - (sizes + 1)
        owners = np.searchsorted(offsets, where, side="right") - 1
        return packed, starts, starts + sizes, owners

    def _hashed(self, packed, starts, ends) -> np.ndarray:
        if not len(starts):
            return np.zeros(0, dtype=np.int64)
        return self.crc(packed, starts, ends).astype(np.int64) % self.buckets

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Number of words of each text, and features as (text numbers, buckets), in order of texts."""
        packed, starts, ends, owners = self._words(texts)
        found = [(owners, self._hashed(packed, starts, ends))]
        # Pairs overlap, so those that begin at even and at odd words take turns.
        left = np.flatnonzero(owners[:-1] == owners[1:])
        for turn in (0, 1):
            firsts = left[left % 2 == turn]
            found.append((owners[firsts], self._hashed(packed, starts[firsts], ends[firsts + 1])))
        return np.bincount(owners, minlength=len(texts)), found


def bucket_counts(texts: DataFrame, text: str, buckets: int) -> DataFrame:
    """bucket, n: how many features of all texts fall into a bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Features(buckets), np.zeros(buckets, dtype=np.int64)
        for batch in by_size(batches, "text"):
            for _, hashed in features(batch.column(0).fill_null(""))[1]:
                total += np.bincount(hashed, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(total[used])], ["bucket", "n"]
        )

    column = F.col(text).cast("string").alias("text")
    counts = texts.select(column).mapInArrow(count, "bucket int, n long")
    return counts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int, text: str = "text") -> DataFrame:
    """bucket, gain: thousandths of the log of the target's share over the documents' share."""
    own = bucket_counts(docs, text, buckets).withColumn("s", F.col("n")).withColumn("t", F.lit(0))
    theirs = bucket_counts(target, text, buckets).withColumn("s", F.lit(0)).withColumn("t", F.col("n"))
    every = docs.sparkSession.range(buckets).select(
        F.col("id").cast("int").alias("bucket"), *[F.lit(0).cast("long").alias(c) for c in "nst"]
    )
    counts = (
        own.unionByName(theirs)
        .unionByName(every)
        .groupBy("bucket")
        .agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    )
    totals = counts.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))

    def smoothed(n: str, more: int) -> Column:
        return F.col(n).cast("double") + F.lit(float(more))

    share = (smoothed("t", 1) * smoothed("all_s", buckets)) / (
        smoothed("s", 1) * smoothed("all_t", buckets)
    )
    return counts.join(F.broadcast(totals)).select(
        "bucket", F.floor(1000 * F.log(share)).alias("gain")
    )


def weigh(docs: DataFrame, gain: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight for each row; ``gain`` has one number for each bucket."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        features = Features(len(gain))
        for batch in by_size(batches, "text"):
            n_words, found = features(batch.column(1).fill_null(""))
            total = np.zeros(batch.num_rows, dtype=np.int64)
            for owners, hashed in found:
                upto = np.append(0, np.cumsum(gain[hashed]))
                edges = np.searchsorted(owners, np.arange(batch.num_rows + 1))
                total += upto[edges[1:]] - upto[edges[:-1]]
            n_features = np.maximum(2 * n_words - 1, 0)
            weight = total // np.maximum(n_features, 1)
            columns = [batch.column(0), *[pa.array(c) for c in (n_words, n_features, weight)]]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(weights, "doc_id long, n_words long, n_features long, weight long")


def gumbel(key: Column, seed: int) -> Column:
    """Thousandths of a Gumbel draw that follows from the seed and the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.left(digest, F.lit(8)), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def numbered(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """``df`` with its row numbers from 1 in ``order``, cut by range instead of in one task.

    Only the sizes of the ranges are added up; there are as many as partitions.
    """
    tie = F.monotonically_increasing_id()
    cut = df.withColumn("_tie", tie).repartitionByRange(*order, "_tie")
    placed = cut.sortWithinPartitions(*order, "_tie").drop("_tie")
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    stored = settle(
        placed.withColumn("_part", F.spark_partition_id()).withColumn("_inside", inside), "ranked"
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        stored.groupBy("_part")
        .agg(F.count("*").alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    )
    rank = (F.col("_before") + F.col("_inside") + 1).alias(out)
    return stored.join(F.broadcast(sizes), "_part").select(*df.columns, rank)


def resample(
    docs: DataFrame,
    target: DataFrame,
    plan: Resampling = Resampling(),
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of every document.

    ``rank`` counts from 1 in order of score, ties to smaller ids; it is null for
    documents that are not drawn.
    """
    rows = gains(docs, target, plan.buckets, text).toArrow()
    gain = np.zeros(plan.buckets, dtype=np.int64)
    gain[rows["bucket"].to_numpy()] = rows["gain"].to_numpy()
    weighed = weigh(docs, gain, key, text).withColumn(
        "score", F.col("weight") + gumbel(F.col("doc_id"), plan.seed)
    )
    stored = settle(weighed, "weights")
    long_enough = F.col("n_words") >= plan.min_words
    n = stored.where(long_enough).count()
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    ranked = numbered(stored.where(long_enough), order, "rank")
    drawn = F.when(F.col("rank") <= plan.percent * n // 100, F.col("rank"))
    others = stored.where(~long_enough).withColumn("rank", F.lit(None).cast("long"))
    return ranked.withColumn("rank", drawn).unionByName(others)
